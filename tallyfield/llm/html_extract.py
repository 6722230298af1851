"""Main text of web pages by a tree-structured graphical model.

The block elements of a page are the nodes of a tree; every node is content or not. A node's
own potential is a weighted sum of what it looks like (tag, names, length, links), every edge
between parent and child has a potential for the four cases. Sum-product messages, upward and
then downward, give each node's content marginal. All weights are learned from labelled pages
by the same messages.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm.common import bounded_sample, slices, table

# Elements of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose inside is no markup, and others that are never main text.
RAW = ("script", "style", "textarea", "iframe")
HIDDEN = ("svg", "object", "select", "noscript", "template")
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var br wbr img".split()
)
CLOSES_P = set(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead"}, "td": {"table", "tr"}, "th": {"table", "tr"}}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
MARK = re.compile(r"data-content=\"?([01])")
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Names that pages give to their parts, by kind.
KINDS = {
    "content": "article content main post entry story text body page copy prose document",
    "menu": "nav navigation menu navbar breadcrumb breadcrumbs tabs toc pagination pager skip",
    "advert": "ad ads advert advertisement adverts sponsor sponsored promo promotion banner outbrain taboola teaser",
    "comment": "comment comments reply replies discussion disqus respond thread reader",
    "foot": "footer foot copyright legal colophon contentinfo",
    "head": "header head masthead logo topbar site branding title",
    "side": "sidebar side aside related widget recommended share sharing social trending popular complementary tags meta more",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe paywall dialog toast warning",
    "form": "form search login signup signin register input contact",
}
KIND_OF = {name: kind for kind, names in KINDS.items() for name in names.split()}
TAGS = {
    "p": "p", "article": "article", "main": "main", "section": "section", "nav": "nav", "menu": "nav", "header": "header",
    "footer": "footer", "aside": "aside", "form": "form", "fieldset": "form", "button": "form", "dialog": "aside", "ul": "list",
    "ol": "list", "dl": "list", "li": "item", "dt": "item", "dd": "item", "div": "div", "blockquote": "quote", "pre": "quote",
    "figure": "figure", "figcaption": "figure", "table": "table", "tr": "table", "td": "cell", "th": "cell", "body": "body",
    "html": "html", "head": "headpart", "title": "headpart", **{f"h{i}": "heading" for i in range(1, 7)},
}

SAMPLE_PAGES, GENERATED_PAGES, EPOCHS = 150, 350, 80
SEED = 5


@dataclass
class Node:
    tag: str
    parent: int
    attributes: str = ""
    chars: int = 0
    linked: int = 0
    stops: int = 0


@dataclass
class Page:
    """Block elements in page order, and runs of text as (node, raw text)."""

    nodes: list[Node] = field(default_factory=list)
    runs: list[tuple[int, str]] = field(default_factory=list)


def _raw_end(source: str, tag: str, position: int) -> int:
    """End of a raw element that opens before ``position``.

    Script and style go on to the end of the page without a closing tag, as in browsers. The others
    are empty if nothing closes them before the next one opens.
    """
    found = re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*>", re.IGNORECASE)
    if tag in ("script", "style"):
        closing = next((m for m in found.finditer(source, position) if m.group(1)), None)
        return closing.end() if closing else len(source)
    following = found.search(source, position)
    return following.end() if following and following.group(1) else position


def _hidden_ends(source: str) -> dict[int, int]:
    """Ends of the hidden elements that are closed, by the place after their opening tag.

    Block elements end a drawing or a list of options that is still open, except in a foreignObject.
    """
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    places: dict[str, list[int]] = {}
    position = 0

    def cut(depth: int) -> None:
        while len(stack) > depth:
            places[stack.pop()[0]].pop()

    while found := TOKEN.search(source, position):
        position = found.end()
        closing, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        tag = (tag or "").lower()
        if tag in HIDDEN or tag == "foreignobject":
            if not closing:
                if not attributes.endswith("/"):
                    places.setdefault(tag, []).append(len(stack))
                    stack.append((tag, position))
                continue
            if places.get(tag):
                depth = places[tag][-1]
                ends[stack[depth][1]] = position
                cut(depth)
        elif tag in RAW and not closing:
            position = position if attributes.endswith("/") and tag not in ("script", "style") else _raw_end(source, tag, position)
        elif tag in CLOSES_P and tag != "hr" and not closing:
            while stack and stack[-1][0] in ("svg", "select"):
                cut(len(stack) - 1)
    return ends


def parsed(source: str) -> Page:
    """The block tree of a page, however broken its markup is."""
    page = Page([Node("#page", -1)])
    nodes, runs = page.nodes, page.runs
    # Open elements as (tag, node); inline ones share the node of the block around them. The places of
    # each tag, and of the blocks, save looking through the stack.
    stack = [("#page", 0)]
    places: dict[str, list[int]] = {}
    blocks: list[int] = []
    at, position = 0, 0
    waiting: list[str] = []
    hidden: dict[int, int] | None = None

    def flush() -> None:
        if waiting:
            runs.append((stack[-1][1], "".join(waiting)))
            waiting.clear()

    def add(text: str) -> None:
        if not text:
            return
        plain = entities.unescape(text) if "&" in text else text
        waiting.append(plain)
        size = len(plain.strip())
        if size:
            node = nodes[stack[-1][1]]
            node.chars += size
            node.linked += size if places.get("a") else 0
            node.stops += plain.count(".") + plain.count("!") + plain.count("?")

    def opened(tag: str, node: int) -> None:
        places.setdefault(tag, []).append(len(stack))
        if tag not in INLINE:
            blocks.append(len(stack))
        stack.append((tag, node))

    def last(tag: str) -> int:
        """The place of the last open element of a tag, 0 if there is none."""
        return places[tag][-1] if places.get(tag) else 0

    def close(depth: int) -> None:
        while len(stack) > depth:
            places[stack.pop()[0]].pop()
        while blocks and blocks[-1] >= depth:
            blocks.pop()

    end = len(source)
    while position < end:
        found = TOKEN.search(source, position)
        if found is None:
            break
        add(source[at : found.start()])
        at = position = found.end()
        closing, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            depth = last(tag)
            if tag in INLINE and blocks and blocks[-1] > depth:
                depth = 0
            if depth:
                if tag not in INLINE:
                    flush()
                close(depth)
            continue
        if tag in RAW:
            if tag in ("script", "style") or not attributes.endswith("/"):
                at = position = _raw_end(source, tag, position)
            continue
        if tag in HIDDEN:
            hidden = _hidden_ends(source) if hidden is None else hidden
            at = position = hidden.get(position, position)
            continue
        if tag in INLINE:
            if tag == "br":
                waiting.append(" ")
            elif tag not in VOID and not attributes.endswith("/"):
                opened(tag, stack[-1][1])
            continue
        flush()
        if tag in VOID:
            continue
        if tag in CLOSES_P:
            depth = last("p")
            if depth and blocks[-1] == depth:
                close(depth)
        sibling = max(map(last, SIBLINGS.get(tag, ())), default=0)
        if sibling and sibling >= max(map(last, SCOPES.get(tag, ())), default=0):
            close(sibling)
        nodes.append(Node(tag, stack[-1][1], attributes))
        opened(tag, len(nodes) - 1)
    if at < end:
        add(source[at:])
    flush()
    return page


def features(page: Page) -> list[list[str]]:
    """What each node looks like, as names."""
    out = []
    for node in page.nodes:
        here = [f"tag:{TAGS.get(node.tag, 'other')}"]
        if node.parent >= 0:
            here.append(f"under:{TAGS.get(page.nodes[node.parent].tag, 'other')}")
        if node.attributes:
            words = {w.lower() for groups in NAMES.findall(node.attributes) for g in groups if g for w in PIECES.findall(g)}
            here += sorted({f"kind:{KIND_OF[w]}" for w in words if w in KIND_OF})
        size = "none" if not node.chars else "tiny" if node.chars < 25 else "short" if node.chars < 80 else "middle" if node.chars < 250 else "long"
        here.append(f"size:{size}")
        if node.chars:
            share = node.linked / node.chars
            here.append("links:none" if share == 0 else "links:some" if share < 0.5 else "links:most")
            if node.stops:
                here.append("stops")
        out.append(here)
    return out


def marginals(scores: list[float], parents: list[int], edge: list[list[float]]) -> tuple[list[float], list[list[float]]]:
    """Content marginal of every node by sum-product, and the expected number of edges of each case.

    Parents come before their children; ``edge[p][c]`` is the log potential of parent p, child c.
    """
    n = len(scores)
    e = [[math.exp(x) for x in row] for row in edge]
    (e00, e01), (e10, e11) = e
    b1 = [1 / (1 + math.exp(-max(-30.0, min(30.0, s)))) for s in scores]
    b0 = [1 - x for x in b1]
    u0, u1 = [0.5] * n, [0.5] * n
    for i in range(n - 1, 0, -1):
        p, x0, x1 = parents[i], b0[i], b1[i]
        m0, m1 = x0 * e00 + x1 * e01, x0 * e10 + x1 * e11
        z = m0 + m1
        u0[i], u1[i] = m0 / z, m1 / z
        x0, x1 = b0[p] * u0[i], b1[p] * u1[i]
        z = x0 + x1
        b0[p], b1[p] = x0 / z, x1 / z
    belief0, belief1 = b0[:], b1[:]
    cases = [[0.0, 0.0], [0.0, 0.0]]
    for i in range(1, n):
        p = parents[i]
        c0, c1 = belief0[p] / u0[i], belief1[p] / u1[i]
        q00, q01, q10, q11 = c0 * e00 * b0[i], c0 * e01 * b1[i], c1 * e10 * b0[i], c1 * e11 * b1[i]
        z = q00 + q01 + q10 + q11
        cases[0][0] += q00 / z
        cases[0][1] += q01 / z
        cases[1][0] += q10 / z
        cases[1][1] += q11 / z
        belief0[i], belief1[i] = max((q00 + q10) / z, 1e-300), max((q01 + q11) / z, 1e-300)
    return belief1, cases


@dataclass
class Model:
    weights: dict[str, float]
    edge: list[list[float]]

    def content(self, page: Page) -> list[float]:
        get = self.weights.get
        scores = [sum([get(f, 0.0) for f in here]) for here in features(page)]
        return marginals(scores, [n.parent for n in page.nodes], self.edge)[0]

    def text(self, source: str | None) -> str:
        """The content blocks of a page, in page order, with an empty line between two."""
        page = parsed(source or "")
        wanted = self.content(page)
        blocks = [" ".join(raw.split()) for node, raw in page.runs if wanted[node] >= 0.5]
        return "\n\n".join([b for b in blocks if b])


def fit(labelled: list[tuple[Page, list[int]]], epochs: int = EPOCHS) -> Model:
    """Weights by Adam on the likelihood of the labels; its gradient is observed less expected counts."""
    prepared = [(features(p), [n.parent for n in p.nodes], y) for p, y in labelled]
    names = sorted({f for fs, _, _ in prepared for here in fs for f in here})
    number = {f: i for i, f in enumerate(names)}
    prepared = [([[number[f] for f in here] for here in fs], parents, y) for fs, parents, y in prepared]
    total = max(1, sum(len(y) for *_, y in prepared))
    w = np.zeros(len(names) + 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, epochs + 1):
        g = 0.0005 * w
        for ids, parents, y in prepared:
            scores = [float(sum(w[i] for i in here)) for here in ids]
            edge = [[w[-4], w[-3]], [w[-2], w[-1]]]
            p, cases = marginals(scores, parents, edge)
            for here, a, b in zip(ids, p, y, strict=True):
                for i in here:
                    g[i] += (a - b) / total
            for a in (0, 1):
                for b in (0, 1):
                    g[-4 + 2 * a + b] += cases[a][b] / total
            for i in range(1, len(y)):
                g[-4 + 2 * y[parents[i]] + y[i]] -= 1 / total
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.3 * m / (1 - 0.9**t) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Model(dict(zip(names, w[:-4].tolist(), strict=True)), [w[-4:-2].tolist(), w[-2:].tolist()])


def marked_labels(page: Page) -> list[int]:
    """Labels of a page whose elements say them in data-content; others have their parent's."""
    labels: list[int] = []
    for node in page.nodes:
        said = MARK.search(node.attributes)
        labels.append(int(said.group(1)) if said else labels[node.parent] if node.parent >= 0 else 0)
    return labels


def article_labels(page: Page) -> list[int] | None:
    """Labels of a page that marks its article by one ``article`` element, else None."""
    if sum(n.tag == "article" for n in page.nodes) != 1:
        return None
    labels: list[int] = []
    for node in page.nodes:
        inside = node.tag == "article" or (node.parent >= 0 and labels[node.parent] == 1)
        labels.append(int(inside and node.tag not in ("nav", "aside", "footer", "form", "header")))
    return labels


def generated_page(rng: random.Random) -> str:
    """A made-up page in one of several layouts; data-content says which elements are content."""
    syllables = "ta re mi no ka lo ve du si ra pel gor ith an es ul".split()

    def word() -> str:
        return "".join(rng.choices(syllables, k=rng.randint(1, 3)))

    def words(low: int, high: int) -> str:
        return " ".join(word() for _ in range(rng.randint(low, high)))

    def sentences(low: int, high: int) -> str:
        return " ".join(words(4, 14).capitalize() + rng.choice("...!?") for _ in range(rng.randint(low, high)))

    def name(kind: str) -> str:
        chosen = rng.choice(KINDS[kind].split())
        style = rng.choice(('class="{}"', 'id="{}"', 'class="{} wide"', 'class="x-{}"', 'class="{}-block"'))
        return style.format(chosen)

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(n))

    def off(tag: str, kind: str, inside: str) -> str:
        plain = rng.random() < 0.3 and tag != "div"
        return f'<{tag} {"" if plain else name(kind)} data-content="0">{inside}</{tag}>'

    def paragraph() -> str:
        text = sentences(1, 6) if rng.random() < 0.85 else words(1, 5) + "."
        if rng.random() < 0.2:
            text = f"<b>{text}"
        if rng.random() < 0.3:
            text += f' <a href="#">{words(1, 3)}</a> {words(2, 8)}.'
        return f"<p>{text}" + rng.choice(("</p>", "</p>", "<br>"))

    def comments() -> str:
        one = "".join(f'<div class="{rng.choice(("comment", "reply"))}"><p>{sentences(1, 3)}</p></div>' for _ in range(rng.randint(1, 4)))
        return off(rng.choice(("section", "div", "ul")), "comment", f"<h3>{words(1, 2)}</h3>{one}")

    inner = f"<h1>{words(2, 9)}</h1>" + "".join(paragraph() for _ in range(rng.choice((1, 1, 2, 3, 5, 7, 9))))
    if rng.random() < 0.3:
        inner += f"<h2>{words(1, 5)}</h2>{paragraph()}"
    if rng.random() < 0.25:
        inner += "<ul>" + "".join(f"<li>{sentences(1, 1)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
    if rng.random() < 0.15:
        inner += f"<blockquote><p>{sentences(1, 3)}</p></blockquote>"
    if rng.random() < 0.15:
        inner += off("aside", "side", f"<ul>{links(3)}</ul>")
    if rng.random() < 0.15:
        inner += off("div", "advert", sentences(1, 2))
    if rng.random() < 0.15:
        inner += comments()
    shell = rng.random()
    if shell < 0.45:
        article = f'<article data-content="1">{inner}</article>'
    elif shell < 0.65:
        article = f'<main data-content="1">{inner}</main>'
    else:
        article = f'<div {name("content")} data-content="1">{inner}</div>'
    before = [off("nav", "menu", f"<ul>{links(rng.randint(2, 8))}</ul>")] * (rng.random() < 0.9)
    before += [off("header", "head", f"<p>{words(1, 5)}</p>")] * (rng.random() < 0.5)
    before += [off("div", "notice", f"<p>{sentences(1, 2)}</p>")] * (rng.random() < 0.4)
    before += [off("div", "advert", sentences(1, 3))] * (rng.random() < 0.6)
    before += [off("form", "form", f"<p>{words(1, 6)}</p><button>{word()}</button>")] * (rng.random() < 0.3)
    after = [off(rng.choice(("aside", "div")), "side", f"<h3>{words(1, 2)}</h3><ul>{links(4)}</ul><p>{sentences(1, 2)}</p>")] * (rng.random() < 0.5)
    after += [comments()] * (rng.random() < 0.35)
    after += [off("footer", "foot", f"&copy; {words(2, 6)} &middot; {sentences(1, 1)}")] * (rng.random() < 0.9)
    rng.shuffle(before)
    rng.shuffle(after)
    wrapped = f'<div class="wrapper">{"".join(before)}{article}{"".join(after)}</div>' if rng.random() < 0.3 else "".join([*before, article, *after])
    return f"<!DOCTYPE html><html><head><title>{words(2, 8)}</title></head><body>{wrapped}</body></html>"


def trained(sources: list[str]) -> Model:
    """A model from generated pages and from those of the given ones that mark their article."""
    rng = random.Random(SEED)
    pages = [parsed(generated_page(rng)) for _ in range(GENERATED_PAGES)]
    labelled = [(p, marked_labels(p)) for p in pages]
    given = [parsed(s) for s in sources]
    labelled += [(p, y) for p, y in ((p, article_labels(p)) for p in given if len(p.nodes) < 500) if y is not None]
    return fit(labelled)


def trained_on(pages: DataFrame) -> Model:
    """A model trained with a bounded sample (``SAMPLE_PAGES``) of the pages."""
    sample = bounded_sample(pages.select("page_id", "html"), "page_id", SAMPLE_PAGES)
    return trained([r["html"] or "" for r in sample.select(F.col("html").cast("string").alias("html")).collect()])


def extracted(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html).

    Null, empty and tag-only pages have an empty text; text without any tags is judged like a
    page of one block. Repeated rows give repeated rows. An empty table gives an empty table;
    the model then knows generated pages only. Further columns are ignored.
    """
    given = model or trained_on(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            texts = [given.text(source) for source in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
