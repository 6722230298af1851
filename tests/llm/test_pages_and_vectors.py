"""WARC round trips, extraction and lattice links."""

import base64
import gzip
import hashlib
import itertools
import random
import time
from collections import Counter

import numpy as np
import pytest
from tallyfield.llm import html_extract, lattice_dedup, warc
from tallyfield.llm.components import connected_components

PAGES = [
    (1, "http://a/\r\nx", "<p>same</p>"), (2, "http://b", "<p>same</p>"), (3, None, None), (4, "u", ""), (None, "v", "<p>same</p>"),
    (5, "w", "é" * 200_000 + "\r\n\r\nWARC/1.1"), (2, "http://b", "<p>same</p>"), (6, "x", "alone"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)


def test_archives_round_trip(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 500)
    made = warc.archives(pages).collect()
    assert len(made) > 1
    for row in made:
        (tmp_path / row["archive"]).write_bytes(row["content"])
        assert gzip.decompress(row["content"]).startswith(b"WARC/1.1\r\n")
    files = spark.read.format("binaryFile").load(str(tmp_path)).select("content")
    found = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.records(files).collect())
    best = {}
    for i, _, h in PAGES:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    wanted = Counter()
    for i, _, h in PAGES:
        data = (h or "").encode()
        revisit = (-1 if i is None else i) < best[h or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        wanted[(i, len(data), digest, "revisit" if revisit else "response", best[h or ""] if revisit else None)] += 1
    assert found == wanted
    payloads = {r["page_id"]: bytes(r["payload"]) for r in warc.records(files).collect() if r["payload"] is not None}
    assert payloads[5] == PAGES[5][2].encode()


def test_small_payloads_refer_to_nothing(pages):
    assert all(r["record_type"] == "response" for r in warc.records(warc.archives(pages, min_bytes=10**9)).collect())


@pytest.mark.parametrize("size", [1, 7, 1 << 16])
def test_reader_takes_any_pieces(size):
    data = warc.record(1, "u", b"one", warc.sha1_32(b"one"), None, False) + warc.record(2, "u", b"", warc.sha1_32(b""), None, False)
    got = list(warc.read_records(data[i : i + size] for i in range(0, len(data), size)))
    assert [warc.payload_of(block) for _, block in got] == [b"one", b""]


def test_reader_refuses_damage():
    good = warc.record(1, "u", b"payload", warc.sha1_32(b"payload"), None, False)
    forged = warc.record(1, "u", b"payload", warc.sha1_32(b"other"), None, False)
    for bad in (good[:-12], good[:40] + b"\0\0" + good[42:], forged, gzip.compress(b"no record\r\n\r\n")):
        with pytest.raises(ValueError):
            list(warc.read_records([bad]))


def test_marginals_are_exact():
    scores, parents, edge = [0.3, -1.0, 0.8, 0.1], [-1, 0, 0, 2], [[0.5, -0.2], [-0.4, 0.9]]
    weight = {}
    for state in np.ndindex(2, 2, 2, 2):
        z = sum(s for s, y in zip(scores, state) if y) + sum(edge[state[parents[i]]][state[i]] for i in range(1, 4))
        weight[state] = np.exp(z)
    total = sum(weight.values())
    got, cases = html_extract.marginals(scores, parents, edge)
    assert got == pytest.approx([sum(w for s, w in weight.items() if s[i]) / total for i in range(4)])
    assert sum(map(sum, cases)) == pytest.approx(3)


@pytest.fixture(scope="module")
def model():
    return html_extract.trained([])


def test_extraction_of_unseen_layouts(model):
    rng = random.Random(99)
    right = wrong = missed = 0
    for _ in range(100):
        page = html_extract.parsed(html_extract.generated_page(rng))
        for node, label, p in zip(page.nodes, html_extract.marked_labels(page), model.content(page), strict=True):
            right += node.chars * (label and p >= 0.5)
            wrong += node.chars * (not label and p >= 0.5)
            missed += node.chars * (label and p < 0.5)
    assert right / (right + wrong) > 0.97 and right / (right + missed) > 0.95


def test_text_of_a_page(model):
    page = (
        "<html><head><title>No</title><script>var t='<p>';</script></head><body><nav><ul><li><a href=/>Menu</a></li></ul></nav>"
        "<!-- <p>hidden</p> --><div class='ad'>Buy things now.</div><article><h1>Title &amp;\n more</h1><p><b>First  &lt;b&gt; text.<br>"
        "<p>Second paragraph, with a sentence. And one more.</p></article><div class='comments'><p>I liked this one.</p></div><footer>&copy; me</footer>"
    )
    assert model.text(page) == "Title & more\n\nFirst <b> text.\n\nSecond paragraph, with a sentence. And one more."


@pytest.mark.parametrize("before", [
    "<svg class=icon/>", "<svg class='icon' />", "<svg><path d='M0'>", "<select><option>One<option>Two", "<object data=x>", "<object data=x />",
    "<noscript>", "<template>", "<iframe src=x>", "<iframe src=x />", "<textarea>", "<svg><path d='M0'/><svg><text>No</text></svg>",
])
@pytest.mark.parametrize("after", ["", "<svg><text>No</text></svg><select><option>No</select><iframe>No</iframe><object>No</object><textarea>No</textarea>"])
def test_unclosed_elements_cut_nothing(before, after):
    page = f"<html><body><div>{before}</div><article><h1>Title</h1><p>First text, with a sentence.</p></article><footer>{after}Foot</footer></body></html>"
    text = " ".join(raw for _, raw in html_extract.parsed(page).runs)
    assert "Title" in text and "First text, with a sentence." in text and "Foot" in text and "No" not in text


def test_closed_elements_are_dropped_whole():
    page = (
        "<p>a</p><svg><svg><text>No</text></svg><text>No</text></svg><p>b</p><svg><foreignObject><p>No</p></foreignObject></svg>"
        "<object>No<object>No</object>No</object><noscript><p>No</p></noscript><script>'<svg>'</script><p>c</p><!-- <svg> --><p>d</p>"
    )
    assert [raw for _, raw in html_extract.parsed(page).runs] == ["a", "b", "c", "d"]


def test_odd_pages(spark, model):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (3, "v", "<<p<"), (4, "w", "<div>" * 3000), (None, "x", "</p></b>")], "page_id long, url string, html string")
    rows = html_extract.extracted(pages, model).collect()
    assert len(rows) == 5 and all(r["n_chars"] == len(r["text"]) for r in rows)


@pytest.mark.parametrize("part", ["<div>", "<b></i>", "<ul><li><b>", "<svg></g><foreignObject>", "<p><em>", "<!x", "<iframe>"])
def test_time_to_parse_grows_with_the_page(part):
    start = time.process_time()
    html_extract.parsed(part * 60_000)
    # Looking through all open elements for each would take minutes.
    assert time.process_time() - start < 20


def test_points_are_of_the_lattice_and_nearest():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (300, 8))
    near, other = both = lattice_dedup.e8_points(x)
    for points in both:
        assert ((points % 2).min(axis=1) == (points % 2).max(axis=1)).all() and (points.sum(axis=1) % 4 == 0).all()
    gap = ((x - near / 2) ** 2).sum(axis=1)
    assert (gap <= 1 + 1e-9).all() and (gap <= ((x - other / 2) ** 2).sum(axis=1) + 1e-9).all()


def test_links_of_vectors(spark, monkeypatch):
    monkeypatch.setattr(lattice_dedup, "BLOCK_ROWS", 4)
    monkeypatch.setattr(lattice_dedup, "GROUP_ROWS", 16)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 64))
    near = [x[k] + rng.normal(0, 0.02, 64) for k in (0, 0, 0, 0, 0, 0, 0, 1, 1, 2)]
    same = [x[5], x[5], 3 * x[6]]
    vectors = [list(map(float, v)) for v in [*x, *near, *same]]
    rows = [(i, v) for i, v in enumerate(vectors)]
    odd = [(100, None), (101, [0.0] * 64), (102, [float("nan")] * 64), (103, [None] * 64), (104, []), (105, [1.0, 0.0]), (106, [2.0, 0.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(3)
    found = {r["vec_id"]: r for r in lattice_dedup.near_duplicates(df).collect()}
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = unit @ unit.T >= 0.9
    assert [found[i]["n_links"] for i in range(len(rows))] == (links.sum(axis=1) - 1).tolist()
    assert all(found[i]["component_id"] == int(np.flatnonzero(links[i]).min()) for i in range(len(rows)))
    assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i in range(100, 105))
    assert found[106]["component_id"] == 105 and found[106]["n_links"] == 1


def meet(a, b, size):
    """Whether the index for so many vectors brings the rows of a and b together."""
    tables, blocks = lattice_dedup.layout(size)
    rows = np.arange(len(a))
    met = np.zeros(len(a), bool)
    for t in range(tables):
        cells = [np.concatenate(x) for x in zip(lattice_dedup.cells(a, t, blocks), lattice_dedup.cells(b, t, blocks), strict=True)]
        met |= lattice_dedup._shared(*cells, rows, rows + len(a)) < lattice_dedup.NONE
    return met


def pairs_of(seed, n, low, high):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(n, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    v = rng.normal(size=a.shape)
    v -= (v * a).sum(axis=1, keepdims=True) * a
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    cosines = rng.uniform(low, high, n)[:, None]
    return a, cosines * a + np.sqrt(1 - cosines**2) * v


SIZES = [most for most, _, _ in lattice_dedup.LAYOUTS]


@pytest.mark.parametrize("size", SIZES)
def test_recall_of_the_index(size):
    assert meet(*pairs_of(1, 2000, 0.9, 1), size).mean() >= 0.9


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize(("low", "high"), [(0.9, 0.901), (0.9, 0.91), (0.91, 0.92), (0.92, 0.93)])
def test_recall_at_the_threshold(low, high, size):
    assert meet(*pairs_of(2, 3000, low, high), size).mean() >= 0.99


def test_links_equal_brute_force(spark, monkeypatch):
    """Groups of near copies of many sizes, in cells compared whole and in blocks."""
    monkeypatch.setattr(lattice_dedup, "BLOCK_ROWS", 16)
    monkeypatch.setattr(lattice_dedup, "GROUP_ROWS", 300)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 32))
    x = np.concatenate([c + rng.normal(0, 0.2, (n, 32)) for c, n in zip(centres, [1, 2, 3, 5, 8, 13, 21, 34, 55, 2, 1, 1], strict=True)])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= lattice_dedup.THRESHOLD
    assert 50 < near.sum() - len(x) < near.size / 4
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    got = {r["vec_id"]: r["n_links"] for r in lattice_dedup.near_duplicates(df).collect()}
    missed = sum((near[i].sum() - 1) - got[i] for i in range(len(x)))
    assert all(got[i] <= near[i].sum() - 1 for i in range(len(x)))
    assert missed <= 0.01 * (near.sum() - len(x))


def test_probed_points_are_the_second_nearest():
    x = np.random.default_rng(4).normal(0, 1, (200, 8))
    near, other = lattice_dedup.e8_points(x)
    whole = [p for p in itertools.product((-2, 0, 2), repeat=8) if sum(map(abs, p)) == 4]
    roots = np.array(whole + [p for p in itertools.product((-1, 1), repeat=8) if sum(p) % 4 == 0])
    far = (((near[:, None] + roots) / 2 - x[:, None]) ** 2).sum(axis=2).min(axis=1)
    assert len(roots) == 240 and np.allclose(((other / 2 - x) ** 2).sum(axis=1), far)


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(40, 41), (41, 40), (42, 42), (None, 3)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({found[i] for i in range(31)}) == 1 and found[40] == found[41] != found[0] and 42 not in found
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("run", "schema"), [
    (lambda d: warc.records(warc.archives(d)), "page_id long, url string, html string"),
    (html_extract.extracted, "page_id long, url string, html string"),
    (lattice_dedup.near_duplicates, "vec_id long, embedding array<float>"),
])
def test_empty_tables(spark, run, schema):
    assert run(spark.createDataFrame([], schema)).count() == 0
