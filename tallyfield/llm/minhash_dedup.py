"""Near-duplicate documents by SetSketch registers.

A document's set holds its distinct five-word shingles. The sketch keeps, per register, the
smallest of exponential hash values over the set, on an exponentially spaced scale of base
``BASE`` and truncated to the scale's ends: ``floor(1 - log_b(minimum))``. Registers of a union
are the larger of both registers, and two sets agree in a register with a probability close to
their Jaccard similarity. Bands of registers give candidates; the similarity of a candidate is
estimated from the counts of larger, smaller and equal registers by likelihood, and pairs that
may reach the threshold are verified on their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm.common import checkpoint, slices, stored, table
from tallyfield.llm.components import connected_components

SHINGLE = 5
BASE = 1.01
BANDS, ROWS = 20, 5
# Scale: minima of up to 10^12 elements stay within a register's 16 bits.
LARGEST = 4000
# Pairs whose estimate lies this far below the threshold are not verified: four standard errors
# of an estimate of 0.85 from 100 registers.
MARGIN = 0.15
# Nodes of one bucket that a task compares with each other at once, and rows per group of buckets.
BLOCK_ROWS, GROUP_ROWS = 1024, 2000
THRESHOLD = 85
# Elements in one numpy step.
BLOCK = 4096


class _Words(dict):
    """Word to hash, forgotten when it grows beyond a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FACTORS = _mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_REGISTERS = _mixed(np.arange(101, 101 + BANDS * ROWS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(text: str | None, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    if len(w) < SHINGLE:
        return _mixed(np.array([(w * _FACTORS[: len(w)]).sum() + np.uint64(len(w))], np.uint64))
    n = len(w) - SHINGLE + 1
    total = w[:n] * _FACTORS[0]
    for i in range(1, SHINGLE):
        total += w[i : i + n] * _FACTORS[i]
    return np.unique(_mixed(total))


def registers(found: np.ndarray) -> np.ndarray:
    """The sketch of a set that is not empty."""
    least = np.full(len(_REGISTERS), np.iinfo(np.uint64).max)
    for start in range(0, len(found), BLOCK):
        block = found[start : start + BLOCK, None] * _REGISTERS[None, :]
        np.minimum(least, (block ^ (block >> np.uint64(32))).min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 1) / 2.0**64
    level = np.floor(1 - np.log(-np.log1p(-np.minimum(uniform, 1 - 1e-16))) / np.log(BASE))
    return np.clip(level + 300, 0, LARGEST).astype("<u2")


_SKETCH = "doc_id long, text_key long, n_shingles long, node binary, registers binary"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Words()
    for batch in slices(batches):
        counts, nodes, sketches = [], [], []
        for text in batch.column("text").to_pylist():
            found = shingles(text, hashes)
            counts.append(len(found))
            nodes.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            sketches.append(registers(found).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()), pa.array(sketches, pa.binary())],
            names=["doc_id", "text_key", "n_shingles", "node", "registers"],
        )


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, node, registers): node is a 128-bit fingerprint of the whole set, null for an empty one."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(_sketch, _SKETCH)


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _Words()
    for batch in slices(batches):
        sets = [shingles(t, hashes) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                batch.column("wanted"),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ],
            names=["node", "wanted", "items"],
        )


def similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard similarity of each pair of sketches (rows), given the set sizes."""
    larger, smaller = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - larger - smaller
    u = (n_a / (n_a + n_b))[:, None]
    grid = np.linspace(0, 1, 201)[None, :] * np.minimum(u / (1 - u), (1 - u) / u)

    def beyond(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up = np.clip(beyond(u - (1 - u) * grid), 1e-9, 1)
    down = np.clip(beyond((1 - u) - u * grid), 1e-9, 1)
    equal = np.clip(1 - up - down, 1e-9, 1)
    score = larger[:, None] * np.log(up) + smaller[:, None] * np.log(down) + same[:, None] * np.log(equal)
    return np.take_along_axis(grid, score.argmax(axis=1)[:, None], 1)[:, 0]


def _likely(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2048):
        def stack(name: str) -> np.ndarray:
            return np.frombuffer(b"".join(batch.column(name).to_pylist()), "<u2").reshape(batch.num_rows, -1).astype(np.int32)

        n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
        keep = similarity(stack("r_a"), stack("r_b"), n_a, n_b) >= least
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) of nodes with 100 * intersection >= threshold * union."""
    known = nodes.select("node", "n_shingles", "registers")
    for side in "ab":
        known_side = known.toDF(side, f"n_{side}", f"r_{side}")
        pairs = pairs.join(known_side, side)
    # Sizes alone bound the similarity.
    pairs = pairs.where(100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b"))
    least = threshold / 100 - MARGIN
    likely = pairs.mapInArrow(lambda it: _likely(it, least), "a binary, b binary")
    for side in "ab":
        likely = likely.join(sets.toDF(side, f"s_{side}"), side)
    both = F.size(F.array_intersect("s_a", "s_b"))
    matched = likely.select("a", "b", both.alias("i"), (F.size("s_a") + F.size("s_b") - both).alias("u"))
    return matched.where(100 * F.col("i") >= threshold * F.col("u")).select("a", "b")


def _band_keys(sketches: np.ndarray) -> np.ndarray:
    """One number per sketch and band."""
    parts = sketches.reshape(len(sketches), BANDS, ROWS).astype(np.uint64)
    return (parts * _FACTORS[None, None, :ROWS] ** np.uint64(3)).sum(axis=2)


def _linked(group: pa.Table, threshold: int) -> pa.Table:
    """Verified edges that join different components within some buckets, or pairs of blocks of buckets.

    A pair that shares several buckets is looked at in the one of its first band. Pairs that
    earlier edges have joined already are left out, so that there are fewer edges than rows.
    """
    names = group.column("node").to_pylist()
    number = {name: k for k, name in enumerate(dict.fromkeys(names))}
    node = np.array([number[name] for name in names])
    first = np.unique(node, return_index=True)[1]
    some = group.take(pa.array(first)).combine_chunks()
    sketches = np.frombuffer(b"".join(some.column("registers").to_pylist()), "<u2").reshape(len(first), -1)
    sizes = some.column("n_shingles").to_numpy()
    bands = _band_keys(sketches)
    lists = some.column("items").chunk(0)
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
    roots: dict = {}
    above = {}
    component = [roots.setdefault(r, len(roots)) for r in some.column("root").to_pylist()]

    def top(x: int) -> int:
        while (y := above.get(x, x)) != x:
            above[x] = above.get(y, y)
            x = y
        return x

    key, low, high, part, band = (group.column(c).to_numpy() for c in ("key", "low", "high", "part", "band"))
    order = np.lexsort((high, low, key))
    new = (np.diff(key[order]) != 0) | (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
    edges = []
    own = np.array(component)
    for rows in np.split(order, np.flatnonzero(new) + 1):
        one, other = low[rows[0]], high[rows[0]]
        left = node[rows[part[rows] == one]]
        right = left if one == other else node[rows[part[rows] == other]]
        for start in range(0, len(left), 256):
            here = left[start : start + 256]
            open_ = own[here][:, None] != own[right][None, :]
            for t in range(band[rows[0]]):
                open_ &= bands[here, t][:, None] != bands[right, t][None, :]
            a, b = sizes[here][:, None], sizes[right][None, :]
            open_ &= 100 * np.minimum(a, b) >= threshold * np.maximum(a, b)
            if one == other:
                open_ &= here[:, None] < right[None, :]
            i, j = np.nonzero(open_)
            i, j = here[i], right[j]
            for at in range(0, len(i), 4096):
                x, y = i[at : at + 4096], j[at : at + 4096]
                guess = similarity(sketches[x].astype(np.int32), sketches[y].astype(np.int32), sizes[x].astype(float), sizes[y].astype(float))
                likely = np.flatnonzero(guess >= threshold / 100 - MARGIN)
                for k in likely[np.argsort(-guess[likely], kind="stable")]:
                    p, q = int(x[k]), int(y[k])
                    if top(component[p]) == top(component[q]):
                        continue
                    both = len(np.intersect1d(values[offsets[p] : offsets[p + 1]], values[offsets[q] : offsets[q + 1]], assume_unique=True))
                    if 100 * both >= threshold * (sizes[p] + sizes[q] - both):
                        above[top(component[p])] = top(component[q])
                        edges.append((p, q))
    back = list(number)
    return pa.table({
        "a": pa.array([back[p] for p, _ in edges], pa.binary()), "b": pa.array([back[q] for _, q in edges], pa.binary()),
    })


def _across(rest: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Edges between components that share a bucket; ``rest`` has key, band, node and root."""
    sizes = stored(rest.groupBy("key").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks")))
    members = rest.join(sizes, "key").select("key", "band", "node", "root", "blocks")
    members = members.withColumn("part", F.pmod(F.xxhash64("node", "key"), F.col("blocks")))
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("key", "band", "node", "root", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    dealt = checkpoint(dealt)
    groups = max(1, dealt.count() // GROUP_ROWS)
    dealt = dealt.withColumn("task", F.pmod(F.xxhash64("key", "low", "high"), F.lit(groups)))
    full = dealt.join(nodes.select("node", "n_shingles", "registers"), "node").join(sets, "node")
    return full.groupBy("task").applyInArrow(lambda group: _linked(group, threshold), "a binary, b binary")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_key) for every row of ``docs`` (doc_id, text).

    ``threshold`` is a similarity in per cent. component_id is the smallest doc_id reachable by
    links. Null, empty and blank texts have no shingles and link with nothing. Rows with a null
    doc_id link with nothing either: component_id is null and kept is true. Repeated rows have
    equal sets, so they share a component, and all rows of its smallest id are kept. An empty
    table gives an empty table; further columns are ignored. text_key is a hash of the text.

    Equal sets are one node of the graph, so copies cost nothing. In every bucket (band and
    value) all nodes are first compared with the smallest and the largest node. Buckets of
    more than three nodes that then still hold several components are compared in full between
    the components, in pairs of blocks of bounded size, so no pair is left out. A task returns
    only edges that join components, so a large group of near copies does not become all its
    pairs.
    """
    rows = stored(sketch(docs))
    linked = rows.where(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
    nodes = linked.groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies"),
        F.min("n_shingles").alias("n_shingles"), F.min("registers").alias("registers"),
    )
    nodes = stored(nodes)
    bands = [F.xxhash64(F.lit(i), F.substring("registers", 2 * ROWS * i + 1, 2 * ROWS)) for i in range(BANDS)]
    keyed = nodes.select("node", "first_id", F.posexplode(F.array(*bands)).alias("band", "key"))
    # Sizes are summed in every task and stored, so that Spark can split the rows of a large bucket in the join.
    buckets = keyed.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("low"), F.max("node").alias("high"))
    shared = stored(keyed.join(stored(buckets.where("size > 1")), "key"))

    wanted = shared.select("node", "first_id").distinct().select(F.col("first_id").alias("doc_id"), F.col("node").alias("wanted"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = texts.join(wanted, "doc_id").select("wanted", "text")
    sets = sets.mapInArrow(_full_sets, "node binary, wanted binary, items array<long>").where("node = wanted").select("node", "items")
    # Rows that repeat an id and a text give one set.
    repeated = checkpoint(linked.groupBy("doc_id", "node").count().where("count > 1").select("node").distinct())
    if not repeated.isEmpty():
        sets = stored(sets)
        once = sets.join(repeated, "node", "left_semi").dropDuplicates(["node"])
        sets = sets.join(repeated, "node", "left_anti").union(once)
    sets = stored(sets)

    def star(end: str) -> DataFrame:
        return shared.where(f"node <> {end}").select(F.least("node", end).alias("a"), F.greatest("node", end).alias("b"))

    first = star("low").union(star("high")).distinct()
    edges = checkpoint(_verified(first, nodes, sets, threshold))
    labels = connected_components(edges)

    rest = shared.where("size > 3").select("key", "band", "node").join(labels, "node", "left")
    rest = rest.select("key", "band", "node", F.coalesce("root", "node").alias("root"))
    rest = stored(rest)
    mixed = rest.groupBy("key").agg(F.min("root").alias("main"), F.max("root").alias("last")).where("main <> last")
    rest = stored(rest.join(stored(mixed.select("key")), "key").select("key", "band", "node", "root"))
    if not rest.isEmpty():
        edges = edges.union(checkpoint(_across(rest, nodes, sets, threshold)))
        labels = connected_components(edges)

    smallest = labels.join(nodes.select("node", "first_id"), "node").groupBy("root").agg(F.min("first_id").alias("component_id"))
    joined = labels.join(smallest, "root").select("node", "component_id")
    alone = nodes.where("copies > 1").join(joined, "node", "left_anti").select("node", F.col("first_id").alias("component_id"))
    found = joined.union(alone)
    result = linked.join(found, "node", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "text_key")
    others = rows.where(F.col("node").isNull() | F.col("doc_id").isNull())
    result = result.union(others.select("doc_id", "n_shingles", "doc_id", "text_key"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return result.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "text_key")


def deduplicated(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``docs``, with all columns, less the near duplicates: the smallest doc_id of a group stays.

    Documents that link with nothing stay, those without words or id included. Of rows equal
    in id and text, one stays if they have words.
    """
    found = stored(near_duplicates(docs, threshold))
    known = found.where("doc_id is not null")
    keys = ("doc_id", "text_key")
    key_of = (F.col("doc_id").cast("long").alias("_id"), F.xxhash64(F.col("text").cast("string")).alias("_key"))

    def matching(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        named = ids.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
        packed = rows.select(F.struct("*").alias("doc"), *key_of)
        return packed.join(named, ["_id", "_key"], how)

    left = matching(docs, known.where("not kept").select(*keys), "left_anti").select("doc.*")
    repeated = known.where("kept and n_shingles > 0").groupBy(*keys).count().where("count > 1")
    if repeated.isEmpty():
        return left
    once = matching(left, repeated, "left_semi").dropDuplicates(["_id", "_key"]).select("doc.*")
    return matching(left, repeated, "left_anti").select("doc.*").union(once)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")
