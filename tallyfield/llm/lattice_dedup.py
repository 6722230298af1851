"""Near-duplicate embeddings by lattice hashing.

Per table, random projections of the unit vector are cut into blocks of eight coordinates and
each block is decoded to the nearest point of the E8 lattice. The points of all blocks name
the vector's cell; its neighbouring cells, probed too, replace one block's point by the second
nearest one of the lattice. Vectors that share a cell, one of them at home there, are
compared by cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm.common import stored, table
from tallyfield.llm.components import connected_components

THRESHOLD = 0.9
# Lattice units per unit of distance, per projected coordinate.
SCALE = 0.48
SEED = 8
# Sets of up to so many vectors take so many tables of so many blocks. More blocks make cells smaller, so
# that chance meetings stay few in larger sets; the tables bring the recall of pairs just above the
# threshold near one in either layout. README.md has it by bands of cosine.
LAYOUTS = ((1 << 20, 28, 2), (1 << 62, 76, 3))
# A key's lowest bits are its table; the largest number is no key.
TABLE_BITS, NONE = 7, np.iinfo(np.int64).max
# Vectors of one cell that a task compares with each other at once, rows per group of cells, rows of a cell
# whose pairs are listed one by one, and pairs whose cosines or cells are computed at once.
BLOCK_ROWS, GROUP_ROWS, SMALL_CELL, PAIRS_AT_ONCE = 1024, 20_000, 24, 1 << 14


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points of D8 (whole coordinates with an even sum)."""
    near = np.rint(x)
    odd = (near.sum(axis=-1) % 2) != 0
    gap = x - near
    worst = np.abs(gap).argmax(axis=-1)[..., None]
    step = np.where(np.take_along_axis(gap, worst, -1) >= 0, 1.0, -1.0)
    moved = near.copy()
    np.put_along_axis(moved, worst, np.take_along_axis(near, worst, -1) + step, -1)
    return np.where(odd[..., None], moved, near)


def _root_towards(gap: np.ndarray) -> np.ndarray:
    """Of the 240 shortest vectors of E8, the one nearest to each gap."""
    size, sign = np.abs(gap), np.where(gap >= 0, 1.0, -1.0)
    order = np.argsort(size, axis=-1)
    whole = np.zeros_like(gap)
    np.put_along_axis(whole, order[..., -2:], np.take_along_axis(sign, order[..., -2:], -1), -1)
    # Halves have an even number of minus signs; if need be, the smallest coordinate gets the wrong one.
    half, least = sign / 2, order[..., :1]
    odd = (sign < 0).sum(axis=-1, keepdims=True) % 2 != 0
    np.put_along_axis(half, least, np.take_along_axis(half, least, -1) * np.where(odd, -1.0, 1.0), -1)
    return np.where(((whole * gap).sum(axis=-1) >= (half * gap).sum(axis=-1))[..., None], whole, half)


def e8_points(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest E8 points of rows of eight numbers, and the next nearest ones beside them, both doubled.

    E8 is D8 together with D8 moved by one half in every coordinate.
    """
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    first = ((x - whole) ** 2).sum(axis=-1) <= ((x - half) ** 2).sum(axis=-1)
    near = np.where(first[..., None], whole, half)
    return (2 * near).astype(np.int64), (2 * (near + _root_towards(x - near))).astype(np.int64)


def _hashed(points: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit number per row of eight whole numbers."""
    h = np.full(points.shape[:-1], salt, np.uint64)
    for i in range(8):
        h = (h ^ points[..., i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


def layout(n: int) -> tuple[int, int]:
    """Tables and blocks for ``n`` vectors."""
    return next((tables, blocks) for most, tables, blocks in LAYOUTS if n <= most)


def cells(unit: np.ndarray, table: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Home cells (rows) and neighbouring cells (rows, blocks) of unit vectors in one table."""
    rng = np.random.default_rng([SEED, unit.shape[1], table])
    near, other = [], []
    for b in range(blocks):
        points, neighbours = e8_points(unit @ rng.normal(0, SCALE, (unit.shape[1], 8)))
        salt = 1 + table * blocks + b
        near.append(_hashed(points, salt))
        other.append(_hashed(neighbours, salt))
    home = sum(near, np.zeros(len(unit), np.uint64))
    probes = np.stack([home - near[b] + other[b] for b in range(blocks)], axis=1)

    def keyed(hashes: np.ndarray) -> np.ndarray:
        return ((hashes << np.uint64(TABLE_BITS)) | np.uint64(table)).view(np.int64)

    return keyed(home), keyed(probes)


def _usable(values: list | None) -> tuple[bytes, bytes] | None:
    """Fingerprint and packed components; None for vectors that link with nothing."""
    if not values or any(v is None for v in values):
        return None
    vector = np.array(values, np.float64)
    if not np.isfinite(vector).all() or not vector.any():
        return None
    vector += 0.0  # -0.0 is 0.0
    with np.errstate(over="ignore"):
        short = vector.astype(np.float32)
    packed = b"f" + short.tobytes() if (short == vector).all() else b"d" + vector.tobytes()
    return xxhash.xxh3_128_digest(vector.tobytes()), packed


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_usable(v) or (None, None) for v in batch.column("embedding").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array([n for n, _ in found], pa.binary()), pa.array([p for _, p in found], pa.binary())],
            names=["vec_id", "node", "vector"],
        )


def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.float32 if packed[:1] == b"f" else np.float64, offset=1).astype(np.float64)


def _units(packed: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension: the rows with it and their unit vectors."""
    vectors = [_unpacked(p) for p in packed]
    sizes = np.array([len(v) for v in vectors])
    out = {}
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        x = np.stack([vectors[i] for i in rows])
        x = x / np.abs(x).max(axis=1, keepdims=True)
        out[int(size)] = rows, x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    return out


def _cells_of(packed: list[bytes], table: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    homes, probes = np.empty(len(packed), np.int64), np.empty((len(packed), blocks), np.int64)
    for rows, unit in _units(packed).values():
        homes[rows], probes[rows] = cells(unit, table, blocks)
    return homes, probes


def _placed(tables: int, blocks: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(node, key, home) of every cell of every vector."""
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                packed = part.column("vector").to_pylist()
                found = [_cells_of(packed, t, blocks) for t in range(tables)]
                keys = np.concatenate([np.column_stack([home, probes]) for home, probes in found], axis=1)
                home = np.zeros(keys.shape, np.int32)
                home[:, :: 1 + blocks] = 1
                which = pa.array(np.repeat(np.arange(len(keys)), keys.shape[1]))
                yield pa.RecordBatch.from_arrays([part.column("node").take(which), pa.array(keys.ravel()), pa.array(home.ravel())], names=["node", "key", "home"])

    return place


class _Cells:
    """Cells of the vectors of a task, decoded when first asked for."""

    def __init__(self, packed: list[bytes], blocks: int) -> None:
        self.packed, self.blocks = packed, blocks
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def of(self, table: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.packed)
        known, homes, probes = self.tables.setdefault(
            table, (np.zeros(n, bool), np.empty(n, np.int64), np.empty((n, self.blocks), np.int64))
        )
        asked = np.zeros(n, bool)
        asked[nodes] = True
        new = np.flatnonzero(asked & ~known)
        if len(new):
            homes[new], probes[new] = _cells_of([self.packed[k] for k in new], table, self.blocks)
            known[new] = True
        return homes, probes


def _shared(homes: np.ndarray, probes: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest cell of a table that the vectors of each pair share, one of them at home there; NONE if they share none."""
    shared = np.where(homes[x] == homes[y], homes[x], NONE)
    for b in range(probes.shape[1]):
        shared = np.minimum(shared, np.where(homes[x] == probes[y, b], homes[x], NONE))
        shared = np.minimum(shared, np.where(homes[y] == probes[x, b], homes[y], NONE))
    return shared


def _in_first_cell(known: _Cells, x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each pair (x, y) met in the first table, and there the smallest cell, that the two share.

    Tables are gone through in turn, for the pairs that met in a later one and share no cell yet:
    near vectors share one soon, so few are decoded often.
    """
    table, left = at & ((1 << TABLE_BITS) - 1), np.ones(len(x), bool)
    first = np.zeros(len(x), bool)
    for t in range(int(table.max(initial=-1)) + 1):
        pairs = np.flatnonzero(left & (table >= t))
        if len(pairs):
            homes, probes = known.of(t, np.concatenate([x[pairs], y[pairs]]))
            shared = _shared(homes, probes, x[pairs], y[pairs])
            first[pairs] = shared == at[pairs]
            left[pairs] = shared == NONE
    return first


def _block_labels(n: int, pairs: np.ndarray) -> np.ndarray:
    """For every row the smallest row it is connected to by the pairs."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
        np.minimum.at(label, pairs[:, 0], low)
        np.minimum.at(label, pairs[:, 1], low)
        label = label[label]
        if (label == before).all():
            return label


def _listed(sizes: np.ndarray, start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within cells that begin at ``start`` and have ``sizes`` rows, some at a time."""
    for step in range(1, int(sizes.max(initial=1))):
        larger = sizes > step
        n = sizes[larger] - step
        left = np.repeat(start[larger] - np.cumsum(n) + n, n) + np.arange(n.sum())
        for a in range(0, len(left), PAIRS_AT_ONCE):
            yield left[a : a + PAIRS_AT_ONCE], left[a : a + PAIRS_AT_ONCE] + step


def _near_pairs(group: dict[str, np.ndarray], unit: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one cell, one at home there, whose vectors' cosine reaches the threshold.

    ``rows`` are sorted by cell; ``unit`` holds the vector of each of them.
    """
    key, low, high, part, home = (group[c][rows] for c in ("key", "low", "high", "part", "home"))
    new = np.flatnonzero((np.diff(key) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)) + 1
    start = np.concatenate([[0], new])
    sizes = np.diff(np.concatenate([start, [len(rows)]]))
    whole = low[start] == high[start]
    small = whole & (sizes <= SMALL_CELL)
    for i, j in _listed(sizes[small], start[small]):
        met = (home[i] | home[j]) > 0
        i, j = i[met], j[met]
        near = np.einsum("nd,nd->n", unit[i], unit[j]) >= THRESHOLD
        yield rows[i[near]], rows[j[near]]
    for a, n, same in zip(start[~small], sizes[~small], whole[~small], strict=True):
        cell = np.arange(a, a + n)
        left, right = (cell, cell) if same else (cell[part[cell] == low[a]], cell[part[cell] != low[a]])
        near = unit[left] @ unit[right].T >= THRESHOLD
        near &= (home[left][:, None] | home[right][None, :]) > 0
        i, j = np.nonzero(np.triu(near, 1) if same else near)
        yield rows[left[i]], rows[right[j]]


def _compared(blocks: int) -> Callable[[pa.Table], pa.Table]:
    def compare(group: pa.Table) -> pa.Table:
        """Links of the vectors of some cells, or pairs of blocks of cells.

        A pair that meets in several cells is counted in one of them.
        """
        names = group.column("node").to_pylist()
        number = {name: k for k, name in enumerate(dict.fromkeys(names))}
        node = np.array([number[name] for name in names])
        first_row = np.unique(node, return_index=True)[1]
        packed = group.column("vector").take(pa.array(first_row)).to_pylist()
        copies = group.column("copies").to_numpy()[first_row]
        columns = {c: group.column(c).to_numpy() for c in ("key", "low", "high", "part", "home")}
        order = np.lexsort((columns["high"], columns["low"], columns["key"]))
        links, label = np.zeros(len(packed), np.int64), np.arange(len(packed))
        seen, joined, known = np.zeros(len(packed), bool), [], _Cells(packed, blocks)
        for size_rows, unit in _units(packed).values():
            place = np.full(len(packed), -1)
            place[size_rows] = np.arange(len(size_rows))
            rows = order[place[node[order]] >= 0]
            for i, j in _near_pairs(columns, unit[place[node[rows]]], rows):
                for a in range(0, len(i), PAIRS_AT_ONCE):
                    p, q = i[a : a + PAIRS_AT_ONCE], j[a : a + PAIRS_AT_ONCE]
                    x, y = node[p], node[q]
                    here = _in_first_cell(known, x, y, columns["key"][p])
                    np.add.at(links, x[here], copies[y[here]])
                    np.add.at(links, y[here], copies[x[here]])
                    seen[x] = seen[y] = True
                    joined.append(np.unique(np.stack([x, y], axis=1), axis=0))
        if joined:
            label = _block_labels(len(packed), np.unique(np.concatenate(joined), axis=0))
        back, used = list(number), np.flatnonzero(seen)
        return pa.table({
            "node": pa.array([back[k] for k in used], pa.binary()),
            "links": pa.array(links[used]),
            "root": pa.array([back[label[k]] for k in used], pa.binary()),
        })

    return compare


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    Vectors that are null, empty or zero, or hold a null or a component that is not finite, link
    with nothing, and so do vectors of different lengths. Equal vectors are one node with a
    number of copies; all rows of a node share its links. Rows that repeat a vec_id are vectors
    of their own, and a null vec_id takes part like any other but names no component unless
    nothing else can. An empty table gives an empty table; further columns are ignored.

    A cell with many vectors is dealt out in pairs of blocks of bounded size, and every task
    returns one row per vector, not per pair.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = stored(rows.mapInArrow(_fingerprints, "vec_id long, node binary, vector binary"))
    nodes = stored(rows.where("node is not null").groupBy("node").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.min("vector").alias("vector")
    ))
    tables, blocks = layout(nodes.count())
    at = stored(nodes.select("node", "vector").mapInArrow(_placed(tables, blocks), "node binary, key long, home int"))
    busy = at.groupBy("key").agg(F.count("*").alias("n"), F.max("home").alias("any_home")).where("n > 1 and any_home = 1").select("key", "n")
    pieces = F.ceil(F.col("n") / BLOCK_ROWS)
    members = at.join(busy, "key").select("key", "node", "home", pieces.alias("pieces"), F.pmod(F.xxhash64("node", "key"), pieces).alias("part"))
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    dealt = stored(dealt.select("key", "node", "home", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")))
    groups = max(1, dealt.count() // GROUP_ROWS)
    dealt = dealt.withColumn("task", F.pmod(F.xxhash64("key", "low", "high"), F.lit(groups)))
    found = dealt.join(nodes.drop("first_id"), "node").groupBy("task").applyInArrow(_compared(blocks), "node binary, links long, root binary")
    found = stored(found)

    labels = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    first = nodes.select("node", "first_id", "copies")
    smallest = labels.join(first, "node").groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = first.join(labels.join(smallest, "root").select("node", "component_id"), "node", "left")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = known.join(links, "node", "left").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "first_id").alias("component_id")
    )
    result = rows.select("vec_id", "node").join(known, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))


def op2_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
