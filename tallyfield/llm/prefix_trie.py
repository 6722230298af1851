"""Trie of the common beginnings of conversations, from composable fingerprints.

A sequence of turns has the fingerprint (length, sum of v_i * B^i mod 2^61 - 1), in two lanes; that
of two sequences one after the other follows from theirs alone. Turns are sorted over all tasks,
each task fingerprints the beginnings in its rows, and what lies in earlier tasks is put in front. A
rebuilt conversation is the head of one and the rest of another; the fingerprints of its beginnings
are combined from those of the two, and no text is copied. Rows with one fingerprint and depth make
a node; each refers to its stored last turn, and the texts behind the references are compared.

Every node belongs to its smallest conversation, and what a conversation shares with smaller ones is a
beginning of it. So sums over a node's subtree are sums over its conversations of one number each,
and no step goes up the tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.llm.common import checkpoint, stored, table

PRIME = (1 << 61) - 1
BASES = (0x1B873593CC9E2D51 % PRIME, 0x0E6546B64A4A7C15 % PRIME)
# Families of conversations, and turns at most that a head has.
FAMILY, MAX_HEAD = 5, 8
# Ids of conversations that make one piece of a list of ends.
IDS_IN_PIECE = 4096
NODE = ["depth", "f0", "f1"]
NOTHING = hashlib.sha256(b"").hexdigest()


def _scanned(seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over the sorted rows of a task: place, fingerprint and bytes of every beginning within the task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        conv, place, size, f, power = None, 0, 0, [0, 0], [1, 1]
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text")), strict=True):
                if c != conv:
                    conv, place, size, f, power = c, 0, 0, [0, 0], [1, 1]
                content = text.encode()
                value = xxhash.xxh3_128_intdigest(b"%d:%s%s" % (len(role), role.encode(), content), seed)
                values = (value & PRIME, value >> 64 & PRIME)
                power = [p * b % PRIME for p, b in zip(power, BASES, strict=True)]
                f = [(x + v * p) % PRIME for x, v, p in zip(f, values, power, strict=True)]
                place, size, row = place + 1, size + len(content), row + 1
                for column, x in zip(out, (part, (part << 33) + row, place, *f, len(content), size), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(pa.array(x, pa.int64()) for x in out), batch.column("role"), batch.column("text")],
                names=["conv_id", "part", "ref", "pos", "f0", "f1", "bytes", "size", "role", "text"],
            )

    return scan


def _times(x: Column, y: Column) -> Column:
    """x * y mod PRIME."""
    return ((x.cast("decimal(19,0)") * y.cast("decimal(19,0)")) % F.lit(PRIME).cast("decimal(19,0)")).cast("long")


def stored_turns(conversations: DataFrame, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Turns (ref, role, text), and for each (conv_id, pos, ref, f0, f1, bytes, size): fingerprint and bytes up to it."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *text)
    # Equal turn numbers go by a digest; the row's number deals equal rows to several tasks.
    tie = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    keyed = turns.withColumn("tie", tie).withColumn("number", F.monotonically_increasing_id())
    order = ["conv_id", F.col("turn").asc_nulls_first(), "tie", "number"]
    in_order = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")
    schema = "conv_id long, part long, ref long, pos long, f0 long, f1 long, bytes long, size long, role string, text string"
    turns = stored(in_order.mapInArrow(_scanned(seed), schema))

    # A conversation that goes on from an earlier task is that task's last; there is one at most per task.
    ends = turns.groupBy("part").agg(F.min("conv_id").alias("first"), F.max_by(F.struct("conv_id", "pos", "f0", "f1", "size"), "ref").alias("last"))
    before, carried = None, []
    for row in sorted(ends.collect(), key=lambda r: r["part"]):  # a row per task
        conv, pos, f0, f1, size = row["last"]
        if before and before[0] == row["first"]:
            carried.append((row["part"], *before, *(pow(b, before[1], PRIME) for b in BASES)))
            if conv == before[0]:
                shift = carried[-1][-2:]
                pos, size = pos + before[1], size + before[4]
                f0, f1 = ((x + s * y) % PRIME for x, s, y in zip(before[2:4], shift, (f0, f1), strict=True))
        before = (conv, pos, f0, f1, size)
    names = "part long, conv_id long, _pos long, _f0 long, _f1 long, _size long, _s0 long, _s1 long"
    carry = F.broadcast(turns.sparkSession.createDataFrame(carried, names))
    joined = turns.drop("role", "text").join(carry, ["part", "conv_id"], "left")

    def with_carry(name: str, value: Column) -> Column:
        return F.when(F.col("_pos").isNull(), F.col(name)).otherwise(value).alias(name)

    prefixes = joined.select(
        "conv_id", "ref", "bytes",
        with_carry("pos", F.col("pos") + F.col("_pos")), with_carry("size", F.col("size") + F.col("_size")),
        *(with_carry(f"f{k}", (F.col(f"_f{k}") + _times(F.col(f"_s{k}"), F.col(f"f{k}"))) % PRIME) for k in (0, 1)),
    )
    return turns.select("ref", "role", "text"), stored(prefixes)


def head_turns(conv_id: Column) -> Column:
    """How many turns of its family's first conversation a conversation begins with."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (MAX_HEAD + 1)


def rebuilt(prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv_id, length), and every beginning (conv_id, length, depth, f0, f1, ref, bytes, size)."""
    convs = prefixes.groupBy("conv_id").agg(F.max("pos").alias("turns"))
    convs = convs.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), head_turns(F.col("conv_id")).alias("h"))
    state = F.struct("pos", "f0", "f1", "size")
    heads = prefixes.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") <= MAX_HEAD))
    heads = heads.groupBy("conv_id").agg(F.collect_list(F.struct("pos", "ref", "f0", "f1", "bytes", "size")).alias("head")).withColumnRenamed("conv_id", "base")
    cuts = prefixes.where(F.col("pos") == head_turns(F.col("conv_id"))).select("conv_id", state.alias("cut"))
    convs = convs.join(heads, "base", "left").join(cuts, "conv_id", "left")
    head = F.filter(F.coalesce("head", F.array()), lambda t: t["pos"] <= F.col("h"))
    convs = convs.withColumn("head", F.array_sort(head)).withColumn("end", F.get("head", F.size("head") - 1))
    zero = F.lit(0).cast("long")
    known = {f"{side}_{c}": F.coalesce(F.col(f"{side}.{c}"), zero) for side in ("end", "cut") for c in ("pos", "f0", "f1", "size")}
    convs = stored(convs.select("conv_id", "h", "head", *(v.alias(k) for k, v in known.items()), (F.size("head") + F.greatest(F.col("turns") - F.col("h"), zero)).alias("length")))

    of_head = convs.select("conv_id", "length", F.inline("head")).withColumnRenamed("pos", "depth")
    own = prefixes.where(F.col("pos") > head_turns(F.col("conv_id"))).join(convs.drop("head"), "conv_id")
    # A head shorter than h moves the rest of the conversation forward by what it lacks.
    lacks = F.col("h") - F.col("end_pos")

    def moved(k: int) -> Column:
        rest = F.pmod(F.col(f"f{k}") - F.col(f"cut_f{k}"), F.lit(PRIME))
        back = F.array(*(F.lit(pow(BASES[k], -i, PRIME)) for i in range(MAX_HEAD + 1)))
        rest = F.when(lacks == 0, rest).otherwise(_times(rest, F.get(back, lacks.cast("int"))))
        return ((F.col(f"end_f{k}") + rest) % PRIME).alias(f"f{k}")

    of_own = own.select(
        "conv_id", "length", (F.col("pos") - lacks).alias("depth"), "ref", moved(0), moved(1), "bytes",
        (F.col("size") - F.col("cut_size") + F.col("end_size")).alias("size"),
    )
    columns = ("conv_id", "length", "depth", "f0", "f1", "ref", "bytes", "size")
    return convs.select("conv_id", "length"), stored(of_head.select(*columns).union(of_own.select(*columns)))


def _ends(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids of each node's ending conversations, from (depth, f0, f1, conv_id).

    Ids are packed in pieces before they are dealt by node, and a task hashes the pieces one by
    one: it keeps a hash, not a list.
    """
    piece = F.floor(F.col("conv_id") / IDS_IN_PIECE).alias("piece")
    packed = ends.groupBy(*NODE, piece).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    in_order = packed.repartition(*NODE).sortWithinPartitions(*NODE, "piece")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def row(nodes: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip([*NODE, "ends_sha256"], [*n, d], strict=True)) for n, d in nodes], schema)

        schema = pa.schema([*((c, pa.int64()) for c in NODE), ("ends_sha256", pa.string())])
        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in [*NODE, "ids"]), strict=True):
                if key == node:
                    digest.update(b"," + ids.encode())
                    continue
                if node:
                    done.append((node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            yield row(done)
        if node:
            yield row([(node, digest.hexdigest())])

    return in_order.select(*NODE, "ids").mapInArrow(hashed, "depth long, f0 long, f1 long, ends_sha256 string")


def _alike(turns: DataFrame, compared: DataFrame) -> bool:
    """Whether the stored turns of every (ref, first_ref) are equal."""
    pairs = compared.where("ref <> first_ref").select("ref", "first_ref").distinct()
    first = turns.select(F.col("ref").alias("first_ref"), F.struct("role", "text").alias("first"))
    both = pairs.join(turns, "ref").join(first, "first_ref")
    return both.where(F.struct("role", "text") != F.col("first")).isEmpty()


def trie(conversations: DataFrame, seed: int = 0) -> DataFrame:
    """A row per distinct beginning of the rebuilt conversations; the module and README.md have the columns.

    Turns go by number, null first; turns of one number by a digest of role and text, so that
    repeated rows are turns like others. Null roles and texts count as empty. Rows without conv_id
    belong to no conversation and are left out. An empty table gives an empty table; further columns
    are ignored. Should two different turns ever share a fingerprint, another seed is taken.
    """
    turns, prefixes = stored_turns(conversations, seed)
    convs, rows = rebuilt(prefixes)
    # Stored, so that Spark can split the rows of a node that very many conversations share.
    nodes = stored(rows.groupBy(*NODE).agg(F.min("conv_id").alias("owner"), F.max("length").alias("longest"), F.min("ref").alias("first_ref")))
    placed = stored(rows.join(nodes, NODE))
    if not _alike(turns, placed):
        return trie(conversations, seed + 1)

    # What each conversation shares with smaller ones: depth, bytes and, there, the node's owner; and whether it owns a leaf.
    shared = F.col("owner") < F.col("conv_id")
    own_leaf = (F.col("depth") == F.col("length")) & (F.col("longest") == F.col("depth")) & ~shared
    parts = placed.groupBy("conv_id").agg(
        F.max(F.when(shared, F.struct("depth", "size", "owner"))).alias("shared"), F.max(own_leaf).alias("own_leaf")
    )
    zero = F.lit(0).cast("long")
    root, root_longest = convs.agg(F.min("conv_id"), F.max("length")).first()
    is_root = F.col("conv_id") == F.lit(root).cast("long")
    told = convs.join(parts, "conv_id", "left").select(
        "conv_id", "length",
        F.coalesce("shared.depth", F.when(is_root, F.lit(-1)).otherwise(zero)).alias("shared_depth"),
        F.coalesce("shared.size", zero).alias("shared_size"),
        F.coalesce("shared.owner", F.lit(root).cast("long")).alias("shared_owner"),
        F.coalesce("own_leaf", is_root & F.lit(root_longest == 0)).cast("long").alias("own_leaf"),
    )
    told = stored(told)

    def summed(rows: DataFrame, *keys: Column | str) -> DataFrame:
        branch = (F.col("shared_depth") <= F.col("depth")) & (F.col("depth") < F.col("length"))
        return rows.groupBy(*keys).agg(
            F.min(F.struct("conv_id", "shared_depth", "shared_owner", "shared_size")).alias("first"),
            F.count("*").alias("n_convs"), F.count_if(branch).alias("n_children"), F.sum("own_leaf").alias("n_leaves"),
            F.sum("shared_size").alias("shared_size"), F.max(F.col("size") - F.col("bytes")).alias("size_before"),
        )

    of_root = told.withColumns({"depth": zero, "size": zero, "bytes": zero})
    nodes = summed(rows.drop("length").join(told, "conv_id"), *NODE)
    top = summed(of_root, "depth").select("depth", zero.alias("f0"), zero.alias("f1"), *nodes.columns[3:])
    ending = rows.where("depth = length").select(*NODE, "conv_id").union(of_root.where("length = 0").select("depth", zero, zero, "conv_id"))
    parent = F.when(F.col("depth") == 0, None).when(F.col("first.shared_depth") == F.col("depth") - 1, F.col("first.shared_owner")).otherwise(F.col("first.conv_id"))
    saved = F.col("shared_size") - F.col("first.shared_size") - (F.col("n_convs") - 1) * F.col("size_before")
    return nodes.union(top).join(_ends(ending), NODE, "left").select(
        F.col("first.conv_id").alias("conv_id"), "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        saved.alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))
