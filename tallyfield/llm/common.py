"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word: a run of characters other than space, tab, line feed, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a session without that setting (a test on one machine) gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='tallyfield-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared folder while the result is in use."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows as a compressed table in the shared folder."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text, in order; an empty array for null."""
    split = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.filter(split, lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def crc_bucket(doc_id: Column, n: int = 5) -> Column:
    """crc32 of the id as text, modulo n; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(-1))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of few rows, since texts can be long."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def bounded_sample(df: DataFrame, key: str, rows: int, seed: int = 1) -> DataFrame:
    """About ``rows`` rows (never more), chosen by a hash of their key: the same on every run."""
    total = max(df.count(), 1)
    place = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30))
    limit = min(1 << 30, -(-rows * (1 << 30) // total))
    return df.where(place < limit).orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(rows)


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.transform(F.array(value), use)[0]
