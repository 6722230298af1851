"""State tables: code, abbreviation, name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.functions.fixed_values import STATES

TERRITORIES = ("PR",)


def state_table(spark: SparkSession, territories: bool = True) -> DataFrame:
    """``ST, StateAbbr, STATE_NAME`` from the fixed list: 52 rows, 51 without territories.

    Spark plans the VALUES list as a local relation of known size, so joins with
    it broadcast without a hint.
    """
    rows = (line.split(" ", 2) for line in STATES.strip().splitlines())
    kept = (r for r in rows if territories or r[1] not in TERRITORIES)
    values = ", ".join("('{}', '{}', '{}')".format(*r) for r in kept)
    return spark.sql(f"SELECT * FROM VALUES {values} AS states(ST, StateAbbr, STATE_NAME)")


def read_state_file(spark: SparkSession, path: str) -> DataFrame:
    """``ST, StateAbbr`` from a pipe-delimited file with columns STATE and STUSAB."""
    table = spark.read.csv(path, sep="|", header=True)
    return table.select(F.col("STATE").alias("ST"), F.col("STUSAB").alias("StateAbbr"))
