"""Typed CSV reading, the dictionary of data sets, and their Parquet form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyfield.functions.columns import clean_numeric, parse_time
from tallyfield.operators.dims import checked_dimension
from tallyfield.sources import schemas
from tallyfield.sources.rejects import csv_format, read_checked_csv
from tallyfield.sources.states import read_state_file

# Where the published files lie below the base folder.
DEFAULT_FILES = {
    "pusa": "demographics/psam_pusa.csv",
    "pusb": "demographics/psam_pusb.csv",
    "accidents": "accidents/US_Accidents_March23.csv",
    "internet": "internet/fbd_us_with_satellite_dec2021_v1.csv",
}
DEFAULT_STATE_FILE = "demographics/state_matcher.txt"

SCHEMAS = {
    "pusa": schemas.PERSONS,
    "pusb": schemas.PERSONS,
    "accidents": schemas.INCIDENTS,
    "internet": schemas.COVERAGE,
}
INCIDENT_TIMES = ("Start_Time", "End_Time")


def read_typed_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    sep: str = ",",
    **options: str,
) -> DataFrame:
    """Read headed CSV files with a fixed schema applied by position.

    A cell that does not fit its type becomes NULL. Doubled quotes inside a
    quoted field are read as one quote, so such a field is not split.
    """
    settings = {**csv_format(sep), "header": "true", **options}
    return spark.read.schema(schema).options(**settings).csv(path)


def union_same_schema(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Append frames whose schemas are equal; raise if one differs."""
    merged = first
    for position, other in enumerate(others, start=2):
        if other.schema != first.schema:
            raise ValueError(
                f"frame {position} differs from the first: "
                f"{other.schema.simpleString()} is not {first.schema.simpleString()}"
            )
        merged = merged.unionByName(other)
    return merged


def clean_persons(persons: DataFrame) -> DataFrame:
    """Numbers that arrive as text become numbers."""
    return clean_numeric(persons, schemas.PERSON_NUMBERS)


def clean_incidents(incidents: DataFrame) -> DataFrame:
    """Start and end become timestamps."""
    return parse_time(incidents, INCIDENT_TIMES)


def with_demographics(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Add ``demographics``, the union of both person parts."""
    return {**tables, "demographics": union_same_schema(tables["pusa"], tables["pusb"])}


def load_tables(
    spark: SparkSession,
    base_path: str,
    files: Mapping[str, str] | None = None,
    checked: bool = False,
) -> dict[str, DataFrame]:
    """The data sets as read from CSV: demographics, pusa, pusb, accidents, internet.

    ``checked`` adds the column of rejected records, for ``reject_counts``.
    """
    paths = {**DEFAULT_FILES, **(files or {})}
    read = read_checked_csv if checked else read_typed_csv
    raw = {name: read(spark, f"{base_path}/{paths[name]}", SCHEMAS[name]) for name in DEFAULT_FILES}
    return with_demographics(raw)


def load_states(spark: SparkSession, base_path: str, file: str = DEFAULT_STATE_FILE) -> DataFrame:
    """The state table that lies with the data sets; a code that occurs twice raises an error."""
    return checked_dimension(read_state_file(spark, f"{base_path}/{file}"), "ST", ["StateAbbr"])


def clean_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The same data sets with cleaned types, ready for the questions."""
    cleaned = {
        "pusa": clean_persons(tables["pusa"]),
        "pusb": clean_persons(tables["pusb"]),
        "accidents": clean_incidents(tables["accidents"]),
        "internet": tables["internet"],
    }
    return with_demographics(cleaned)


def store_parquet(tables: Mapping[str, DataFrame], path: str) -> None:
    """Write every source table once as Parquet.

    Questions read few of the 287 person columns; Parquet lets Spark prune
    columns and push filters, where CSV is parsed whole on every run.
    """
    for name in DEFAULT_FILES:
        tables[name].write.mode("overwrite").parquet(f"{path}/{name}")


def load_parquet(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Read what ``store_parquet`` wrote."""
    return with_demographics(
        {name: spark.read.parquet(f"{path}/{name}") for name in DEFAULT_FILES}
    )
