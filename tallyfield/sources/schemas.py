"""Fixed schemas of the three data sets. All columns are nullable."""

from __future__ import annotations

from pyspark.sql import types as T

from tallyfield.functions import fixed_values as fixed

TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
}


def _fields(columns: str) -> list[T.StructField]:
    named = (column.split() for column in columns.split(","))
    return [T.StructField(name, TYPES[kind], True) for name, kind in named]


def _replicate_weights() -> list[T.StructField]:
    count = fixed.PERSON_REPLICATE_WEIGHTS
    return [T.StructField(f"PWGTP{n}", TYPES["int"], True) for n in range(1, count + 1)]


PERSONS = T.StructType(_fields(fixed.PERSON_COLUMNS) + _replicate_weights())
INCIDENTS = T.StructType(_fields(fixed.INCIDENT_COLUMNS))
COVERAGE = T.StructType(_fields(fixed.COVERAGE_COLUMNS))

# Person columns that arrive as text but hold numbers.
PERSON_NUMBERS = {
    "PINCP": "double",
    "POVPIP": "double",
    "PERNP": "double",
    "NOP": "int",
}
