"""CSV reading that keeps what it could not read, and counts of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The raw record of a row with a cell that does not fit its type, or with too many or too few fields.
REJECTED = "rejected_record"
# Names in the counts beside those of the columns.
ALL_ROWS, REJECTED_ROWS, MISSHAPEN_ROWS = "(rows)", "(rejected rows)", "(misshapen rows)"


def read_checked_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    sep: str = ",",
    **options: str,
) -> DataFrame:
    """Like ``read_typed_csv``, with one more column ``rejected_record``.

    It holds the raw record of every row that does not fit the schema and is NULL in all others.
    Cells that fit keep their value in rejected rows too. All columns are parsed whatever is
    selected later, so the verdict on a row does not depend on the query.
    """
    settings = {**csv_format(sep), "header": "true", "columnPruning": "false", **options}
    settings["columnNameOfCorruptRecord"] = REJECTED
    return spark.read.schema(_with_record(schema)).options(**settings).csv(path)


def csv_format(sep: str = ",") -> dict[str, str]:
    """Doubled quotes inside a quoted field stand for one quote."""
    return {"sep": sep, "quote": '"', "escape": '"'}


def reject_counts(rows: DataFrame, sep: str = ",") -> DataFrame:
    """``column_name, n`` for a frame of ``read_checked_csv``, from one pass.

    For every column the number of cells with text that does not fit its type; and the numbers
    of all rows, of rejected rows and of misshapen ones: rejected although every cell that is
    there fits, so with a field too many or too few. Rejected records alone are parsed again, as
    text.
    """
    names = [c for c in rows.columns if c != REJECTED]
    raw = F.from_csv(REJECTED, ", ".join(f"`{c}` string" for c in names), csv_format(sep))
    told = rows.select(*(F.col(f"`{c}`") for c in names), REJECTED, F.when(F.col(REJECTED).isNotNull(), raw).alias("_raw"))

    def bad(c: str) -> Column:
        return F.col(REJECTED).isNotNull() & F.col("_raw").getField(c).isNotNull() & F.col(f"`{c}`").isNull()

    any_bad = F.array_contains(F.array(*map(bad, names)), True)
    counted = {
        **{c: F.count_if(bad(c)) for c in names},
        ALL_ROWS: F.count("*"),
        REJECTED_ROWS: F.count(REJECTED),
        MISSHAPEN_ROWS: F.count_if(F.col(REJECTED).isNotNull() & ~any_bad),
    }
    pairs = F.array(*(F.struct(F.lit(name).alias("column_name"), n.alias("n")) for name, n in counted.items()))
    return told.agg(pairs.alias("counts")).select(F.inline("counts"))


def accepted(rows: DataFrame) -> DataFrame:
    """The rows that fit the schema, without the record."""
    return rows.filter(F.col(REJECTED).isNull()).drop(REJECTED)


def _with_record(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType(), True)])

