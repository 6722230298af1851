"""Report sink."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

ROWS = "(rows)"


def write_report(report: DataFrame, path: str, fmt: str = "csv") -> dict[str, int]:
    """Replace ``path`` with the report, written in parallel whatever its length.

    The rows and the NULLs of every column are counted while they are written, without another
    pass: ``{"(rows)": n, column: nulls, ...}``. The report is written beside the old one, which
    goes only when the new one is complete; a failed write leaves the old one as it was. Columns
    without a type, as of a bare NULL, are written as strings, as CSV takes none of that kind.
    """
    spark = report.sparkSession
    report = report.withColumns({c: F.col(f"`{c}`").cast("string") for c, kind in report.dtypes if kind == "void"})
    seen = Observation()
    nulls = (F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{k}") for k, c in enumerate(report.columns))
    writer = report.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls).write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    fresh = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(path), hadoop.Path(fresh)
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        writer.save(fresh)
        files.delete(old, True)
        files.rename(new, old)
    finally:
        files.delete(new, True)
    return {ROWS: seen.get["rows"], **{c: seen.get[f"c{k}"] for k, c in enumerate(report.columns)}}
