"""Batch job: read the data sets, profile them, answer the questions, write reports.

    python -m tallyfield.job --data DIR --out DIR [--state-file FILE] [--questions A1 N7 ...]

The state table of the X family is the file that lies with the data sets, or ``--state-file``;
with ``--built-in-states`` it is the fixed list. Cells and rows that do not fit are counted per
data set in ``statistics/rejects_*``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.plans.suite import QUESTIONS, describe_all, preview_all, run_all
from tallyfield.session import get_session
from tallyfield.sources import readers
from tallyfield.sources.rejects import REJECTED, reject_counts
from tallyfield.sources.reports import write_report
from tallyfield.sources.states import read_state_file


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--data", required=True, help="folder with the CSV data sets")
    parser.add_argument("--out", required=True, help="shared folder for Parquet and reports")
    parser.add_argument("--format", default="csv", help="report format")
    parser.add_argument("--state-file", help="pipe-delimited state table for the X family")
    parser.add_argument("--built-in-states", action="store_true", help="use the fixed list instead")
    parser.add_argument("--questions", nargs="*", default=list(QUESTIONS))
    args = parser.parse_args(argv)

    spark = get_session("tallyfield")
    checked = readers.load_tables(spark, args.data, checked=True)
    raw = {name: rows.drop(REJECTED) for name, rows in checked.items()}
    for name in readers.DEFAULT_FILES:
        counts = reject_counts(checked[name])
        write_report(counts, f"{args.out}/statistics/rejects_{name}", args.format)
    readers.store_parquet(readers.clean_tables(raw), f"{args.out}/tables")
    tables = readers.load_parquet(spark, f"{args.out}/tables")

    for name, rows in preview_all(tables).items():
        write_report(rows, f"{args.out}/statistics/{name}_preview", args.format)
    for name, report in describe_all(tables).items():
        write_report(report, f"{args.out}/statistics/{name}", args.format)

    if args.built_in_states:
        states = None
    elif args.state_file:
        states = read_state_file(spark, args.state_file)
    else:
        states = readers.load_states(spark, args.data)
    for name, report in run_all(spark, tables, states, args.questions).items():
        write_report(
            report if name != "N10" or args.format != "csv" else _joined(report),
            f"{args.out}/reports/{name}",
            args.format,
        )


def _joined(report: DataFrame) -> DataFrame:
    """CSV holds no arrays, so the list of states becomes text."""
    return report.withColumn("states_list", F.concat_ws(",", "states_list"))


if __name__ == "__main__":
    main()
