"""Events written out as the published incident file, some of it unreadable, and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.standins import table
from tallyfield.sources import schemas
from tallyfield.sources.readers import clean_incidents
from tallyfield.sources.rejects import csv_format, read_checked_csv, reject_counts
from tallyfield.sources.shared import shared_folder

# Every so many events, at this remainder, something is wrong with the line; at most one thing in a line.
BAD_SEVERITY, BAD_VISIBILITY, BAD_STOP = (50, 7), (60, 11), (40, 3)
TOO_LONG, TOO_SHORT = (90, 5), (80, 9)


def _at(rule: tuple[int, int]) -> Column:
    return F.col("event_id") % rule[0] == rule[1]


def _lines(events: DataFrame) -> DataFrame:
    given = {
        "ID": F.col("event_id").cast("string"),
        "Severity": F.when(_at(BAD_SEVERITY), "n/a").otherwise((F.col("event_id") % 4 + 1).cast("string")),
        "Start_Time": F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(".000000000")),
        "Description": F.col("props"),  # quotes and commas
        "Zipcode": F.col("user_id").cast("string"),
        "Weather_Condition": F.col("event_type"),
        "Visibility(mi)": F.when(_at(BAD_VISIBILITY), "12,5").otherwise(F.col("value").cast("string")),
        "Stop": F.when(_at(BAD_STOP), "yes").otherwise((F.col("event_type") == "error").cast("string")),
    }
    none = F.lit(None).cast("string")
    names = schemas.INCIDENTS.names

    def line(columns: list[str]) -> Column:
        return F.to_csv(F.struct(*(given.get(c, none).alias(c) for c in columns)), csv_format())

    whole = line(names)
    return events.select(
        F.when(_at(TOO_LONG), F.concat(whole, F.lit(",surplus"))).when(_at(TOO_SHORT), line(names[:9])).otherwise(whole).alias("value")
    )


def incidents_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    _lines(table(spark, sf_dir, "events")).write.text(path)
    return read_checked_csv(spark, path, schemas.INCIDENTS, header="false")


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the reading rejects, by column."""
    return reject_counts(incidents_from_csv(spark, sf_dir))


def read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What cells that could be read hold, in rejected rows too."""
    rows = clean_incidents(incidents_from_csv(spark, sf_dir))
    seen = F.round(F.col("`Visibility(mi)`").cast("double"), 2).cast("decimal(12,2)")
    return rows.groupBy("Weather_Condition").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("rejected_record").isNull()).alias("n_whole"),
        F.sum("Severity").alias("severity"),
        F.sum(seen).cast("double").alias("visibility"),
        F.count_if("Stop").alias("stops"),
        F.sum(F.length("Description")).alias("description_chars"),
        F.date_format(F.max("Start_Time"), "yyyy-MM-dd HH:mm:ss").alias("last_start"),
    )
