"""The given tables in the role of persons, incidents and coverage.

A view joins only the tables that the asked columns come from; without columns it
holds all of its role. How a table is joined is left to Spark, which decides by its
size: below the configured threshold it is broadcast, else both sides are shuffled
and skewed partitions are split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"  # prices have two decimals; as decimals they add up exactly

# Given schemas spare Spark a job per table that would read them from the files.
_TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; only the columns a query uses are read."""
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ST, StateAbbr`` from the nations."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("ST"), F.col("n_name").alias("StateAbbr")
    )


def _code(column: str, *names: str) -> Column:
    """1-based place of the value in a list of names."""
    return F.array_position(F.array(*map(F.lit, names)), F.col(column)).cast("int")


# Expression over the joined tables, and the tables it needs beside the base.
Role = tuple[Column, tuple[str, ...]]


def _incident_roles() -> dict[str, Role]:
    return {
        "ID": (F.col("event_id"), ()),
        "Severity": (
            F.pmod(F.get_json_object("props", "$.k").try_cast("int"), F.lit(4)) + 1, ()
        ),
        "Start_Time": (F.col("ts"), ()),
        "Zipcode": (F.col("user_id"), ()),
        "City": (F.col("user_id"), ()),
        "Street": (F.col("event_type"), ()),
        "Weather_Condition": (F.col("event_type"), ()),
        "Visibility(mi)": (F.col("value"), ()),
        "Stop": (F.col("event_type") == "error", ()),
        "Traffic_Signal": (F.col("event_type") == "purchase", ()),
        "State": (F.col("n_name"), ("customer", "nation")),
    }


def _person_roles() -> dict[str, Role]:
    return {
        "SERIALNO": (F.col("l_orderkey"), ()),
        "AGEP": (F.col("l_quantity").cast("int"), ()),
        "WKHP": (F.col("l_quantity"), ()),
        "JWMNP": (F.col("l_quantity"), ()),
        "WAGP": (F.col("l_extendedprice").cast(MONEY), ()),
        "PINCP": (F.col("l_extendedprice").cast(MONEY), ()),
        "POVPIP": (F.col("l_extendedprice").cast(MONEY), ()),
        "ADJINC": (F.round((1 + F.col("l_tax")) * 1_000_000).cast("int"), ()),
        "SEX": (_code("l_returnflag", "A", "R", "N"), ()),
        "NATIVITY": (_code("l_linestatus", "O", "F"), ()),
        "WRK": (F.when(F.col("l_linestatus") == "O", 1).otherwise(2), ()),
        "NOP": (F.col("l_linenumber"), ()),
        "SCHL": (F.col("p_size"), ("part",)),
        "OCCP": (F.col("p_brand"), ("part",)),
        "INDP": (
            _code("p_type", "ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"), ("part",)
        ),
        "MAR": (F.substring("o_orderpriority", 1, 1).try_cast("int"), ("orders",)),
        "ESR": (_code("o_orderstatus", "O", "F", "P"), ("orders",)),
        "RAC1P": (
            _code("c_mktsegment", "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
            ("orders", "customer"),
        ),
        "ST": (F.col("c_nationkey"), ("orders", "customer")),
    }


def _coverage_roles() -> dict[str, Role]:
    return {
        "MaxAdDown": (F.col("l_quantity"), ()),
        "Consumer": (F.when(F.col("l_returnflag") == "A", 0).otherwise(1), ()),
        "Business": (F.when(F.col("l_linestatus") == "O", 1).otherwise(0), ()),
        "ProviderName": (F.col("s_name"), ("supplier",)),
        "StateAbbr": (F.col("n_name"), ("orders", "customer", "nation")),
    }


_KEYS = {
    ("events", "customer"): ("user_id", "c_custkey"),
    ("lineitem", "orders"): ("l_orderkey", "o_orderkey"),
    ("lineitem", "part"): ("l_partkey", "p_partkey"),
    ("lineitem", "supplier"): ("l_suppkey", "s_suppkey"),
    ("lineitem", "customer"): ("o_custkey", "c_custkey"),
    ("lineitem", "nation"): ("c_nationkey", "n_nationkey"),
    ("events", "nation"): ("c_nationkey", "n_nationkey"),
}
# Orders, customers and nations are joined with each other first, so that the
# base rows are shuffled for them once.
_CHAIN = ("orders", "customer", "nation")


def _view(
    spark: SparkSession, sf_dir: str, base: str, roles: dict[str, Role], columns: tuple[str, ...]
) -> DataFrame:
    columns = columns or tuple(roles)
    needed = {t for c in columns for t in roles[c][1]}
    chain = [t for t in _CHAIN if t in needed]
    rows = table(spark, sf_dir, base)
    if chain:
        side = table(spark, sf_dir, chain[0])
        for name in chain[1:]:
            left, right = _KEYS[(base, name)]
            side = side.join(table(spark, sf_dir, name), F.col(left) == F.col(right))
        left, right = _KEYS[(base, chain[0])]
        rows = rows.join(side, F.col(left) == F.col(right))
    for name in sorted(needed - set(_CHAIN)):
        left, right = _KEYS[(base, name)]
        rows = rows.join(table(spark, sf_dir, name), F.col(left) == F.col(right))
    return rows.select(*(roles[c][0].alias(c) for c in columns))


def incidents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Events as incidents."""
    return _view(spark, sf_dir, "events", _incident_roles(), columns)


def persons(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Order lines as persons."""
    return _view(spark, sf_dir, "lineitem", _person_roles(), columns)


def coverage(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Order lines as coverage rows."""
    return _view(spark, sf_dir, "lineitem", _coverage_roles(), columns)
