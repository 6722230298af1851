from __future__ import annotations

import math
import random
from decimal import Decimal
from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from conftest import rows_of
from tallyfield.operators import groups, pairs, quantiles, ranks, shares, stats

SLOW = settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


# --- groups ---------------------------------------------------------------


@pytest.mark.parametrize("heavy_groups, heavy_rows", [(10_000, 1_000), (2, 1), (10_000, 0), (1, 0)])
def test_attach_takes_each_row_once(frame, heavy_groups, heavy_rows):
    keys = ["hot"] * 30 + ["warm"] * 10 + ["warm2"] * 10 + ["cold", None, None]
    rows = frame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    sums = rows.groupBy("k").agg(F.sum("i").alias("total"), F.count("*").alias("n"))
    got = groups.attach_to_groups(
        rows, sums, ["k"], "n", heavy_groups=heavy_groups, heavy_rows=heavy_rows
    )
    window = W.partitionBy("k")
    want = rows.withColumns(
        {"total": F.sum("i").over(window), "n": F.count("*").over(window)}
    )
    assert rows_of(got.select("k", "i", "total", "n")) == rows_of(want)


def test_attach_is_an_inner_join(frame):
    rows = frame([("a", 1), ("b", 2)], "k string, i int")
    group = frame([("a", 5, 2_000)], "k string, v int, n long")
    for heavy_rows in (0, 5_000):
        got = groups.attach_to_groups(rows, group, ["k"], "n", heavy_rows=heavy_rows)
        assert rows_of(got) == [("a", 1, 5, 2000)]


# --- ranks ----------------------------------------------------------------


def test_rank_methods(frame):
    df = frame([("g", v) for v in (3, 3, 1, None)], "g string, v int")
    for method, want in (("rank", [1, 1, 3, 4]), ("dense_rank", [1, 1, 2, 3])):
        ranked = ranks.group_rank(df, ["g"], [F.desc("v")], method)
        assert sorted(r["rank"] for r in ranked.collect()) == want
    rows = ranks.rank_rows(df, ["g"], "v")
    assert sorted(r["rank"] for r in rows.collect()) == [1, 1, 3, 4]


def test_top_n_keeps_ties(frame):
    df = frame([("s", h, c) for h, c in ((0, 5), (1, 3), (2, 2), (3, 2))], "s string, h int, c int")
    top = ranks.top_n_per_group(df, ["s"], [F.desc("c")], 3)
    assert rows_of(top.select("h", "rank")) == [(0, 1), (1, 2), (2, 3), (3, 3)]


VALUES = st.one_of(
    st.none(),
    st.sampled_from([0.0, -0.0, 1.0, -1.0, 1e-9, 1e12, -1e12, 0.1, 0.30000000000000004, 0.3]),
    st.floats(allow_nan=True, allow_infinity=True, width=32),
)


@SLOW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), VALUES), min_size=1, max_size=60))
def test_rank_rows_equals_a_window(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    window = W.partitionBy("g").orderBy(F.desc_nulls_last("v"))
    want = repr(rows_of(df.withColumn("rank", F.rank().over(window))))  # NaN does not equal itself
    for limits in ({}, {"heavy_rows": 1}, {"heavy_rows": 1, "heavy_groups": 1, "parts": 4}):
        got = ranks.rank_rows(df, ["g"], "v", **limits)
        assert repr(rows_of(got.select("g", "v", "rank"))) == want


def test_rank_rows_puts_nan_above_infinity(spark):
    rows = [("g", 1.0), ("g", float("inf")), ("g", float("nan")), ("g", float("-inf"))]
    ranked = ranks.rank_rows(spark.createDataFrame(rows, "g string, v double"), ["g"], "v").collect()
    assert {str(r["v"]): r["rank"] for r in ranked} == {"nan": 1, "inf": 2, "1.0": 3, "-inf": 4}


def test_rank_rows_with_a_hot_value(spark):
    df = spark.range(30_000).select(
        F.lit("s").alias("g"),
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("id").cast("double")).alias("v"),
    )
    window = W.partitionBy("g").orderBy(F.desc_nulls_last("v"))
    want = rows_of(df.withColumn("rank", F.rank().over(window)))
    for heavy_rows in (5_000, 5_000_000):
        got = ranks.rank_rows(df, ["g"], "v", heavy_rows=heavy_rows)
        assert rows_of(got.select("g", "v", "rank")) == want


def test_rank_rows_reads_twice_and_shuffles_the_rows_once(spark, tmp_path):
    spark.range(4_000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("v"), "id").write.parquet(str(tmp_path / "rows"))
    ranked = ranks.rank_rows(spark.read.parquet(str(tmp_path / "rows")), ["g"], "v", heavy_rows=100)
    tasks = ranked.withColumn("task", F.spark_partition_id())
    assert ranked.collect()
    plan = ranked._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    shuffles = [line for line in plan.splitlines() if " Exchange " in f" {line.strip(' :+-*()0123456789')} " and "Reused" not in line]
    assert plan.count("FileScan") == 2 and len(shuffles) <= 4
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = tasks.filter("g = 0 AND v = 7").select("task").distinct().count()
        others = tasks.filter("g = 0 AND v <> 7").select("task").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert hot >= 1 and others > 1


def test_rank_rows_in_one_crowded_bin_of_many_values(spark):
    df = spark.range(20_000).select(
        F.lit("s").alias("g"),
        (1 + F.pmod(F.xxhash64("id"), F.lit(5_000)) * 1e-12).alias("v"),
    )
    window = W.partitionBy("g").orderBy(F.desc_nulls_last("v"))
    want = rows_of(df.withColumn("rank", F.rank().over(window)))
    got = ranks.rank_rows(df, ["g"], "v", heavy_rows=100)
    assert rows_of(got.select("g", "v", "rank")) == want


# --- shares ---------------------------------------------------------------


def test_conditional_ratio(frame):
    df = frame([("a", 1), ("a", None), ("a", 5), ("b", 9)], "k string, v int")
    got = shares.conditional_ratio(df, ["k"], F.col("v") < 3, "r", 100)
    assert rows_of(got) == [("a", 1 / 3 * 100), ("b", 0.0)]


def test_count_conditions(frame):
    df = frame([(True,), (False,), (None,)], "f boolean")
    got = shares.count_conditions(df, {"yes": F.col("f"), "no": ~F.col("f")})
    assert rows_of(got) == [(1, 1)]


def test_shares_sum_to_one_and_drop_unknown_parents(frame):
    df = frame(
        [("a", "x", 1), ("a", "y", 3), ("b", "x", 5), ("z", "x", 0), (None, "x", 7)],
        "p string, c string, m int",
    )
    got = shares.share_of_parent(df, "p", "m")
    assert rows_of(got.select("p", "c", "share")) == [
        ("a", "x", 0.25), ("a", "y", 0.75), ("b", "x", 1.0), ("z", "x", None),
    ]


def test_running_share(frame):
    df = frame([("a", 1, 0.5), ("a", 2, 0.25), ("a", 3, 0.25)], "p string, r int, s double")
    got = shares.running_share(df, ["p"], "r", "s")
    assert [r["cumulative_share"] for r in got.orderBy("r").collect()] == [0.5, 0.75, 1.0]


def test_leaders_summary(frame):
    df = frame([("p", "TX", 0.5), ("p", "AL", 0.7), ("q", "TX", 0.5)], "e string, s string, v double")
    got = shares.leaders_summary(df, "e", "s", "v")
    assert [(r[0], r[1], round(r[2], 9), r[3]) for r in got.orderBy("e").collect()] == [
        ("p", 2, 0.6, ["AL", "TX"]), ("q", 1, 0.5, ["TX"]),
    ]


# --- stats ----------------------------------------------------------------


def test_profile_and_preview(frame):
    df = frame([(1, 2.0, "x", True), (3, None, "y", None)], "a int, `b(mi)` double, c string, d boolean")
    assert stats.numeric_columns(df) == ["a", "b(mi)"]
    assert rows_of(stats.profile(df)) == [
        ("a", 2, 2.0, pytest.approx(2**0.5), 1.0, 3.0), ("b(mi)", 1, 2.0, None, 2.0, 2.0),
    ]
    assert rows_of(stats.profile(df, ["a"]))[0][0] == "a"
    assert stats.preview(df, columns=2, rows=1).columns == ["a", "b(mi)"]
    assert stats.preview(df, columns=2, rows=1).count() == 1


def test_profile_takes_long_and_decimal_columns(frame):
    rows = [(2**53 + 1, Decimal("0.10"), 1.5), (-(2**53), Decimal("0.20"), None)]
    df = frame(rows, "code long, money decimal(12,2), f float")
    got = {r["column_name"]: r for r in stats.profile(df).collect()}
    assert set(got) == {"code", "money", "f"}
    assert got["code"]["mean"] == 0.5
    assert (got["money"]["mean"], got["money"]["n"], got["f"]["n"]) == (0.15, 2, 1)
    assert stats.profile(df.select(F.lit("x").alias("t"))).collect() == []


def test_profile_agrees_with_describe(frame):
    df = frame([(i, float(i * i)) for i in range(20)], "a int, b double")
    described = {r["summary"]: r for r in df.describe().collect()}
    for row in stats.profile(df).collect():
        c = row["column_name"]
        assert float(described["mean"][c]) == row["mean"]
        assert float(described["stddev"][c]) == pytest.approx(row["stddev"])
        assert float(described["min"][c]) == row["min"] and float(described["max"][c]) == row["max"]


def test_percentile_gap(frame):
    df = frame([("s", v) for v in [*range(1, 11), 0, -5, None]], "s string, v int")
    assert rows_of(stats.percentile_gap(df, ["s"], "v", "gap")) == [("s", 8.0)]
    assert df.filter("v > 0").agg(stats.median_of("v")).first()[0] == 5


@pytest.mark.parametrize("accuracy", [10, 10_000])
def test_exact_quantiles(spark, accuracy):
    """Whatever the accuracy of the brackets; values that a double cannot hold, hot values, NULL keys."""
    draw = random.Random(accuracy)
    rows = [(draw.choice(["a", "b", None]), draw.choice([None, 5, 2**60 + draw.randrange(50), draw.randrange(10**6)])) for _ in range(900)]
    rows += [("none", None), ("one", 3)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(4)
    points = {"low": 0.1, "mid": 0.5, "high": 0.9, "least": 0.0, "most": 1.0}
    got = quantiles.exact_quantiles(df, ["k"], "v", points, [F.count("*").alias("n")], accuracy)
    want = []
    for key in {k for k, _ in rows}:
        values = sorted(v for k, v in rows if k == key and v is not None)
        places = [max(1, math.ceil(Decimal(str(p)) * len(values))) for p in points.values()]
        want.append((key, *(values[p - 1] if values else None for p in places), sum(k == key for k, _ in rows)))
    assert rows_of(got) == sorted(want, key=repr)


def test_exact_quantiles_of_nothing(frame):
    df = frame([("a", float("nan")), ("b", float("nan")), ("b", 2.0)], "k string, v double")
    assert rows_of(quantiles.exact_quantiles(df, ["k"], "v", {"mid": 0.5})) == [("a", None), ("b", 2.0)]
    assert quantiles.exact_quantiles(df.limit(0), ["k"], "v", {"mid": 0.5}).collect() == []


def test_bounded_lookup(frame):
    df = frame([("a", 1.0), ("a", 3.0), (None, 5.0), ("?", 2.0)], "k string, v double")
    got = stats.deviation_from_peers(df, ["k"], "v", "mean", "off", max_groups=3)
    assert rows_of(got.select("k", "v", "mean", "off")) == [("?", 2.0, 2.0, 0.0), ("a", 1.0, 2.0, -1.0), ("a", 3.0, 2.0, 1.0), (None, 5.0, 5.0, 0.0)]
    with pytest.raises(Exception, match="more than 2 groups"):
        stats.deviation_from_peers(df, ["k"], "v", "mean", "off", max_groups=2).collect()


def test_min_max(frame):
    df = frame([("a", 1, 5), ("b", 3, 5), ("c", 2, 5)], "k string, x int, y int")
    got = stats.min_max_normalise(df, ["x", "y"]).select("k", "x_norm", "y_norm")
    assert rows_of(got) == [("a", 0.0, 0.5), ("b", 1.0, 0.5), ("c", 0.5, 0.5)]


def test_category_gap(frame):
    df = frame([("a", 1, 10.0), ("a", 2, 4.0), ("a", 3, 99.0), ("b", 1, 7.0)], "k string, c int, v double")
    names = ("one", "two", "gap", "n")
    got = stats.category_gap(df, ["k"], "c", 1, 2, "v", names).select("k", *names)
    assert rows_of(got) == [("a", 10.0, 4.0, 6.0, 2), ("b", 7.0, None, None, 1)]


def test_median_screen_of_nothing(frame):
    df = frame([], "a double, b double, n long")
    assert stats.median_screen(df, "a", "b", "score", "n").collect() == []


def test_median_screen_is_strict(frame):
    rows = [("w", 1.0, 9.0), ("x", 2.0, 5.0), ("y", 3.0, 1.0), ("z", 2.0, 1.0)]
    df = frame([(k, a, b, 10) for k, a, b in rows], "k string, a double, b double, n long")
    got = stats.median_screen(df, "a", "b", "score", "n")
    # The medians are 2.0 and 1.0; nothing lies below 1.0.
    assert got.collect() == []
    kept = stats.median_screen(df.withColumn("b", -F.col("a")), "a", "b", "score", "n")
    assert [r["k"] for r in kept.collect()] == ["y"]


# --- pairs ----------------------------------------------------------------


def brute_pairs(rows, max_gap):
    found = []
    for a, b in combinations([r for r in rows if None not in r], 2):
        if a[0] == b[0] and a[1] != b[1] and a[2] != b[2] and abs(a[3] - b[3]) < max_gap:
            first, second = (a, b) if a[2] < b[2] else (b, a)
            found.append((a[0], first[2], first[1], second[2], second[1]))
    return sorted(found, key=repr)


def near(spark, rows, max_gap=100, chunk_rows=2_000, parts=3):
    df = spark.createDataFrame(rows, "k string, d string, i string, t long").repartition(parts)
    return pairs.near_pairs(df, "k", "d", "i", F.col("t"), max_gap, chunk_rows)


@pytest.mark.parametrize("chunk_rows, parts", [(2_000, 1), (1, 3), (3, 17)])
def test_near_pairs_equal_brute_force(spark, chunk_rows, parts):
    rng = random.Random(7)
    rows = [
        (rng.choice(["z1", "z2", None]), rng.choice(["s1", "s2", "s3", None]), f"A-{i}",
         rng.choice([None, *range(-150, 450, 7)]))
        for i in range(120)
    ]
    assert rows_of(near(spark, rows, 100, chunk_rows, parts)) == brute_pairs(rows, 100)


def test_near_pairs_edges(spark):
    def found(*rows):
        return rows_of(near(spark, list(rows), 86_400))

    assert found(("z", "S1", "a", 0), ("z", "S2", "b", 86_399)) == [("z", "a", "S1", "b", "S2")]
    assert found(("z", "S1", "a", 0), ("z", "S2", "b", 86_400)) == []
    assert found(("z", "S1", "a", 0), ("z", "S1", "b", 1)) == []
    assert found(("z", "S1", "a", 0), ("y", "S2", "b", 1)) == []
    assert found(("z", None, "a", 0), ("z", "S2", "b", None)) == []
    # Ids compare as text, so A-10 comes before A-2 whichever street is first.
    assert found(("z", "S1", "A-2", 5), ("z", "S2", "A-10", 5)) == [("z", "A-10", "S2", "A-2", "S1")]
    # Either side of a slot border.
    assert found(("z", "S1", "a", 86_399), ("z", "S2", "b", 86_401)) == [("z", "a", "S1", "b", "S2")]


def test_near_pairs_with_a_hot_street(spark):
    """Thousands of rows on one street at one time meet one row on another."""
    rows = [("hot", "S1", f"h{i}", 10) for i in range(6_000)] + [("hot", "S2", "x", 20)]
    rows += [(f"z{i}", "S1", f"c{i}", i) for i in range(3_000)]
    got = near(spark, rows, 100, chunk_rows=500)
    assert got.count() == 6_000
    assert got.select("id_a").distinct().count() == 6_000


def test_near_pairs_split_a_key_with_many_streets(spark):
    """No street is crowded, but the key is; the pairs come from several tasks."""
    rows = [("hot", f"S{i:04}", f"h{i:04}", i % 100) for i in range(600)]
    got = near(spark, rows, 100, chunk_rows=100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = got.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in spread) == 600 * 599 // 2
    assert len(spread) > 1
    assert got.distinct().count() == 600 * 599 // 2


def test_near_pairs_beside_a_crowded_slot(spark):
    """Crowded and ordinary slots, frequent and other streets, on both sides of a border."""
    rng = random.Random(3)
    rows = [
        (rng.choice(["z1", "z2"]), rng.choice(["s1"] * 6 + ["s2", "s3", "s4"]), f"A-{i}", t)
        for i, t in enumerate([*range(0, 100, 2), 150, 199, 200, 250, 399, *range(400, 500, 9)])
    ]
    for chunk_rows in (1, 2, 7, 1_000):
        assert rows_of(near(spark, rows, 100, chunk_rows)) == brute_pairs(rows, 100)


def test_near_pairs_read_the_rows_three_times(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([("z", "s", "i", 1)], "k string, d string, i string, t long").write.parquet(path)
    got = pairs.near_pairs(spark.read.parquet(path), "k", "d", "i", F.col("t"), 100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("FileScan parquet") <= 3


def test_co_occurrence(frame):
    df = frame(
        [("c1", "d1", "Light Rain"), ("c1", "d1", "Snow"), ("c2", "d1", "rain"), ("c2", "d1", "Snow"),
         ("c3", "d1", "Rain"), ("c3", "d2", "Snow"), ("c4", None, "Rain and Snow"), ("c5", "d1", None)],
        "c string, d string, w string",
    )
    got = pairs.co_occurrence(
        df, ["c"], {"day": F.col("d")}, [F.col("w").contains("Rain"), F.col("w").contains("Snow")]
    )
    assert rows_of(got) == [("c1",), ("c4",)]


# --- moments ----------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 60])
def test_profile_equals_sparks_aggregates(spark, n):
    draw = random.Random(n)

    def some(value):
        return None if draw.random() < 0.2 else value

    rows = [
        (
            some(draw.randint(-(2**63), 2**63 - 1)), some(Decimal(draw.randint(-10**11, 10**11)).scaleb(-2)),
            some(Decimal(draw.randint(-10**23, 10**23)).scaleb(-3)), some(draw.choice([draw.uniform(-1e6, 1e6), float("nan")])),
        )
        for _ in range(n)
    ]
    df = spark.createDataFrame(rows, "i long, d decimal(12,2), w decimal(28,3), f float").repartition(3)
    got = {r["column_name"]: r for r in stats.profile(df).collect()}
    for c in df.columns:
        want = df.agg(F.count(c), F.sum(F.col(c).cast("decimal(38,3)") if c != "f" else F.col(c)), F.stddev(c), F.min(c).cast("double"), F.max(c).cast("double")).first()
        n, total, deviation, low, high = want
        assert got[c]["n"] == n
        assert repr((got[c]["min"], got[c]["max"])) == repr((low, high))
        if n:
            mean = float(total) / n
            assert got[c]["mean"] == pytest.approx(mean, rel=1e-12, abs=1e-6, nan_ok=True)
        if n < 2:
            assert got[c]["stddev"] is None
        else:
            assert got[c]["stddev"] == pytest.approx(deviation, rel=1e-6, abs=1e-6, nan_ok=True)


def test_profile_scans_once_and_shuffles_a_row_per_task(spark, tmp_path):
    wide = spark.range(2000).select(*((F.col("id") * k % 97).alias(f"c{k}") for k in range(268)))
    wide.write.parquet(str(tmp_path / "wide"))
    profiled = stats.profile(spark.read.parquet(str(tmp_path / "wide")))
    assert profiled.count() == 268
    plan = profiled._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Expand" not in plan


def test_profile_of_no_rows(frame):
    assert stats.profile(frame([], "a int, b double")).collect() == []
    assert rows_of(stats.profile(frame([(None, 1.0)], "a int, b double"))) == [("a", 0, None, None, None, None), ("b", 1, 1.0, None, 1.0, 1.0)]
