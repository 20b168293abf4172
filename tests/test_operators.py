"""Joins, rollups, ordered operators, reshape, filters and column tests on hand-written rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from opsmart.operators import filters, joins, ordered, quality, reshape, rollups


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_context_join_keeps_facts(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, city string")
    place = spark.createDataFrame([("a", 10)], "name string, x int")
    assert rows(joins.with_context(fact, place, {"city": "name"}, ["x"]), "id") == [(1, "a", 10), (2, "b", None), (3, None, None)]


def test_spine_join_and_zero_fill(spark):
    spine = spark.createDataFrame([(1,), (2,)], "k int")
    facts = [spark.createDataFrame([(1, 5)], "k int, a int"), spark.createDataFrame([(2, 7)], "k int, b int")]
    joined = joins.zero_fill(joins.spine_join(spine, facts, ["k"]), ["a", "b"])
    assert rows(joined, "k") == [(1, 5, 0), (2, 0, 7)]


def test_gaps_and_labels(spark):
    months = spark.createDataFrame([("x", 1)], "city string, m int")
    expected = joins.expand_with(months, {"asset": ["p", "q"], "cost": ["l"]})
    actual = spark.createDataFrame([("x", 1, "p", "l")], "city string, m int, asset string, cost string")
    assert rows(joins.coverage_gaps(expected, actual, ["city", "m", "asset", "cost"])) == [("x", 1, "q", "l")]
    codes = spark.createDataFrame([("NG",), ("LIG",)], "code string")
    names = spark.createDataFrame([("NG", "Natural Gas")], "code string, name string")
    assert rows(joins.with_labels(codes, names, "code", "name", "fuel"), "code") == [("LIG", "LIG"), ("NG", "Natural Gas")]


def test_join_on_expression(spark):
    left = spark.createDataFrame([("Fort_Collins",), ("Denver",)], "city string")
    right = spark.createDataFrame([("Fort Collins", 3)], "city string, n int")
    got = joins.join_on_expression(left, right, F.regexp_replace("city", "_", " "), F.col("city"), ["n"])
    assert rows(got, "city") == [("Denver", None), ("Fort_Collins", 3)]


def test_most_frequent_takes_lowest_on_ties(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (1, None), (2, "z"), (2, "z"), (2, "a"), (3, None)], "k int, v string")
    assert rows(rollups.most_frequent(df, ["k"], "v", "top"), "k") == [(1, "a"), (2, "z"), (3, None)]


def test_counts_totals_profile_mix(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None)], "k string, v double")
    assert rows(rollups.value_counts(df, "k")) == [("a", 2), ("b", 1)]
    assert rows(rollups.totals_by(df, "v", "k")) == [("a", 3.0), ("b", None)]
    assert rows(rollups.totals_by(df, "v")) == [(3.0,)]
    assert rows(rollups.profile(df, "v")) == [(1.0, 2.0, 1.5, 2)]
    assert rows(rollups.distinct_values(df, "k")) == [("a",), ("b",)]
    assert rows(rollups.distinct_values(df, "k", newest=1)) == [("b",)]
    mix = spark.createDataFrame([("g", "x"), ("g", "x"), ("g", "y"), ("h", "y")], "g string, m string")
    assert rows(rollups.mix_within(mix.withColumn("g", F.lit(None).cast("string")), "g", "m"), "m") == [(None, "x", 2, 4, 0.5), (None, "y", 2, 4, 0.5)]
    assert rows(rollups.mix_within(mix, "g", "m"), "g", "m") == [("g", "x", 2, 3, 0.6667), ("g", "y", 1, 3, 0.3333), ("h", "y", 1, 1, 1.0)]


def test_shares_and_running_shares(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 2.0), ("c", 1.0)], "k string, v double")
    shared = ordered.share_of_total(df, "v", "share")
    got = ordered.running_total(shared, "share", "run", F.desc("v"), F.col("k"))
    assert rows(got.select("k", "share", F.round("run", 1)), "k") == [("a", 50.0, 50.0), ("b", 33.3, 83.3), ("c", 16.7, 100.0)]


def test_running_total_and_rank_over_many_ranges(spark, many_ranges):
    """A third of all rows share one value."""
    values = [float(5 if i % 3 == 0 else i % 17) for i in range(600)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double").repartition(7)
    got = {r["id"]: r["run"] for r in ordered.running_total(df, "v", "run", F.desc("v"), F.col("id")).collect()}
    total = 0.0
    for i, v in sorted(enumerate(values), key=lambda p: (-p[1], p[0])):
        total += v
        assert got[i] == total
    ranks = {r["id"]: r["rank"] for r in ordered.rank_descending(df, "v", "rank").collect()}
    for i, v in enumerate(values):
        assert ranks[i] == 1 + sum(x > v for x in values)


def test_rank_gaps_and_nulls(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0), (3, 1.0), (4, None)], "id int, v double")
    assert rows(ordered.rank_descending(df, "v", "rank").select("id", "rank"), "id") == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_lag_counts_rows_not_months(spark):
    months = [m for m in range(1, 15) if m != 3]
    df = spark.createDataFrame([("s", m, float(m * m)) for m in months], "s string, m int, v double")
    got = {r["m"]: r["d"] for r in ordered.lag_change(df, "v", "d", ["s"], "m", 12).collect()}
    assert got[14] == 14.0**2 - 1.0 and got[13] is None


def test_lags_of_a_large_group(spark, many_ranges):
    """One group holds a third of all rows and spans several ranges; one group is NULL."""
    data = [("hot" if i % 3 == 0 else None if i % 3 == 1 else f"g{i % 5}", i, float(i * i % 101)) for i in range(900)]
    df = spark.createDataFrame(data, "g string, t int, v double").repartition(5)
    got = {r["t"]: (r["one"], r["twelve"]) for r in ordered.lag_changes(df, ["g"], ["t"], {"one": ("v", 1), "twelve": ("v", 12)}).collect()}
    assert len(got) == 900
    seen = {}
    for g, t, v in data:
        past = seen.setdefault(g, [])
        assert got[t] == (v - past[-1] if past else None, v - past[-12] if len(past) >= 12 else None)
        past.append(v)


def test_group_peak(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, "a", 5.0), (3, "a", 1.0), (4, "b", None), (5, None, 2.0)], "id int, g string, v double")
    assert [r[0] for r in rows(ordered.group_peak_flag(df, "v", "p", ["g"]).orderBy("id").select("p"))] == [1, 1, 0, 0, 1]


def test_reshape(spark):
    wide = spark.createDataFrame([("2024-01", "7", "x", "u")], "period string, sales string, price string, `sales-units` string")
    long = reshape.melt_with_units(wide, ["period"], ["sales", "revenue", "price"])
    assert rows(long, "data_type") == [("2024-01", "price", None, ""), ("2024-01", "sales", 7.0, "u")]
    back = reshape.pivot_max(long, ["period"], "data_type", "value", ["sales", "price", "revenue"])
    assert rows(back) == [("2024-01", 7.0, None, None)]
    cells = spark.createDataFrame([("r", 1, 2.0), ("r", 1, 3.0), ("r", 2, 4.0)], "k string, c int, v double")
    assert rows(reshape.cross_tab(cells, "k", "c", [1, 2, 3], F.sum("v"))) == [("r", 5.0, 4.0, None)]


def test_filters(spark):
    df = spark.createDataFrame([(1, "ALL", 1.0), (2, None, 2.0), (3, "RES", None)], "id int, s string, v double")
    assert [r[0] for r in rows(filters.except_value(df, "s", "ALL"))] == [3]
    assert [r[0] for r in rows(filters.drop_missing(df, ["v"]), "id")] == [1, 2]
    assert [r[0] for r in rows(filters.latest_period(df, "id"))] == [3]
    assert [r[0] for r in rows(filters.facets(df, s=["RES"]))] == [3]
    assert [r[0] for r in rows(filters.between(df, "id", 2, 3), "id")] == [2, 3]
    assert [r[0] for r in rows(filters.at_least(df, "v", 2.0, ["id"]))] == [2]
    assert [r[0] for r in rows(filters.top_k(df, 2, F.desc("id")))] == [3, 2]
    empty = df.filter("id > 9")
    assert filters.first_non_empty(empty, df).count() == 3 and filters.first_non_empty(df, empty).count() == 3
    assert filters.has_rows(df) and not filters.has_rows(empty)
    assert filters.lower_names(df.toDF("ID", "S", "V")).columns == ["id", "s", "v"]
    assert filters.present_columns(df, ["v", "zz", "id"]) == ["v", "id"]
    assert filters.with_constants(df, {"c": "k"}).first()["c"] == "k"


def test_relative_window_ends(spark):
    as_of = dt.date(2026, 8, 31)
    days = [as_of - dt.timedelta(days=n) for n in (91, 90, 5, 4)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in rows(filters.relative_window(df, "d", as_of), "d")] == [days[1], days[2]]


def test_column_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, "x"), (None, None), (None, "a")], "id int, s string")
    report = quality.run_tests(df, "t", [*quality.not_null("id", "s", severity="warn"), *quality.accepted_values("s", ["a"]), *quality.unique("id")])
    got = {(r["column_name"], r["test"]): (r["failures"], r["severity"], r["passed"]) for r in report.collect()}
    assert got == {
        ("id", "not_null"): (2, "warn", False), ("s", "not_null"): (1, "warn", False),
        ("s", "accepted_values"): (1, "error", False), ("id", "unique"): (1, "error", False),
    }
    assert quality.failed_errors(report).count() == 2


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 7 AS period", "'x' AS s", "1.0 AS unused").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    plan = filters.facets(filters.except_value(df, "s", "ALL"), period=[1, 2]).select("id")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(s), Not(EqualTo(s,ALL)), In(period, [1,2])" in plan
    assert "unused" not in plan.split("ReadSchema")[1]


def test_shares_and_running_totals_of_small_and_large_values(spark):
    small = spark.createDataFrame([("a", 0.00002), ("b", 0.00002)], "k string, v double")
    assert {r["share"] for r in ordered.share_of_total(small, "v", "share").collect()} == {50.0}
    run = lambda df: [r["run"] for r in ordered.running_total(df, "v", "run", F.col("k")).orderBy("k").collect()]
    assert run(small) == [0.00002, 0.00004]
    assert run(spark.createDataFrame([("a", 3e14), ("b", None), ("c", 1e40), ("d", 1.0)], "k string, v double")) == [3e14, 3e14, 1e40, 1e40]


def test_changes_across_ranges(spark, many_ranges):
    """Groups of every size over many ranges, nulls among values and groups, against lags of whole groups."""
    rng = random.Random(4)
    rows = [(g, t, None if rng.random() < 0.1 else rng.random()) for g, n in ((None, 3), ("a", 500), ("b", 1), ("c", 40), ("d", 13)) for t in range(n)]
    df = spark.createDataFrame(rows, "g string, t int, v double")
    df = df.withColumn("__range_like", F.lit(1))
    got = ordered.lag_changes(df, ["g"], ["t"], {"one": ("v", 1), "twelve": ("v", 12), "two": ("t", 2)})
    assert got.columns == ["g", "t", "v", "__range_like", "one", "twelve", "two"] and got.count() == len(rows)
    known = {(g, t): v for g, t, v in rows}
    minus = lambda a, b: None if a is None or b is None else a - b
    for r in got.collect():
        v = known[r["g"], r["t"]]
        want = [minus(v, known.get((r["g"], r["t"] - n))) for n in (1, 12)]
        assert [r["one"], r["twelve"]] == want and r["two"] == (2 if r["t"] >= 2 else None)


def test_changes_need_one_row_per_key(spark):
    df = spark.createDataFrame([("a", 1, 1.0, 1), ("a", 1, 2.0, 2), ("a", 2, 4.0, 3)], "g string, t int, v double, n int")
    with pytest.raises(Exception, match="several rows of a group are equal in t"):
        ordered.lag_changes(df, ["g"], ["t"], {"d": ("v", 1)}).collect()
    split = ordered.lag_changes(df, ["g"], ["t", "n"], {"d": ("v", 1)})
    assert [r["d"] for r in split.orderBy("n").collect()] == [None, 1.0, 2.0]
