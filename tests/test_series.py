import datetime as dt

from pyspark.sql import functions as F

from sieveframe.operators import series
from sieveframe.operators.ranking import (
    category_order,
    key_at_max,
    key_at_min,
    top,
    with_top_flag,
)
from tests.conftest import values


def at(day, hour=0):
    return dt.datetime(2015, 1, 1, hour) + dt.timedelta(days=day)


def rows(spark, items):
    return spark.createDataFrame(items, "k string, t timestamp_ntz")


def test_missing_days_count_zero_whatever_the_time(spark):
    df = rows(spark, [("a", at(0, 23)), ("a", at(0, 1)), ("a", at(3, 5)), ("a", None)])
    filled = series.fill_days(series.count_by_day(df, "t"))
    assert values(filled, "claims", "day") == [2, 0, 0, 1]


def test_keyed_series_equals_one_series_each(spark):
    items = [("a", at(0)), ("a", at(5)), ("b", at(2)), ("b", at(2, 9)), ("c", at(20)), (None, at(1))]
    df = rows(spark, items)
    keyed = series.fill_days(series.count_by_day(df, "t", ["k"]), ["k"])
    assert keyed.filter("k is null").isEmpty()
    for key in "abc":
        alone = series.fill_days(series.count_by_day(df.filter(F.col("k") == key), "t"))
        mine = keyed.filter(F.col("k") == key).select("day", "claims")
        assert sorted(map(str, mine.collect())) == sorted(map(str, alone.collect()))


def test_keyed_fill_and_rolling_mean_shuffle_once_by_key(spark):
    df = rows(spark, [("a", at(0))])
    out = series.daily(series.count_by_day(df, "t", ["k"]), ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") == 2  # per (key, day), then by key
    assert "Join" not in plan


def test_rolling_mean_needs_fourteen_days(spark):
    df = rows(spark, [("a", at(i)) for i in range(16) for _ in range(i)] + [("a", at(0))])
    out = values(series.daily(series.count_by_day(df, "t")), "avg_14d", "day")
    counts = [1, *range(1, 16)]
    assert out[:13] == [None] * 13
    assert out[13:] == [sum(counts[i - 13 : i + 1]) / 14 for i in (13, 14, 15)]


def test_halves_of_an_odd_period(spark):
    df = rows(spark, [("a", at(0)), ("a", at(1)), ("a", at(2)), ("a", at(2)), ("a", at(4))])
    [row] = series.halves(series.fill_days(series.count_by_day(df, "t"))).collect()
    assert tuple(row) == (5, 1.0, 1.0)


def test_empty_series(spark):
    counts = series.count_by_day(rows(spark, []), "t")
    assert series.fill_days(counts).isEmpty()
    assert series.halves(series.fill_days(counts)).first().days == 0


def test_period_counts_calendar_days(spark):
    df = rows(spark, [("a", at(0, 23)), ("a", at(1, 1))])
    row = series.period(df, "t").first()
    assert (row.days, round(row.months, 4)) == (2, 0.0667)


def test_top_breaks_ties_by_key_and_puts_null_last(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", None), ("d", 1)], "k string, v int")
    assert [r.k for r in top(df, "v", "k", n=3).collect()] == ["a", "b", "d"]
    plan = top(df, "v", "k")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_keys_at_the_ends(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", None), ("d", 1)], "k string, v int")
    k, v = F.col("k"), F.col("v")
    assert tuple(df.agg(key_at_max(v, k), key_at_min(v, k)).first()) == ("a", "d")


def test_one_row_is_flagged(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", None), ("d", 1.0)], "k string, v double")
    out = with_top_flag(df, "k", "v").collect()
    assert [(r.k, r.is_top) for r in out] == [
        ("c", False), ("d", False), ("b", False), ("a", True),
    ]


def test_category_order(spark):
    df = spark.createDataFrame([("lo",), ("mid",), ("hi",), ("?",)], "k string")
    place = category_order(F.col("k"), ["lo", "mid", "hi"])
    assert [r[0] for r in df.select(place).collect()] == [1, 2, 3, 3]
