import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sieveframe.functions import dates, numbers, text
from sieveframe.functions.text import WHITESPACE, snake_name


@pytest.mark.parametrize(
    "name, expected",
    [
        ("unit price (net)", "unit_price_net"),
        ("shipToCity", "ship_to_city"),
        ("\tLot No.", "lot_no"),
        ("aBCd", "a_bcd"),
        ("  x__Y  ", "x_y"),
        ("1Ab2C", "1_ab2_c"),
        ("already_snake", "already_snake"),
        ("été", "t"),
        ("--", ""),
    ],
)
def test_snake_name(name, expected):
    assert snake_name(name) == expected


def test_whitespace_is_what_python_strips():
    every = [chr(i) for i in range(0x11000) if not 0xD800 <= i < 0xE000]
    assert set(WHITESPACE) == {c for c in every if c.isspace()}


def test_strip_blank_equals_str_strip(spark):
    generator = random.Random(1)
    alphabet = WHITESPACE + "aé漢​😀"
    cells = ["".join(generator.choices(alphabet, k=n % 7)) for n in range(600)]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = [r[0] for r in df.select(text.strip_blank(F.col("c"))).collect()]
    assert got == [c.strip() or None for c in cells]


def test_yes_no(spark):
    df = spark.createDataFrame([(c,) for c in ["yes", "Y", "No", "n", "maybe", None]], "c string")
    assert [r[0] for r in df.select(text.yes_no(F.col("c"))).collect()] == [
        True, True, False, False, None, None,
    ]
    assert [r[0] for r in df.select(text.is_yes_no(F.col("c"))).collect()] == [
        True, True, True, True, False, None,
    ]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=50, max_size=60))
def test_formats_equal_python(spark, cells):
    cells = [*cells, 0.5, 1.5, 2.5, 12.5, -0.04, 0.25, 1234567.5, 999999.96, -0.5]
    df = spark.createDataFrame([(c,) for c in cells], "x double")
    x = F.col("x")
    got = df.select(
        numbers.fixed(x, 0), numbers.fixed(x, 1), numbers.grouped(x),
        numbers.grouped(x, 2), numbers.signed(x, 1), numbers.signed(x, 0),
    ).collect()
    for c, row in zip(cells, got):
        want = (f"{c:.0f}", f"{c:.1f}", f"{c:,.0f}", f"{c:,.2f}", f"{c:+.1f}", f"{c:+.0f}")
        assert tuple(row) == want


def test_percent_and_dollar_texts(spark):
    row = spark.range(1).select(
        numbers.as_percent(F.lit(0.605), 1),
        numbers.as_percent(F.lit(0.125), 0),
        numbers.dollars(F.lit(64067.3)),
        numbers.big_dollars(F.lit(52761940.0)),
        numbers.big_dollars(F.lit(999999.0)),
    ).first()
    assert tuple(row) == ("60.5%", "12%", "$64,067", "$52.8M", "$999,999")


def test_two_roundings(spark):
    df = spark.createDataFrame([(v,) for v in (0.5, 1.5, 2.5, -2.5, 2.7)], "x double")
    even = [r[0] for r in df.select(numbers.half_even(F.col("x"))).collect()]
    up = [r[0] for r in df.select(F.round("x")).collect()]
    whole = [r[0] for r in df.select(numbers.to_bigint(F.col("x"))).collect()]
    assert even == [0, 2, 2, -2, 3]
    assert up == [1, 2, 3, -3, 3]
    assert whole == [0, 2, 2, -2, 3]


def test_half_even_digits(spark):
    df = spark.createDataFrame([(v,) for v in (0.25, 0.35, 33.349, 66.65)], "x double")
    got = [r[0] for r in df.select(numbers.half_even(F.col("x"), 1)).collect()]
    assert got == [0.2, 0.4, 33.3, 66.6]


def test_exact_sum_ignores_the_order(spark):
    cells = [0.1, 0.2, 0.3, 1e9, -1e9, 0.07] * 50
    for part in (cells, cells[::-1], sorted(cells)):
        df = spark.createDataFrame([(c,) for c in part], "x double").repartition(3)
        total = df.agg(numbers.exact_sum(df, "x").cast("double")).first()[0]
        assert total == 33.5


def test_exact_sum_keeps_whole_numbers_and_missing(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a long, b double")
    row = df.agg(
        numbers.exact_sum(df, "a"), numbers.exact_sum(df, "b"), numbers.exact_mean(df, "a")
    ).first()
    assert tuple(row) == (3, None, 1.5)


def test_ratio_and_percent_by_zero(spark):
    row = spark.range(1).select(
        numbers.ratio(F.lit(1), F.lit(0)), numbers.percent(F.lit(1), F.lit(0)),
        numbers.percent(F.lit(1), F.lit(8)),
    ).first()
    assert tuple(row) == (None, None, 12.5)


def test_dates(spark):
    import datetime as dt

    df = spark.sql(
        "select timestamp_ntz '2015-02-01 23:30:00' as a, "
        "timestamp_ntz '2015-02-03 00:10:00' as b"
    )
    a, b = F.col("a"), F.col("b")
    row = df.select(
        dates.day(a), dates.week_start(a), dates.days_spanned(a, b),
        dates.short_day(b), dates.long_day(b),
    ).first()
    assert tuple(row) == (
        dt.date(2015, 2, 1), dt.date(2015, 1, 26), 3, "Feb 3", "Feb 3, 2015",
    )


@pytest.mark.parametrize(
    "cell, parsed",
    [
        ("2015-01-25", "2015-01-25 00:00:00"),
        ("20150125", "2015-01-25 00:00:00"),
        ("2015-01-25T10:11:12", "2015-01-25 10:11:12"),
        ("2015-01-25 10:11", "2015-01-25 10:11:00"),
        ("2015-01", "2015-01-01 00:00:00"),
        ("01/25/2015", None),
        ("20151325", None),
        ("soon", None),
    ],
)
def test_parse_iso(spark, cell, parsed):
    df = spark.createDataFrame([(cell,)], "c string")
    got = df.select(dates.parse_iso(F.col("c")).cast("string")).first()[0]
    assert got == parsed


def test_has_zone(spark):
    cells = ["2015-01-25T10:00:00Z", "2015-01-25 10:00:00+02:00", "2015-01-25", "2015-01-25 10:00:00"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = [r[0] for r in df.select(dates.has_zone(F.col("c"))).collect()]
    assert got == [True, True, False, False]


def test_plain_numbers_read_like_python(spark):
    cells = [0.0, -0.0, 1.0, 56388.0, 9999999.0, 1e7, 14773770.0, 12345678.25, -2.5e9,
             9007199254740993.0, 9.99e15, 1e16, 1.5e300, 0.001, 0.00025, -1e-4, 1e-5, 2.5e-12,
             0.1, 123.456]
    df = spark.createDataFrame([(c,) for c in cells], "x double")
    got = [r[0] for r in df.select(numbers.plain(F.col("x"))).collect()]
    assert got == [repr(c) for c in cells]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.5,)], "x double")
    assert tuple(df.agg(numbers.exact_sum(df, "x").cast("double")).first()) == (1.5,)


def test_exact_sum_of_fine_amounts(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("x"), (F.col("id") / 7).alias("y"), F.lit(float("nan")).alias("z"))
    row = df.agg(*(numbers.exact_sum(df, c).cast("double").alias(c) for c in "xyz")).first()
    assert row.x == 4.0 and row.y == pytest.approx(499500 / 7, rel=1e-14) and row.z is None
    turned = df.orderBy(F.desc("y"))
    assert turned.agg(numbers.exact_sum(turned, "y").cast("double")).first()[0] == row.y
    assert df.agg(numbers.exact_mean(df, "x")).first()[0] == 0.004


def test_exact_sum_of_mixed_sizes(spark):
    cells = [1e13, 0.01, -1e13, 1e-9, 2.5, None, 1e15]
    df = spark.createDataFrame([(c,) for c in cells], "x double")
    total = df.agg(numbers.exact_sum(df, "x")).first()[0]
    assert total == sum(__import__("decimal").Decimal(str(c)) for c in cells if c is not None)
