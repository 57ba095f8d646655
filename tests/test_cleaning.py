import pytest

from sieveframe.operators import cleaning
from sieveframe.plans.claims import CLAIMS
from tests.conftest import values


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_rename(spark):
    df = table(spark, [], "`unit price (net)` int, shipToCity int, ` Lot#7` int")
    assert cleaning.rename_snake_case(df).columns == ["unit_price_net", "ship_to_city", "lot_7"]


def test_rename_refuses_equal_names(spark):
    df = table(spark, [], "`a-b` int, `a b` int, c int")
    with pytest.raises(ValueError, match="a_b"):
        cleaning.rename_snake_case(df)


def test_drop_empty_columns(spark):
    df = table(spark, [(1, None, None), (None, None, None)], "a int, `_c.39` string, v void")
    assert cleaning.drop_empty_columns(df).columns == ["a"]


def test_drop_duplicates_counts_nulls_as_equal(spark):
    df = table(spark, [(1, None), (1, None), (2, "x")], "a int, b string")
    assert sorted(values(cleaning.drop_duplicates(df), "a")) == [1, 2]


def test_strip_text_leaves_other_columns(spark):
    df = table(spark, [("  Zürich\n", 1), ("\t", 2), (None, 3)], "city string, n int")
    out = cleaning.strip_text(df)
    assert values(out, "city", "n") == ["Zürich", None, None]
    assert values(out, "n", "n") == [1, 2, 3]


def test_yes_no_keeps_missing_and_skips_other_text(spark):
    df = table(
        spark,
        [("n", "Yes", "no way", None), (None, "yes", "no", None), ("NO", "nO", "Y", None)],
        "paid string, insured string, note string, blank string",
    )
    out = cleaning.convert_yes_no(df)
    kinds = dict(out.dtypes)
    assert (kinds["paid"], kinds["insured"]) == ("boolean", "boolean")
    assert (kinds["note"], kinds["blank"]) == ("string", "string")
    assert [tuple(r)[:2] for r in out.collect()] == [
        (False, True), (None, True), (False, False),
    ]


def test_fill_missing_ignores_unknown_columns_and_fills_void(spark):
    df = table(spark, [("Rear", None, 1), (None, None, None)], "t string, v void, n int")
    out = cleaning.fill_missing(df, {"t": "none", "v": "x", "n": 0, "absent": 1})
    assert [tuple(r) for r in out.collect()] == [("Rear", "x", 1), ("none", "x", 0)]


def test_replace_values_matches_whole_cells(spark):
    df = table(spark, [("Suburu",), ("Suburu X",), (None,)], "auto_make string")
    out = cleaning.replace_values(df, {"auto_make": {"Suburu": "Subaru"}, "no": {"a": "b"}})
    assert values(out, "auto_make") == ["Subaru", "Suburu X", None]


def test_clean_runs_all_steps(spark):
    df = table(
        spark,
        [(8, "no", " "), (8, " no\t", None), (9, "yes", ""), (7, None, None)],
        "`Lot No` long, `Sold?` string, Remarks string",
    )
    out = cleaning.clean(df)
    assert out.columns == ["lot_no", "sold"]
    assert dict(out.dtypes)["sold"] == "boolean"
    assert values(out, "sold", "lot_no") == [None, False, True]


def test_nan_counts_as_missing(spark):
    nan = float("nan")
    df = table(spark, [(nan, nan, 1), (2.5, nan, 2)], "x double, gone double, id int")
    assert cleaning.drop_empty_columns(df).columns == ["x", "id"]
    assert values(cleaning.fill_missing(df, {"x": 0.25}), "x", "id") == [0.25, 2.5]


def test_a_filled_column_is_kept(spark):
    df = table(spark, [(" ", "Suburu"), (None, "Lada")], "collisionType string, `Auto make` string")
    out = CLAIMS.clean(df)
    assert sorted(tuple(r) for r in out.collect()) == [
        ("Not Applicable", "Lada"), ("Not Applicable", "Subaru"),
    ]


def test_cleaning_twice_changes_nothing(spark):
    df = table(spark, [(" a", "yes"), (" a ", "yes"), ("b", None)], "A string, B string")
    once = cleaning.clean(df)
    again = cleaning.clean(once)
    assert once.schema == again.schema
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))


def test_a_table_without_rows_has_only_empty_columns(spark):
    assert cleaning.clean(table(spark, [], "a string, b int")).columns == []


def test_one_job_looks_at_all_columns(spark):
    df = table(spark, [("a", "Y", 1)], "a string, b string, c int")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("look", "look")
    cleaning.clean(df)
    spark.sparkContext.setJobGroup("", "")
    assert len(tracker.getJobIdsForGroup("look")) <= 2  # a shuffle map stage and the result
