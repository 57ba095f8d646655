import pytest
from pyspark.sql import functions as F

from sieveframe.operators.groups import with_group_size
from sieveframe.operators.quantiles import group_quantiles


@pytest.fixture
def skewed(spark):
    """A third of the rows lie in one group; null is a key like any other."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 31 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.floor(F.col("id") / 4).cast("string")))
    )
    return spark.range(40_000).select("id", key.alias("a"), (F.col("id") % 2).alias("b"))


@pytest.mark.parametrize("limit", [1 << 22, 300, 0], ids=["all", "hot", "none"])
def test_group_size(skewed, limit):
    got = with_group_size(skewed, ["a", "b"], "n", hot_bytes=limit).toPandas()
    pdf = skewed.toPandas()
    want = pdf.groupby(["a", "b"], dropna=False)["id"].transform("size")
    assert len(got) == len(pdf)
    sizes = got.set_index("id")["n"].sort_index()
    assert sizes.tolist() == want.tolist()


@pytest.mark.parametrize("limit", [1 << 22, 300, 0], ids=["all", "hot", "none"])
def test_only_larger_groups(skewed, limit):
    got = with_group_size(skewed, ["a", "b"], "n", 3, hot_bytes=limit)
    pdf = skewed.toPandas()
    size = pdf.groupby(["a", "b"], dropna=False)["id"].transform("size")
    assert sorted(r.id for r in got.collect()) == sorted(pdf.id[size >= 3])


def test_the_split_path_shuffles_no_hot_rows(skewed):
    df = with_group_size(skewed, ["a"], "n", hot_bytes=100)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "Cartesian" not in plan


def brute(pdf, points):
    return {
        k: [float(g.quantile(p)) for p in points.values()]
        for k, g in pdf.dropna().groupby("k")["v"]
    }


@pytest.mark.parametrize(
    "max_sorted, slices", [(10**6, 64), (500, 64), (40, 8), (1, 4), (1, 2)]
)
def test_group_quantiles_equal_brute_force(spark, max_sorted, slices):
    """Hot groups, hot values, ties, outliers, tiny groups and nulls."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") < 2, "one")
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string")))
    )
    value = (
        F.when(F.col("id") % 4 == 0, 7.5)
        .when(F.col("id") % 1000 == 999, 1e12)
        .when(F.col("id") % 97 == 5, None)
        .otherwise((F.hash("id") % 5000) / 100)
    )
    df = spark.range(20_000).select(key.alias("k"), value.alias("v"))
    points = {"p0": 0.0, "p5": 0.05, "q1": 0.25, "median": 0.5, "p999": 0.999, "p100": 1.0}
    got = {
        r["k"]: [r[n] for n in points]
        for r in group_quantiles(df, "k", "v", points, max_sorted, slices).collect()
    }
    want = brute(df.toPandas(), points)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert group_quantiles(df, "k", "v", {"m": 0.5}).collect() == []


def test_wide_keys_are_not_broadcast(spark):
    """No side above the threshold is broadcast, and hot keys only within their bytes."""
    wide = F.concat(F.repeat(F.lit("k"), 2000), (F.col("id") % 9000).cast("string"))
    df = spark.range(20_000).select("id", wide.alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        out = with_group_size(df, ["k"], "n")
        assert out.filter("n > 1").count() == 20_000
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "broadcast" not in plan.lower()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_quantiles_of_whole_numbers(spark):
    df = spark.range(41).select(F.lit("x").alias("k"), (F.col("id") * 3).alias("v"))
    [row] = group_quantiles(df, "k", "v", {"p10": 0.1, "m": 0.5, "p90": 0.9}).collect()
    assert tuple(row) == ("x", 12.0, 60.0, 108.0)


def test_a_group_without_values_stays(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", None), ("a", nan), ("b", 2.0), ("b", nan)], "k string, v double")
    found = {r.k: r.m for r in group_quantiles(df, "k", "v", {"m": 0.5}).collect()}
    assert found == {"a": None, "b": 2.0}
