import math
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lotwise.operators.median import price_summary, value_bucket
from lotwise.plans import reports


def _summary(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    return {r.k: (r["count"], r.minimum, r.median, r.maximum) for r in price_summary(df, ["k"], "v").collect()}


def _expected(rows):
    groups = {}
    for key, value in rows:
        groups.setdefault(key, []).append(value)
    return {k: (len(v), min(v), statistics.median(v), max(v)) for k, v in groups.items()}


def test_even_and_odd_groups(spark):
    rows = [("even", 1.0), ("even", 2.0), ("even", 4.0), ("even", 9.0), ("odd", 3.0), ("odd", 1.0), ("odd", 2.0)]
    assert _summary(spark, rows) == {"even": (4, 1.0, 3.0, 9.0), "odd": (3, 1.0, 2.0, 3.0)}


def test_middle_ranks_in_buckets_far_apart(spark):
    rows = [("a", 1.0)] * 500 + [("a", 1e6)] * 500
    assert _summary(spark, rows) == {"a": (1000, 1.0, 500000.5, 1e6)}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(
            st.sampled_from(["a", "b"]),
            st.one_of(st.integers(-5, 5).map(float), st.floats(-1e9, 1e9).map(lambda x: round(x, 2) + 0.0)),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_any_values(spark, rows):
    found, expected = _summary(spark, rows), _expected(rows)
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        assert all(math.isclose(a, b, rel_tol=1e-15, abs_tol=0) for a, b in zip(found[key], values))


def test_buckets_never_fall(spark):
    values = sorted([-1e12, -3.5, -1.0, -1e-9, 0.0, 1e-9, 0.5, 1.0, 1.0001, 99999.99, 100000.0, 1e300, math.inf, math.nan],
                    key=lambda x: (math.isnan(x), x))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    buckets = [r.b for r in df.select("i", value_bucket(df.v).alias("b")).orderBy("i").collect()]
    assert buckets == sorted(buckets)


def test_same_as_built_in_median_on_one_hot_group(spark):
    from pyspark.sql import functions as F

    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 900).cast("string")).alias("k"),
        (F.pmod(F.xxhash64("id"), F.lit(5_000_000)) / 100).alias("v"),
    )
    built_in = rows.groupBy("k").agg(F.median("v").alias("median"))
    ours = price_summary(rows, ["k"], "v").select("k", "median")
    assert ours.exceptAll(built_in).isEmpty() and built_in.exceptAll(ours).isEmpty()


def test_distribution_drops_rows_without_price_or_currency(spark, models):
    dim = models.dim()
    counted = reports.rpt_price_distribution(dim).groupBy().sum("offer_count").first()[0]
    assert counted == dim.filter("price_amount is not null and price_currency is not null").count()


def test_values_are_shuffled_once(spark, tmp_path):
    import re

    path = str(tmp_path / "values")
    spark.range(1000).selectExpr("cast(id % 7 as string) k", "cast(id % 90 as double) v").write.parquet(path)
    summary = price_summary(spark.read.parquet(path), ["k"], "v")
    summary.collect()
    plan = summary._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    assert "ReusedExchange" in plan
