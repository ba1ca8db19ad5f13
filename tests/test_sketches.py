"""Sketches by day against exact figures, merged in any order, and a month that reads no raw row."""

import numpy as np
from pyspark.sql import functions as F

from cellwright.operators import sketches as K

DAY = K.DAY_US


def table(spark, n=60_000):
    value = F.when(F.col("id") % 97 == 0, None).when(F.col("id") % 89 == 0, float("nan")).otherwise(F.exp(F.sin(F.col("id")) * 3))
    return spark.range(n).select((F.col("id") % 3).alias("k"), (F.col("id") * (30 * DAY // n)).alias("us"), value.alias("v"), (F.col("id") % 5000).alias("unit"))


def test_error_bounds(spark):
    df = table(spark)
    exact = np.sort([r.v for r in df.where("v is not null and not isnan(v)").select("v").collect()])
    got = K.answers(K.merged(K.by_day(df, ["k"], "us", "v", "unit")), {f"p{p}": p / 100 for p in (1, 25, 50, 95, 99)}).first()
    assert (got.n, got.least, got.most) == (len(exact), exact[0], exact[-1])
    for p in (1, 25, 50, 95, 99):
        assert abs(np.searchsorted(exact, got[f"p{p}"]) / len(exact) - p / 100) < 0.01
    units = df.where("v is not null and not isnan(v)").select("unit").distinct().count()
    assert abs(got.distinct - units) < 0.05 * units


def test_a_month_from_stored_days(spark, tmp_path):
    df, path = table(spark), str(tmp_path / "days")
    K.write_days(K.by_day(df.where(F.col("us") < 20 * DAY), ["k"], "us", "v"), path)
    K.write_days(K.by_day(df.where(F.col("us") >= 15 * DAY), ["k"], "us", "v"), path)  # five days again
    days = spark.read.parquet(path)
    assert days.groupBy("k", "day").count().where("count > 1").count() == 0
    month = K.merged(days, ["k"], 3, 9)
    assert "PartitionFilters: [isnotnull(day" in month._jdf.queryExecution().executedPlan().toString()
    rows = df.where("v is not null and not isnan(v)").where(F.col("us").between(3 * DAY, 10 * DAY - 1))
    assert {(r.k, r.n) for r in month.collect()} == {(r.k, r["count"]) for r in rows.groupBy("k").count().collect()}
    whole = K.answers(K.merged(days), {"p50": 0.5}).first()
    assert whole.n == df.where("v is not null and not isnan(v)").count()


def test_empty_and_all_null(spark):
    none = spark.createDataFrame([(1, None, 1.0), (2, 5, None), (3, 5, float("nan"))], "k long, us long, v double")
    assert K.by_day(none, ["k"], "us", "v").count() == 0
    assert K.merged(K.by_day(none, ["k"], "us", "v"), ["k"]).count() == 0
