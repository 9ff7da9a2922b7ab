import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordwise.operators import charts
from recordwise.plans import dashboards

pytestmark = pytest.mark.literal


def frame(spark, values):
    return spark.createDataFrame([(i, float(v) if v is not None else None) for i, v in enumerate(values)], "id bigint, v double")


@pytest.mark.parametrize("seed", range(4))
def test_histogram_agrees_with_numpy(spark, seed):
    rnd = random.Random(seed)
    values = [round(rnd.uniform(0, 10), rnd.choice([0, 1, 2, 8])) for _ in range(700)]
    got = charts.histogram(frame(spark, [*values, None]), "v", 20).collect()
    counts, edges = np.histogram(values, bins=20)
    assert [r["count"] for r in got] == counts.tolist()
    assert [r["bin_start"] for r in got] == pytest.approx(edges[:-1].tolist())
    assert got[-1]["bin_end"] == max(values)


def test_histogram_of_equal_values_and_of_none(spark):
    got = charts.histogram(frame(spark, [4, 4, 4]), "v", 10).collect()
    counts, edges = np.histogram([4, 4, 4], bins=10)
    assert [r["count"] for r in got] == counts.tolist() and got[0]["bin_start"] == edges[0]
    assert charts.histogram(frame(spark, [None]), "v", 10).count() == 0


def test_histogram_span(spark):
    got = charts.histogram(frame(spark, [-500, 0, 100, 900]), "v", 2, within=(-100, 500)).collect()
    assert [(r["bin_start"], r["count"]) for r in got] == [(0.0, 1), (50.0, 1)]


def test_box_stats(spark):
    values = [random.Random(1).gauss(0, 1) for _ in range(101)]
    row = charts.box_stats(frame(spark, values), [], "v").first()
    assert row["q1"] == pytest.approx(np.percentile(values, 25)) and row["median"] == pytest.approx(np.median(values))
    assert row["stddev"] == pytest.approx(np.std(values, ddof=1)) and row["low"] == min(values)


def test_shares_and_scaling(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("b", 3, 5.0)], "k string, count bigint, flat double")
    assert [r["percent"] for r in charts.share_of_total(df).orderBy("k").collect()] == [25.0, 75.0]
    scaled = charts.min_max_scaled(df, ["count", "flat"]).orderBy("k").collect()
    assert [(r["count_scaled"], r["flat_scaled"]) for r in scaled] == [(0.0, None), (1.0, None)]


def test_samples_do_not_depend_on_layout(spark):
    df = spark.range(5000)
    ids = lambda d: sorted(r["id"] for r in charts.repeatable_sample(d, 50).collect())
    assert ids(df.repartition(1)) == ids(df.repartition(9, F.rand(3)))
    assert "TakeOrderedAndProject" in charts.repeatable_sample(df, 50)._jdf.queryExecution().executedPlan().toString()
    words = df.select(F.col("id").cast("string").alias("id"))
    assert charts.repeatable_sample(words, 20).count() == 20
    assert charts.repeatable_sample(df.limit(5), 20).count() == 5


def test_matrix_runs_no_job_for_its_columns(spark):
    df = spark.createDataFrame([("g", 2000, 1.0), ("g", 2000, 3.0), ("h", 2001, 5.0)], "g string, y int, v double")
    got = {r["g"]: (r["y2000"], r["y2001"], r["y2002"]) for r in charts.matrix(df, "g", "y", "avg(v)", [2000, 2001, 2002], "y").collect()}
    assert got == {"g": (2.0, None, None), "h": (None, 5.0, None)}


def test_top_groups_break_ties_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [r["k"] for r in charts.top_groups(df, "k", "count(1)", 2).collect()] == ["c", "a"]


def test_executive_kpis_of_nothing(spark, movies):
    row = dashboards.executive_kpis(movies.where("id > 99")).first()
    assert tuple(row) == (0, 0.0, 0.0, 0.0, 0.0)
    some = dashboards.executive_kpis(movies).first()
    assert some["avg_roi"] == pytest.approx((225 - 22 + 0 - 100 * 35 / 95) / 4)


def test_pairs_are_complete(spark, movies):
    assert dashboards.money_pairs(movies).count() == 4
    assert dashboards.popularity_pairs(movies).count() == 5


def test_histogram_and_outliers_leave_nan_out(spark):
    from recordwise.operators import quality

    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "v double")
    assert [r["count"] for r in charts.histogram(df, "v", 4).collect()] == [1, 0, 0, 1]
    assert tuple(charts.unplaced(df, "v").first()) == (4, 1, 1)
    many = spark.range(49).selectExpr("cast(id % 5 as double) as v").union(spark.createDataFrame([(float("nan"),)], "v double"))
    assert quality.outliers(many, ["v"]).first()["outliers"] == 0


def test_ratings_by_year_are_rows(spark):
    df = spark.range(3000).selectExpr("'g' as genres", "concat(lpad(cast(id + 1 as string), 4, '0'), '-01-01') as release_date",
                                      "1.0d as revenue_musd", "1.0d as budget_musd", "2.0d as vote_average", "1.0d as popularity")
    rows = dashboards.genre_year_ratings(df)
    assert rows.columns == ["genre", "year", "avg_rating"] and rows.count() == 3000
