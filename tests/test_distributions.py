import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.operators import distributions, pivots, quantiles
from tests.conftest import rows


def grouped(spark):
    """One group with a third of the rows on a single value, a small one, a null one."""
    rng = np.random.default_rng(3)
    data = [("big", float(v)) for v in np.round(rng.gamma(2.0, 9000.0, 4000), 2)] + [("big", 15000.0)] * 2000
    data += [("small", 1.0), ("small", 2.0), ("small", 4.0), (None, 5.0), ("big", None)]
    return data, spark.createDataFrame(data, "g string, v double").repartition(5)


def test_quantiles_are_exact_for_every_group(spark):
    data, df = grouped(spark)
    wanted = {"q1": 0.25, "q2": 0.5, "q3": 0.75, "p99": 0.99, "top": 1.0}
    got = {r["g"]: r for r in quantiles.quantiles(df, "v", wanted, ["g"]).collect()}
    for group in ("big", "small", None):
        values = [v for g, v in data if g == group and v is not None]
        for name, q in wanted.items():
            assert got[group][name] == pytest.approx(np.quantile(values, q), rel=1e-12)
    overall = quantiles.quantiles(df, "v", wanted).first()
    values = [v for _, v in data if v is not None]
    assert [overall[n] for n in wanted] == pytest.approx([np.quantile(values, q) for q in wanted.values()], rel=1e-12)


def test_sketched_quantiles_are_close(spark):
    _, df = grouped(spark)
    exact = quantiles.quantiles(df, "v", {"m": 0.5}).first()["m"]
    assert quantiles.quantiles(df, "v", {"m": 0.5}, accuracy=10_000).first()["m"] == pytest.approx(exact, rel=0.01)


def test_mean_and_median(spark):
    data, df = grouped(spark)
    values = [v for _, v in data if v is not None]
    got = quantiles.mean_median(df, "v").first()
    assert (got["n"], got["median"]) == (len(values), np.median(values))
    assert got["mean"] == pytest.approx(np.mean(values))


def test_box_matches_its_definition(spark):
    data, df = grouped(spark)
    for row in distributions.box_stats(df, "v", ["g"]).collect():
        values = np.array([v for g, v in data if g == row["g"] and v is not None])
        q1, q3 = np.quantile(values, [0.25, 0.75])
        inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
        assert (row["whisker_low"], row["whisker_high"]) == (inside.min(), inside.max())
        assert (row["count"], row["outliers"]) == (len(values), len(values) - len(inside))


def test_histogram_counts_like_numpy(spark):
    data, df = grouped(spark)
    values = [v for _, v in data if v is not None]
    counts, edges = np.histogram(values, bins=20)
    got = distributions.histogram(df, "v", 20).orderBy("bin").collect()
    assert [r["count"] for r in got] == list(counts)
    assert [r["bin_start"] for r in got] == pytest.approx(list(edges[:-1]))
    per_group = distributions.histogram(df, "v", 20, ["g"]).groupBy("g").agg(F.sum("count").alias("n"), F.count("*"))
    assert rows(per_group) == [(None, 1, 20), ("big", 6000, 20), ("small", 3, 20)]


def test_constant_and_empty_columns(spark):
    constant = spark.createDataFrame([(7.0,)] * 3, "v double")
    assert [r["count"] for r in distributions.histogram(constant, "v", 3).orderBy("bin").collect()] == [3, 0, 0]
    assert distributions.density(constant, "v").collect() == []
    box = distributions.box_stats(constant, "v").first()
    assert (box["q1"], box["whisker_low"], box["outliers"]) == (7.0, 7.0, 0)
    empty = constant.where("v > 9")
    assert distributions.histogram(empty, "v", 3).collect() == []
    assert distributions.density(empty.withColumn("g", F.lit("a")), "v", ["g"]).collect() == []
    assert distributions.box_stats(empty, "v").collect() == []


def test_density_is_close_to_the_exact_kernel_sum(spark):
    data, df = grouped(spark)
    values = np.array([v for _, v in data if v is not None])
    h = values.std(ddof=1) * len(values) ** -0.2
    for row in distributions.density(df, "v", points=20).collect():
        exact = np.exp(-0.5 * ((row["x"] - values) / h) ** 2).sum() / (len(values) * h * np.sqrt(2 * np.pi))
        assert row["density"] == pytest.approx(exact, rel=5e-3, abs=5e-8)
    curve = distributions.density(df, "v", cut=3).orderBy("x").collect()
    area = np.trapezoid([r["density"] for r in curve], [r["x"] for r in curve])
    assert area == pytest.approx(1.0, abs=0.01)


def test_cross_tabs(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "x", 2)], "r string, c string, n int")
    tab = pivots.cross_tab(df, "r", "c", "n")
    assert rows(tab) == [("a", 1, 3), ("b", 2, 0)]
    assert rows(pivots.row_percentages(tab, "r")) == [("a", 25.0, 75.0), ("b", 100.0, 0.0)]
    with pytest.raises(ValueError, match="too many"):
        pivots.domain(df, "c", limit=1)
