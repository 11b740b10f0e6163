import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart import schemas
from stratamart.functions.cleaning import shared_columns
from stratamart.operators import distributions, profile, quantiles, sketches
from stratamart.plans import layers
from stratamart.sources import readers
from stratamart.sources.lake import Lake
from tests.conftest import rows
from tests.test_lake import LINE, write_listing_csv

SHARES = {"q01": 0.01, "q25": 0.25, "q50": 0.5, "q99": 0.99}


@pytest.mark.parametrize("accuracy", [50, 500])
def test_merged_sketches_keep_to_their_error(spark, accuracy):
    """Loads of unlike sizes and ranges, one of them skewed, against all rows."""
    loads = [spark.range(20_000).select(F.pow(F.rand(1), 4).alias("x"), (F.col("id") % 700).alias("k")),
             spark.range(500).select((F.rand(2) + 5).alias("x"), (F.col("id") + 600).alias("k")),
             spark.range(9_000).select((F.rand(3) * 0.01).alias("x"), (F.col("id") % 3).alias("k"))]
    merged = sketches.merged(loads[0].sparkSession.createDataFrame(
        [r for part in loads for r in sketches.sketched(part, ["x", "k"], accuracy=accuracy).collect()],
        sketches.sketched(loads[0], ["x", "k"]).schema))
    got = sketches.profile_of(merged, SHARES)
    every = loads[0].union(loads[1]).union(loads[2])
    told = {r["column"]: r for r in got.collect()}
    assert told["x"]["rows"] == 29_500 and told["k"]["nulls"] == 0 and told["k"]["max"] == 1_099
    assert abs(told["k"]["distinct"] - 1_100) <= 3 * 1.04 / 2 ** (sketches.DISTINCT_BITS / 2) * 1_100
    assert abs(told["x"]["mean"] - every.agg(F.avg("x")).first()[0]) < 1e-9
    errors = sketches.rank_errors(every, got, SHARES).collect()
    assert len(errors) == 8 and max(r["error"] for r in errors) <= 3 * sketches.rank_error(accuracy) <= 3 / accuracy


def test_sketches_of_odd_columns(spark):
    df = spark.createDataFrame([(1.0, None, "a", "g"), (float("nan"), None, None, "g"), (None, None, "a", None)], "x double, y double, t string, g string")
    part = sketches.sketched(df, ["x", "y"], ["t"])
    both = sketches.profile_of(sketches.merged(part.unionByName(sketches.sketched(df.limit(0), ["x", "y"], ["t"]))), {"q50": 0.5})
    assert rows(both) == [("t", 3, 1, None, None, None, None, 1), ("x", 3, 2, 1.0, 1.0, 1.0, 1.0, 1), ("y", 3, 3, None, None, None, None, 0)]
    grouped = sketches.sketched_quantiles(df, "x", {"q50": 0.5}, ["g"])
    assert rows(grouped) == [(None, None), ("g", 1.0)]


def test_profiles_take_an_accuracy(spark):
    random = np.random.default_rng(4)
    values = random.gamma(2, 3, 20_000)
    df = spark.createDataFrame([(float(v), "ab"[i % 2]) for i, v in enumerate(values)], "x double, g string")
    rank = lambda v, of=values: (of <= v).mean()
    numbers = profile.numeric_profile(df, ["x"], accuracy=1_000).first()
    exact = profile.numeric_profile(df, ["x"]).first()
    assert (numbers["count"], numbers["max"]) == (exact["count"], exact["max"]) and exact["q50"] == pytest.approx(np.median(values))
    for name, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        assert abs(rank(numbers[name]) - share) <= 2 / 1_000
    for got in quantiles.mean_median(df, "x", ["g"], accuracy=1_000).collect():
        of = values[np.arange(len(values)) % 2 == "ab".index(got["g"])]
        assert got["n"] == len(of) and got["mean"] == pytest.approx(of.mean()) and abs(rank(got["median"], of) - 0.5) <= 2 / 1_000
    box = distributions.box_stats(df, "x", accuracy=1_000).first()
    spread = 1.5 * (box["q3"] - box["q1"])
    inside = values[(values >= box["q1"] - spread) & (values <= box["q3"] + spread)]
    assert (box["count"], box["outliers"]) == (len(values), len(values) - len(inside))
    assert (box["whisker_low"], box["whisker_high"]) == (inside.min(), inside.max())
    per_group = {r["g"]: r for r in distributions.box_stats(df, "x", ["g"], accuracy=1_000).collect()}
    assert per_group["a"]["count"] == per_group["b"]["count"] == 10_000


def test_loads_add_to_the_stored_profile(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    for name, prices in (("a", (1, 2, 3)), ("b", (10, 20))):
        write_listing_csv(tmp_path / f"{name}.csv", [LINE | {"price": float(p), "make": name} for p in prices])
        got = layers.append_profile(lake, readers.read_flat(spark, str(tmp_path / f"{name}.csv")))
    told = {r["column"]: r for r in got.collect()}
    assert (told["price"]["rows"], told["price"]["min"], told["price"]["q50"], told["price"]["max"]) == (5, 1.0, 3.0, 20.0)
    assert told["make"]["distinct"] == 2 and told.keys() == {*schemas.PROFILE_NUMBERS, *schemas.CATEGORY_COLUMNS}
    assert lake.read("bronze", "profile").count() == 2 * len(told)  # one row per load and column


def test_bronze_holds_texts_to_their_widths(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    write_listing_csv(tmp_path / "a.csv", [LINE, LINE | {"trim": "t" * 51}])
    source = readers.read_flat(spark, str(tmp_path / "a.csv"))
    with pytest.raises(Exception, match="trim is longer than 50"):
        layers.load_bronze(lake, source)
    assert layers.load_bronze(lake, source, widths={}).count() == 2


def test_narrower_join_keys_are_warned_of(spark):
    left, right = spark.createDataFrame([(1, 2)], "a int, b int"), spark.createDataFrame([(1,)], "a int")
    with pytest.warns(UserWarning, match="'b'"):
        assert shared_columns(left, right, ["a", "b"], strict=False) == ["a"]
