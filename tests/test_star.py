import pytest
from pyspark.sql import functions as F

from stratamart.operators import star
from stratamart.operators.keys import dense_key
from stratamart.schemas import DimensionSpec, FactSpec
from stratamart.staging import materialize
from tests.conftest import rows

CAR = DimensionSpec("car", "car_id", ("make", "trim"))
STATE = DimensionSpec("state", "state_id", ("colour",))
SALE = FactSpec("sale", (CAR, STATE), ("price",), key="sale_id")
FLAT = [("a", None, "red", 1.0), ("a", None, "red", 1.0), ("a", "x", None, 2.0), ("b", "x", "blue", 3.0)]


def flat(spark):
    return spark.createDataFrame(FLAT, "make string, trim string, colour string, price double")


def build(spark):
    source = materialize(dense_key(flat(spark), "sale_id"), "flat")
    dimensions = {d.name: star.build_dimension(source, d) for d in SALE.dimensions}
    return source, dimensions, star.fact_rows(source, SALE, dimensions)


def test_null_parts_of_a_key_find_their_tuple(spark):
    _, dimensions, fact = build(spark)
    assert rows(dimensions["car"]) == [(1, "a", None), (2, "a", "x"), (3, "b", "x")]
    assert rows(fact.drop("sale_id")) == [(1, 2 + 1, 1.0)] * 2 + [(2, 1, 2.0), (3, 2, 3.0)]
    assert sorted(r.sale_id for r in fact.collect()) == [1, 2, 3, 4]


def test_star_joined_back_is_the_flat_table(spark):
    source, dimensions, fact = build(spark)
    columns = ["make", "trim", "colour", "price"]
    wide = star.widen(fact, SALE, dimensions, columns)
    assert rows(star.row_differences(source.select(*columns), wide)) == []
    fewer = wide.where("make <> 'b'")
    assert rows(star.row_differences(wide, fewer)) == [("b", "x", "blue", 3.0, 1)]


def test_remodelling_drops_and_counts_orphans(spark):
    source, dimensions, fact = build(spark)
    new = DimensionSpec("maker", "maker_id", ("make",))
    makers = star.build_dimension(dimensions["car"].where("make = 'a'"), new)
    spec = FactSpec("sale", (new,), ("price",))
    mapping = star.surrogate_map(dimensions["car"], "car_id", [(new, makers)])
    remapped = star.remap_fact(fact, spec, [("car_id", mapping)])
    assert rows(star.missing_keys(remapped, spec)) == [("maker", 1)]
    kept = star.drop_orphans(remapped, spec)
    assert rows(kept) == [(1, 1.0), (1, 1.0), (1, 2.0)]
    assert kept.where(F.col("maker_id").isNull()).count() == 0


def test_tables_of_equal_rows_are_not_shuffled(spark):
    columns = ["make", "trim", "colour", "price"]
    rows_of = flat(spark).select(*columns)
    same = star.row_differences(rows_of, rows_of.repartition(3))
    assert rows(same) == [] and same.columns == [*columns, "surplus"]
    assert "Exchange" not in same._jdf.queryExecution().executedPlan().toString()


def test_differences_in_nulls_and_copies_are_found(spark):
    def table(*data):
        return spark.createDataFrame(data, "a string, b string, x double")
    nan = float("nan")
    left = table(("a", None, 0.0), ("c", "c", nan), ("d", "d", 1.0), ("d", "d", 1.0))
    right = table((None, "a", -0.0), ("c", "c", nan), ("d", "d", 1.0), ("d", "d", 1.0), ("d", "d", 1.0))
    assert rows(star.row_differences(left, right)) == [(None, "a", 0.0, -1), ("a", None, 0.0, 1), ("d", "d", 1.0, -1)]


def test_members_of_an_old_dimension_are_left_out(spark):
    old = spark.createDataFrame([(7, "a", None), (8, "b", "x")], "car_id long, make string, trim string")
    assert rows(star.new_members(flat(spark), old, CAR, 8)) == [(9, "a", "x")]
    none = star.new_members(flat(spark).where("make = 'b'"), old, CAR, 8)
    assert none.count() == 0


def test_a_fact_ships_hashes_of_its_tuples(spark, no_broadcast):
    source = materialize(flat(spark).withColumn("sale_id", F.monotonically_increasing_id()), "sales")
    dimensions = {d.name: materialize(star.build_dimension(source, d), d.name) for d in SALE.dimensions}
    fact = star.fact_rows(source, SALE, dimensions)
    assert rows(fact.drop("sale_id")) == rows(star.fact_rows(source, SALE, dimensions, complete=False).drop("sale_id"))
    shuffled = [line for line in fact._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert shuffled and not any("colour" in line or "trim" in line for line in shuffled)
    twice = dimensions | {"car": dimensions["car"].unionByName(dimensions["car"].withColumn("car_id", F.col("car_id") + 9))}
    with pytest.raises(Exception, match="two rows of car have the same hashes"):
        star.fact_rows(source, SALE, twice).collect()
