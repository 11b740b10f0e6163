import pytest
from pyspark.sql import functions as F

from stratamart import schemas
from stratamart.operators import quality, star
from stratamart.plans import layers
from stratamart.sources import readers
from stratamart.sources.lake import Lake
from tests.conftest import rows
from tests.test_lake import LINE, write_listing_csv


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def landed(spark, path, lines):
    write_listing_csv(path, lines)
    return readers.read_flat(spark, str(path))


def makes(lake):
    joined = lake.read("silver", "fato_veiculo").join(lake.read("silver", "dim_modelo"), "id_modelo")
    return [r[0] for r in rows(joined.select("make"))]


def wide(lake):
    silver = {t: lake.read("silver", t) for t in layers.SILVER_STAR}
    return star.widen(silver["fato_veiculo"], schemas.SILVER_FATO, silver, schemas.LISTING_COLUMNS)


def test_an_appended_star_equals_a_rebuilt_one(spark, lake, tmp_path):
    first = [LINE, LINE, LINE | {"make": "b", "trim": ""}]
    second = [LINE, LINE | {"make": "b", "trim": ""}, LINE | {"make": "a"}, LINE | {"make": "a"}, LINE | {"condition": "New"}]
    layers.load_bronze(lake, landed(spark, tmp_path / "a.csv", first))
    assert lake.published("silver") == {}
    layers.append_silver(lake)  # nothing there yet: a load
    before = {t: lake.folders("silver", t) for t in layers.SILVER_STAR}
    layers.load_bronze(lake, landed(spark, tmp_path / "b.csv", second), "append")
    layers.append_silver(lake)
    for table, key in (("dim_modelo", "id_modelo"), ("dim_especificacao", "id_especificacao"), ("fato_veiculo", "id_fato")):
        told = quality.key_check(lake.read("silver", table), key, table).first()
        assert told["duplicates"] == told["nulls"] == 0 and told["min_key"] == 1 and told["max_key"] == told["rows"]
        assert lake.folders("silver", table)[0] == before[table][0] and len(lake.folders("silver", table)) == 2
    assert lake.read("silver", "dim_modelo").count() == 3 and lake.read("silver", "fato_veiculo").count() == 8
    assert rows(star.row_differences(lake.read("bronze", "vehicle_prices").select(*schemas.LISTING_COLUMNS), wide(lake))) == []
    # Only what is new was written.
    part = spark.read.parquet(lake.folders("silver", "dim_modelo")[1])
    assert rows(part.select("id_modelo", "make")) == [(3, "a")]
    appended = rows(wide(lake))
    layers.append_silver(lake)  # nothing new: no further part
    assert len(lake.folders("silver", "fato_veiculo")) == 2
    layers.load_silver(lake)
    assert rows(wide(lake)) == appended and len(lake.folders("silver", "fato_veiculo")) == 1
    assert len(lake.unused_runs("silver")) == 2


def test_a_reader_sees_whole_versions_only(spark, lake, tmp_path, monkeypatch):
    layers.load_bronze(lake, landed(spark, tmp_path / "a.csv", [LINE | {"make": m} for m in "ab"]))
    layers.load_silver(lake)
    opened = lake.read("silver", "fato_veiculo")
    layers.load_bronze(lake, landed(spark, tmp_path / "b.csv", [LINE | {"make": m} for m in "xyz"]), "append")
    seen = []
    original = layers.fact_rows

    def look(*arguments):
        seen.append(makes(lake))
        return original(*arguments)

    with monkeypatch.context() as patch:
        patch.setattr(layers, "fact_rows", look)
        layers.load_silver(lake)
        layers.append_silver(lake)
    assert seen == [["a", "b"]] and makes(lake) == ["a", "b", "x", "y", "z"]
    assert opened.count() == 2  # what was opened stays as it was


@pytest.mark.parametrize("load", [layers.load_silver, layers.append_silver])
def test_a_dead_run_leaves_the_star(spark, lake, tmp_path, monkeypatch, load):
    layers.load_bronze(lake, landed(spark, tmp_path / "a.csv", [LINE | {"make": m} for m in "ab"]))
    layers.load_silver(lake)
    assert lake.is_star_loaded("silver", "fato_veiculo")
    layers.load_bronze(lake, landed(spark, tmp_path / "b.csv", [LINE | {"make": "z"}]), "append")

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(layers, "fact_rows", crash)
        with pytest.raises(RuntimeError):
            load(lake)
    assert makes(lake) == ["a", "b"] and not lake.is_star_loaded("silver", "fato_veiculo")
    assert len(lake.unused_runs("silver")) == 1
    load(lake)
    assert makes(lake) == ["a", "b", "z"] and lake.is_star_loaded("silver", "fato_veiculo")


def test_null_and_nan_tuples_are_found_again(spark):
    spec = schemas.DimensionSpec("d", "k", ("x", "y"))
    old = spark.createDataFrame([(1, None, 0.0), (2, "a", float("nan"))], "k long, x string, y double")
    source = spark.createDataFrame([(None, -0.0), ("a", float("nan")), (None, None), ("a", None), ("a", None)], "x string, y double")
    assert rows(star.new_members(source, old, spec, 2)) == [(3, None, None), (4, "a", None)]
    assert rows(star.new_members(source.limit(0), old, spec, 2)) == []


def test_registered_names_follow_an_appended_star(spark, lake, tmp_path):
    layers.load_bronze(lake, landed(spark, tmp_path / "a.csv", [LINE]))
    layers.load_silver(lake)
    lake.register([("silver", "fato_veiculo")])
    layers.load_bronze(lake, landed(spark, tmp_path / "b.csv", [LINE, LINE | {"make": "n"}]), "append")
    layers.append_silver(lake)
    assert spark.table("silver.fato_veiculo").count() == 1  # until it is registered again
    for _ in range(2):
        lake.register([("silver", "fato_veiculo")])
        assert spark.table("silver.fato_veiculo").count() == 3
    layers.load_silver(lake)
    lake.register([("silver", "fato_veiculo")])
    assert spark.table("silver.fato_veiculo").where(F.col("id_fato") > 0).count() == 3
    spark.sql("DROP DATABASE silver CASCADE")
