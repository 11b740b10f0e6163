import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratamart import schemas, staging
from stratamart.functions.cleaning import fill_missing, fitting_widths
from stratamart.plans import layers, reports
from stratamart.sources import readers
from stratamart.sources.lake import Lake, write_csv, write_json
from stratamart.streaming.ingest import append_new_files
from tests.conftest import SF_DIR, rows
from tests.test_lake import LINE, write_listing_csv

SMALL = "k long, day int, price double, note string"


def schema(spark):
    return spark.createDataFrame([], SMALL).schema


def test_csv_rows_are_read_whole_or_rejected(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'k,day,price,note\n1,2018.0,1.5,"two\nlines"\n2,2018,1,5,x\n3,2018,2.5\n4,2018.5,3.5,x\n5,NA,nan,\n6,1,y,x\n')
    arguments = (spark, str(tmp_path / "a.csv"), "csv", schema(spark))
    assert rows(readers.read_flat(*arguments, bad="drop")) == [(1, 2018, 1.5, "two\nlines"), (5, None, None, None)]
    assert rows(readers.read_rejects(*arguments)) == [
        ("a.csv", "day: 2018.5", None), ("a.csv", "number of fields", "2,2018,1,5,x"),
        ("a.csv", "number of fields", "3,2018,2.5"), ("a.csv", "price: y", None)]
    with pytest.raises(Exception, match="row cannot be read"):
        readers.read_flat(*arguments).collect()
    with pytest.raises(ValueError):
        readers.read_flat(*arguments, bad="ignore")


def test_json_lines_are_read_whole_or_rejected(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"k": 1, "day": 2018.0, "price": 1.5, "note": null}\n\n{"k": 2, "day": 2018, "price": 1\n'
        '{"k": 3, "day": 2018, "note": "x"}\n{"k": 4, "day": "z", "price": 1, "note": "x", "more": [1]}\n')
    arguments = (spark, str(tmp_path / "a.json"), "json", schema(spark))
    assert rows(readers.read_flat(*arguments, bad="drop")) == [(1, 2018, 1.5, None)]
    assert rows(readers.read_rejects(*arguments).select("reason")) == [("broken record",), ("day: z",), ("missing price",)]
    with pytest.raises(Exception, match="row cannot be read"):
        readers.read_flat(*arguments).collect()


def test_files_with_another_header_are_not_read_by_position(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    write_listing_csv(landing / "a.csv", [LINE | {"make": "m", "model": "o"}], schemas.LISTING_COLUMNS[::-1])
    table = str(tmp_path / "table")
    assert append_new_files(spark, str(landing), table, str(tmp_path / "progress")) == 1
    assert rows(spark.read.parquet(table).select("make", "model")) == [("m", "o")]
    write_listing_csv(landing / "b.csv", [LINE])
    with pytest.raises(Exception, match="(?i)header"):
        append_new_files(spark, str(landing), table, str(tmp_path / "progress"))


def test_appended_rows_continue_the_keys(spark, tmp_path):
    write_listing_csv(tmp_path / "a.csv", [LINE, LINE | {"make": "z"}])
    lake = Lake(spark, str(tmp_path / "lake"))
    source = readers.read_flat(spark, str(tmp_path / "a.csv"))
    for _ in range(2):
        layers.load_all(lake, source, "append")
        layers.load_flat(lake, source, "append")
    for table in (("bronze", "vehicle_prices"), ("silver", "veiculo")):
        assert rows(lake.read(*table).select("id")) == [(1,), (2,), (3,), (4,)]
    assert lake.read("silver", "fato_veiculo").count() == lake.read("dw", "fato_veiculo").count() == 4


@pytest.mark.parametrize("mode", ["append", "nonsense"])
def test_stars_refuse_modes_they_cannot_do(spark, tmp_path, mode):
    lake = Lake(spark, str(tmp_path))
    for load in (layers.load_silver, layers.load_gold, layers.load_abbreviated):
        with pytest.raises(ValueError, match="load mode"):
            load(lake, mode)


def test_a_half_written_star_does_not_count_as_loaded(spark, tmp_path, monkeypatch):
    write_listing_csv(tmp_path / "a.csv", [LINE, LINE | {"make": "b"}])
    write_listing_csv(tmp_path / "b.csv", [LINE | {"make": m} for m in "abz"])
    lake = Lake(spark, str(tmp_path / "lake"))
    layers.load_bronze(lake, readers.read_flat(spark, str(tmp_path / "a.csv")))
    layers.load_silver(lake)
    layers.load_bronze(lake, readers.read_flat(spark, str(tmp_path / "b.csv")))
    with monkeypatch.context() as patch:
        def crash(*_):
            raise RuntimeError("lost")
        patch.setattr(layers, "fact_rows", crash)
        with pytest.raises(RuntimeError):
            layers.load_silver(lake)
    silver = layers.load_silver(lake, "skip_if_loaded")
    joined = silver["fato_veiculo"].join(silver["dim_modelo"], "id_modelo")
    assert rows(joined.select("make")) == [("a",), ("b",), ("z",)]


def test_a_second_lake_takes_over_the_names(spark, tmp_path):
    for name, n in (("one", 5), ("it's two", 3)):
        lake = Lake(spark, str(tmp_path / name))
        lake.write("lakes", "t", spark.range(n))
        for _ in range(2):
            lake.register([("lakes", "t")])
        assert spark.table("lakes.t").count() == n
    spark.sql("DROP DATABASE lakes CASCADE")


def test_clearing_forgets_the_lakes(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(staging, "shared_folder", lambda _: f"file:{tmp_path}/app")
    before = dict(layers._session_lakes)
    first = layers.session_lake(spark, "/nowhere")
    staging.clear(spark)
    assert layers.session_lake(spark, "/nowhere") is not first
    layers._session_lakes.clear()
    layers._session_lakes.update(before)


def listing(spark):
    """One row whose columns may be null, as in tables."""
    kinds = [F.lit(None if LINE[f.name] == "NA" else LINE[f.name]).cast(f.dataType).alias(f.name) for f in schemas.LISTING]
    return spark.range(1).select(*[F.when(F.col("id") >= 0, k).alias(f.name) for k, f in zip(kinds, schemas.LISTING)])


def largest_method(df):
    """Bytes of the largest method that Spark generates for a query; the JVM compiles none above 8,000."""
    found = df._jdf.queryExecution().debug().codegenToSeq()
    return max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.length()))


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_text_is_read_by_methods_that_the_jvm_compiles(spark, tmp_path, fmt):
    {"csv": write_csv, "json": write_json}[fmt](listing(spark), str(tmp_path / fmt))
    assert largest_method(readers.read_flat(spark, str(tmp_path / fmt), fmt, source_column="_source_file")) < 8000


def test_the_first_misfit_of_a_row_is_named_whatever_its_kind(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,day,price,note\n1,x,y,n\n")
    (tmp_path / "b.csv").write_text("k,day,price,note\nz,1,y,n\n")
    for name, reason in (("a", "day: x"), ("b", "k: z")):
        with pytest.raises(Exception, match=f"row cannot be read, {reason}"):
            readers.read_flat(spark, str(tmp_path / f"{name}.csv"), "csv", schema(spark)).collect()


def test_bronze_is_written_by_methods_that_the_jvm_compiles(spark, tmp_path):
    listing(spark).write.parquet(str(tmp_path / "in"))
    source = readers.read_flat(spark, str(tmp_path / "in"), "parquet", source_column="_source_file", located=True)
    rows_held = fitting_widths(fill_missing(source), schemas.BRONZE_WIDTHS)
    assert largest_method(rows_held) < 5000


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_landing_files_are_bounded(spark, monkeypatch, fmt):
    monkeypatch.setattr(layers, "LANDING_FILES", layers.LANDING_FILES | {"maxRecordsPerFile": "1000"})
    lake = layers.SessionLake(spark, SF_DIR)
    found = lake.landing(fmt)
    assert found.groupBy("_source_file").count().agg(F.max("count")).first()[0] <= 1000
    assert found.select(*schemas.LISTING_COLUMNS).exceptAll(lake.landing().select(*schemas.LISTING_COLUMNS)).isEmpty()
    assert found.count() == lake.landing().count()


def order_tables(spark, folder):
    """Twelve line items, two of them alike, of four orders, three parts and two customers."""
    day = datetime.datetime(1997, 5, 1)
    items = [(i // 3, i % 3, i % 3, float(i), 10.0 + i, 0.01 * i, "R", "O") for i in range(11)]
    for name, kinds, table in (
        ("customer", "c_custkey long, c_mktsegment string", [(0, "BUILDING"), (1, "MACHINERY")]),
        ("part", "p_partkey long, p_brand string, p_name string, p_size int, p_type string",
         [(i, f"Brand#{i}", f"hot bolt{i}", i + 1, "SMALL") for i in range(3)]),
        ("orders", "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderstatus string, o_orderpriority string",
         [(i, i % 2, day, "F", ("1-URGENT", "4-NOT SPECIFIED")[i % 2]) for i in range(4)]),
        ("lineitem", "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_discount double, l_returnflag string, l_linestatus string", [*items, items[0]]),
    ):
        spark.createDataFrame(table, kinds).write.parquet(str(folder / f"{name}.parquet"))


def test_the_column_listing_leaves_only_the_layers(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(staging, "shared_folder", lambda _: f"file:{tmp_path}/app")
    monkeypatch.setattr(layers, "LANDING_FILES", layers.LANDING_FILES | {"maxRecordsPerFile": "5"})
    order_tables(spark, tmp_path / "in")
    lake = layers.SessionLake(spark, str(tmp_path / "in"))
    found = reports.table_columns(lake)
    assert rows(found.where("column = 'price'").select("camada", "tabela", "position", "type", "non_null")) == [
        ("bronze", "vehicle_prices", 20, "double", 12), ("dw", "fato_veiculo", 4, "double", 12),
        ("silver", "fato_veiculo", 6, "double", 12), ("silver", "veiculo", 20, "double", 12)]
    assert found.count() == 95
    assert not any((tmp_path / "app/staged").iterdir())
    export = lake.path("export", "vehicle_price_clean")
    assert all(p.name.endswith(".csv.gz") for p in Path(export.removeprefix("file:")).glob("part-*"))
    exported = readers.read_flat(spark, export, source_column="_file_name")
    assert exported.groupBy("_file_name").count().agg(F.max("count")).first()[0] <= 5
    # The export spells the filled history, which a reader takes as missing.
    assert rows(fill_missing(exported.drop("_file_name"))) == rows(lake.flat().drop("id"))
