import pytest
from pyspark.sql import functions as F

from stratamart import schemas
from stratamart.plans import layers, marts, reports
from stratamart.sources import lake as lakes, readers
from stratamart.sources.lake import Lake
from stratamart.streaming.ingest import append_new_files
from tests.conftest import SF_DIR, rows

LINE = {c: 1 for c in schemas.LISTING_COLUMNS} | {
    c: "t" for c in schemas.CATEGORY_COLUMNS} | {"price": 15000.5, "accident_history": "None"}


def write_listing_csv(path, lines, columns=None):
    columns = columns or schemas.LISTING_COLUMNS
    text = [",".join(columns)] + [",".join(str(line[c]) for c in columns) for line in lines]
    path.write_text("\n".join(text) + "\n")


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    write_listing_csv(tmp_path / "a.csv", [LINE | {"engine_hp": "NaN", "model": '"Say ""hi"", x"', "year": "NA"}],
                      schemas.LISTING_COLUMNS[::-1])
    got = readers.read_flat(spark, str(tmp_path / "a.csv"), source_column="_source_file").first()
    assert (got["model"], got["year"], got["engine_hp"], got["accident_history"], got["price"], got["_source_file"]) == (
        'Say "hi", x', None, None, None, 15000.5, "a.csv")
    write_listing_csv(tmp_path / "b.csv", [LINE], schemas.LISTING_COLUMNS[:-1])
    with pytest.raises(ValueError, match="price"):
        readers.read_flat(spark, str(tmp_path / "b.csv"))


def test_inferred_types(spark, tmp_path):
    write_listing_csv(tmp_path / "a.csv", [LINE])
    inferred = dict(readers.read_inferred_csv(spark, str(tmp_path / "a.csv")).dtypes)
    assert (inferred["make"], inferred["year"], inferred["price"]) == ("string", "int", "double")


def test_load_modes(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    two, three = spark.range(2), spark.range(3)
    assert not lake.is_loaded("x", "t")
    assert lake.write("x", "t", two, "skip_if_loaded").count() == 2
    assert lake.write("x", "t", three, "skip_if_loaded").count() == 2
    assert lake.write("x", "t", three, "append", rows_per_file=1).count() == 5
    assert lake.write("x", "t", three, "overwrite").count() == 3
    with pytest.raises(ValueError):
        lake.write("x", "t", two, "merge")


def test_loading_twice_keeps_the_counts(spark, tmp_path):
    write_listing_csv(tmp_path / "a.csv", [LINE, LINE, LINE | {"trim": "", "price": 9.0}, LINE | {"make": "z"}])
    lake = Lake(spark, str(tmp_path / "lake"))
    source = readers.read_flat(spark, str(tmp_path / "a.csv"))
    for mode in ("overwrite", "skip_if_loaded", "overwrite"):
        layers.load_all(lake, source, mode, source_name="a.csv")
        flat = layers.load_flat(lake, source, mode, csv_path=str(tmp_path / "clean"))
        short = layers.load_abbreviated(lake, mode)
    assert flat.count() == 4
    assert rows(lake.read("bronze", "vehicle_prices").select("id", "_source_file")) == [(i, "a.csv") for i in (1, 2, 3, 4)]
    assert lake.read("silver", "fato_veiculo").count() == lake.read("dw", "fato_veiculo").count() == 4
    assert lake.read("silver", "dim_modelo").count() == 3
    assert sorted(r.srk_vcl for r in short["fat_vcl"].collect()) == [1, 2, 3, 4]
    assert readers.read_raw_csv(spark, str(tmp_path / "clean")).count() == 4
    assert flat.select("accident_history").distinct().collect()[0][0] == "None"


def test_abbreviated_layout_refuses_lossy_values(spark):
    df = spark.createDataFrame([(150.5, "m" * 15)], "engine_hp double, model string")
    with pytest.raises(Exception, match="engine_hp is no whole number"):
        layers.abbreviated(df).collect()
    with pytest.raises(Exception, match="model is longer than 14"):
        layers.abbreviated(df.withColumn("engine_hp", F.lit(150.0)), schemas.WIDTHS).collect()
    assert layers.abbreviated(df.withColumn("engine_hp", F.lit(150.0))).columns == ["ehp", "mod"]


def test_typed_tables_and_catalog(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    name = lake.create("dims", "cor", schemas.TABLES["dw", "dim_cor"], schemas.WIDTHS, ("srk_cor",), replace=True)
    spark.sql(f"INSERT INTO {name} VALUES (1, 'red', 'black')")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        spark.sql(f"INSERT INTO {name} VALUES (2, 'vermilion', 'black')")
    assert lakes.run_sql(spark, "SELECT count(*) FROM {t}", t=spark.table(name)).first()[0] == 1
    lake.write("dims", "other", spark.range(3))
    lake.register([("dims", "other")])
    assert spark.table("dims.other").count() == 3
    assert {r.tableName for r in lakes.list_tables(spark, "dims").collect()} == {"cor", "other"}
    assert "dims" in {r[0] for r in lakes.list_databases(spark).collect()}
    assert [r.col_name for r in lakes.describe_table(spark, name).collect()][:3] == ["srk_cor", "exterior_color", "interior_color"]
    spark.sql("DROP DATABASE dims CASCADE")


def test_incremental_loads_take_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    arguments = (spark, str(landing), str(tmp_path / "table"), str(tmp_path / "progress"))
    write_listing_csv(landing / "a.csv", [LINE, LINE])
    assert append_new_files(*arguments) == 2
    assert append_new_files(*arguments) == 0
    write_listing_csv(landing / "b.csv", [LINE | {"accident_history": "Minor"}])
    assert append_new_files(*arguments) == 1
    table = spark.read.parquet(str(tmp_path / "table"))
    assert rows(table.groupBy("_source_file", "accident_history").count()) == [("a.csv", "None", 2), ("b.csv", "Minor", 1)]


def test_top_k_keeps_ties_at_the_edge(spark):
    fact = spark.createDataFrame([(i, 100.0) for i in range(1, 5)] + [(5, 200.0), (6, 50.0)], "id_modelo bigint, price double")
    models = spark.createDataFrame([(i, f"m{7 - i}", "x", "b") for i in range(1, 7)],
                                   "id_modelo bigint, make string, model string, body_type string")
    assert marts.best_per_key(fact, "id_modelo", "price", 2).count() == 6
    top = marts.most_expensive(fact, models, 3).collect()
    assert [(r.make, r.price) for r in top] == [("m2", 200.0), ("m3", 100.0), ("m4", 100.0)]


def test_verification_report(spark):
    report = reports.verification(layers.session_lake(spark, SF_DIR))
    assert all(r.matches for r in report["reconciliation"].collect())
    assert all(r.rows == r.max_key and r.duplicates == 0 for r in report["keys"].collect())
    assert rows(report["top_makes_silver"]) == rows(report["top_makes_gold"])
