
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

import oracles  # noqa: E402
from stratamart import schemas  # noqa: E402
from stratamart.functions.columns import round_money  # noqa: E402
from stratamart.operators import distributions, profile, quality, sketches, star  # noqa: E402
from stratamart.plans import layers, marts, reports, sales  # noqa: E402
from stratamart.plans.layers import SessionLake, session_lake  # noqa: E402
from stratamart.sources.lake import Lake, preview  # noqa: E402
from stratamart.sources.listings import read_table  # noqa: E402
from stratamart.sources.readers import json_fields, read_flat, read_rejects  # noqa: E402
from stratamart.staging import materialize, shared_folder  # noqa: E402
from stratamart.streaming.ingest import append_new_files  # noqa: E402

try:  # the subpackage may be left out; its modules themselves swallow no import error
    from stratamart.llm import queries as llm
except ImportError:
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

# Literals that mean the same on the given tables as the original ones mean on vehicles.
MAKES = ("Brand#1", "Brand#2", "Brand#3")
MODEL_PREFIX = "hot"
ACCIDENT = "1-URGENT"
RECENT_YEAR = 1998
LATEST_YEAR = 2000


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def _on_lake(build: Callable[[SessionLake], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(session_lake(spark, sf_dir))


def _with_models(build: Callable[..., DataFrame], **options) -> Query:
    """A query over the silver fact and its model dimension."""
    def run(lake: SessionLake) -> DataFrame:
        silver = lake.silver()
        return build(silver["fato_veiculo"], silver["dim_modelo"], **options)
    return _on_lake(run)


def _with_specs(build: Callable[..., DataFrame], **options) -> Query:
    """A query over the silver fact and its specification dimension."""
    def run(lake: SessionLake) -> DataFrame:
        silver = lake.silver()
        return build(silver["fato_veiculo"], silver["dim_especificacao"], **options)
    return _on_lake(run)


def _on_tables(build: Callable[..., DataFrame], *names: str) -> Query:
    """A query over the given tables themselves."""
    return lambda spark, sf_dir: build(*[read_table(spark, sf_dir, n) for n in names])


def _landed(fmt: str) -> Query:
    return _on_lake(lambda lake: lake.landing(fmt).select(*schemas.LISTING_COLUMNS))


def _incremental_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = session_lake(spark, sf_dir)
    lake.landing("csv")
    target = f"{shared_folder(spark)}/incremental-{uuid.uuid4().hex}"
    for _ in range(2):  # the second run finds no new file and adds nothing
        append_new_files(spark, lake.path("landing", "csv"), f"{target}/table", f"{target}/progress")
    return spark.read.parquet(f"{target}/table").select(*schemas.LISTING_COLUMNS)


_ORDER_LINES = "key long, day int, price double, priority string"


def _rejected(fmt: str) -> Query:
    """Orders as a landing file in which some lines are faulty, by the last digit of the key: rows read, rows rejected by reason."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fault = F.col("o_orderkey") % 5
        year = F.year("o_orderdate").cast("string")
        values = {"key": F.col("o_orderkey"), "day": F.when(fault == 3, F.concat(F.lit("x"), year)).otherwise(F.concat(year, F.lit(".0"))),
                  "price": F.col("o_totalprice"), "priority": F.col("o_orderpriority")}
        named = {k: v.cast("string").alias(k) for k, v in values.items()}
        orders = read_table(spark, sf_dir, "orders")
        target = f"{shared_folder(spark)}/rejects-{uuid.uuid4().hex}"
        if fmt == "csv":
            line = F.concat_ws(",", *named.values())
            short = F.concat_ws(",", named["key"], named["day"], named["price"])
            lines = F.when(fault == 2, F.concat(line, F.lit(",more"))).when(fault == 4, short).otherwise(line)
            # The separator is in no line, so lines and header are written as they are.
            orders.select(lines.alias(",".join(named))).write.options(header=True, sep="\u0001", quote="").csv(target)
        else:
            line = F.to_json(F.struct(*named.values()))
            short = F.to_json(F.struct(named["key"], named["price"], named["priority"]))
            lines = F.when(fault == 2, F.expr("substring(line, 1, length(line) - 1)")).when(fault == 4, short).otherwise(F.col("line"))
            orders.withColumn("line", line).select(lines.alias("value")).write.text(target)
        kinds = spark.createDataFrame([], _ORDER_LINES).schema
        read = read_flat(spark, target, fmt, kinds, bad="drop").agg(
            F.count("*").alias("n"), F.sum("day").alias("days")).select(F.lit("read").alias("outcome"), "n", "days")
        reasons = F.substring_index("reason", ":", 1)
        rejected = read_rejects(spark, target, fmt, kinds).groupBy(reasons.alias("outcome")).agg(F.count("*").alias("n"))
        return read.unionByName(rejected.withColumn("days", F.lit(None).cast("long")))
    return run


def _appended_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of a bronze table into which the same listings went twice."""
    source = session_lake(spark, sf_dir).landing()
    lake = Lake(spark, f"{shared_folder(spark)}/append-{uuid.uuid4().hex}")
    for _ in range(2):
        bronze = layers.load_bronze(lake, source, "append")
    return bronze.agg(F.count("*").alias("n"), F.countDistinct("id").alias("keys"), F.min("id").alias("first"), F.max("id").alias("last"))


# Listings before this year are a first load, those from then on a second one.
SECOND_LOAD = 1998


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[Lake, DataFrame]:
    """A lake whose bronze and silver hold the listings of a first load, and those of the second, still to be loaded."""
    source = session_lake(spark, sf_dir).landing().drop("_file", "_row")  # a part of a file's rows has no dense places
    lake = Lake(spark, f"{shared_folder(spark)}/loads-{uuid.uuid4().hex}")
    layers.load_bronze(lake, source.where(F.col("year") < SECOND_LOAD))
    layers.load_silver(lake)
    return lake, source.where(F.col("year") >= SECOND_LOAD)


def _appended_star(spark: SparkSession, sf_dir: str) -> tuple[Lake, dict[str, DataFrame]]:
    lake, more = _two_loads(spark, sf_dir)
    layers.load_bronze(lake, more, "append")
    return lake, layers.append_silver(lake)


def _silver_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat rows that a star stands for to which a second load was appended."""
    _, silver = _appended_star(spark, sf_dir)
    return star.widen(silver["fato_veiculo"], schemas.SILVER_FATO, silver, schemas.LISTING_COLUMNS)


def _silver_append_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, silver = _appended_star(spark, sf_dir)
    keys = {"dim_modelo": "id_modelo", "dim_especificacao": "id_especificacao", "fato_veiculo": "id_fato"}
    return quality.union_all([quality.key_check(silver[t], key, t) for t, key in keys.items()])


def _silver_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a reader finds in the fact before a reload, while a run has written but not published, and after."""
    lake, more = _two_loads(spark, sf_dir)
    seen = {"before": lake.read("silver", "fato_veiculo")}
    layers.load_bronze(lake, more, "append")
    run = lake.begin("silver")  # a run that dies
    lake.write_run(run, "fato_veiculo", seen["before"].limit(0))
    seen["during"] = lake.read("silver", "fato_veiculo")
    layers.load_silver(lake, "skip_if_loaded")
    seen["after"] = lake.read("silver", "fato_veiculo")
    return quality.union_all([df.agg(F.lit(moment).alias("moment"), F.count("*").alias("n"), F.max("id_fato").alias("last"))
                              for moment, df in seen.items()])


def _wide(lake: SessionLake, layer: str) -> DataFrame:
    """A star joined back to flat rows."""
    tables, spec = {"silver": (lake.silver, schemas.SILVER_FATO), "dw": (lake.gold, schemas.GOLD_FATO)}[layer]
    return star.widen(tables()["fato_veiculo"], spec, tables(), schemas.LISTING_COLUMNS)


def _roundtrip(lake: SessionLake) -> DataFrame:
    """How many rows of the re-joined stars differ from the flat bronze table."""
    bronze = lake.bronze().select(*schemas.LISTING_COLUMNS)
    return quality.union_all([
        star.row_differences(bronze, _wide(lake, layer)).agg(F.count("*").alias("differing_rows"))
        .select(F.lit(layer).alias("star"), "differing_rows") for layer in ("silver", "dw")
    ])


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.union_all([
        quality.foreign_key_check(read_table(spark, sf_dir, child), key, read_table(spark, sf_dir, parent),
                                  parent_key, f"{child}.{key}")
        for child, key, parent, parent_key in oracles.REFERENCES
    ])


def _profile_of_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of listings that came in two loads, from the sketches of each: exact numbers, and whether the
    quantiles' ranks and the distinct counts keep to three times their sketches' errors."""
    source = session_lake(spark, sf_dir).landing().drop("_file", "_row")
    lake = Lake(spark, f"{shared_folder(spark)}/profile-{uuid.uuid4().hex}")
    for part in (source.where(F.col("year") < SECOND_LOAD), source.where(F.col("year") >= SECOND_LOAD)):
        found = layers.append_profile(lake, part)
    found = materialize(found, "profile")  # evaluated once, as sketches are random
    exact = profile.distinct_counts(source.select([F.col(c).cast("string").alias(c) for c in [*schemas.PROFILE_NUMBERS, *schemas.CATEGORY_COLUMNS]]),
                                    [*schemas.PROFILE_NUMBERS, *schemas.CATEGORY_COLUMNS]).withColumnRenamed("distinct", "_exact")
    ranks = sketches.rank_errors(source, found.where(F.col("column").isin(schemas.PROFILE_NUMBERS)), layers.PROFILE_SHARES)
    near = ranks.groupBy("column").agg((F.max("error") <= 3 * sketches.rank_error(200)).alias("quantiles_near"))
    counted = F.abs(F.col("distinct") - F.col("_exact")) <= F.greatest(F.lit(1), 3 * 1.04 / 2 ** (sketches.DISTINCT_BITS / 2) * F.col("_exact"))
    return found.join(exact, "column").join(near, "column", "left").select(
        "column", "rows", "nulls", "min", "max", F.coalesce("quantiles_near", F.lit(True)).alias("quantiles_near"), counted.alias("distinct_near"))


def _missing_keys(lake: SessionLake) -> DataFrame:
    """Fact rows without a key where dimension rows are missing on purpose."""
    gold = lake.gold() | {"dim_modelo": lake.gold()["dim_modelo"].where(F.col("make") != MAKES[0]),
                          "dim_condicao": lake.gold()["dim_condicao"].where("condition <> 'Fair'")}
    return layers.gold_orphans(lake.silver(), gold)


def _best_value(**options) -> Callable[..., DataFrame]:
    return lambda fato, modelo: marts.best_value(fato, modelo, min_year=RECENT_YEAR, **options)


def _round_curve(curve: DataFrame) -> DataFrame:
    return _rounded(curve, x=4, density=10)


def _round_bins(bins: DataFrame) -> DataFrame:
    return _rounded(bins, bin_start=4, bin_end=4)


def _round_box(box: DataFrame) -> DataFrame:
    return _rounded(box, q1=4, median=4, q3=4)


def _summary(rows: DataFrame) -> DataFrame:
    return marts.price_summary(rows).select("n", round_money(F.col("mean")).alias("mean"),
                                            F.round("median", 4).alias("median"))


def _raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    """A profile of the raw listings, nulls and all."""
    return _on_lake(lambda lake: build(lake.landing().select(*schemas.LISTING_COLUMNS)))


def queries() -> dict[str, Query]:
    silver_tables = {
        "silver_dim_modelo": _on_lake(lambda lake: lake.silver()["dim_modelo"]),
        "silver_dim_especificacao": _on_lake(lambda lake: lake.silver()["dim_especificacao"]),
        "silver_fato": _on_lake(lambda lake: lake.silver()["fato_veiculo"].drop("id_fato")),
        "silver_append": _silver_append,
        "silver_append_keys": _silver_append_keys,
        "silver_reload": _silver_reload,
    }
    gold_tables = {
        "gold_dim_modelo": _on_lake(lambda lake: lake.gold()["dim_modelo"]),
        "gold_dim_condicao": _on_lake(lambda lake: lake.gold()["dim_condicao"]),
        "gold_dim_cor": _on_lake(lambda lake: lake.gold()["dim_cor"]),
        "gold_fato": _on_lake(lambda lake: lake.gold()["fato_veiculo"]),
        "gold_abbreviated": _on_lake(lambda lake: lake.gold_abbreviated()["fat_vcl"].drop("srk_vcl")),
        "gold_abbreviated_mdl": _on_lake(lambda lake: lake.gold_abbreviated()["dim_mdl"]),
        "gold_abbreviated_con": _on_lake(lambda lake: lake.gold_abbreviated()["dim_con"]),
        "gold_abbreviated_cor": _on_lake(lambda lake: lake.gold_abbreviated()["dim_cor"]),
    }
    sources = {
        "csv_roundtrip": _landed("csv"),
        "json_ingest": _landed("json"),
        "parquet_ingest": _landed("parquet"),
        "flat_clean": _on_lake(lambda lake: lake.flat().drop("id")),
        "bronze_load": _on_lake(lambda lake: lake.bronze().select(*schemas.LISTING_COLUMNS)),
        "bronze_preview": _on_lake(lambda lake: preview(
            lake.bronze().select(*schemas.LISTING_COLUMNS), 10, schemas.LISTING_COLUMNS)),
        "incremental_bronze": _incremental_bronze,
        "csv_rejects": _rejected("csv"),
        "json_rejects": _rejected("json"),
        "bronze_append_keys": _appended_keys,
        "json_props": _on_tables(
            lambda events: json_fields(events.select("event_id", "event_type", "props"), "props", "k bigint"),
            "events"),
        "catalog_columns": _on_lake(reports.table_columns),
    }
    marts_queries = {
        "q1_layer_counts": _on_lake(reports.layer_counts),
        "q1b_layer_fact_counts": _on_lake(reports.layer_fact_counts),
        "q2_price_stats": _on_lake(lambda lake: marts.price_stats(lake.silver()["fato_veiculo"])),
        "q2b_price_report": _on_lake(reports.price_report),
        "q3_top_makes": _with_models(marts.top_makes),
        "q3b_top_makes_gold": _on_lake(lambda lake: marts.top_makes(
            lake.gold()["fato_veiculo"], lake.gold()["dim_modelo"], "srk_modelo")),
        "q4_price_between": _with_models(marts.price_between),
        "q5_make_in": _with_models(marts.make_in, makes=MAKES),
        "q6_model_prefix": _with_models(marts.model_prefix, prefix=MODEL_PREFIX),
        "q7_fuel_share": _with_models(marts.fuel_share),
        "q8_avg_price_by_make": _with_models(marts.avg_price_by_make),
        "q8b_price_range_by_make": _with_models(marts.price_range_by_make),
        "q8c_price_and_count_by_make": _with_models(marts.price_and_count_by_make),
        "q8d_avg_price_flat": _on_lake(lambda lake: marts.average_price_by_make(lake.bronze(), None)),
        "q9_accident_class": _on_lake(lambda lake: marts.accident_class(
            lake.silver()["fato_veiculo"], lake.silver()["dim_modelo"], lake.silver()["dim_especificacao"], ACCIDENT)),
        "q10_accident_counts": _with_specs(marts.accident_counts),
        "q11_accident_prices": _with_specs(marts.accident_prices),
        "q12_best_value": _with_models(_best_value()),
        "q13_best_value_fixed": _with_models(_best_value(max_price=20000)),
        "q14_accident_by_band": _with_specs(marts.accident_by_band),
        "q14b_pivot": _with_specs(marts.band_pivot),
        "q14b_pivot_transposed": _with_specs(marts.band_pivot_transposed),
        "q14b_row_share": _with_specs(marts.band_row_share),
        "q15_make_model_year": _with_models(marts.make_model_year, min_year=LATEST_YEAR),
        "q16_most_expensive": _with_models(marts.most_expensive),
        "a1_average_ticket": _on_tables(sales.average_ticket, "orders", "customer"),
        "a2_active_customers": _on_tables(sales.active_customers, "orders"),
        "a3_sales_by_region": _on_tables(
            sales.sales_by_region, "lineitem", "orders", "customer", "nation", "region"),
    }
    chart_data = {
        "q4b_histogram": _with_models(lambda f, m: _round_bins(
            distributions.histogram(marts.in_range(f), "price", 20))),
        "q4b_density": _with_models(lambda f, m: _round_curve(distributions.density(marts.in_range(f), "price"))),
        "q4b_mean_median": _with_models(lambda f, m: _summary(marts.in_range(f))),
        "q4b_box_top_makes": _with_models(lambda f, m: _round_box(marts.box_of_top_makes(f, m))),
        "q5b_box_by_make": _with_models(lambda f, m: _round_box(marts.box_of_makes(f, m, MAKES))),
        "q5b_density_by_make": _with_models(lambda f, m: _round_curve(marts.density_of_makes(f, m, MAKES))),
        "q6b_scatter_bins": _with_models(lambda f, m: _rounded(
            marts.scatter_of_prefix(f, m, MODEL_PREFIX), mean_mileage=4)),
        "q6b_histogram": _with_models(lambda f, m: _round_bins(marts.histogram_of_prefix(f, m, MODEL_PREFIX))),
        "q6b_mean_median": _with_models(lambda f, m: _summary(marts.rows_of_model_prefix(f, m, MODEL_PREFIX))),
        "q12b_histogram_top20": _with_models(lambda f, m: _round_bins(
            marts.best_value_histogram(_best_value()(f, m)))),
        "q12b_scatter_top20": _with_models(lambda f, m: marts.best_value_scatter(_best_value()(f, m))),
        "q12b_labels": _with_models(lambda f, m: marts.best_value_labels(_best_value()(f, m))),
    }
    profiles = {
        "profile_shape": _raw(profile.shape),
        "profile_columns": _raw(profile.column_info),
        "profile_nulls": _raw(lambda rows: _rounded(profile.null_profile(rows), fraction=6)),
        "profile_duplicates": _raw(profile.duplicate_profile),
        "profile_categories": _raw(lambda rows: profile.category_profile(rows, schemas.PROFILE_CATEGORIES)),
        "profile_fuel_counts": _raw(lambda rows: profile.value_counts(rows, "fuel_type")),
        "profile_numeric": _raw(lambda rows: _rounded(
            profile.numeric_profile(rows, schemas.PROFILE_NUMBERS), mean=4, std=4, min=4, q25=4, q50=4, q75=4, max=4)),
        "profile_price_histogram": _raw(lambda rows: _round_bins(distributions.histogram(rows, "price", 50))),
        "profile_price_density": _raw(lambda rows: _round_curve(distributions.density(rows, "price"))),
        "profile_outliers": _raw(lambda rows: _round_box(distributions.box_stats(rows, "price"))),
        "category_domain": _on_lake(lambda lake: profile.category_domain(lake.bronze(), schemas.CATEGORY_COLUMNS)),
        "category_distinct": _on_lake(lambda lake: profile.distinct_counts(lake.bronze(), schemas.CATEGORY_COLUMNS)),
        "profile_of_two_loads": _profile_of_loads,
        "profile_document_copies": _on_tables(lambda d: profile.duplicate_profile(d.drop("doc_id")), "documents"),
        "profile_event_columns": _on_tables(profile.column_info, "events"),
    }
    checks = {
        "check_keys": _on_lake(reports.key_checks),
        "check_foreign_keys": _on_lake(reports.foreign_key_checks),
        "check_orphans": _on_lake(lambda lake: layers.gold_orphans(lake.silver(), lake.gold())),
        "check_missing_keys": _on_lake(_missing_keys),
        "check_references": _references,
        "check_orphan_customers": _on_tables(
            lambda orders, customer: quality.orphan_keys(orders, "o_custkey", customer.where("c_mktsegment <> 'BUILDING'"), "c_custkey"),
            "orders", "customer"),
        "check_unused_keys": _on_tables(
            lambda customer, orders: quality.orphan_keys(customer, "c_custkey", orders, "o_custkey"),
            "customer", "orders"),
        "check_duplicate_keys": _on_tables(
            lambda lineitem: quality.duplicate_keys(lineitem, ["l_orderkey", "l_linenumber"]), "lineitem"),
        "check_types": _on_lake(lambda lake: quality.type_check(
            lake.bronze(), dict.fromkeys([*schemas.INTEGER_COLUMNS, "mileage_per_year", "price"], "int"))),
        "check_widths": _on_lake(lambda lake: quality.width_check(lake.bronze(), schemas.WIDTHS)),
        "reconcile_layers": _on_lake(reports.reconcile_layers),
        "star_roundtrip_diff": _on_lake(_roundtrip),
        "star_wide_silver": _on_lake(lambda lake: _wide(lake, "silver")),
        "star_wide_gold": _on_lake(lambda lake: _wide(lake, "dw")),
    }
    found = sources | silver_tables | gold_tables | marts_queries | chart_data | profiles | checks
    return found | llm.queries() if llm else found


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql() | (llm.oracle_sql() if llm else {})


def entry(spark: SparkSession) -> DataFrame:
    """Top makes by average price on the star built from the smallest tables."""
    return queries()["q8_avg_price_by_make"](spark, "/root/testdata/sf0.001")
