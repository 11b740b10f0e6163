"""The load jobs: raw to flat, raw to bronze, bronze to silver star, silver to gold star."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratamart import schemas, staging
from stratamart.functions.cleaning import fill_missing, fitting_widths
from stratamart.operators import sketches
from stratamart.operators.keys import dense_key, file_key, located_key
from stratamart.operators.star import (
    build_dimension, drop_orphans, fact_rows, missing_keys, new_members, rekey_dimension, remap_fact, surrogate_map,
)
from stratamart.sources import listings
from stratamart.sources.lake import MODES, Lake, write_csv, write_json
from stratamart.sources.readers import read_flat

SILVER_STAR = ("dim_modelo", "dim_especificacao", "fato_veiculo")
GOLD_STAR = ("dim_modelo", "dim_condicao", "dim_cor", "fato_veiculo")
SHORT_LAYER = "dw_short"
SHORT_STAR = {"dim_cor": "dim_cor", "dim_condicao": "dim_con", "dim_modelo": "dim_mdl", "fato_veiculo": "fat_vcl"}


def _passing(load: Callable) -> Callable:
    """A load that keeps nothing but the tables it writes; it must return only scans of these."""
    @wraps(load)
    def run(lake: Lake, *args, **options):
        with staging.passing(lake.spark):
            return load(lake, *args, **options)
    return run


def _load_mode(mode: str, allowed: tuple[str, ...] = MODES) -> None:
    if mode not in allowed:
        raise ValueError(f"load mode {mode!r} is none of {allowed}")


# These loads rebuild a star whole, as its keys are ranks, which change with the rows; `append_silver` adds to one.
_STAR_MODES = ("overwrite", "skip_if_loaded")


def _continued(lake: Lake, layer: str, table: str, keyed: DataFrame, key: str, mode: str) -> DataFrame:
    """Keys that go on after the largest stored one when rows are appended."""
    last = lake.last_key(layer, table, key) if mode == "append" else 0
    return keyed.withColumn(key, F.col(key) + last) if last else keyed


@_passing
def load_flat(lake: Lake, source: DataFrame, mode: str = "overwrite", csv_path: str | None = None,
              fills: dict[str, object] | None = None, csv_options: dict[str, str] | None = None) -> DataFrame:
    """Rows of `read_flat` to the flat clean table (and its CSV export, written with `csv_options`).

    Every row is kept, outliers included.
    """
    _load_mode(mode)
    if mode == "skip_if_loaded" and lake.is_loaded("silver", "veiculo"):
        return lake.read("silver", "veiculo")
    keyed = dense_key(fill_missing(source.select(*schemas.LISTING_COLUMNS), fills), "id")
    keyed = _continued(lake, "silver", "veiculo", keyed, "id", mode)
    table = lake.write("silver", "veiculo", keyed.select("id", *schemas.LISTING_COLUMNS), mode)
    if csv_path:
        write_csv(table.drop("id"), csv_path, "overwrite", **csv_options or {})
    return table


@_passing
def load_bronze(lake: Lake, source: DataFrame, mode: str = "overwrite", source_name: str | None = None,
                fills: dict[str, object] | None = None, widths: dict[str, int] | None = None) -> DataFrame:
    """Rows of `read_flat` to bronze: nulls filled, texts held to their columns' widths (`BRONZE_WIDTHS`; a longer one fails the load), rows numbered, ingestion time and source file recorded.

    Located rows are numbered by their place in the files, others by way of a staged copy. Appended rows
    continue the numbers of the stored ones.
    """
    _load_mode(mode)
    if mode == "skip_if_loaded" and lake.is_loaded("bronze", "vehicle_prices"):
        return lake.read("bronze", "vehicle_prices")
    rows = fill_missing(source, fills)
    if "_source_file" not in rows.columns:
        rows = rows.withColumn("_source_file", F.lit(source_name).cast("string"))
    rows = rows.withColumn("_ingestion_timestamp", F.current_timestamp())
    rows = fitting_widths(rows, schemas.BRONZE_WIDTHS if widths is None else widths)
    columns = [*schemas.LISTING_COLUMNS, *schemas.PROVENANCE.fieldNames()]
    if {"_file", "_row"} <= set(rows.columns):
        keyed = located_key(rows.select(*columns, "_file", "_row"), "id")
    else:
        keyed = dense_key(rows.select(*columns), "id")
    keyed = _continued(lake, "bronze", "vehicle_prices", keyed, "id", mode)
    return lake.write("bronze", "vehicle_prices", keyed, mode)


PROFILE_SHARES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def append_profile(lake: Lake, rows: DataFrame, accuracy: int = 200) -> DataFrame:
    """Sketch the rows of one load and keep the sketches beside those of earlier loads; returns the profile of all.

    (column, rows, nulls, mean, min, q25, q50, q75, max, distinct). Earlier rows are not read again.
    """
    found = sketches.sketched(rows, schemas.PROFILE_NUMBERS, schemas.CATEGORY_COLUMNS, accuracy=accuracy)
    return sketches.profile_of(sketches.merged(lake.write("bronze", "profile", found, "append")), PROFILE_SHARES)


@_passing
def load_silver(lake: Lake, mode: str = "overwrite") -> dict[str, DataFrame]:
    """Bronze to the silver star, published whole: readers see the old star until then, a load that dies leaves it.

    Every bronze row becomes one fact row, so the dense bronze `id` serves as the fact's key.
    """
    _load_mode(mode, _STAR_MODES)
    if not (mode == "skip_if_loaded" and lake.is_star_loaded("silver", "fato_veiculo")):
        bronze = lake.read("bronze", "vehicle_prices")
        run = lake.begin("silver")
        dimensions = {
            spec.name: lake.write_run(run, spec.name, build_dimension(bronze, spec))
            for spec in schemas.SILVER_FATO.dimensions
        }
        keyed = bronze.withColumnRenamed("id", schemas.SILVER_FATO.key)
        lake.write_run(run, "fato_veiculo", fact_rows(keyed, schemas.SILVER_FATO, dimensions))
        lake.publish(run, SILVER_STAR)
    return lake.read_star("silver", SILVER_STAR)


@_passing
def append_silver(lake: Lake) -> dict[str, DataFrame]:
    """Bronze rows that the silver star lacks, added to it; a star that is not there is loaded.

    Only bronze rows above the fact's largest key are read. Their tuples that a dimension lacks, null
    being equal to null, get keys after its largest one, and only these and the new fact rows are written. Old files
    stay as they are: the new version is the old one and a further part of each table. Keys of an appended star are
    not ranks; `load_silver` makes them so again. A run that dies changes nothing and can be repeated, as what
    is new follows from what is published.
    """
    if not lake.published("silver"):
        return load_silver(lake)
    star = lake.read_star("silver", SILVER_STAR)
    last = lake.last_key("silver", "fato_veiculo", schemas.SILVER_FATO.key)
    new = lake.read("bronze", "vehicle_prices").where(F.col("id") > last)
    if not new.isEmpty():
        onto, run = lake.published("silver"), lake.begin("silver")
        dimensions = {}
        for spec in schemas.SILVER_FATO.dimensions:
            keyed = new_members(new, star[spec.name], spec, lake.last_key("silver", spec.name, spec.key))
            dimensions[spec.name] = star[spec.name].unionByName(lake.write_run(run, spec.name, keyed))
        keyed = new.withColumnRenamed("id", schemas.SILVER_FATO.key)
        lake.write_run(run, "fato_veiculo", fact_rows(keyed, schemas.SILVER_FATO, dimensions))
        lake.publish(run, SILVER_STAR, onto)
    return lake.read_star("silver", SILVER_STAR)


def _model_map(silver: dict[str, DataFrame], gold: dict[str, DataFrame]) -> DataFrame:
    return surrogate_map(silver["dim_modelo"], "id_modelo", [(schemas.GOLD_MODELO, gold["dim_modelo"])])


def gold_fact(silver: dict[str, DataFrame], gold: dict[str, DataFrame], models: DataFrame) -> DataFrame:
    """The gold fact before orphans are removed; `models` maps the silver to the gold model keys."""
    specs = surrogate_map(
        silver["dim_especificacao"], "id_especificacao",
        [(schemas.GOLD_CONDICAO, gold["dim_condicao"]), (schemas.GOLD_COR, gold["dim_cor"])],
        keep=schemas.PROMOTED,
    )
    # Stored, so that its true size decides whether the fact is shuffled for it.
    return remap_fact(silver["fato_veiculo"], schemas.GOLD_FATO,
                      [("id_especificacao", staging.materialize(specs, "specs")), ("id_modelo", models)])


@_passing
def load_gold(lake: Lake, mode: str = "overwrite") -> dict[str, DataFrame]:
    """Silver star to gold star: new dimensions, then the fact with their keys, orphans dropped.

    The model dimension keeps its attributes, so its keys are only renumbered; the specification
    dimension is split into two, which are looked up.
    """
    _load_mode(mode, _STAR_MODES)
    if not (mode == "skip_if_loaded" and lake.is_star_loaded("dw", "fato_veiculo")):
        silver = lake.read_star("silver", SILVER_STAR)
        run = lake.begin("dw")
        rows, models = rekey_dimension(silver["dim_modelo"], "id_modelo", schemas.GOLD_MODELO)
        gold = {"dim_modelo": lake.write_run(run, "dim_modelo", rows)}
        for spec in (schemas.GOLD_CONDICAO, schemas.GOLD_COR):
            gold[spec.name] = lake.write_run(run, spec.name, build_dimension(silver["dim_especificacao"], spec))
        lake.write_run(run, "fato_veiculo", drop_orphans(gold_fact(silver, gold, models), schemas.GOLD_FATO))
        lake.publish(run, GOLD_STAR)
    return lake.read_star("dw", GOLD_STAR)


def gold_orphans(silver: dict[str, DataFrame], gold: dict[str, DataFrame]) -> DataFrame:
    """(dimension, missing): fact rows without a key per gold dimension."""
    return missing_keys(gold_fact(silver, gold, _model_map(silver, gold)), schemas.GOLD_FATO)


def abbreviated(df: DataFrame, widths: dict[str, int] | None = None) -> DataFrame:
    """Short column names, horsepower as a whole number (fails on a lossy cast)."""
    if "engine_hp" in df.columns:
        whole = F.col("engine_hp").cast("int")
        message = F.concat(F.lit("engine_hp is no whole number: "), F.col("engine_hp").cast("string"))
        exact = F.col("engine_hp").isNull() | (whole.cast("double") == F.col("engine_hp"))
        df = df.withColumn("engine_hp", F.when(exact, whole).otherwise(F.raise_error(message).cast("int")))
    df = fitting_widths(df, widths or {})
    return df.select(*[F.col(c).alias(schemas.ABBREVIATED.get(c, c)) for c in df.columns])


@_passing
def load_abbreviated(lake: Lake, mode: str = "overwrite", widths: dict[str, int] | None = None
                     ) -> dict[str, DataFrame]:
    """The gold star under its abbreviated names; `widths` makes over-wide text fail the load."""
    _load_mode(mode, _STAR_MODES)
    if not (mode == "skip_if_loaded" and lake.is_star_loaded(SHORT_LAYER, "fat_vcl")):
        run = lake.begin(SHORT_LAYER)
        gold = lake.read_star("dw", GOLD_STAR)
        for table, short in SHORT_STAR.items():
            rows = gold[table]
            if short == "fat_vcl":
                rows = file_key(rows, "srk_vcl")
            lake.write_run(run, short, abbreviated(rows, widths))
        lake.publish(run, tuple(SHORT_STAR.values()))
    return lake.read_star(SHORT_LAYER, tuple(SHORT_STAR.values()))


def load_all(lake: Lake, source: DataFrame, mode: str = "overwrite", source_name: str | None = None) -> None:
    """All layers; with `append` bronze and the silver star grow and the gold star is rebuilt from them."""
    load_bronze(lake, source, mode, source_name)
    if mode == "append":
        append_silver(lake)
    else:
        load_silver(lake, mode)
    load_gold(lake, "overwrite" if mode == "append" else mode)


# Text files land compressed and bounded, as one task reads a whole file: CSV with quoted new lines cannot be split.
LANDING_FILES = {"compression": "gzip", "maxRecordsPerFile": "500000"}
# The export likewise, at the level that costs little time.
EXPORT_LEVEL = {"zlib.compress.level": "BEST_SPEED"}

_session_lakes: dict[tuple[str, str], "SessionLake"] = {}
staging.on_clear.append(_session_lakes.clear)


class SessionLake(Lake):
    """The layers over one input folder, each loaded on first use and kept for the application.

    They live in the shared folder, like every staged table, so queries read stored tables as they
    would in a warehouse.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        name = "".join(c if c.isalnum() else "_" for c in sf_dir.strip("/"))
        super().__init__(spark, f"{staging.shared_folder(spark)}/lake/{name}-{uuid.uuid4().hex}")
        self.sf_dir = sf_dir
        self._landed: set[str] = set()
        self._layers: dict[str, object] = {}

    def landing(self, fmt: str = "parquet") -> DataFrame:
        """The raw listings as they arrive: a flat file in the given format, nulls and all."""
        if "parquet" not in self._landed:
            with staging.passing(self.spark):
                self.write("landing", "parquet", listings.listings(self.spark, self.sf_dir))
            self._landed.add("parquet")
        if fmt not in self._landed:
            write = {"csv": write_csv, "json": write_json}[fmt]
            write(self.read("landing", "parquet"), self.path("landing", fmt), "overwrite", **LANDING_FILES)
            self._landed.add(fmt)
        return read_flat(self.spark, self.path("landing", fmt), fmt, source_column="_source_file",
                         located=fmt == "parquet")

    def _loaded(self, name: str, load) -> object:
        if name not in self._layers:
            self._layers[name] = load()
        return self._layers[name]

    def bronze(self) -> DataFrame:
        return self._loaded("bronze", lambda: load_bronze(self, self.landing()))

    def flat(self) -> DataFrame:
        export = self.path("export", "vehicle_price_clean")
        return self._loaded("flat", lambda: load_flat(
            self, self.landing("csv"), csv_path=export, csv_options=LANDING_FILES | EXPORT_LEVEL))

    def silver(self) -> dict[str, DataFrame]:
        self.bronze()
        return self._loaded("silver", lambda: load_silver(self))

    def gold(self) -> dict[str, DataFrame]:
        self.silver()
        return self._loaded("gold", lambda: load_gold(self))

    def gold_abbreviated(self) -> dict[str, DataFrame]:
        self.gold()
        return self._loaded("short", lambda: load_abbreviated(self))


def session_lake(spark: SparkSession, sf_dir: str) -> SessionLake:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _session_lakes:
        _session_lakes[key] = SessionLake(spark, key[1])
    return _session_lakes[key]
