"""Layered Parquet tables: paths, load modes, typed table definitions, catalog listings."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from stratamart.schemas import TABLES, create_table_ddl
from stratamart.sources.readers import CSV_OPTIONS

MODES = ("append", "overwrite", "skip_if_loaded")


_FOLDERS = "map<string, array<string>>"
_VERSIONS = f"number long, run string, tables {_FOLDERS}"


@dataclass(frozen=True)
class Run:
    """A load that writes a new version of a layer's star."""

    layer: str
    number: int
    name: str


class Lake:
    """Tables `<root>/<layer>/<table>`, and stars whose versions are published whole.

    A version of a star is written by a run, into folders of its own. `<layer>.versions` is a small table that says
    when a run began and, once all its tables are written, which folders make up the star. Readers look there for the
    newest version that was published, so they never see a part of one, and what they opened stays as it is. One load of
    a layer runs at a time; the folders of old and dead runs are nobody's and may be deleted (`unused_runs`).
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        """Scan of a table; tables of the data model need no look at the files for their schema."""
        return self._scan(layer, table, self.folders(layer, table))

    def _scan(self, layer: str, table: str, folders: list[str]) -> DataFrame:
        reader = self.spark.read
        if (layer, table) in TABLES:
            reader = reader.schema(TABLES[layer, table])
        return reader.parquet(*folders)

    def _versions(self, layer: str) -> list[Row]:
        """What runs of a layer began (no tables yet) and published, oldest first; two rows per run at most."""
        try:
            found = self.spark.read.schema(_VERSIONS).json(f"{self.root}/{layer}.versions").collect()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        return sorted(found, key=lambda v: (v["number"], v["tables"] is not None))

    def _record(self, layer: str, number: int, run: str, tables: dict[str, list[str]] | None) -> None:
        said = F.lit(None) if tables is None else F.create_map(
            *[c for t, parts in tables.items() for c in (F.lit(t), F.array(*map(F.lit, parts)))])
        row = self.spark.range(1, numPartitions=1).select(F.lit(number).alias("number"), F.lit(run).alias("run"), said.cast(_FOLDERS).alias("tables"))
        row.write.mode("append").json(f"{self.root}/{layer}.versions")

    def published(self, layer: str) -> dict[str, list[str]]:
        """The folders of each table in the newest published version; empty if there is none."""
        found = [v["tables"] for v in self._versions(layer) if v["tables"] is not None]
        return dict(found[-1]) if found else {}

    def folders(self, layer: str, table: str, published: dict[str, list[str]] | None = None) -> list[str]:
        """Where a table lies: its folders in the published version, or its own."""
        parts = (self.published(layer) if published is None else published).get(table)
        return [f"{self.root}/{layer}.runs/{part}" for part in parts] if parts else [self.path(layer, table)]

    def read_star(self, layer: str, tables: tuple[str, ...]) -> dict[str, DataFrame]:
        """Scans of several tables, all of one version."""
        published = self.published(layer)
        return {t: self._scan(layer, t, self.folders(layer, t, published)) for t in tables}

    def begin(self, layer: str) -> Run:
        """Begin a run that will publish a new version; until then the layer counts as not fully loaded."""
        versions = self._versions(layer)
        run = Run(layer, 1 + (versions[-1]["number"] if versions else 0), uuid.uuid4().hex)
        self._record(layer, run.number, run.name, None)
        return run

    def write_run(self, run: Run, table: str, df: DataFrame) -> DataFrame:
        """Write a table, or a part of one, into the run's folder and return a scan of it. It is not published yet."""
        path = f"{self.root}/{run.layer}.runs/{run.name}/{table}"
        df.write.parquet(path)
        return self._scan(run.layer, table, [path])

    def publish(self, run: Run, tables: tuple[str, ...], onto: dict[str, list[str]] | None = None) -> None:
        """Make the run's tables the newest version, those in `onto` as further parts of what is there."""
        self._record(run.layer, run.number, run.name, {t: [*(onto or {}).get(t, []), f"{run.name}/{t}"] for t in tables})

    def is_star_loaded(self, layer: str, fact: str) -> bool:
        """The last run that began was published, and the fact has a row."""
        versions = self._versions(layer)
        return (not versions or versions[-1]["tables"] is not None) and self.is_loaded(layer, fact)

    def unused_runs(self, layer: str) -> list[str]:
        """Runs of which the newest published version holds nothing: old ones, and those that died."""
        used = {part.split("/")[0] for parts in self.published(layer).values() for part in parts}
        return sorted({v["run"] for v in self._versions(layer)} - used)

    def is_loaded(self, layer: str, table: str) -> bool:
        """The table exists and has a row; looks at one row, never counts."""
        try:
            return not self.read(layer, table).isEmpty()
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise

    def last_key(self, layer: str, table: str, key: str) -> int:
        """The largest key of a table, 0 where there is none."""
        if not self.is_loaded(layer, table):
            return 0
        return self.read(layer, table).agg(F.max(key)).first()[0] or 0

    def write(self, layer: str, table: str, df: DataFrame, mode: str = "overwrite",
              rows_per_file: int | None = None) -> DataFrame:
        """Write in parallel by partition and return a scan of the table."""
        if mode not in MODES:
            raise ValueError(f"unknown load mode {mode!r}")
        if mode != "skip_if_loaded" or not self.is_loaded(layer, table):
            writer = df.write.mode("append" if mode == "append" else "overwrite")
            if rows_per_file:
                writer = writer.option("maxRecordsPerFile", rows_per_file)
            writer.parquet(self.path(layer, table))
        return self.read(layer, table)

    def register(self, tables: list[tuple[str, str]]) -> None:
        """Make tables visible to SQL as `layer.table`, over the files where they are.

        A name that stands for other files is given to these; tables that own their files are not replaced. A name
        stands for the version that was newest when it was registered.
        """
        for layer, table in tables:
            name, paths = f"{layer}.{table}", self.folders(layer, table)
            self._database(layer)
            if self.spark.catalog.tableExists(name):
                told = {r.col_name: r.data_type for r in describe_table(self.spark, f"EXTENDED {name}").collect()}
                kind = told.get("Type")
                if kind == "EXTERNAL" and [_place(told.get("Location", ""))] == [_place(p) for p in paths]:
                    continue
                if kind not in ("EXTERNAL", "VIEW"):
                    raise ValueError(f"{name} already stands for {told.get('Location')}")
                self.spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} {name}")
            if len(paths) == 1:
                self.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_quoted(paths[0])}")
            else:  # a star that was appended to has several folders
                parts = " UNION ALL ".join(f"SELECT * FROM parquet.`{p.replace('`', '``')}`" for p in paths)
                self.spark.sql(f"CREATE VIEW {name} AS {parts}")

    def _database(self, layer: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION {_quoted(f'{self.root}/{layer}')}")

    def create(self, layer: str, table: str, schema: T.StructType, widths: dict[str, int] | None = None,
               not_null: tuple[str, ...] = (), replace: bool = False) -> str:
        """Define an empty typed table; `replace` drops a definition of the same name first.

        With `widths` an over-wide text makes the insert fail.
        """
        name = f"{layer}.{table}"
        self._database(layer)
        if replace:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(create_table_ddl(name, schema, self.path(layer, table), widths, not_null))
        return name


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _place(location: str) -> str:
    """A location without the ways to spell the local file system."""
    return location.removeprefix("file:").rstrip("/").replace("///", "/", 1)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", **options: str) -> None:
    """Header in every part, one part per partition unless `maxRecordsPerFile` is among the options."""
    df.write.mode(mode).options(**CSV_OPTIONS, **options).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists", **options: str) -> None:
    """One object per line; nulls are written out, so that a missing field can be told from an empty one."""
    df.write.mode(mode).options(ignoreNullFields="false", **options).json(path)


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def preview(df: DataFrame, n: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """The first `n` rows; give `order_by` when the answer must be repeatable."""
    ordered = df.orderBy(*[F.col(c).asc_nulls_first() for c in order_by]) if order_by else df
    return ordered.limit(n)


def run_sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """SQL text over frames, named in the text as `{name}`."""
    return spark.sql(text, **tables)
