"""Readers for flat listings in CSV, JSON and Parquet."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stratamart.functions.cleaning import NA_TOKENS, nan_to_null, normalize_missing, require_columns, tokens_to_null
from stratamart.schemas import LISTING

# Quotes are doubled inside quoted fields, as data-frame libraries write and read them.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}
# The text of a row that cannot be told apart into fields.
RECORD = "_record"


def read_raw_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Every column as text, named by the header."""
    return spark.read.options(**CSV_OPTIONS, multiLine=multiline).csv(path)


def read_inferred_csv(spark: SparkSession, path: str) -> DataFrame:
    """Types guessed by an extra pass over the data; for profiling, not for loads."""
    return normalize_missing(spark.read.options(**CSV_OPTIONS, inferSchema=True).csv(path))


def _fitting(given: Column, kind: T.DataType, wanted: T.DataType) -> Column:
    """The value in the wanted type, null where that would change it."""
    value = given.try_cast(wanted)
    if isinstance(wanted, (T.IntegerType, T.LongType)) and isinstance(
            kind, (T.StringType, T.DoubleType, T.FloatType, T.DecimalType)):
        text = isinstance(kind, T.StringType)
        number = given.try_cast("double") if text else given
        # Data-frame libraries write whole numbers of a column with gaps as 2018.0.
        whole = F.when(number == F.floor(number), number.try_cast(wanted))
        return F.coalesce(value, whole) if text else whole
    return value


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name and cast them; a value that does not fit becomes null."""
    require_columns(raw, schema.fieldNames(), "input")
    kinds = {f.name.lower(): f.dataType for f in raw.schema.fields}
    return raw.select(*[
        _fitting(F.col(f"`{f.name}`"), kinds[f.name.lower()], f.dataType).alias(f.name) for f in schema.fields
    ])


def _misfits(raw: DataFrame, schema: T.StructType) -> list[Column]:
    """Per column that is stored in another type, what does not fit it."""
    kinds = {f.name.lower(): f.dataType for f in raw.schema.fields}
    found = []
    for f in schema.fields:
        kind, given = kinds[f.name.lower()], F.col(f"`{f.name}`")
        if kind != f.dataType and not isinstance(f.dataType, T.StringType):
            lost = given.isNotNull() & _fitting(given, kind, f.dataType).isNull()
            found.append(F.when(lost, F.concat(F.lit(f"{f.name}: "), given.cast("string"))))
    return found


def csv_text(reader, columns: list[str], multiline: bool):
    """`reader` set to read all columns as text, rows with another number of fields in `_record`.

    Files whose header differs from `columns` fail, since fields are matched to it by position.
    """
    fields = [T.StructField(c, T.StringType()) for c in [*columns, RECORD]]
    return reader.options(**CSV_OPTIONS, multiLine=multiline, columnNameOfCorruptRecord=RECORD,
                          columnPruning=False, enforceSchema=False).schema(T.StructType(fields))


def _raw(spark: SparkSession, path: str, fmt: str, schema: T.StructType, multiline: bool) -> tuple[DataFrame, Column]:
    """The rows as they are stored, with `_record` where text is read, and what is wrong with a whole row."""
    place = [F.col("_metadata.file_name").alias("_name"), F.col("_metadata.file_path").alias("_file")]
    if fmt == "csv":
        header = read_raw_csv(spark, path, multiline).columns
        raw = csv_text(spark.read, header, multiline).csv(path).select("*", *place)
        require_columns(raw, schema.fieldNames(), "input")
        return raw, field_fault(schema)
    if fmt == "json":
        lines = spark.read.text(path).select(F.col("value").alias(RECORD), *place).where(F.trim(RECORD) != "")
        # A generated column is parsed once, however often later expressions and filters name it.
        parsed = lines.select("*", _once(F.from_json(RECORD, "map<string,string>")).alias("_fields"))
        names = schema.fieldNames()
        raw = parsed.select("*", *[F.try_element_at("_fields", F.lit(c)).alias(c) for c in names])
        absent = F.get(F.array_except(F.array(*[F.lit(c) for c in names]), F.map_keys("_fields")), F.lit(0))
        return raw, F.when(F.col("_fields").isNull(), F.lit("broken record")).otherwise(F.concat(F.lit("missing "), absent))
    if fmt == "parquet":
        raw = spark.read.parquet(path).select("*", *place, F.col("_metadata.row_index").alias("_row"))
        require_columns(raw, schema.fieldNames(), "input")
        return raw, F.lit(None).cast("string")
    raise ValueError(f"unknown format {fmt!r}")


def field_fault(schema: T.StructType) -> Column:
    """What is wrong with a whole CSV row; looks at a column beside `_record`, as Spark asks for."""
    seen = F.length(F.coalesce(F.col(f"`{schema.fieldNames()[0]}`"), F.lit(""))) >= 0
    return F.when(F.col(RECORD).isNotNull() & seen, F.lit("number of fields"))


def checked(raw: DataFrame, schema: T.StructType, fault: Column, bad: str = "fail") -> DataFrame:
    """Typed rows; rows that cannot be read whole fail the query or, with `bad="drop"`, are left to `read_rejects`."""
    if bad not in ("fail", "drop"):
        raise ValueError(f"unknown treatment of bad rows {bad!r}")
    if RECORD in raw.columns:
        return _checked_text(raw, schema, fault, bad)
    clean = nan_to_null(tokens_to_null(raw))
    misfits = _misfits(clean, schema)
    if misfits:
        clean = clean.where(_accepted(F.coalesce(fault, *misfits), bad))
    # NaN may also be spelled as text.
    return nan_to_null(typed(clean, schema))


def _accepted(reason: Column, bad: str) -> Column:
    failure = F.raise_error(F.concat(F.lit("row cannot be read, "), reason)).cast("boolean")
    return reason.isNull() if bad == "drop" else F.when(reason.isNull(), True).otherwise(failure)


def _checked_text(raw: DataFrame, schema: T.StructType, fault: Column, bad: str) -> DataFrame:
    """`checked` for rows read as text.

    Each value is cleaned and cast once, by kind in arrays: written out per column, and again in the filter, the
    expressions make methods that the JVM does not compile. A generated column is computed once, however often later
    expressions name it.
    """
    kinds = {f.name.lower(): f.dataType for f in raw.schema.fields}
    texts = [f for f in schema.fields if isinstance(kinds[f.name.lower()], T.StringType)]
    others = [f"`{f.name}`" for f in schema.fields if f not in texts]
    given = F.array(*[F.col(f"`{f.name}`") for f in texts])
    rows = raw.select(*others, fault.alias("_fault"), _once(F.transform(given, _present)).alias("_texts"))
    wanted: dict[T.DataType, list[int]] = {}
    for i, f in enumerate(texts):
        if not isinstance(f.dataType, T.StringType):
            wanted.setdefault(f.dataType, []).append(i)
    some = {n: F.array(*[F.get("_texts", F.lit(i)) for i in places]) for n, places in enumerate(wanted.values())}
    values = [F.transform(some[n], _fitter(kind)).alias(f"v{n}") for n, kind in enumerate(wanted)]
    rows = rows.select("*", _once(F.struct(F.lit(0).alias("none"), *values)).alias("_values"))
    lost = [F.zip_with(some[n], f"_values.v{n}", lambda text, v: text.isNotNull() & v.isNull()) for n in some]
    any_lost = reduce(lambda a, b: a | b, [F.exists(gone, lambda x: x) for gone in lost], F.lit(False))
    said = [F.filter(F.zip_with(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(f"{texts[i].name}: ").alias("name")) for i in places]),
                                F.arrays_zip(some[n].alias("text"), lost[n].alias("gone")),
                                lambda named, x: F.when(x["gone"], F.struct(named["place"].alias("place"), F.concat(named["name"], x["text"]).alias("said")))),
                     lambda x: x.isNotNull()) for n, places in enumerate(wanted.values())]
    first = F.array_min(F.concat(*said))["said"] if said else F.lit(None).cast("string")
    rows = rows.where(_accepted(F.coalesce(F.col("_fault"), F.when(any_lost, first)), bad))
    place = {i: (n, at) for n, places in enumerate(wanted.values()) for at, i in enumerate(places)}

    def value(i: int) -> Column:
        return F.get(F.col(f"_values.v{place[i][0]}"), F.lit(place[i][1]))

    at = {f.name: i for i, f in enumerate(texts)}
    return nan_to_null(rows.select(*[
        (F.col(f"`{f.name}`") if f.name not in at else value(at[f.name]) if at[f.name] in place
         else F.get("_texts", F.lit(at[f.name]))).alias(f.name) for f in schema.fields]))


def _present(text: Column) -> Column:
    """`missing_to_null` for a lambda, which Spark interprets: that is slow at CASE, not at IF."""
    return F.nvl2(F.nullif(F.trim(text).isin(*NA_TOKENS), F.lit(True)), text, F.lit(None).cast("string"))


def _fitter(kind: T.DataType) -> Callable[[Column], Column]:
    return lambda text: _fitting(text, T.StringType(), kind)


def _once(column: Column) -> Column:
    return F.explode(F.array(column))


def read_flat(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType = LISTING,
              source_column: str | None = None, located: bool = False, multiline: bool = True,
              bad: str = "fail") -> DataFrame:
    """Typed rows of `schema` with missing values as null.

    Columns are matched by name, whatever their order in the files. `source_column` adds the name
    of the file a row came from; `located` adds `_file` and `_row` (Parquet only), by which a load
    can number the rows.

    No value is lost silently: a CSV row with too many or too few fields, a JSON line that is broken
    or lacks a field, and a value that does not fit its type fail the query, or with `bad="drop"` are
    left out here and returned by `read_rejects`. Quoted fields may hold new lines; `multiline=False`
    lets Spark split large CSV files that have none.
    """
    raw, fault = _raw(spark, path, fmt, schema, multiline)
    extra = []
    if source_column:
        raw = raw.withColumn(source_column, F.col("_name"))
        extra.append(T.StructField(source_column, T.StringType()))
    if located:
        extra += [T.StructField("_file", T.StringType()), T.StructField("_row", T.LongType())]
    return checked(raw, T.StructType(schema.fields + extra), fault, bad)


def read_rejects(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType = LISTING,
                 multiline: bool = True) -> DataFrame:
    """(file, reason, record): the rows that `read_flat` cannot read; the record is null where its fields could be told apart."""
    raw, fault = _raw(spark, path, fmt, schema, multiline)
    record = F.col(RECORD) if RECORD in raw.columns else F.lit(None).cast("string")
    rows = nan_to_null(tokens_to_null(raw.withColumn("_text", F.struct(record.alias("record")))))
    faults = rows.select(F.col("_name").alias("file"), F.coalesce(fault, *_misfits(rows, schema)).alias("reason"),
                         F.col("_text.record").alias("record"))
    return faults.where(F.col("reason").isNotNull())


def json_fields(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Replace a JSON text column by its fields."""
    parsed = df.withColumn("_json", F.from_json(column, schema))
    return parsed.select(*[c for c in df.columns if c != column], "_json.*")
