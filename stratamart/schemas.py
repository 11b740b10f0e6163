"""Schemas, star specifications, string widths and the abbreviated names of the data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(),
          "double": T.DoubleType(), "timestamp": T.TimestampType()}


def struct(text: str) -> T.StructType:
    """`"a string, b int"` as a StructType."""
    pairs = (field.split() for field in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


LISTING = struct(
    "make string, model string, year int, mileage int, engine_hp double, transmission string, "
    "fuel_type string, drivetrain string, body_type string, exterior_color string, "
    "interior_color string, owner_count int, accident_history string, seller_type string, "
    "condition string, trim string, vehicle_age int, mileage_per_year double, "
    "brand_popularity double, price double"
)
LISTING_COLUMNS = LISTING.fieldNames()
PROVENANCE = struct("_ingestion_timestamp timestamp, _source_file string")

# Text columns that take part in the category domain, and the two profile selections.
CATEGORY_COLUMNS = ["make", "model", "fuel_type", "transmission", "drivetrain", "body_type",
                    "exterior_color", "interior_color", "accident_history", "seller_type",
                    "condition", "trim"]
PROFILE_CATEGORIES = ["model", "make", "transmission", "drivetrain", "body_type", "exterior_color",
                      "interior_color", "seller_type", "condition", "trim"]
PROFILE_NUMBERS = ["price", "mileage", "year", "engine_hp", "vehicle_age", "mileage_per_year",
                   "owner_count"]


@dataclass(frozen=True)
class DimensionSpec:
    """A dimension: distinct tuples of `columns`, numbered by `key`."""

    name: str
    key: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class FactSpec:
    """A fact: dimension keys and measures; `key` is its own row id, if it has one."""

    name: str
    dimensions: tuple[DimensionSpec, ...]
    measures: tuple[str, ...]
    key: str | None = None

    @property
    def columns(self) -> list[str]:
        own = [self.key] if self.key else []
        return own + [d.key for d in self.dimensions] + list(self.measures)


SILVER_MODELO = DimensionSpec("dim_modelo", "id_modelo", (
    "make", "model", "year", "engine_hp", "transmission", "fuel_type", "drivetrain", "body_type", "trim"))
SILVER_ESPECIFICACAO = DimensionSpec("dim_especificacao", "id_especificacao", (
    "exterior_color", "interior_color", "owner_count", "accident_history", "seller_type", "condition",
    "vehicle_age"))
SILVER_FATO = FactSpec("fato_veiculo", (SILVER_MODELO, SILVER_ESPECIFICACAO),
                       ("mileage", "mileage_per_year", "brand_popularity", "price"), key="id_fato")

GOLD_MODELO = DimensionSpec("dim_modelo", "srk_modelo", (
    "make", "model", "year", "trim", "engine_hp", "transmission", "fuel_type", "drivetrain", "body_type"))
GOLD_CONDICAO = DimensionSpec("dim_condicao", "srk_condicao", ("seller_type", "condition", "accident_history"))
GOLD_COR = DimensionSpec("dim_cor", "srk_cor", ("exterior_color", "interior_color"))
GOLD_FATO = FactSpec("fato_veiculo", (GOLD_MODELO, GOLD_CONDICAO, GOLD_COR),
                     ("mileage", "price", "owner_count", "vehicle_age", "mileage_per_year",
                      "brand_popularity"))
# What the gold fact takes from the silver specification dimension instead of the silver fact.
PROMOTED = ("owner_count", "vehicle_age")

# The abbreviated column names of the gold layout.
ABBREVIATED = {
    "exterior_color": "ext", "interior_color": "itr",
    "seller_type": "sel", "condition": "cnd", "accident_history": "acc",
    "make": "mak", "model": "mod", "year": "yer", "trim": "trm", "engine_hp": "ehp",
    "transmission": "trn", "fuel_type": "ful", "drivetrain": "drv", "body_type": "bdy",
    "mileage": "mil", "price": "prc", "owner_count": "own", "vehicle_age": "age",
    "mileage_per_year": "mpy", "brand_popularity": "pop",
    "srk_cor": "srk_cor", "srk_condicao": "srk_con", "srk_modelo": "srk_mdl",
}

# Maximal text widths of the flat table and of the abbreviated layout.
WIDTHS = {
    "make": 13, "model": 14, "transmission": 9, "fuel_type": 8, "drivetrain": 3, "body_type": 12,
    "exterior_color": 6, "interior_color": 6, "accident_history": 5, "seller_type": 7,
    "condition": 9, "trim": 7,
}
# Columns the tight layouts declare as whole numbers.
INTEGER_COLUMNS = ["year", "mileage", "engine_hp", "owner_count", "vehicle_age"]

# Text widths of the bronze table.
BRONZE_WIDTHS = {
    "make": 100, "model": 100, "fuel_type": 50, "transmission": 50, "drivetrain": 50, "body_type": 50,
    "exterior_color": 50, "interior_color": 50, "accident_history": 50, "seller_type": 50,
    "condition": 50, "trim": 50, "_source_file": 255,
}


def bronze_schema() -> T.StructType:
    return T.StructType([T.StructField("id", T.LongType())] + LISTING.fields + PROVENANCE.fields)


def flat_schema() -> T.StructType:
    """The flat clean table: `id` and the listing columns."""
    return T.StructType([T.StructField("id", T.LongType())] + LISTING.fields)


def dimension_schema(spec: DimensionSpec) -> T.StructType:
    return T.StructType([T.StructField(spec.key, T.LongType())] + [LISTING[c] for c in spec.columns])


def fact_schema(spec: FactSpec) -> T.StructType:
    keys = ([spec.key] if spec.key else []) + [d.key for d in spec.dimensions]
    return T.StructType([T.StructField(k, T.LongType()) for k in keys] + [LISTING[c] for c in spec.measures])


def short_schema(schema: T.StructType, key: str | None = None) -> T.StructType:
    """A gold schema under its abbreviated names, horsepower as a whole number."""
    def field(f: T.StructField) -> T.StructField:
        kind = T.IntegerType() if f.name == "engine_hp" else f.dataType
        return T.StructField(ABBREVIATED.get(f.name, f.name), kind)
    own = [T.StructField(key, T.LongType())] if key else []
    return T.StructType(own + [field(f) for f in schema.fields])


# Every table of the data model: (layer, table) -> schema.
TABLES: dict[tuple[str, str], T.StructType] = {
    ("bronze", "vehicle_prices"): bronze_schema(),
    ("silver", "veiculo"): flat_schema(),
    ("silver", "dim_modelo"): dimension_schema(SILVER_MODELO),
    ("silver", "dim_especificacao"): dimension_schema(SILVER_ESPECIFICACAO),
    ("silver", "fato_veiculo"): fact_schema(SILVER_FATO),
    ("dw", "dim_modelo"): dimension_schema(GOLD_MODELO),
    ("dw", "dim_condicao"): dimension_schema(GOLD_CONDICAO),
    ("dw", "dim_cor"): dimension_schema(GOLD_COR),
    ("dw", "fato_veiculo"): fact_schema(GOLD_FATO),
    # The abbreviated layout reuses the name of the colour dimension, so it is a layer of its own.
    ("dw_short", "dim_mdl"): short_schema(dimension_schema(GOLD_MODELO)),
    ("dw_short", "dim_con"): short_schema(dimension_schema(GOLD_CONDICAO)),
    ("dw_short", "dim_cor"): short_schema(dimension_schema(GOLD_COR)),
    ("dw_short", "fat_vcl"): short_schema(fact_schema(GOLD_FATO), "srk_vcl"),
}


def create_table_ddl(name: str, schema: T.StructType, location: str,
                     widths: dict[str, int] | None = None, not_null: tuple[str, ...] = ()) -> str:
    """`CREATE TABLE` text for a Parquet table; `widths` turns text columns into VARCHAR(n)."""
    widths = widths or {}

    def column(field: T.StructField) -> str:
        kind = f"VARCHAR({widths[field.name]})" if field.name in widths else field.dataType.simpleString()
        return f"`{field.name}` {kind}" + (" NOT NULL" if field.name in not_null else "")

    columns = ", ".join(column(f) for f in schema.fields)
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{location}'"
