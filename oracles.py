"""ANSI SQL for every registered query, over the given tables."""

from __future__ import annotations

from stratamart import schemas

# The listing schema over the given tables (b has the filled nulls, l the raw ones).
_BASE = """
WITH items AS (
  SELECT p_brand AS make, p_name AS model, CAST(year(o_orderdate) AS INT) AS year,
    CAST(l_quantity AS INT) * 2000 AS mileage, CAST(p_size * 10 AS DOUBLE) AS engine_hp,
    l_linestatus AS transmission, o_orderstatus AS fuel_type, l_returnflag AS drivetrain, p_type AS body_type,
    split_part(p_name, ' ', 1) AS exterior_color, split_part(p_name, ' ', 2) AS interior_color,
    CAST(l_linenumber AS INT) AS owner_count,
    nullif(o_orderpriority, '4-NOT SPECIFIED') AS accident_history, c_mktsegment AS seller_type,
    CASE WHEN l_discount < 0.03 THEN 'Fair' WHEN l_discount < 0.07 THEN 'Good' ELSE 'Excellent' END AS condition,
    concat('T', CAST(p_size % 5 AS VARCHAR)) AS trim, CAST(2002 - year(o_orderdate) AS INT) AS vehicle_age,
    CAST(l_quantity AS INT) * 2000 / CAST(2002 - year(o_orderdate) AS DOUBLE) AS mileage_per_year,
    l_extendedprice AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey
), l AS (
  SELECT make, model, year, mileage, engine_hp, transmission, fuel_type, drivetrain, body_type, exterior_color,
    interior_color, owner_count, accident_history, seller_type, condition, trim, vehicle_age, mileage_per_year,
    CAST(count(*) OVER (PARTITION BY make) AS DOUBLE) / (SELECT count(*) FROM items) AS brand_popularity, price
  FROM items
), b AS (
  SELECT * REPLACE (coalesce(accident_history, 'None') AS accident_history) FROM l
)
"""

REFERENCES = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("labels", "doc_id", "documents", "doc_id"),
    ("part", "p_partkey", "lineitem", "l_partkey"),
    ("customer", "c_custkey", "orders", "o_custkey"),
    ("documents", "doc_id", "labels", "doc_id"),
]

_HAS_PRICE = "price BETWEEN 20000 AND 500000"
_MAKES = "make IN ('Brand#1', 'Brand#2', 'Brand#3')"


def _on_listings(text: str, *ctes: str) -> str:
    return _BASE + "".join(f", {c}" for c in ctes) + "\n" + text


def _money(expression: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(28,6)), {digits}) AS DOUBLE)"


def _rejects(broken: str, short: str) -> str:
    return f"""
SELECT CASE o_orderkey % 5 WHEN 2 THEN '{broken}' WHEN 3 THEN 'day' WHEN 4 THEN '{short}' ELSE 'read' END AS outcome,
  count(*) AS n, CAST(sum(CASE WHEN o_orderkey % 5 < 2 THEN year(o_orderdate) END) AS BIGINT) AS days
FROM orders GROUP BY ALL"""


def _nulls_first(columns) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in columns)


def _dimension(spec: schemas.DimensionSpec) -> str:
    columns = ", ".join(spec.columns)
    return (f"SELECT row_number() OVER (ORDER BY {_nulls_first(spec.columns)}) AS {spec.key}, {columns} "
            f"FROM (SELECT DISTINCT {columns} FROM b)")


def _fact(spec: schemas.FactSpec) -> str:
    keys = [f"dense_rank() OVER (ORDER BY {_nulls_first(d.columns)}) AS {d.key}" for d in spec.dimensions]
    return f"SELECT {', '.join([*keys, *spec.measures])} FROM b"


def _rejoined(spec: schemas.FactSpec) -> str:
    joins = " ".join(f"JOIN ({_dimension(d)}) USING ({d.key})" for d in spec.dimensions)
    return f"({_fact(spec)}) {joins}"


def _renamed(inner: str, columns) -> str:
    def short(c: str) -> str:
        source = "CAST(engine_hp AS INT)" if c == "engine_hp" else c
        return f"{source} AS {schemas.ABBREVIATED.get(c, c)}"
    return f"SELECT {', '.join(short(c) for c in columns)} FROM ({inner})"


def _histogram(rows: str, bins: int, value: str = "price") -> str:
    return f"""
SELECT CAST(g.bin AS INT) AS bin, round(lo + g.bin * ((hi - lo) / {bins}), 4) AS bin_start,
  round(lo + (g.bin + 1) * ((hi - lo) / {bins}), 4) AS bin_end, coalesce(c.n, 0) AS count
FROM (SELECT unnest(range({bins})) AS bin) g
CROSS JOIN (SELECT min({value}) AS lo, max({value}) AS hi FROM ({rows})) s
LEFT JOIN (
  SELECT CAST(CASE WHEN hi > lo THEN least(floor(({value} - lo) / ((hi - lo) / {bins})), {bins - 1}) ELSE 0 END AS INT)
    AS bin, count(*) AS n
  FROM ({rows}) CROSS JOIN (SELECT min({value}) AS lo, max({value}) AS hi FROM ({rows})) GROUP BY 1
) c ON c.bin = g.bin"""


def _density(rows: str, group: str = "", points: int = 200, cut: int = 0) -> str:
    key = f"{group}, " if group else ""
    using = f"JOIN s USING ({group})" if group else "CROSS JOIN s"
    group_by = f"GROUP BY {group}" if group else ""
    return f"""
, r AS ({rows}),
s AS (SELECT {key}min(price) AS lo, max(price) AS hi, count(*) AS n, stddev_samp(price) AS sd,
       stddev_samp(price) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h FROM r {group_by}),
cells AS (SELECT {key}least(floor((price - lo) / ((hi - lo) / 1024)), 1023) AS cell, count(*) AS m
          FROM r {using} GROUP BY ALL),
grid AS (SELECT {key}CAST(point AS INT) AS point, lo, hi, n, h,
          lo - {cut}.0 * h + point * ((hi - lo + {2 * cut}.0 * h) / {points - 1}) AS x
          FROM s CROSS JOIN (SELECT unnest(range({points})) AS point))
SELECT {key}point, round(x, 4) AS x,
  round(sum(m * exp(-0.5 * pow((x - (lo + (cell + 0.5) * (hi - lo) / 1024)) / h, 2)))
        / (n * h * sqrt(2 * pi())), 10) AS density
FROM grid {f"JOIN cells USING ({group})" if group else "CROSS JOIN cells"}
GROUP BY {key}point, x, n, h"""


def _box(rows: str, group: str = "") -> str:
    key = f"{group}, " if group else ""
    using = f"JOIN q USING ({group})" if group else "CROSS JOIN q"
    inside = "price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return f"""
, r AS ({rows}),
q AS (SELECT {key}quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
       quantile_cont(price, 0.75) AS q3 FROM r {f"GROUP BY {group}" if group else ""})
SELECT {key}round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, count(*) AS count,
  min(CASE WHEN {inside} THEN price END) AS whisker_low, max(CASE WHEN {inside} THEN price END) AS whisker_high,
  CAST(sum(CASE WHEN {inside} THEN 0 ELSE 1 END) AS BIGINT) AS outliers
FROM r {using} GROUP BY {key}q1, median, q3"""


def _summary(rows: str) -> str:
    return f"SELECT count(*) AS n, {_money('avg(price)')} AS mean, round(median(price), 4) AS median FROM ({rows})"


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def _column_info(table: str, columns: list[tuple[str, str]], prefix: str = "") -> str:
    return _union(
        f"SELECT {prefix}CAST({i} AS INT) AS position, '{c}' AS \"column\", '{kind}' AS type, "
        f"count({c}) AS non_null FROM ({table})" for i, (c, kind) in enumerate(columns))


def _schema_pairs(schema) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _categories(columns, table: str) -> str:
    return _union(f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS count FROM {table} "
                  f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in columns)


def _numbers(columns) -> str:
    def part(c: str) -> str:
        quartiles = ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), {q}), 4) AS {n}"
                              for n, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))
        return (f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 4) AS mean, "
                f"round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, round(CAST(min({c}) AS DOUBLE), 4) AS min, "
                f"{quartiles}, round(CAST(max({c}) AS DOUBLE), 4) AS max FROM l")
    return _union(part(c) for c in columns)


def _pivot_cells(row: str, column: str, values) -> str:
    return ", ".join(f"CAST(count(*) FILTER (WHERE {column} = '{v}') AS BIGINT) AS \"{v}\"" for v in values)


_BAND = "CASE WHEN price < 15000 THEN 'Barato' WHEN price < 30000 THEN 'Médio' ELSE 'Caro' END"
_BEST = f"""
SELECT veiculo, year, km, preco FROM (
  SELECT concat(make, ' ', model) AS veiculo, year, mileage AS km, {_money('price')} AS preco
  FROM b WHERE price < (SELECT avg(price) FROM b) AND mileage < 80000 AND year >= 1998
  ORDER BY price, veiculo, year, km LIMIT 20)"""
_TOP_MAKES = f"""SELECT make, price FROM b WHERE {_HAS_PRICE} AND make IN (
  SELECT make FROM b WHERE {_HAS_PRICE} GROUP BY make ORDER BY count(*) DESC, make LIMIT 10)"""


def _distinct_rows(spec) -> str:
    return f"(SELECT DISTINCT {', '.join(spec.columns)} FROM b)"


def _layer_rows() -> list[tuple[str, str, str, str]]:
    """(layer, table, key, source whose rows are the table's)."""
    return [
        ("bronze", "vehicle_prices", "id", "b"), ("silver", "veiculo", "id", "b"),
        ("silver", "dim_modelo", "id_modelo", _distinct_rows(schemas.SILVER_MODELO)),
        ("silver", "dim_especificacao", "id_especificacao", _distinct_rows(schemas.SILVER_ESPECIFICACAO)),
        ("silver", "fato_veiculo", "id_fato", "b"),
        ("dw", "dim_modelo", "srk_modelo", _distinct_rows(schemas.GOLD_MODELO)),
        ("dw", "dim_condicao", "srk_condicao", _distinct_rows(schemas.GOLD_CONDICAO)),
        ("dw", "dim_cor", "srk_cor", _distinct_rows(schemas.GOLD_COR)),
        ("dw_short", "fat_vcl", "srk_vcl", "b"),
    ]


def _layer_columns() -> str:
    """Column listing of every layer table: no column has a null once the accident history is filled."""
    layers = {(layer, table): source for layer, table, _, source in _layer_rows()} | {("dw", "fato_veiculo"): "b"}
    parts = []
    for (layer, table), schema in schemas.TABLES.items():
        if layer == "dw_short":
            continue
        for i, (column, kind) in enumerate(_schema_pairs(schema)):
            parts.append(
                f"SELECT '{layer}' AS camada, '{table}' AS tabela, CAST({i} AS INT) AS position, "
                f"'{column}' AS \"column\", '{kind}' AS type, count(*) AS non_null FROM {layers[layer, table]}")
    return _union(parts)


def _reference_check(child: str, key: str, parent: str, parent_key: str) -> str:
    orphan = f"{key} IS NOT NULL AND {key} NOT IN (SELECT {parent_key} FROM {parent})"
    return (f"SELECT '{child}.{key}' AS reference, count(*) AS rows, count(*) - count({key}) AS nulls, "
            f"count(DISTINCT CASE WHEN {orphan} THEN {key} END) AS orphan_keys, "
            f"count(CASE WHEN {orphan} THEN 1 END) AS orphan_rows FROM {child}")


def _lossy(column: str) -> str:
    return (f"SELECT '{column}' AS \"column\", 'int' AS target, count(*) AS rows, "
            f"count(CASE WHEN CAST({column} AS DOUBLE) <> trunc(CAST({column} AS DOUBLE)) THEN 1 END) AS lossy FROM b")


def _sources() -> dict[str, str]:
    listing = _on_listings("SELECT * FROM l")
    filled = _on_listings("SELECT * FROM b")
    return {
        "csv_roundtrip": listing, "json_ingest": listing, "parquet_ingest": listing,
        "flat_clean": filled, "bronze_load": filled, "incremental_bronze": filled,
        "csv_rejects": _rejects("number of fields", "number of fields"),
        "json_rejects": _rejects("broken record", "missing day"),
        "bronze_append_keys": "SELECT 2 * count(*) AS n, 2 * count(*) AS keys, 1 AS first, 2 * count(*) AS last FROM lineitem",
        "bronze_preview": _on_listings(
            f"SELECT * FROM b ORDER BY {_nulls_first(schemas.LISTING_COLUMNS)} LIMIT 10"),
        "json_props": "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
        "catalog_columns": _on_listings(_layer_columns()),
        "silver_dim_modelo": _on_listings(_dimension(schemas.SILVER_MODELO)),
        "silver_dim_especificacao": _on_listings(_dimension(schemas.SILVER_ESPECIFICACAO)),
        "silver_fato": _on_listings(_fact(schemas.SILVER_FATO)),
        "silver_append": _on_listings(f"SELECT {', '.join(schemas.LISTING_COLUMNS)} FROM b"),
        "silver_append_keys": _on_listings(_union(
            f"SELECT '{table}' AS \"table\", '{key}' AS key, count(*) AS rows, 0 AS nulls, 0 AS duplicates, 1 AS min_key, count(*) AS max_key FROM {source}"
            for table, key, source in (("dim_modelo", "id_modelo", _distinct_rows(schemas.SILVER_MODELO)),
                                       ("dim_especificacao", "id_especificacao", _distinct_rows(schemas.SILVER_ESPECIFICACAO)),
                                       ("fato_veiculo", "id_fato", "b")))),
        "silver_reload": _on_listings(_union(
            f"SELECT '{moment}' AS moment, count(*) AS n, count(*) AS last FROM b {kept}"
            for moment, kept in (("before", "WHERE year < 1998"), ("during", "WHERE year < 1998"), ("after", "")))),
        "gold_dim_modelo": _on_listings(_dimension(schemas.GOLD_MODELO)),
        "gold_dim_condicao": _on_listings(_dimension(schemas.GOLD_CONDICAO)),
        "gold_dim_cor": _on_listings(_dimension(schemas.GOLD_COR)),
        "gold_fato": _on_listings(_fact(schemas.GOLD_FATO)),
        "gold_abbreviated": _on_listings(_renamed(_fact(schemas.GOLD_FATO), schemas.GOLD_FATO.columns)),
        "gold_abbreviated_mdl": _on_listings(_renamed(
            _dimension(schemas.GOLD_MODELO), [schemas.GOLD_MODELO.key, *schemas.GOLD_MODELO.columns])),
        "gold_abbreviated_con": _on_listings(_renamed(
            _dimension(schemas.GOLD_CONDICAO), [schemas.GOLD_CONDICAO.key, *schemas.GOLD_CONDICAO.columns])),
        "gold_abbreviated_cor": _on_listings(_renamed(
            _dimension(schemas.GOLD_COR), [schemas.GOLD_COR.key, *schemas.GOLD_COR.columns])),
    }


def _marts() -> dict[str, str]:
    stats = (f"SELECT {_money('avg(price)')} AS preco_medio, {_money('min(price)')} AS preco_minimo, "
             f"{_money('max(price)')} AS preco_maximo FROM b")
    top5 = "SELECT make, count(*) AS total FROM b GROUP BY make ORDER BY total DESC, make LIMIT 5"
    listed = "SELECT make, model, price FROM b WHERE {} ORDER BY price DESC, make, model LIMIT 10"
    average = f"SELECT make, {_money('avg(price)')} AS preco_medio FROM b GROUP BY make"
    text = "concat('$', format('{:,.2f}', preco_medio))"
    pivot = _pivot_cells("accident_history", _BAND, ("Barato", "Caro", "Médio"))
    accidents = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "None")
    share = ", ".join(f"round(count(*) FILTER (WHERE {_BAND} = '{v}') * 1.0 / count(*) * 100, 6) AS \"{v}\""
                      for v in ("Barato", "Caro", "Médio"))
    layers = [("Bronze", "vehicle_prices", "b")] + [
        ("Silver", t, s) for layer, t, _, s in _layer_rows() if layer == "silver" and t != "veiculo"]
    listings = {
        "q1_layer_counts": _union(
            f"SELECT '{layer}' AS camada, '{t}' AS tabela, count(*) AS registros FROM {s}" for layer, t, s in layers),
        "q1b_layer_fact_counts": "SELECT 'Bronze' AS camada, count(*) AS registros FROM b "
                                 "UNION ALL SELECT 'Silver - Fatos', count(*) FROM b",
        "q2_price_stats": stats,
        "q2b_price_report": f"SELECT unnest(['Silver', 'Gold']) AS camada, *, {text} AS texto FROM ({stats})",
        "q3_top_makes": top5,
        "q3b_top_makes_gold": top5,
        "q4_price_between": listed.format(_HAS_PRICE),
        "q5_make_in": listed.format(_MAKES),
        "q6_model_prefix": listed.format("model LIKE 'hot%'"),
        "q7_fuel_share": f"SELECT fuel_type, count(*) AS total, "
                         f"{_money('count(*) / CAST((SELECT count(*) FROM b) AS DOUBLE) * 100', 1)} AS share "
                         f"FROM b GROUP BY fuel_type ORDER BY total DESC",
        "q8_avg_price_by_make": f"{average} ORDER BY preco_medio DESC, make LIMIT 10",
        "q8b_price_range_by_make": f"""
WITH t AS (SELECT make, {_money('avg(price)')} AS preco_medio, count(*) AS quantidade,
  {_money('min(price)')} AS preco_min, {_money('max(price)')} AS preco_max
  FROM b GROUP BY make ORDER BY preco_medio DESC, make LIMIT 10)
SELECT *, {_money('preco_medio - preco_min')} AS erro_abaixo, {_money('preco_max - preco_medio')} AS erro_acima,
  round(preco_medio / (SELECT max(preco_medio) FROM t), 6) AS razao_maximo FROM t""",
        "q8c_price_and_count_by_make": f"SELECT make AS marca, {_money('avg(price)')} AS preco_medio, "
                                       f"count(*) AS quantidade FROM b GROUP BY make "
                                       f"ORDER BY preco_medio DESC, marca LIMIT 10",
        "q8d_avg_price_flat": average,
        "q9_accident_class": "SELECT make, model, price, accident_history FROM b WHERE accident_history = '1-URGENT' "
                             "ORDER BY price DESC, make, model LIMIT 10",
        "q10_accident_counts": f"SELECT accident_history, count(*) AS quantidade, {_money('avg(price)')} AS preco_medio "
                               f"FROM b GROUP BY accident_history",
        "q11_accident_prices": f"SELECT accident_history AS historico, {_money('avg(price)')} AS preco_medio, "
                               f"count(*) AS quantidade FROM b GROUP BY accident_history",
        "q12_best_value": _BEST,
        "q13_best_value_fixed": _BEST.replace("(SELECT avg(price) FROM b)", "20000"),
        "q14_accident_by_band": f"SELECT accident_history, {_BAND} AS faixa_preco, count(*) AS total FROM b GROUP BY 1, 2",
        "q14b_pivot": f"SELECT accident_history, {pivot} FROM b GROUP BY 1",
        "q14b_pivot_transposed": f"SELECT {_BAND} AS faixa_preco, "
                                 f"{_pivot_cells('faixa_preco', 'accident_history', accidents)} FROM b GROUP BY 1",
        "q14b_row_share": f"SELECT accident_history, {share} FROM b GROUP BY 1",
        "q15_make_model_year": f"SELECT make AS marca, model AS modelo, year AS ano, {_money('avg(price)')} AS preco_medio, "
                               f"count(*) AS quantidade FROM b WHERE year >= 2000 GROUP BY 1, 2, 3 "
                               f"ORDER BY preco_medio DESC, marca, modelo, ano LIMIT 20",
        "q16_most_expensive": "SELECT body_type, make, model, price FROM b "
                              "ORDER BY price DESC, body_type, make, model LIMIT 10",
    }
    q8b = listings.pop("q8b_price_range_by_make").strip().removeprefix("WITH ")
    cte, _, rest = q8b.rpartition("\nSELECT *, ")
    listings["q8b_price_range_by_make"] = ""
    queries = {name: _on_listings(text) for name, text in listings.items()}
    queries["q8b_price_range_by_make"] = _on_listings(f"SELECT *, {rest}", cte)
    return queries | {
        "a1_average_ticket": f"""
SELECT c_mktsegment AS segment,
  {_money("CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*)")} AS average_ticket, count(*) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
        "a2_active_customers": "SELECT CAST(year(o_orderdate) AS INT) AS year, "
                               "count(DISTINCT o_custkey) AS active_customers FROM orders GROUP BY 1",
        "a3_sales_by_region": """
SELECT r_name AS region, CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))
  * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(28,2)) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
    }


def _charts() -> dict[str, str]:
    ranged = f"SELECT price FROM b WHERE {_HAS_PRICE}"
    prefixed = "SELECT * FROM b WHERE model LIKE 'hot%'"
    best = f"best AS ({_BEST})"
    label = "CASE WHEN length(veiculo) > 30 THEN concat(substring(veiculo, 1, 30), '...') ELSE veiculo END"
    cell = "CAST(CASE WHEN hi{0} > lo{0} THEN least(floor(({1} - lo{0}) / ((hi{0} - lo{0}) / {2})), {3}) ELSE 0 END AS INT)"
    return {
        "q4b_histogram": _on_listings(_histogram(ranged, 20)),
        "q4b_density": _BASE + _density(ranged),
        "q4b_mean_median": _on_listings(_summary(ranged)),
        "q4b_box_top_makes": _BASE + _box(_TOP_MAKES, "make"),
        "q5b_box_by_make": _BASE + _box(f"SELECT make, price FROM b WHERE {_MAKES}", "make"),
        "q5b_density_by_make": _BASE + _density(f"SELECT make, price FROM b WHERE {_MAKES}", "make", 100, 2),
        "q6b_scatter_bins": _on_listings(f"""
SELECT {cell.format('x', 'CAST(year AS DOUBLE)', 10, 9)} AS x_bin, {cell.format('y', 'price', 20, 19)} AS y_bin,
  count(*) AS count, round(avg(mileage), 4) AS mean_mileage
FROM ({prefixed}) CROSS JOIN (SELECT CAST(min(year) AS DOUBLE) AS lox, CAST(max(year) AS DOUBLE) AS hix,
  min(price) AS loy, max(price) AS hiy FROM ({prefixed})) GROUP BY 1, 2"""),
        "q6b_histogram": _on_listings(_histogram(prefixed, 15)),
        "q6b_mean_median": _on_listings(_summary(prefixed)),
        "q12b_histogram_top20": _on_listings(_histogram("SELECT preco FROM best", 10, "preco"), best),
        "q12b_scatter_top20": _on_listings(
            "SELECT *, round(preco / (SELECT max(preco) FROM best), 6) AS razao_maximo FROM best", best),
        "q12b_labels": _on_listings(
            f"SELECT {label} AS rotulo, preco, km, year, round(preco / (SELECT max(preco) FROM ten), 6) AS razao_maximo "
            f"FROM ten", best, "ten AS (SELECT * FROM best ORDER BY preco, veiculo, year, km LIMIT 10)"),
    }


def _profiles() -> dict[str, str]:
    columns = schemas.LISTING_COLUMNS
    everything = ", ".join(columns)
    nulls = _union(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, "
                   f"round((count(*) - count({c})) / CAST(count(*) AS DOUBLE), 6) AS fraction FROM l" for c in columns)
    events = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
              ("value", "double"), ("props", "string")]
    duplicates = ("SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, count(*) AS distinct_rows, "
                  "CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM "
                  "(SELECT count(*) AS n FROM {} GROUP BY {})")
    return {
        "profile_shape": _on_listings("SELECT count(*) AS rows, CAST(20 AS INT) AS columns FROM l"),
        "profile_columns": _on_listings(_column_info("SELECT * FROM l", _schema_pairs(schemas.LISTING))),
        "profile_nulls": _on_listings(nulls),
        "profile_duplicates": _on_listings(duplicates.format("l", everything)),
        "profile_categories": _on_listings(
            f"SELECT *, count(*) OVER (PARTITION BY \"column\") AS \"distinct\" "
            f"FROM ({_categories(schemas.PROFILE_CATEGORIES, 'l')})"),
        "profile_fuel_counts": _on_listings("SELECT fuel_type, count(*) AS count FROM l GROUP BY 1"),
        "profile_numeric": _on_listings(_numbers(schemas.PROFILE_NUMBERS)),
        "profile_price_histogram": _on_listings(_histogram("SELECT price FROM l", 50)),
        "profile_price_density": _BASE + _density("SELECT price FROM l"),
        "profile_outliers": _BASE + _box("SELECT price FROM l"),
        "category_domain": _on_listings(
            f"SELECT \"column\", value, row_number() OVER (PARTITION BY \"column\" ORDER BY value) - 1 AS code "
            f"FROM ({_categories(schemas.CATEGORY_COLUMNS, 'b')})"),
        "category_distinct": _on_listings(_union(
            f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"distinct\" FROM b" for c in schemas.CATEGORY_COLUMNS)),
        "profile_document_copies": duplicates.format("documents", "text, lang, source, n_chars"),
        "profile_event_columns": _column_info("SELECT * FROM events", events),
    }


def _checks() -> dict[str, str]:
    keys = _union(
        f"SELECT '{layer}.{table}' AS \"table\", '{key}' AS key, count(*) AS rows, CAST(0 AS BIGINT) AS nulls, "
        f"CAST(0 AS BIGINT) AS duplicates, CAST(1 AS BIGINT) AS min_key, count(*) AS max_key FROM {source}"
        for layer, table, key, source in _layer_rows())
    foreign = _union(
        f"""SELECT '{layer}.fato_veiculo.{d.key}' AS reference, count(*) AS rows, count(*) - count(f.{d.key}) AS nulls,
  count(DISTINCT CASE WHEN d.{d.key} IS NULL THEN f.{d.key} END) AS orphan_keys,
  count(CASE WHEN f.{d.key} IS NOT NULL AND d.{d.key} IS NULL THEN 1 END) AS orphan_rows
FROM ({_fact(spec)}) f LEFT JOIN ({_dimension(d)}) d ON f.{d.key} = d.{d.key}"""
        for layer, spec in (("silver", schemas.SILVER_FATO), ("dw", schemas.GOLD_FATO)) for d in spec.dimensions)
    orphans = _union(
        f"SELECT '{d.name}' AS dimension, count(CASE WHEN d.{d.key} IS NULL THEN 1 END) AS missing "
        f"FROM b LEFT JOIN ({_dimension(d)}) d ON "
        + " AND ".join(f"b.{c} IS NOT DISTINCT FROM d.{c}" for c in d.columns)
        for d in schemas.GOLD_FATO.dimensions)
    widths = _union(
        f"SELECT '{c}' AS \"column\", CAST({w} AS INT) AS max_width, CAST(max(length({c})) AS INT) AS longest, "
        f"count(CASE WHEN length({c}) > {w} THEN 1 END) AS too_long FROM b" for c, w in schemas.WIDTHS.items())
    everything = ", ".join(schemas.LISTING_COLUMNS)
    reconciled = _union(
        f"SELECT '{t}' AS \"table\", count(*) AS rows, count(*) AS expected_rows, true AS matches FROM b"
        for t in ("bronze.vehicle_prices", "silver.veiculo", "silver.fato_veiculo", "dw.fato_veiculo"))
    return {
        "check_keys": _on_listings(keys),
        "check_foreign_keys": _on_listings(foreign),
        "check_orphans": _on_listings(orphans),
        "check_references": _union(_reference_check(*r) for r in REFERENCES),
        "check_unused_keys": "SELECT c_custkey, count(*) AS rows FROM customer "
                             "WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) GROUP BY 1",
        "profile_of_two_loads": _on_listings(_union(
            [f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls, min(CAST({c} AS DOUBLE)) AS min, "
             f"max(CAST({c} AS DOUBLE)) AS max, TRUE AS quantiles_near, TRUE AS distinct_near FROM l" for c in schemas.PROFILE_NUMBERS]
            + [f"SELECT '{c}', count(*), count(*) - count({c}), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), TRUE, TRUE FROM l"
               for c in schemas.CATEGORY_COLUMNS])),
        "check_missing_keys": _on_listings(_union(
            f"SELECT '{dimension}' AS dimension, count(*) FILTER (WHERE {lost}) AS missing FROM b"
            for dimension, lost in (("dim_modelo", "make = 'Brand#1'"), ("dim_condicao", "condition = 'Fair'"), ("dim_cor", "FALSE")))),
        "check_orphan_customers": "SELECT o_custkey, count(*) AS rows FROM orders WHERE o_custkey NOT IN "
                                  "(SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY 1",
        "check_duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem "
                                "GROUP BY 1, 2 HAVING count(*) > 1",
        "check_types": _on_listings(_union(
            _lossy(c) for c in [*schemas.INTEGER_COLUMNS, "mileage_per_year", "price"])),
        "check_widths": _on_listings(widths),
        "reconcile_layers": _on_listings(reconciled),
        "star_roundtrip_diff": _on_listings(_union(
            f"SELECT '{layer}' AS star, count(*) AS differing_rows FROM "
            f"(SELECT * FROM b EXCEPT ALL SELECT {everything} FROM {_rejoined(spec)})"
            for layer, spec in (("silver", schemas.SILVER_FATO), ("dw", schemas.GOLD_FATO)))),
        "star_wide_silver": _on_listings("SELECT * FROM b"),
        "star_wide_gold": _on_listings("SELECT * FROM b"),
    }


def oracle_sql() -> dict[str, str]:
    return _sources() | _marts() | _charts() | _profiles() | _checks()
