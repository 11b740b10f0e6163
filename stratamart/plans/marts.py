"""The analytical queries over the silver star.

`fato`, `modelo` and `espec` are the silver fact and dimensions. Dimensions can be as large as the
fact, so none is broadcast unless Spark finds it small: grouped queries aggregate per key before
the join (`sum_through`), row queries spread frequent keys (`skew_join`). Averages are rounded before they are ordered. Every top-k is
ordered by all its output columns, so ties cannot change the answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratamart.functions.columns import price_band, ratio, round_money, short_label, vehicle_name
from stratamart.operators import distributions, pivots, quantiles
from stratamart.operators.skew import skew_join, sum_through
from stratamart.sources.lake import run_sql
from stratamart.staging import materialize

# The range and the bands of the price that the queries are asked with.
PRICE_RANGE = (20000, 500000)
BANDS = ("Barato", "Caro", "Médio")


def _top(df: DataFrame, n: int, largest: str, *ties: str) -> DataFrame:
    """The `n` rows with the largest value; `ties`, then all other columns, decide between equals."""
    named = (largest, *ties)
    return df.orderBy(F.desc(largest), *ties, *[c for c in df.columns if c not in named]).limit(n)


def best_per_key(fact: DataFrame, key: str, measure: str, n: int) -> DataFrame:
    """The `n` rows of largest measure of every key (nulls last), so that joining, ordering and limiting to `n` may follow.

    Rows of one key meet the same dimension row or none, so no other row can be among the first `n` after
    the join, whatever keys are missing there. Spark cuts to `n` per key before the shuffle, which splits hot keys.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc_nulls_last(measure)))
    return fact.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


# --- counts and global statistics -------------------------------------------------------------

def price_stats(fato: DataFrame) -> DataFrame:
    return fato.agg(
        round_money(F.avg("price")).alias("preco_medio"),
        round_money(F.min("price")).alias("preco_minimo"),
        round_money(F.max("price")).alias("preco_maximo"),
    )


def top_makes(fato: DataFrame, modelo: DataFrame, key: str = "id_modelo", n: int = 5) -> DataFrame:
    counts = sum_through(fato, modelo, key, ["make"], {"total": F.lit(1)})
    return _top(counts, n, "total", "make")


# --- filtered top-k ---------------------------------------------------------------------------

def price_between(fato: DataFrame, modelo: DataFrame, low: float = PRICE_RANGE[0], high: float = PRICE_RANGE[1],
                  n: int = 10) -> DataFrame:
    rows = fato.where(F.col("price").between(low, high)).select("id_modelo", "price")
    listed = best_per_key(rows, "id_modelo", "price", n).join(modelo, "id_modelo").select("make", "model", "price")
    return _top(listed, n, "price", "make", "model")


def most_expensive(fato: DataFrame, modelo: DataFrame, n: int = 10) -> DataFrame:
    listed = best_per_key(fato.select("id_modelo", "price"), "id_modelo", "price", n).join(modelo, "id_modelo")
    return _top(listed.select("body_type", "make", "model", "price"), n, "price", "body_type", "make", "model")


def make_in(fato: DataFrame, modelo: DataFrame, makes: Sequence[str] = ("Toyota", "Honda", "Ford"),
            n: int = 10) -> DataFrame:
    rows = rows_of_makes(fato, modelo, makes)
    return _top(rows.select("make", "model", "price"), n, "price", "make", "model")


def rows_of_makes(fato: DataFrame, modelo: DataFrame, makes: Sequence[str]) -> DataFrame:
    wanted = modelo.where(F.col("make").isin(*makes)).select("id_modelo", "make", "model")
    return skew_join(fato.select("id_modelo", "price"), wanted, ["id_modelo"])


def rows_of_model_prefix(fato: DataFrame, modelo: DataFrame, prefix: str) -> DataFrame:
    wanted = modelo.where(F.col("model").startswith(prefix)).select("id_modelo", "make", "model", "year")
    return skew_join(fato.select("id_modelo", "price", "mileage"), wanted, ["id_modelo"])


def model_prefix(fato: DataFrame, modelo: DataFrame, prefix: str = "Civic", n: int = 10) -> DataFrame:
    rows = rows_of_model_prefix(fato, modelo, prefix).select("make", "model", "price")
    return _top(rows, n, "price", "make", "model")


def accident_class(fato: DataFrame, modelo: DataFrame, espec: DataFrame, value: str = "maior",
                   n: int = 10) -> DataFrame:
    classed = espec.where(F.col("accident_history") == value).select("id_especificacao", "accident_history")
    rows = skew_join(fato.select("id_especificacao", "id_modelo", "price"), classed, ["id_especificacao"])
    best = best_per_key(rows.select("id_modelo", "price", "accident_history"), "id_modelo", "price", n)
    listed = best.join(modelo, "id_modelo").select("make", "model", "price", "accident_history")
    return _top(listed, n, "price", "make", "model")


def best_value(fato: DataFrame, modelo: DataFrame, min_year: int = 2018, max_mileage: int = 80000,
               max_price: float | None = None, n: int = 20) -> DataFrame:
    """Cheap, little driven, recent. Without `max_price` the average over the whole fact is the limit."""
    limit = fato.agg(F.avg("price")).scalar() if max_price is None else F.lit(max_price)
    cheap = fato.where((F.col("price") < limit) & (F.col("mileage") < max_mileage))
    recent = modelo.where(F.col("year") >= min_year).select("id_modelo", "make", "model", "year")
    listed = skew_join(cheap.select("id_modelo", "mileage", "price"), recent, ["id_modelo"]).select(
        vehicle_name(F.col("make"), F.col("model")).alias("veiculo"), "year",
        F.col("mileage").alias("km"), "price")
    chosen = listed.orderBy("price", "veiculo", "year", "km").limit(n)
    return chosen.select("veiculo", "year", "km", round_money(F.col("price")).alias("preco")).orderBy(
        "preco", "veiculo", "year", "km")


# --- grouped statistics -----------------------------------------------------------------------

def fuel_share(fato: DataFrame, modelo: DataFrame) -> DataFrame:
    counts = sum_through(fato, modelo, "id_modelo", ["fuel_type"], {"total": F.lit(1)})
    whole = fato.agg(F.count("*")).scalar()
    share = round_money(ratio(F.col("total"), whole) * 100, 1)
    return counts.withColumn("share", share).orderBy(F.desc("total"), "fuel_type")


def _price_sums() -> dict[str, Column]:
    """What the count and the average of the price are made of."""
    return {"quantidade": F.lit(1), "_sum": F.col("price"), "_present": F.when(F.col("price").isNotNull(), 1)}


def _average() -> Column:
    return round_money(ratio(F.col("_sum"), F.col("_present"))).alias("preco_medio")


def average_price_by_make(rows: DataFrame, n: int | None = 10) -> DataFrame:
    """Average price per make of flat rows, dearest first; all makes when `n` is None."""
    averages = rows.groupBy("make").agg(round_money(F.avg("price")).alias("preco_medio"))
    return _top(averages, n, "preco_medio", "make") if n else averages


def avg_price_by_make(fato: DataFrame, modelo: DataFrame, n: int = 10) -> DataFrame:
    sums = sum_through(fato, modelo, "id_modelo", ["make"], _price_sums())
    return _top(sums.select("make", _average()), n, "preco_medio", "make")


def price_range_by_make(fato: DataFrame, modelo: DataFrame, n: int = 10) -> DataFrame:
    """Adds count, extremes, the distances of the extremes from the average, and the ratio to the top average."""
    sums = sum_through(fato, modelo, "id_modelo", ["make"], _price_sums(),
                       {"_low": F.col("price")}, {"_high": F.col("price")})
    stats = sums.select("make", _average(), "quantidade", round_money(F.col("_low")).alias("preco_min"),
                        round_money(F.col("_high")).alias("preco_max"))
    top = materialize(_top(stats, n, "preco_medio", "make"), "top_makes")
    return top.select(
        "*",
        round_money(F.col("preco_medio") - F.col("preco_min")).alias("erro_abaixo"),
        round_money(F.col("preco_max") - F.col("preco_medio")).alias("erro_acima"),
        F.round(ratio(F.col("preco_medio"), top.agg(F.max("preco_medio")).scalar()), 6).alias("razao_maximo"),
    ).orderBy("preco_medio", "make")


def price_and_count_by_make(fato: DataFrame, modelo: DataFrame, n: int = 10) -> DataFrame:
    sums = sum_through(fato, modelo, "id_modelo", ["make"], _price_sums())
    stats = sums.select(F.col("make").alias("marca"), _average(), "quantidade")
    return _top(stats, n, "preco_medio", "marca")


def _by_accident(fato: DataFrame, espec: DataFrame) -> DataFrame:
    sums = sum_through(fato, espec, "id_especificacao", ["accident_history"], _price_sums())
    return sums.select("accident_history", "quantidade", _average())


def accident_counts(fato: DataFrame, espec: DataFrame) -> DataFrame:
    return _by_accident(fato, espec).orderBy(F.desc("quantidade"), "accident_history")


def accident_prices(fato: DataFrame, espec: DataFrame) -> DataFrame:
    rows = _by_accident(fato, espec).select(
        F.col("accident_history").alias("historico"), "preco_medio", "quantidade")
    return rows.orderBy(F.desc("preco_medio"), "historico")


def _bands(fato: DataFrame, espec: DataFrame) -> DataFrame:
    """Per accident class, one count per price band."""
    band = price_band(F.col("price"))
    return sum_through(fato, espec, "id_especificacao", ["accident_history"],
                       {b: F.when(band == b, 1).otherwise(0) for b in BANDS})


def accident_by_band(fato: DataFrame, espec: DataFrame) -> DataFrame:
    long = _bands(fato, espec).unpivot("accident_history", list(BANDS), "faixa_preco", "total")
    return long.where(F.col("total") > 0).orderBy("accident_history", "faixa_preco")


def make_model_year(fato: DataFrame, modelo: DataFrame, min_year: int = 2020, n: int = 20) -> DataFrame:
    recent = modelo.where(F.col("year") >= min_year)
    sums = sum_through(fato, recent, "id_modelo", ["make", "model", "year"], _price_sums())
    return run_sql(
        fato.sparkSession,
        """
        SELECT make AS marca, model AS modelo, year AS ano,
               CAST(round(CAST(_sum / _present AS DECIMAL(28, 6)), 2) AS DOUBLE) AS preco_medio, quantidade
        FROM {sums}
        ORDER BY preco_medio DESC, marca, modelo, ano
        LIMIT {n}
        """, sums=sums, n=n)


# --- cross-tabs -------------------------------------------------------------------------------

def band_pivot(fato: DataFrame, espec: DataFrame) -> DataFrame:
    return pivots.cross_tab(accident_by_band(fato, espec), "accident_history", "faixa_preco", "total", BANDS)


def band_pivot_transposed(fato: DataFrame, espec: DataFrame) -> DataFrame:
    counts = materialize(accident_by_band(fato, espec), "accident_by_band")
    return pivots.cross_tab(counts, "faixa_preco", "accident_history", "total")


def band_row_share(fato: DataFrame, espec: DataFrame) -> DataFrame:
    shares = pivots.row_percentages(band_pivot(fato, espec), "accident_history")
    return shares.select("accident_history", *[F.round(c, 6).alias(c) for c in BANDS])


# --- data behind the charts -------------------------------------------------------------------

def in_range(fato: DataFrame, low: float = PRICE_RANGE[0], high: float = PRICE_RANGE[1]) -> DataFrame:
    return fato.where(F.col("price").between(low, high))


def price_summary(rows: DataFrame) -> DataFrame:
    """Mean and median of the price."""
    return quantiles.mean_median(rows, "price")


def box_of_top_makes(fato: DataFrame, modelo: DataFrame, n: int = 10) -> DataFrame:
    """Box statistics, within the price range, of the `n` makes with most rows there; rows without a make do not rank.

    The star is joined once, for the copies per make and price; ranking and boxes work on those.
    """
    named = modelo.where(F.col("make").isNotNull()).select("id_modelo", "make")
    rows = skew_join(in_range(fato).select("id_modelo", "price"), named, ["id_modelo"])
    counts = quantiles.value_counts_sorted(rows, "price", ["make"])
    totals = counts.groupBy("make").agg(F.sum("_n").alias("total"))
    top = materialize(_top(totals, n, "total", "make").select("make"), "top_makes")
    return distributions.box_stats_of_counts(counts.join(top, "make", "left_semi"), "price", ["make"])


def box_of_makes(fato: DataFrame, modelo: DataFrame, makes: Sequence[str]) -> DataFrame:
    return distributions.box_stats(rows_of_makes(fato, modelo, makes), "price", ["make"])


def density_of_makes(fato: DataFrame, modelo: DataFrame, makes: Sequence[str]) -> DataFrame:
    """One curve per make, drawn two bandwidths beyond the data as violins are."""
    rows = materialize(rows_of_makes(fato, modelo, makes).select("make", "price"), "priced_rows")
    return distributions.density(rows, "price", ["make"], points=100, cut=2)


def histogram_of_prefix(fato: DataFrame, modelo: DataFrame, prefix: str, bins: int = 15) -> DataFrame:
    rows = materialize(rows_of_model_prefix(fato, modelo, prefix).select("price"), "priced_rows")
    return distributions.histogram(rows, "price", bins)


def scatter_of_prefix(fato: DataFrame, modelo: DataFrame, prefix: str) -> DataFrame:
    """Price against year, coloured by mileage."""
    rows = rows_of_model_prefix(fato, modelo, prefix).select("year", "price", "mileage")
    return distributions.scatter_bins(materialize(rows, "priced_rows"), "year", "price", 10, 20, "mileage")


def best_value_scatter(chosen: DataFrame) -> DataFrame:
    """The chosen rows as points, with their price relative to the dearest of them."""
    stored = materialize(chosen, "best_value")
    top = stored.agg(F.max("preco")).scalar()
    return stored.withColumn("razao_maximo", F.round(ratio(F.col("preco"), top), 6))


def best_value_labels(chosen: DataFrame, n: int = 10) -> DataFrame:
    """The `n` cheapest of the chosen rows with their axis label."""
    best = materialize(chosen.orderBy("preco", "veiculo", "year", "km").limit(n), "best_value")
    top = best.agg(F.max("preco")).scalar()
    return best.select(
        short_label(F.col("veiculo")).alias("rotulo"), "preco", "km", "year",
        F.round(ratio(F.col("preco"), top), 6).alias("razao_maximo"))


def best_value_histogram(chosen: DataFrame, bins: int = 10) -> DataFrame:
    return distributions.histogram(materialize(chosen, "best_value"), "preco", bins)
