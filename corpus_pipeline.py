"""A training corpus from raw documents: quality filter, near-duplicates, repeated passages, mixing, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratamart.llm import mixing, packing, quality, queries, repeats, simhash
from stratamart.sources.listings import read_table
from stratamart.staging import shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: The stages' decisions need a classifier fold, an order of fingerprints and token ids: no SQL says them.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.score(docs.select(*COLUMNS), queries.quality_model(spark, sf_dir)).where("predicted = 1").select(*COLUMNS)


def near_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates.

    Rows that repeat the smallest id all stay, since nothing tells them apart; documents without an id have
    none to be chosen by and stay if their group holds no other.
    """
    found = simhash.near_duplicates(docs, queries.SIMHASH_SHINGLE, queries.SIMHASH_BITS)
    chosen = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    return docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["doc_id"]), "left_semi").select(*COLUMNS)


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document holds; bytes left of a cut character go too."""
    return repeats.without_passages(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    taken = mixing.mix(docs.select(*COLUMNS), mixing.words("text"))
    copies = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    return taken.where(copies > 0).select(*COLUMNS, F.explode(F.sequence(F.lit(1), copies)).alias("_copy")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their place in the packed sequences."""
    return packing.pack(packing.pieces(docs, queries.word_encoding()))


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", near_distinct),
    ("suffix-array dedup", without_passages),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
