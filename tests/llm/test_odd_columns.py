"""Columns of any name go through the operators, or are ignored by them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.llm import extraction, forest, host_rules, mixing, neighbours, packing, phrases, quality, ranked, records, repeats, simhash
from stratamart.llm.queries import byte_encoding, word_encoding

ODD = ["a.b", "_doc", "_source", "_slice", "_turn", "_hash", "_size", "_query", "_carried", "c0", "before", "others", "`x`", "lang"]
TEXT = "words that make a text " * 12


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"{TEXT}{i}", f"s{i % 2}", *range(len(ODD))) for i in range(6)]
    kinds = ", ".join(f"`{c.replace('`', '``')}` int" for c in ODD)
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, {kinds}")


def carried(df, names=ODD):
    return {tuple(r) for r in df.select(*[F.col(f"`{c.replace('`', '``')}`") for c in names]).collect()}


CARRIES = {
    "score": lambda d: quality.score(d, quality.Model(np.zeros(256), 0.0, 1.0, 0.0, 0.0)),
    "without_passages": repeats.without_passages,
    "mix": lambda d: mixing.mix(d, mixing.words("text")),
    "extract": lambda d: extraction.extract(d.withColumnRenamed("text", "html")),
    "pack": lambda d: packing.pack(packing.pieces(d, word_encoding()).crossJoin(d.drop("doc_id", "text", "source").limit(1))),
}


@pytest.mark.parametrize("name", CARRIES)
def test_odd_columns_are_carried(docs, name):
    found = CARRIES[name](docs)
    names = [c for c in ODD if c != "before" or name != "mix"]
    assert carried(found, names) == {tuple(ODD.index(c) for c in names)} and found.count() == 6


IGNORES = {
    "simhash": lambda d: simhash.near_duplicates(d, 4, 4),
    "records": lambda d: records.read(records.write(d, byte_encoding())),
    "hosts": lambda d: host_rules.judge(d, F.col("source")),
    "ranked": lambda d: ranked.search(d, d.select(F.col("doc_id").alias("item_id"), "text", "`a.b`", "_query"), 6).where("item_id = 1"),
    "vectors": lambda d: neighbours.near_duplicates(d.select(F.col("doc_id").alias("vec_id"), F.array(F.lit(1.0), F.col("doc_id").cast("double")).alias("embedding"), "`a.b`", "_slice"), 0.95),
    "forest": lambda d: forest.search(*[d.select(F.col("doc_id").alias("vec_id"), F.array(F.lit(1.0), F.col("doc_id").cast("double")).alias("embedding"), "`a.b`", "_slice")] * 2, 20).where("rank = 1"),
}


@pytest.mark.parametrize("name", IGNORES)
def test_odd_columns_are_ignored(docs, name):
    assert IGNORES[name](docs).count() == 6


def test_phrases_ignore_odd_columns(docs):
    assert phrases.mine(docs.drop("lang").withColumn("lang", F.lit("x")), 6).count() > 0
