"""Ranked lexical search: posting lists with range-maximum tables, best intervals of documents first.

Documents are matched against the terms of the queries, and each task searches the documents it reads. A posting
list holds a term's documents in ascending order with the impact of the term on each, and a sparse table that gives
the largest impact between any two of its places. What the terms of a query can add up to within an interval of
documents is bounded by the sum of these maxima. The intervals of the largest bounds are opened first: the
document of the largest single impact is scored and the interval splits there, until no bound can reach the best `k`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stratamart.llm.common import add_running, id_of, key_of
from stratamart.llm.textbytes import byte_set, chunks, encoded, lowered, row_of, runs
from stratamart.operators.keys import dense_key
from stratamart.staging import materialize

_TERM_BYTES = ~byte_set(range(0x00, 0x30), range(0x3A, 0x41), range(0x5B, 0x61), range(0x7B, 0x80))
_LOWERED = lowered()

#: Terms of the queries that are searched together, counted per query: what the driver holds and ships at once. A
#: further block of queries is a further pass over the documents.
BLOCK_TERMS = 200_000
#: Documents and postings indexed together in a task. Memory only.
SHARD_DOCS, SHARD_POSTINGS = 1 << 14, 1 << 21
#: Intervals opened together.
STEP = 128

SCALE, FREQUENCY, LENGTH = 1_000_000_000, 1000, 12


def _terms(rows: pa.RecordBatch, raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and number of every term, and the terms that the numbers stand for."""
    begins, ends = runs(_TERM_BYTES[raw], edges)
    codes, found = encoded(_LOWERED[raw], begins, ends)
    return row_of(begins, edges), codes, found


def _counted(rows: np.ndarray, codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of row and code, ascending, and how often each occurs."""
    pairs, counts = np.unique(rows * width + codes, return_counts=True)
    return pairs // width, pairs % width, counts


def query_terms(queries: DataFrame, query_id: str = "item_id") -> DataFrame:
    """`_query` (a number per row), the id, `term` and `times` of every distinct term of each query, and its `block`."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, edges in chunks(batches):
            rows, codes, found = _terms(batch, raw, edges)
            at, code, counts = _counted(rows, codes, max(len(found), 1))
            terms = found.take(pa.array(code)).cast(pa.large_string()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), terms, pa.array(counts.astype(np.int64))],
                                             ["_query", "_id", "term", "times"])

    numbered = dense_key(queries.select(F.col(query_id).cast("long").alias("_id"), F.col("text").cast("string").alias("text")), "_query")
    terms = materialize(numbered.mapInArrow(split, "_query long, _id long, term string, times long"), "query_terms")
    sizes = terms.groupBy("_query").agg(F.count("*").alias("_size")).withColumn("_all", F.lit(0))
    before = add_running(sizes, ["_all"], ["_query"], "_size", ["_query"], 64)
    return terms.join(before.select("_query", F.floor(F.col("before") / BLOCK_TERMS).alias("block")), "_query")


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Per document: `_doc` (see `key_of`), `n` terms in all, and the numbers and frequencies of those in the vocabulary."""
    wanted = pa.array([t.encode() for t in vocabulary], pa.large_binary())

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, edges in chunks(batches):
            rows, codes, found = _terms(batch, raw, edges)
            number = pc.fill_null(pc.index_in(found, wanted), -1).to_numpy().astype(np.int64)[codes]
            hit = number >= 0
            at, term, counts = _counted(rows[hit], number[hit], max(len(wanted), 1))
            offsets = pa.array(np.searchsorted(at, np.arange(batch.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.bincount(rows, minlength=batch.num_rows).astype(np.int64)),
                 pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int64)))],
                ["_doc", "n", "terms", "times"])

    read = docs.select(key_of("doc_id").alias("_doc"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(match, "_doc long, n long, terms array<int>, times array<long>")


class Shard:
    """Posting lists of some documents, each with the places of the largest impacts between any two of its places."""

    def __init__(self, docs: np.ndarray, lists: np.ndarray, terms: np.ndarray, impacts: np.ndarray) -> None:
        """`docs` ascending; a posting is a place in `docs`, a term and an impact."""
        order = np.lexsort((lists, terms))
        self.docs, self.width = docs, len(docs) + 1
        self.doc, self.impact = lists[order], impacts[order]
        self.key = terms[order] * self.width + self.doc
        self.best = [np.arange(len(order), dtype=np.int32)]
        longest = int(np.bincount(terms).max()) if len(terms) else 0
        # Ranges never leave a list, so the tables of all lists lie in one array per level.
        for level in range(1, max(longest, 1).bit_length()):
            last, half = self.best[-1], 1 << (level - 1)
            if len(last) <= half:
                break
            a, b = last[:-half], last[half:]
            self.best.append(np.where(self.impact[a] >= self.impact[b], a, b))

    def places(self, terms: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """For each document and term, the first place in the term's list that is not before the document."""
        return np.searchsorted(self.key, terms[None, :] * self.width + doc[:, None])

    def largest(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place and the impact of the largest impact in each range of a list; impact 0 in an empty one."""
        size = end - begin
        place = np.zeros(size.shape, dtype=np.int32)
        levels = np.frexp(np.maximum(size, 1).astype(np.float64))[1] - 1
        for level in np.unique(levels[size > 0]):
            at = (levels == level) & (size > 0)
            table = self.best[level]
            a, b = table[begin[at]], table[end[at] - (1 << int(level))]
            place[at] = np.where(self.impact[a] >= self.impact[b], a, b)
        return place, np.where(size > 0, self.impact[place] if len(self.impact) else 0, 0)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, scores: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best `k` of the given results (best first) and this shard's documents, by score, then ascending id."""
        if not len(terms) or not len(self.key):
            return scores, docs

        def opened(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Per interval: the bound of its scores, and the document of its largest impact."""
            place, impact = self.largest(begin, end)
            adds = impact * weights
            return adds.sum(axis=1), self.doc[place[np.arange(len(adds)), adds.argmax(axis=1)]]

        low = np.array([0], dtype=np.int64)
        begin, end = self.places(terms, low), self.places(terms, low + len(self.docs))
        bound, split = opened(begin, end)
        while True:
            # Documents of an interval come after its first one: with an equal score they may still have smaller ids.
            if len(scores) == k:
                open_ = (bound > scores[-1]) | ((bound == scores[-1]) & (self.docs[np.minimum(low, len(self.docs) - 1)] < docs[-1]))
                low, begin, end, bound, split = low[open_], begin[open_], end[open_], bound[open_], split[open_]
            if not len(low):
                return scores, docs
            rest = np.zeros(len(low), dtype=bool)
            if len(low) > STEP:
                rest[np.argpartition(-bound, STEP)[STEP:]] = True
            first, at = begin[~rest], split[~rest]
            here = self.places(terms, at)
            held = (here < end[~rest]) & (self.doc[np.minimum(here, len(self.doc) - 1)] == at[:, None])
            after = here + held
            found = (np.where(held, self.impact[np.minimum(here, len(self.doc) - 1)], 0) * weights).sum(axis=1)
            scores, docs = merged(np.concatenate((scores, found)), np.concatenate((docs, self.docs[at])), k)
            begins, ends = np.concatenate((first, after)), np.concatenate((here, end[~rest]))
            lows = np.concatenate((low[~rest], at + 1))
            bounds, splits = opened(begins, ends)
            some = bounds > 0
            low, begin, end = np.concatenate((low[rest], lows[some])), np.concatenate((begin[rest], begins[some])), np.concatenate((end[rest], ends[some]))
            bound, split = np.concatenate((bound[rest], bounds[some])), np.concatenate((split[rest], splits[some]))


def merged(scores: np.ndarray, docs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((docs, -scores))[:k]
    order = order[scores[order] > 0]
    return scores[order], docs[order]


@dataclass(frozen=True)
class Query:
    """A query's number, id, terms (ascending numbers) and their weights times how often it holds them."""

    number: int
    query_id: int | None
    terms: np.ndarray
    weights: np.ndarray


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    """Shards of the rows (`_doc`, `m`, `terms`, `times`) as they come, of bounded size."""
    held: list[pa.RecordBatch] = []
    docs = found = 0

    def build() -> Shard:
        table = pa.Table.from_batches(held).combine_chunks().sort_by("_doc")
        lists = table.column("terms").combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy()
        place = np.repeat(np.arange(table.num_rows), sizes)
        times = table.column("times").combine_chunks().flatten().to_numpy()
        m = table.column("m").to_numpy()
        impact = SCALE * times // (FREQUENCY * times + LENGTH * m[place])
        return Shard(table.column("_doc").to_numpy(), place, lists.flatten().to_numpy().astype(np.int64), impact)

    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            held.append(part)
            docs += part.num_rows
            found += len(part.column("terms").flatten())
            if docs >= SHARD_DOCS or found >= SHARD_POSTINGS:
                yield build()
                held, docs, found = [], 0, 0
    if held:
        yield build()


def _block(spark: SparkSession, terms: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """`_query`, `_id`, `_doc`, `score`: the best of every task for the queries of one block."""
    rows = terms.select("_query", "_id", "term", "times").collect()  # at most BLOCK_TERMS, or one query
    vocabulary = sorted({r["term"] for r in rows})
    number = {t: i for i, t in enumerate(vocabulary)}
    matched = materialize(postings(docs, vocabulary), "postings")
    total = matched.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    holding = {r["term"]: r["count"] for r in matched.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    weight = np.zeros(len(vocabulary), dtype=np.int64)
    for term, df in holding.items():
        weight[term] = math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * df + 1)))
    wanted: dict[int, tuple[int | None, list[tuple[int, int]]]] = {}
    for r in rows:
        wanted.setdefault(r["_query"], (r["_id"], []))[1].append((number[r["term"]], r["times"]))
    queries = []
    for query, (query_id, pairs) in sorted(wanted.items()):
        terms_, times = (np.array(a, dtype=np.int64) for a in zip(*sorted(pairs)))
        useful = weight[terms_] > 0
        queries.append(Query(query, query_id, terms_[useful], (weight[terms_] * times)[useful]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(0, dtype=np.int64)
        best = [(empty, empty)] * len(queries)
        for shard in _shards(batches):
            best = [shard.search(q.terms, q.weights, k, *found) for q, found in zip(queries, best)]
        sizes = [len(scores) for scores, _ in best]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([q.number for q in queries], sizes), pa.int64()),
                 pa.array([q.query_id for q, size in zip(queries, sizes) for _ in range(size)], pa.int64()),
                 pa.array(np.concatenate([docs for _, docs in best])), pa.array(np.concatenate([scores for scores, _ in best]))],
                ["_query", "_id", "_doc", "score"])

    # The length part of an impact needs the totals; wide decimals, as its product may pass 64 bits.
    length = F.expr(f"cast(75 + (cast(25 * n as decimal(20,0)) * cast({total['docs']} as decimal(18,0))) div {max(total['terms'], 1)} as bigint)")
    ready = matched.where("size(terms) > 0").select("_doc", length.alias("m"), "terms", "times")
    return ready.mapInArrow(search, "_query long, _id long, _doc long, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = 20, query_id: str = "item_id") -> DataFrame:
    """Per query its `k` documents of the largest scores above 0 (all, if fewer): the query's id, `rank` (from 1), `doc_id`, `score`.

    Terms are runs of ASCII letters, digits and all other characters beyond ASCII; only A-Z are lower-cased. N counts the
    documents with a term, L all terms of theirs, n those of one, df the documents holding a term, tf its occurrences.
    A term weighs floor(1000 ln((2 N + 2) / (2 df + 1))); with m = 75 + 25 n N div L a score sums weight times
    10^9 tf div (1000 tf + 12 m) over the terms of the query, repeats included. Exact: nothing is cut off.

    Equal scores come by ascending doc_id, a null one last; rows that repeat a doc_id are documents of their own,
    rows of queries that repeat an id are queries of their own. A null or empty text holds no term: such a query
    returns nothing, such a document is never found. Empty tables give no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    terms = materialize(query_terms(queries, query_id), "blocked_terms")
    blocks = [r["block"] for r in terms.select("block").distinct().orderBy("block").collect()]
    schema = "_query long, _id long, _doc long, score long"
    found = spark.createDataFrame([], schema)
    for block in blocks:
        best = _block(spark, terms.where(F.col("block") == block), docs, k)
        found = found.unionByName(best) if len(blocks) == 1 else found.unionByName(materialize(best, "found"))
    order = Window.partitionBy("_query").orderBy(F.desc("score"), "_doc")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("_id").alias(query_id), "rank", id_of("_doc").alias("doc_id"), "score")
