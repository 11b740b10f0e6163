"""Quality rules on texts, and verdicts on hosts whose documents break them too often.

Each document is checked by simple rules. Failures are counted per host, and a host's rate is shrunk
towards the rate of all hosts by a beta prior that is itself estimated from the hosts: a host of few documents is
not condemned by them, one of many is judged by its own. A host's verdict goes back to its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratamart.llm.common import join_salted, slice_count, text_key
from stratamart.llm.textbytes import byte_set, chunks, encoded, per_row, row_of, runs
from stratamart.operators.quality import union_all
from stratamart.staging import materialize

_SPACES = byte_set(0x20, range(0x09, 0x0E))
_SYMBOLS = byte_set(*b"#*$%&|<>")
_NEW_LINE = 0x0A

#: A document fails below so many words, or with more than this share of its words in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 0.5
#: A host fails if the shrunk rate of any rule's failures is above this.
MOST_FAILING = 0.5

_SIGNALS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: What a document fails by, as SQL conditions over its signals. The first two are those that reject it by itself.
RULES = {
    "short": f"n_words < {LEAST_WORDS}",
    "repeats": f"100 * n_repeat_words > {round(100 * MOST_REPEATED)} * n_words",
    "symbols": "10 * n_symbols > n_words",
    "word_length": "word_chars < 3 * n_words or word_chars > 10 * n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
}
BASE_RULES = ("short", "repeats")


def _repeated(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which words lie in a window of three that the same row holds twice or more."""
    covered = np.zeros(len(words), dtype=bool)
    if len(words) < 3:
        return covered
    starts = np.flatnonzero(rows[:-2] == rows[2:])
    window = [a[starts].astype(np.uint64) for a in (words, words[1:], words[2:], rows)]
    mixed = np.zeros(len(starts), dtype=np.uint64)
    for part in window:
        mixed = (mixed ^ part) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    alike = mixed[order][1:] == mixed[order][:-1]
    # Only windows whose hashes meet are compared themselves.
    some = order[np.concatenate((alike, [False])) | np.concatenate(([False], alike))]
    exact = np.lexsort([part[some] for part in window])
    some = some[exact]
    same = np.ones(max(len(some) - 1, 0), dtype=bool)
    for part in window:
        same &= part[some][1:] == part[some][:-1]
    twice = starts[some[np.concatenate((same, [False])) | np.concatenate(([False], same))]] if len(some) else some
    for step in range(3):
        covered[twice + step] = True
    return covered


def _measure(raw: np.ndarray, edges: np.ndarray) -> list[np.ndarray]:
    """The signals of the rows between the edges, in the order of `_SIGNALS`."""
    count = len(edges) - 1
    inside = ~_SPACES[raw]
    begins, ends = runs(inside, edges)
    rows = row_of(begins, edges)
    words, _ = encoded(raw, begins, ends)
    chars = per_row(inside & ((raw & 0xC0) != 0x80), edges)
    line_begins, line_ends = runs(raw != _NEW_LINE, edges)
    held = np.concatenate(([0], np.cumsum(inside, dtype=np.int64)))
    with_word = held[line_ends] > held[line_begins]
    line_begins, line_ends = line_begins[with_word], line_ends[with_word]
    lines, texts = encoded(raw, line_begins, line_ends)
    line_rows = row_of(line_begins, edges)
    n_lines = np.bincount(line_rows, minlength=count)
    distinct = np.unique(line_rows * max(len(texts), 1) + lines) // max(len(texts), 1)
    return [np.bincount(rows, minlength=count), chars, per_row(_SYMBOLS[raw], edges), n_lines,
            n_lines - np.bincount(distinct, minlength=count), np.bincount(rows[_repeated(rows, words)], minlength=count)]


def signals(docs: DataFrame, host: Column) -> DataFrame:
    """`doc_id`, `host` and, as longs, of every whole text: `n_words`, `word_chars`, `n_symbols`, `n_lines` (lines with a
    word), `n_dup_lines` (of them, those equal to an earlier one) and `n_repeat_words` (words in windows of three that
    the text holds twice or more).

    A null text has no words. A null doc_id or host is kept. Repeated rows are measured one by one. Other
    columns are ignored, so that none can clash.
    """
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, edges in chunks(batches):
            found = [pa.array(a.astype(np.int64)) for a in _measure(raw, edges)]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *found], ["doc_id", "host", *_SIGNALS])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), host.cast("string").alias("host"), F.col("text").cast("string").alias("text"))
    return read.mapInArrow(measure, "doc_id long, host string, " + ", ".join(f"{s} long" for s in _SIGNALS))


def host_rates(measured: DataFrame) -> DataFrame:
    """One row per host and rule: `host_key` (never null), `rule`, `docs`, `failed`, and the `rate` shrunk by the prior.

    The prior of a rule is a beta distribution with the mean of all documents and the strength that the spread of
    the hosts' rates tells (moments of the beta-binomial, hosts weighted by their documents). Hosts that differ no
    more than chance would make them get the common rate; so does a single host. Failures are counted per task before
    they are shuffled, so a hot host is one row of each.
    """
    counted = materialize(measured.groupBy(text_key("host").alias("host_key")).agg(
        F.count("*").alias("docs"), *[F.count_if(F.expr(test)).alias(rule) for rule, test in RULES.items()]), "hosts")
    rules = union_all([counted.select("host_key", F.lit(r).alias("rule"), "docs", F.col(r).alias("failed")) for r in RULES])
    docs, failed = F.col("docs"), F.col("failed")
    wide = lambda c: c.cast("decimal(38,0)")  # noqa: E731  sums of whole numbers do not depend on their order
    moments = rules.groupBy("rule").agg(
        F.count("*").cast("double").alias("_hosts"), F.sum(wide(docs)).cast("double").alias("_docs"), F.sum(wide(failed)).cast("double").alias("_failed"),
        F.sum(wide(docs * docs)).cast("double").alias("_squares"),
        F.sum((failed.cast("double") * failed / docs).cast("decimal(38,9)")).cast("double").alias("_spread"))
    mean = F.col("_failed") / F.col("_docs")
    free = F.col("_hosts") - 1
    room = F.col("_docs") - F.col("_squares") / F.col("_docs") - free
    chance = mean * (1 - mean)
    told = F.when((room > 0) & (chance > 0), ((F.col("_spread") - F.col("_failed") * mean) / chance - free) / room)
    # The correlation within a host: 0 is chance alone, near 1 hosts that fail always or never.
    prior = moments.select("rule", mean.alias("_mean"), F.least(F.coalesce(told, F.lit(0.0)), F.lit(1 - 1e-9)).alias("_alike"))
    strength = 1 / F.col("_alike") - 1
    shrunk = F.when(F.col("_alike") <= 0, F.col("_mean")).otherwise((failed + F.col("_mean") * strength) / (docs + strength))
    return rules.join(F.broadcast(prior), "rule").select("host_key", "rule", "docs", "failed", shrunk.alias("rate"))


def judge(docs: DataFrame, host: Column, most_failing: float = MOST_FAILING) -> DataFrame:
    """The columns of `signals` with `base_failed`, `host_failed` and `kept`.

    `base_failed` says that the document is too short or repeats itself. `host_failed` says that the shrunk rate of
    failures of some rule is above `most_failing` for its host. A document is kept if neither holds. Documents
    without a host share one. An empty table gives no rows.

    The texts are read once; verdicts meet the measured rows, those of a hot host spread over as many keys as
    there are rows for.
    """
    measured = materialize(signals(docs, host), "signals")
    rates = host_rates(measured)
    verdicts = materialize(rates.groupBy("host_key").agg(F.max(F.col("rate") > most_failing).alias("host_failed"), F.first("docs").alias("docs")), "verdicts")
    rows = verdicts.agg(F.sum("docs")).first()[0] or 0
    base = F.expr(" or ".join(f"({RULES[r]})" for r in BASE_RULES))
    joined = join_salted(measured.withColumn("host_key", text_key("host")), "host_key", "doc_id", verdicts.drop("docs"), slice_count(rows))
    return joined.select("doc_id", "host", *_SIGNALS, base.alias("base_failed"), "host_failed",
                         (~(base | F.col("host_failed"))).alias("kept"))
