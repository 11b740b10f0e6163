"""Quality classifier: naive Bayes support vectors over hashed byte n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import ddl, give_back, map_batches, quoted
from stratamart.staging import materialize

#: Hash space of the n-gram indicators, a power of two.
FEATURES = 1 << 16
#: Lengths of the byte n-grams.
LENGTHS = (1, 2, 3, 4)
#: Labelled rows the support vectors are fitted on at most; the log-count ratios count all of them.
FIT_ROWS = 5_000
#: Distinct n-grams of all these rows at most, by which the task that fits is bounded in bytes (12 each).
FIT_GRAMS = 25_000_000
#: Added to every count; cost of a margin violation; passes of the dual coordinate descent.
SMOOTHING, COST, PASSES = 1.0, 0.1, 12
#: Distinct n-grams at which a text's own evidence and the labels' prior count alike (about 400 characters).
HALF = 800

_CHUNK = 1 << 20
_FACTOR = np.uint32(0x9E3779B1)


def features(text: str | None, width: int = FEATURES) -> np.ndarray:
    """The distinct hashed n-grams of a whole text, as sorted numbers below `width`. A null or empty text has none.

    A rolling hash of each length is taken over all bytes at once; long texts go in chunks that overlap.
    """
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    shift = np.uint32(32 - int(math.log2(width)))
    seen = np.zeros(width, dtype=bool)
    for first in range(0, len(data), _CHUNK):
        part = data[first:first + _CHUNK + max(LENGTHS) - 1].astype(np.uint32) + np.uint32(1)
        rolled = part
        for n in range(1, max(LENGTHS) + 1):
            if n > 1:
                rolled = rolled[:-1] * np.uint32(257) + part[n - 1:]
            if not len(rolled):
                break
            if n in LENGTHS:
                seen[((rolled + np.uint32(n << 28)) * _FACTOR) >> shift] = True
    return np.flatnonzero(seen).astype(np.int32)


def sureness(n_grams):
    """How much a text tells, 0 to 1. The fitted bias holds for texts that tell enough; it fades out with this."""
    return n_grams / (n_grams + HALF)


@dataclass(frozen=True)
class Model:
    """Weights per feature (log-count ratios times support vector weights), a bias, the scale of the sigmoid and the
    log odds of the labels, which a text without n-grams gets."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    prior: float

    def score(self, text: str | None) -> float:
        at = features(text, len(self.weights))
        sure = sureness(len(at))
        margin = float(self.weights[at].sum()) / math.sqrt(max(len(at), 1)) + self.bias * sure
        z = max(-500.0, min(500.0, self.slope * margin + self.shift * sure + self.prior * (1 - sure)))
        return 1.0 / (1.0 + math.exp(-z))


def log_count_ratios(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    p, q = good + SMOOTHING, bad + SMOOTHING
    return np.log((p / p.sum()) / (q / q.sum()))


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, width: int) -> np.ndarray:
    """Hinge-loss linear weights by dual coordinate descent; row i has `values[i]` at `rows[i]`, the last feature is the bias."""
    w = np.zeros(width)
    alpha = np.zeros(len(rows))
    # Each class weighs the same in all.
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    most = COST * 0.5 / np.maximum(share, 1e-9)
    norms = np.array([v @ v for v in values])
    random = np.random.default_rng(7)
    for _ in range(PASSES):
        largest = 0.0
        for i in random.permutation(len(rows)):
            if norms[i] == 0:
                continue
            gradient = y[i] * (w[rows[i]] @ values[i]) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), most[i])
            if new != alpha[i]:
                w[rows[i]] += (new - alpha[i]) * y[i] * values[i]
                largest = max(largest, abs(new - alpha[i]) / most[i])
                alpha[i] = new
        if largest < 1e-3:
            break
    return w


def _fitted(at: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, prior: float) -> Model:
    """The model of the rows that hold the features `at`."""
    width = len(ratios)
    sure = sureness(np.array([len(a) for a in at], dtype=float))
    rows = [np.append(a, np.int32(width)) for a in at]
    values = [np.append(ratios[a] / math.sqrt(max(len(a), 1)), s) for a, s in zip(at, sure)]
    w = dual_descent(rows, values, y, width + 1)
    margins = np.array([w[a] @ v for a, v in zip(rows, values)])
    return Model(ratios * w[:width], float(w[width]), *_sigmoid(margins, sure, y, prior), prior)


def _sigmoid(margins: np.ndarray, sure: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and shift that turn margins into probabilities: logistic loss by Newton steps, slightly regularised.

    Shift counts by a text's sureness and the prior by the rest. Likewise the classes weigh the same where texts tell
    much and as often as they occur where texts tell little.
    """
    a, b = 1.0, 0.0
    target, fixed = (y > 0).astype(float), prior * (1 - sure)
    weight = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9)) ** sure
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b * sure + fixed, -500, 500)))
        g, h = weight * (p - target), weight * p * (1 - p)
        gradient = np.array([g @ margins + 0.01 * a, g @ sure + 0.01 * b])
        hessian = np.array([[h @ margins**2 + 0.01, h @ (margins * sure)], [h @ (margins * sure), h @ sure**2 + 0.01]])
        move = np.linalg.solve(hessian, gradient)
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-6:
            break
    return float(a), float(b)


def fit(labelled: DataFrame, width: int = FEATURES, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on `doc_id`, `text`, `label` (1 good, 0 bad; rows with another label or none are left out).

    The log-count ratios come from all labelled rows, counted by Spark (at most `width` counts per class
    reach the driver). The hinge-loss fit takes the `fit_rows` rows, about, whose hash is smallest, as far as they
    hold `FIT_GRAMS` n-grams; one task reads them and returns the weights. Without both labels the model knows nothing
    and scores everything 0.5.
    """
    rows = materialize(labelled.where("label in (0, 1)").select(
        F.col("label").cast("int").alias("label"), F.col("text").cast("string").alias("text"),
        F.xxhash64("doc_id", "text").alias("_turn")), "labelled_texts")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, width), dtype=np.int64)
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                counts[label, features(text, width)] += 1
        where = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(counts[1, where]), pa.array(counts[0, where])],
                                         ["feature", "good", "bad"])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = pa.array([features(t, width).tobytes() for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("_turn"), at], ["label", "_turn", "at"])
            give_back()

    classes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(classes) < 2:
        return Model(np.zeros(width), 0.0, 0.0, 0.0, 0.0)
    sums = (rows.select("label", "text").mapInArrow(counted, "feature long, good long, bad long")
            .groupBy("feature").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).toArrow())
    good, bad = np.zeros(width), np.zeros(width)
    at = sums.column("feature").to_numpy()
    good[at], bad[at] = sums.column("good").to_numpy(), sums.column("bad").to_numpy()
    ratios, prior = log_count_ratios(good, bad), math.log(classes[1] / classes[0])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, labels, grams = [], [], 0
        for batch in batches:
            for label, data in zip(batch.column("label").to_pylist(), batch.column("at").to_pylist()):
                grams += len(data) // 4
                if len(held) < 2 * fit_rows and (grams <= FIT_GRAMS or not held):
                    held.append(np.frombuffer(data, dtype=np.int32))
                    labels.append(label)
        if held:
            m = _fitted(held, np.where(np.array(labels) == 1, 1.0, -1.0), ratios, prior)
            yield pa.RecordBatch.from_arrays([pa.array([m.weights.tobytes()], pa.binary()), *(pa.array([v]) for v in (m.bias, m.slope, m.shift))],
                                             ["weights", "bias", "slope", "shift"])

    share = min(1.0, fit_rows / sum(classes.values()))
    chosen = rows.where(F.pmod("_turn", F.lit(1_000_000)) < int(share * 1_000_000 + 1))
    sample = chosen.mapInArrow(found, "label int, _turn long, at binary").repartition(1).sortWithinPartitions("_turn", "at", "label")
    model = sample.mapInArrow(fitted, "weights binary, bias double, slope double, shift double").first()
    if model is None:
        return Model(ratios, 0.0, 1.0, 0.0, prior)
    return Model(np.frombuffer(model["weights"]), model["bias"], model["slope"], model["shift"], prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Add `score` (0 to 1, higher for label 1) and `predicted` (1 from 0.5 on) to the columns of `docs`.

    Only the whole text is an input; null and empty texts get the share of label 1; columns
    named like a result are replaced; an empty table gives an empty result.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    model = docs.sparkSession.sparkContext.broadcast(model)  # bounded: one number per feature

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.value.score(t) for t in batch.column("text").to_pylist()], dtype=float)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                [*(f.name for f in kept), "score", "predicted"])
            give_back()

    schema = ddl(kept)
    return map_batches(docs.select(*quoted([f.name for f in kept])), scored, f"{schema}, score double, predicted int")
