"""Document quality by naive Bayes support vectors.

Features are n-gram indicators: character trigrams and pairs of word shapes, hashed
to ``DIM`` places. Each indicator is scaled by the log-ratio of its share in the two
classes; on the scaled indicators a linear model is fitted to the hinge loss by dual
coordinate descent. Its margins become probabilities by a logistic curve fitted on
documents it has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, table, text_runs
from tidemark.llm.shingles import SPACES, run_words, scrambled, text_bytes

BITS = 16
DIM = 2 << BITS
ACCEPTED = 0.7


def _kinds() -> np.ndarray:
    """The shape of each byte: letters by case, bytes of other letters, digits, white space, and each sign itself."""
    kind = np.arange(256, dtype="u8")
    kind[65:91], kind[97:123], kind[128:], kind[48:58] = 1, 2, 2, 3
    kind[SPACES] = 4
    return kind


KIND = _kinds()
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], "u8")


def features(texts: pa.Array) -> Iterator[np.ndarray]:
    """The places of each text's indicators, without repetition; none for an empty text.

    The first half of the places is for trigrams of bytes in which letters count by
    what they are, the second for shapes: trigrams of byte kinds, and whether a word repeats the one before,
    with the kinds of its first and last byte.
    """
    data, offsets = text_bytes(texts)
    mask = np.uint64((1 << BITS) - 1)
    words, starts = run_words(texts)
    for i in range(len(texts)):
        own = data[offsets[i] : offsets[i + 1]]
        if len(own) == 0:
            yield np.zeros(0, "i8")
            continue
        seen = np.zeros(DIM, bool)
        for lo in range(0, len(own), 1 << 20):  # long texts piece by piece, overlapping by two bytes
            part = own[lo : lo + (1 << 20) + 2]
            for half, x in enumerate((part.astype("u8"), KIND[part])):
                if len(part) >= 3:
                    h = x[:-2] * FACTORS[0] + x[1:-1] * FACTORS[1] + x[2:] * FACTORS[2]
                    seen[(h >> np.uint64(64 - BITS)).astype("i8") + (half << BITS)] = True
        w = words[starts[i] : starts[i + 1]]
        if len(w) > 1:
            again = w[1:] == w[:-1]
            shape = np.array([again.any(), again.mean() > 0.05, again.mean() > 0.3, len(np.unique(w)) < 0.5 * len(w)])
            seen[(1 << BITS) + (scrambled(np.arange(900, 904, dtype="u8"))[shape] & mask).astype("i8")] = True
        yield np.flatnonzero(seen)


@dataclass(frozen=True)
class Classifier:
    """``weights`` by feature place (log-ratios times fitted weights), ``bias``, and the logistic curve's ``slope`` and ``shift``."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, places: np.ndarray) -> float:
        # texts of all lengths count alike: the scaled indicators have length 1
        return float(self.weights[places].sum() / max(np.sqrt(len(places)), 1.0)) + self.bias

    def score(self, places: np.ndarray) -> float:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(places) + self.shift, -40, 40)))


def _ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    counts = np.ones((2, DIM))
    for places, label in zip(rows, y, strict=True):
        counts[int(label > 0), places] += 1
    shares = counts / counts.sum(1, keepdims=True)
    return np.log(shares[1] / shares[0])


def _descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: float, epochs: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model, one dual variable at a time.

    ``cost`` is the bound of the dual variables, larger for the rarer class so that both weigh alike.
    """
    rng = np.random.default_rng(seed)
    values = [ratio[p] / max(np.sqrt(len(p)), 1.0) for p in rows]
    square = np.array([v @ v + 1.0 for v in values])
    share = np.array([(y < 0).mean(), (y > 0).mean()])
    bound = cost / (2 * np.maximum(np.where(y > 0, share[1], share[0]), 1e-9))
    weight, bias, dual = np.zeros(DIM), 0.0, np.zeros(len(rows))
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            slack = y[i] * (weight[rows[i]] @ values[i] + bias) - 1
            new = min(max(dual[i] - slack / square[i], 0.0), bound[i])
            step = (new - dual[i]) * y[i]
            if step:
                weight[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
                dual[i] = new
        if moved < 1e-3:
            break
    return weight, bias


def _curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through labelled margins, by Newton steps on softened labels."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    goal = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -40, 40)))
        gradient = np.array([((p - goal) * margins).sum() + 1e-3 * a, (p - goal).sum()])
        w = np.maximum(p * (1 - p), 1e-9)
        hessian = np.array([[(w * margins**2).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 1e-6)), float(b)


def train(rows: list[np.ndarray], y: np.ndarray, seed: int = 3, cost: float = 1.0, epochs: int = 30) -> Classifier:
    """Fits on four fifths of the rows and the logistic curve on the rest; labels are 1 and -1.

    With one class only, every score is that class's.
    """
    if len(set(y.tolist())) < 2:
        return Classifier(np.zeros(DIM), 0.0, 1.0, float(np.sign(y.sum()) * 3) if len(y) else 0.0)
    fifth = np.random.default_rng(seed).permutation(len(rows)) % 5 == 0
    if len(set(y[~fifth].tolist())) < 2 or len(set(y[fifth].tolist())) < 2:
        fifth = np.zeros(len(rows), bool)
    fitted = [rows[i] for i in np.flatnonzero(~fifth)]
    ratio = _ratios(fitted, y[~fifth])
    weight, bias = _descend(fitted, y[~fifth], ratio, cost, epochs, seed)
    model = Classifier(weight * ratio, bias, 1.0, 0.0)
    tried = np.flatnonzero(fifth) if fifth.any() else np.arange(len(rows))
    slope, shift = _curve(np.array([model.margin(rows[i]) for i in tried]), y[tried])
    return Classifier(model.weights, bias, slope, shift)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = 6000,
    seed: int = 5,
) -> Classifier:
    """Fits on about ``rows`` whole labelled documents that are not held out, chosen by a hash of their id.

    The features are worked out where the documents are; the driver gets those of the
    sample, and the tasks its ids, which ``rows`` bounds.
    """
    chosen = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out("id")
    )
    n = chosen.count()
    draw = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = chosen.filter(draw < rows / max(n, 1)).distinct()
    # a document that is labelled both ways teaches nothing
    chosen = chosen.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other").drop("other")
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "id").select("id", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_runs(batch.column(2), 1 << 20):
                part = batch.slice(lo, hi - lo)
                found = [p.astype("<u4").tobytes() for p in features(part.column(2))]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(found, pa.binary())], names=["id", "label", "places"])

    id_type = sample.schema["id"].dataType.simpleString()
    got = sample.mapInArrow(run, f"id {id_type}, label int, places binary").orderBy("id").collect()
    return train([np.frombuffer(r["places"], "<u4").astype("i8") for r in got], np.array([2 * r["label"] - 1 for r in got], "f8"))


def score(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text", accepted: float = ACCEPTED) -> DataFrame:
    """One row per row: its id, ``score`` (0 to 1, higher: label 1 is likelier) and ``predicted`` (1 from ``accepted`` on).

    A null text is scored as an empty one, which has no features and gets the score of the bias.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for lo, hi in text_runs(batch.column(1), 1 << 20):
                part = batch.slice(lo, hi - lo)
                scores = np.array([model.score(p) for p in features(part.column(1))], "f8")
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores), pa.array((scores >= accepted).astype("i4"))], names=[id_col, "score", "predicted"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double, predicted int")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
