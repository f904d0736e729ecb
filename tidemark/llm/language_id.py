"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of the next letter after up to three letters. The models
are fitted on a sample of labelled documents, counted by Spark, and stored side by
side in sorted arrays of n-gram hashes: one search gives an n-gram's probability in
all languages. A text gets the language of the lowest cross-entropy per letter; a
text whose best cross-entropy is above what labelled texts reach is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, table, text_runs

ORDER = 4
UNKNOWN = "und"
#: Odd multipliers of the letters in an n-gram's hash, the last letter's first.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], "u8")
COUNTS = "lang string, c0 int, c1 int, c2 int, c3 int, n long"
CHUNK = 1 << 17


@dataclass(frozen=True)
class Model:
    """Sorted hashes and log-probabilities (n-grams by languages) of each order, the same of contexts' back-off weights.

    ``limit`` holds, by language, the highest cross-entropy that is not rejected, and
    ``sharpness`` turns differences of cross-entropy into probabilities.
    """

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    floor: np.ndarray
    limit: np.ndarray
    sharpness: float


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def streams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts with one 0 behind each word, and the text that each belongs to."""
    lowered = [t.lower() + "\n" for t in texts]
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(texts), dtype="i4"), [len(t) for t in lowered])
    letter = letters()[code]
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (owner[1:] == owner[:-1])
    return np.where(letter, code, 0).astype("u4")[keep], owner[keep]


def windows(code: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of places: each one's letter and those before it in its text (0 before the first), and the owners."""
    for lo in range(0, len(code), CHUNK):
        hi, first = min(lo + CHUNK, len(code)), max(lo - ORDER + 1, 0)
        part, own = code[first:hi].astype("u8"), owner[first:hi]
        back = np.zeros((ORDER, hi - lo), "u8")
        for k in range(ORDER):
            shift = lo - first - k
            src, same = part[max(shift, 0) : hi - first - k], own[max(shift, 0) : hi - first - k] == own[max(shift, 0) + k : hi - first]
            back[k, hi - lo - len(src) :] = np.where(same, src, 0)
        yield back, owner[lo:hi]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), "i8"), np.zeros(len(wanted), bool)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


def entropies(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy in nats a letter by text and language, and the number of letters and word ends."""
    code, owner = streams(texts)
    total, n = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), "i8")
    for back, own in windows(code, owner):
        parts = np.cumsum(back * FACTORS[:, None], axis=0, dtype="u8")
        left = np.arange(back.shape[1])
        n += np.bincount(own, minlength=len(texts))
        for order in range(ORDER, 0, -1):
            keys, values = model.grams[order - 1]
            at, found = _find(keys, parts[order - 1][left])
            for k in range(len(model.languages)):
                total[:, k] += np.bincount(own[left[found]], values[at[found], k], len(texts))
            left = left[~found]
            if not len(left):
                break
            # the context of what is not there passes its weight to the shorter n-gram
            keys, values = model.contexts[order - 1]
            context = (back[1:order, left] * FACTORS[: order - 1, None]).sum(0, dtype="u8")
            at, found = _find(keys, context)
            for k in range(len(model.languages)):
                total[:, k] += np.bincount(own[left[found]], values[at[found], k], len(texts))
        if len(left):
            total += np.bincount(own[left], minlength=len(texts))[:, None] * model.floor
    return -total / np.maximum(n, 1)[:, None], n


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in text_runs(batch.column(1)):
            part = batch.slice(lo, hi - lo)
            langs, texts = np.array(part.column(0).to_pylist(), object), part.column(1).to_pylist()
            for lang in sorted(set(langs)):
                code, owner = streams([t for t, own in zip(texts, langs, strict=True) if own == lang])
                for back, _ in windows(code, owner):
                    _, first, n = np.unique((back * FACTORS[:, None]).sum(0, dtype="u8"), return_index=True, return_counts=True)
                    grams = back[:, first].astype("i4")
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), *map(pa.array, grams), pa.array(n)], names=["lang", "c0", "c1", "c2", "c3", "n"])


def _one_language(grams: np.ndarray, n: np.ndarray) -> list[dict]:
    """Of one language and each order: n-gram letters, discounted shares; contexts and their weights."""
    orders = []
    for order in range(ORDER, 0, -1):
        ones, twos = (n == 1).sum(), (n == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        key = (grams[1:order] * FACTORS[: order - 1, None]).sum(0, dtype="u8") if order > 1 else np.zeros(len(n), "u8")
        contexts, where = np.unique(key, return_inverse=True)
        mass, kinds = np.bincount(where, n), np.bincount(where)
        orders.append({
            "grams": grams,
            "share": np.maximum(n - discount, 0) / mass[where],
            "contexts": contexts,
            "weight": discount * kinds / mass,
        })
        if order > 1:
            # a shorter n-gram counts once for each letter that stands in front of it
            shorter = (grams[: order - 1] * FACTORS[: order - 1, None]).sum(0, dtype="u8")
            _, first, n = np.unique(shorter, return_index=True, return_counts=True)
            grams = grams[: order - 1][:, first]
    return orders[::-1]


def estimate(counts: pd.DataFrame) -> Model:
    """The models of all languages from their n-gram counts of the highest order."""
    languages = sorted(counts["lang"].unique())
    each = []
    for lang in languages:
        own = counts[counts["lang"] == lang]
        each.append(_one_language(own[["c0", "c1", "c2", "c3"]].to_numpy("u8").T, own["n"].to_numpy("f8")))
    alphabet = len(np.unique(np.concatenate([m[0]["grams"][0] for m in each]))) + 1
    floor = np.full(len(languages), -np.log(alphabet))
    grams, contexts, below = [], [], None
    for order in range(1, ORDER + 1):
        letters_ = np.concatenate([m[order - 1]["grams"] for m in each], axis=1)
        keys, first = np.unique((letters_ * FACTORS[:order, None]).sum(0, dtype="u8"), return_index=True)
        letters_ = letters_[:, first]
        own = (letters_[1:order] * FACTORS[: order - 1, None]).sum(0, dtype="u8") if order > 1 else np.zeros(len(keys), "u8")
        share, weight = np.zeros((len(keys), len(languages))), np.ones((len(keys), len(languages)))
        all_contexts = np.unique(np.concatenate([m[order - 1]["contexts"] for m in each]))
        passed = np.zeros((len(all_contexts), len(languages)))
        for k, m in enumerate(each):
            level = m[order - 1]
            at, _ = _find(keys, (level["grams"] * FACTORS[:order, None]).sum(0, dtype="u8"))
            share[at, k] = level["share"]
            at, found = _find(level["contexts"], own)
            weight[found, k] = level["weight"][at[found]]
            at, _ = _find(all_contexts, level["contexts"])
            passed[at, k] = np.log(level["weight"])
        if order == 1:
            shorter = np.full(share.shape, 1 / alphabet)
        else:
            at, _ = _find(below[0], (letters_[: order - 1] * FACTORS[: order - 1, None]).sum(0, dtype="u8"))
            shorter = below[1][at]
        below = keys, share + weight * shorter
        grams.append((keys, np.log(below[1])))
        contexts.append((all_contexts, passed))
    return Model(languages, grams, contexts, floor, np.full(len(languages), np.inf), 1.0)


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 1500,
    seed: int = 7,
) -> Model | None:
    """Fits on about ``per_language`` whole documents of each language and calibrates on half as many others.

    Only documents with text and language that are not held out are taken, chosen by
    a hash of their id. None if there are none.
    """
    labelled = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("id")
    )
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, per_language / n)])[F.col("lang")]
    draw = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30)) / share
    few = draw >= F.when(share >= 1, F.lit(0.0)).otherwise(1.0)  # too few rows: calibrated on what was fitted
    counts = labelled.filter(draw < 1).select("lang", "text").mapInArrow(_counted, COUNTS)
    counts = counts.groupBy("lang", "c0", "c1", "c2", "c3").agg(F.sum("n").alias("n")).toPandas()
    if not len(counts):
        return None
    model = estimate(counts)
    tried = labelled.filter(few & (draw < 1.5)).withColumnRenamed("lang", "given")
    seen = predict(tried, model, "id", "text", keep=["given"]).select("given", "lang_pred", "entropies", "letters").toPandas()
    return _calibrated(model, seen)


def _calibrated(model: Model, seen: pd.DataFrame) -> Model:
    """Sets the sharpness that makes the labelled texts' languages likeliest, and the limits.

    A language's limit is 1.5 times the cross-entropy that all but a thousandth of
    its texts stay under; short texts get the slack of ``above``.
    """
    seen = seen[(seen["letters"] > 0) & seen["given"].isin(model.languages)]
    if not len(seen):
        return model
    h = np.stack(seen["entropies"].to_list())
    given = np.searchsorted(model.languages, seen["given"].to_list())
    rows = np.arange(len(h))

    def loss(s: float) -> float:
        return -np.mean(np.log(_probabilities(h, s)[rows, given] + 1e-12))

    sharpness = min((2.0**k for k in range(0, 7)), key=loss)
    limit = np.full(len(model.languages), np.inf)
    long = seen["letters"].to_numpy() >= 100
    for k in range(len(limit)):
        own = h[(given == k) & long, k]
        if len(own):
            limit[k] = 1.5 * np.quantile(own, 0.999)
    return Model(model.languages, model.grams, model.contexts, model.floor, limit, sharpness)


def _probabilities(h: np.ndarray, sharpness: float) -> np.ndarray:
    e = np.exp(-sharpness * (h - h.min(1, keepdims=True)))
    return e / e.sum(1, keepdims=True)


def above(h: np.ndarray, n: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Whether a cross-entropy is rejected: above the limit by more than 4 nats by the root of the letters."""
    return h > limit + 4 / np.sqrt(np.maximum(n, 1))


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per row: its id, the columns of ``keep``, and what follows.

    ``lang_pred``: the language of the lowest cross-entropy, the first by name among
    equals; ``und`` if the text is null or has no letter, or no language was learned.
    ``score``: its probability, 0 for ``und``. ``rejected``: ``und``, or not like any text the
    model was calibrated on. ``entropies``: by language; ``letters``: letters and word ends.
    """
    keep = keep or []
    names = [id_col, *keep]
    rest = [c for c in names if c != text_col]
    rows = docs.select(F.col(text_col).cast("string").alias("__text"), *rest)
    at = [rest.index(c) + 1 if c != text_col else 0 for c in names]  # the text is handed over once
    fields = ", ".join(f"`{c}` {rows.schema[i].dataType.simpleString()}" for c, i in zip(names, at, strict=True))
    schema = f"{fields}, lang_pred string, score double, rejected boolean, entropies array<double>, letters long"
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for lo, hi in text_runs(batch.column(0), 1 << 19):
                part = batch.slice(lo, hi - lo)
                texts = [t or "" for t in part.column(0).to_pylist()]
                if model is None:
                    h, n, best = np.zeros((len(texts), 1)), np.zeros(len(texts), "i8"), np.zeros(len(texts), "i8")
                    known_names, limit, sharpness = [UNKNOWN], np.zeros(1), 1.0
                else:
                    h, n = entropies(model, texts)
                    known_names, limit, sharpness, best = model.languages, model.limit, model.sharpness, h.argmin(1)
                row, known = np.arange(len(texts)), n > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(i) for i in at],
                        pa.array([known_names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], pa.string()),
                        pa.array(np.where(known, _probabilities(h, sharpness)[row, best], 0.0)),
                        pa.array(~known | above(h[row, best], n, limit[best])),
                        pa.array(list(h), pa.list_(pa.float64())),
                        pa.array(n),
                    ],
                    names=[*names, "lang_pred", "score", "rejected", "entropies", "letters"],
                )

    return rows.mapInArrow(run, schema)


def recognised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """The input's rows and columns without those whose language is rejected (null texts and texts without letters go too)."""
    model = fit(docs, id_col, text_col, lang_col, **options)
    names = {c: f"__{i}" for i, c in enumerate(docs.columns)}
    found = predict(docs.toDF(*names.values()), model, names[id_col], names[text_col], [n for c, n in names.items() if c != id_col])
    return found.filter("not rejected").select(*[F.col(n).alias(c) for c, n in names.items()])


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's predicted language."""
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
