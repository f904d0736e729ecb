"""Near-duplicate documents by an inverted join of MinHash coordinates.

Documents with the same set of word shingles are one class. A class has a signature
of ``COORDINATES`` minima and is posted under each (coordinate, value). Two classes
whose sets agree to the threshold share at least ``matches`` coordinates but for a chance of
two in a million, and then also one of the rarest COORDINATES - matches + 1 of each: only these
are joined (prefix), and what no other class has is skipped.

Postings of up to ``SMALL`` classes give all their pairs. Longer ones first give one pair
for each member, with their smallest class; what these pairs link is one component.
Members of long postings in different components are then compared block by block, on
their full sets, so that no link between components is lost and no posting gives all its pairs.
Every other pair is confirmed on the full shingle sets of both texts, too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table, text_runs
from tidemark.llm.components import components
from tidemark.llm.shingles import run_words, scrambled, shingles

COORDINATES = 48
SMALL = 16
BLOCK = 256
#: Classes whose coordinates one task counts: nearly all differ, so its hash table takes some 50 MB.
SHARE = 8192
WIDTH = 5
_STEP = scrambled(np.arange(1, 2 * COORDINATES + 1, dtype="u8"))
TIMES, PLUS = _STEP[:COORDINATES] | np.uint64(1), _STEP[COORDINATES:]


def matches(percent: int) -> int:
    """The most coordinates that sets of this similarity share but for a chance below two in a million: 28 at 85, 24 at 80."""
    p, missed = percent / 100, 0.0
    for m in range(COORDINATES):
        missed += comb(COORDINATES, m) * p**m * (1 - p) ** (COORDINATES - m)
        if missed >= 2e-6:
            return m
    return COORDINATES


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """``id``, ``text_hash``, ``n_shingles``, ``print`` (a digest of the shingle set, null if empty) and ``minima``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_runs(batch.column(1), 1 << 19):
                part = batch.slice(lo, hi - lo)
                hashes, starts = shingles(*run_words(part.column(1)), width)
                sizes, prints = [], []
                for i in range(len(starts) - 1):
                    own = np.sort(hashes[starts[i] : starts[i + 1]])
                    own = own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own
                    sizes.append(len(own))
                    prints.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                full = np.flatnonzero(np.array(sizes))
                minima = np.zeros((len(full), COORDINATES), "u4")
                if len(full):
                    for k in range(COORDINATES):
                        # starts of empty sets fall on their successors and are left out
                        minima[:, k] = np.minimum.reduceat(hashes * TIMES[k] + PLUS[k], starts[full]) >> np.uint64(32)
                offsets = np.concatenate([[0], np.cumsum(np.array(sizes) > 0)]) * COORDINATES
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(minima.view("i4").ravel()))
                columns = [part.column(0), part.column(2), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), lists]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "text_hash", "n_shingles", "print", "minima"])

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, text_hash long, n_shingles long, print binary, minima array<int>"
    return _hashed(docs, id_col, text_col).mapInArrow(run, schema)


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def _coordinates(classes: DataFrame) -> DataFrame:
    return classes.select("node", F.posexplode("minima").alias("place", "value"))


def _posted(classes: DataFrame, least: int) -> DataFrame:
    """``node``, ``place``, ``value``, with ``total`` and ``hub`` (the smallest class) of the posting: each class under its rarest coordinates."""
    rows = _coordinates(classes)
    shares = classes.select("node", "minima").repartition(classes.count() // SHARE + 1, "node")
    postings = stored(
        _coordinates(shares).groupBy("place", "value").agg(F.count("*").alias("total"), F.min("node").alias("hub")).filter("total > 1"),
        "postings",
    )
    shared = rows.join(postings, ["place", "value"])
    by_rarity = Window.partitionBy("node").orderBy("total", "place")
    all_of_node = Window.partitionBy("node")
    # what a class shares with none comes first in its order and takes up places of the prefix
    return (
        shared.withColumns({"nth": F.row_number().over(by_rarity), "n": F.count("*").over(all_of_node)})
        .filter(F.col("nth") + (COORDINATES - F.col("n")) <= COORDINATES - least + 1)
        .filter(F.col("n") >= least)
        .select("node", "place", "value", "total", "hub")
    )


def _matching(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose signatures agree in at least ``matches(percent)`` places, with their number."""
    left = classes.select(F.col("node").alias("a"), F.col("minima").alias("x"), F.col("size").alias("n"))
    right = classes.select(F.col("node").alias("b"), F.col("minima").alias("y"), F.col("size").alias("m"))
    same = F.aggregate(F.zip_with("x", "y", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, v: s + v)
    fit = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    return pairs.join(left, "a").join(right, "b").filter(fit).select("a", "b", same.alias("same")).filter(F.col("same") >= matches(percent))


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_runs(batch.column(2)):
                keep = []
                for i in range(lo, hi):
                    own = [np.unique(shingles(*run_words(batch.column(c).slice(i, 1)), width)[0]) for c in (2, 3)]
                    both = len(np.intersect1d(*own, assume_unique=True))
                    if 100 * both >= percent * (len(own[0]) + len(own[1]) - both):
                        keep.append(i)
                yield pa.RecordBatch.from_arrays([c.take(pa.array(keep, pa.int64())) for c in batch.columns[:2]], names=["a", "b"])

    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _across(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose ends are not yet in one component."""
    a = found.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    b = found.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    joined = pairs.join(a, "a", "left").join(b, "b", "left")
    return joined.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(pairs.columns)


def _crowds(posted: DataFrame, found: DataFrame) -> DataFrame | None:
    """``node``, ``component`` and ``crowd`` of the members of long postings that hold several components; None if there are none.

    Postings with common members form a crowd, so that two members meet once and not in each posting they share.
    """
    members = posted.filter(F.col("total") > SMALL).join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    key = ["place", "value"]
    split = members.groupBy(key).agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("node").alias("least"))
    split = stored(split.filter("lo <> hi").select(*key, "least"), "split-postings")
    if split.isEmpty():
        return None
    members = stored(members.join(split, key).select("node", "component", "least"), "split-members")
    crowds = components(members.select(F.col("least").alias("a"), F.col("node").alias("b")))
    return members.select("node", "component").distinct().join(crowds.select("node", F.col("component").alias("crowd")), "node")


def _linked_in_blocks(crowds: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components of a crowd, on full sets: for each member one to each component that it has links to.

    The members are dealt into blocks of about ``BLOCK``; two blocks at a time meet in one group.
    """
    # written, so that the join with it can split a crowd that holds most rows
    blocks = stored(crowds.groupBy("crowd").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "crowd-sizes")
    dealt = (
        crowds.join(blocks, "crowd")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("crowd", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "component")
        .join(sets, "node")
    )

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["own", "node"], ignore_index=True)
        i, j = part["i"].iloc[0], part["j"].iloc[0]
        x, y = (np.flatnonzero(part["own"] == k) for k in (i, j))
        hashes = [np.frombuffer(b, "u8") for b in part["hashes"]]
        size = np.array([len(h) for h in hashes])
        _, column, times = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(part)), size)
        # what only one text has adds nothing to an intersection
        number = np.cumsum(times > 1) - 1
        shared = times[column] > 1
        owner, column = owner[shared], number[column[shared]]
        both = np.zeros((len(x), len(y)), "f4")
        by = np.argsort(column, kind="stable")
        owner, column = owner[by], column[by]
        for lo in range(0, int(number[-1]) + 1, 4096):
            a, b = np.searchsorted(column, [lo, lo + 4096])
            has = np.zeros((len(part), 4096), "f4")
            has[owner[a:b], column[a:b] - lo] = 1
            both += has[x] @ has[y].T
        kind = part["component"].to_numpy()
        hit = 100 * both >= percent * (size[x][:, None] + size[y][None, :] - both)
        hit &= kind[x][:, None] != kind[y][None, :]
        nodes, out = part["node"].to_numpy(), []
        for row in np.flatnonzero(hit.any(1)):
            to = y[hit[row]]
            _, first = np.unique(kind[to], return_index=True)
            out += [(nodes[x[row]], nodes[t]) for t in to[first]]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return dealt.groupBy("crowd", "i", "j").applyInPandas(meet, "a long, b long")


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """``node`` and its sorted shingle hashes, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_runs(batch.column(1), 1 << 19):
                part = batch.slice(lo, hi - lo)
                hashes, starts = shingles(*run_words(part.column(1)), width)
                packed = [np.unique(hashes[starts[i] : starts[i + 1]]).tobytes() for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], names=["node", "hashes"])

    return texts.select("node", "text").mapInArrow(run, "node long, hashes binary")


def _classes_and_components(docs: DataFrame, id_col: str, text_col: str, percent: int, width: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``signatures``, and for each class its ``print`` and the ``keeper`` (first row) of its component."""
    if percent < 80:
        raise ValueError("signatures are made for 80 percent and more; 85 is the default")
    rows = stored(signatures(docs, id_col, text_col, width), "signatures")
    classes = rows.filter("print is not null").groupBy("print").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first"), F.max("minima").alias("minima"), F.max("n_shingles").alias("size")
    )
    classes = stored(classes.withColumn("node", F.xxhash64("print")), "classes")
    twice = classes.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1")
    if not twice.isEmpty():
        raise ValueError("two classes have one number; number them by another hash")

    posted = stored(_posted(classes, matches(percent)), "posted")
    short = posted.filter(F.col("total") <= SMALL)
    other = short.select(F.col("node").alias("b"), "place", "value")
    near = short.withColumnRenamed("node", "a").join(other, ["place", "value"]).filter("a < b").select("a", "b")
    starred = posted.filter((F.col("total") > SMALL) & (F.col("node") != F.col("hub"))).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    candidates = stored(_matching(near.union(starred).distinct(), classes, percent), "candidates")

    # first each class with its likeliest partner, then what still lies between components
    ends = candidates.union(candidates.select("b", "a", "same"))
    best = ends.groupBy("a").agg(F.max(F.struct("same", "b")).alias("top")).select("a", "top.b")
    best = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    nodes = ends.select(F.col("a").alias("node")).distinct()
    texts = _texts(docs, nodes, classes, id_col, text_col)
    links = stored(_confirmed(best, texts, percent, width), "links")
    found = components(links)
    rest = stored(_across(candidates.join(best, ["a", "b"], "left_anti"), found), "rest")
    if not rest.isEmpty():
        links = stored(links.union(_confirmed(rest, texts, percent, width)), "links")
        found = components(links)
    crowds = _crowds(posted, found)
    if crowds is not None:
        crowds = stored(crowds, "crowds")
        texts = _texts(docs, crowds.select("node").distinct(), classes, id_col, text_col)
        sets = stored(_sets(texts, width).dropDuplicates(["node"]), "sets")
        more = stored(_linked_in_blocks(crowds, sets, percent), "links")
        if not more.isEmpty():
            links = stored(links.union(more), "links")
            found = components(links)

    named = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first").alias("keeper"))
    return rows, stored(named.join(smallest, "component").select("print", "keeper"), "class-components")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, width: int = WIDTH
) -> DataFrame:
    """One row per row: its id, ``n_shingles``, ``component_id`` and ``kept``.

    Words are runs of characters other than ASCII white space, with A-Z in lower case; a set holds
    the distinct shingles of ``width`` words, or all words as one if there are fewer.
    Documents are linked when 100 * intersection >= percent * union; 80 is the least
    ``percent`` that the number of coordinates is made for. ``component_id`` is the
    smallest id that links lead to. A text without words, or null, has an empty set and
    is linked with nothing. Rows that repeat an id count as one document if their texts
    agree. A null id is greater than no other: a component's smallest id ignores it.
    """
    rows, of_class = _classes_and_components(docs, id_col, text_col, percent, width)
    empty = rows.filter("print is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    return (
        rows.join(of_class, "print")
        .select("id", "n_shingles", F.col("keeper.id").alias("component_id"))
        .union(empty)
        .select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("component_id").eqNullSafe(F.col("id")).alias("kept"))
    )


def deduplicate_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, width: int = WIDTH) -> DataFrame:
    """The input's rows and columns, one row of each component: that of the smallest id.

    Rows that repeat an id are told apart by their texts. Texts without words all stay.
    """
    rows, of_class = _classes_and_components(docs, id_col, text_col, percent, width)
    keepers = of_class.select("keeper").distinct().select(F.col("keeper.id").alias("__id"), F.col("keeper.text_hash").alias("__hash"))
    empty = rows.filter("print is null").select("id", "text_hash").distinct()
    keepers = keepers.union(empty)
    text = F.xxhash64(F.col(text_col).cast("string"))
    return docs.join(keepers, F.col(id_col).eqNullSafe(F.col("__id")) & (text == F.col("__hash")), "left_semi")


def _texts(docs: DataFrame, nodes: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The text of the first document of each class in ``nodes``; ids that repeat are told apart by a hash of their texts."""
    wanted = nodes.join(classes, "node").select("node", F.col("first.id").alias("i"), F.col("first.text_hash").alias("h"))
    found = _hashed(docs, id_col, text_col).join(wanted, F.col("id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("h")))
    return stored(found.select("node", "text"), "class-texts")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near copies."""
    return near_duplicates(table(spark, sf_dir, "documents"))
