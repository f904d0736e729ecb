"""Repeated passages by threshold-bounded interval expansion on a Burrows-Wheeler transform.

Each 100-byte string is dealt out by its anchor, the least hash of its 20-byte
substrings, so that equal strings meet. Strings that follow each other and have the
same anchor travel as one segment. Anchors that occur once are done; equal segments are merged, and
only the first place of each can be new text. Segments of an anchor that differ are
sorted to the threshold's depth; breadth-first backward extension from the empty
string gives the common prefixes of neighbouring suffixes by increasing value and
stops at the threshold. What has no value by then is equal, and of equal strings the first stays.
Segments none of whose strings shares its 64-bit hash with another of the anchor are left out
of the sort beforehand: they hold nothing that is repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import release, stored, table, tasks, text_runs
from tidemark.llm.shingles import _powers, scrambled, text_bytes

ANCHOR = 20
#: What one sort takes of an anchor: segments of less than 2 * length bytes, so 1.6 MB at 100. Beyond, strings are grouped one by one.
MOST_SEGMENTS = 1 << 13
CHUNK = 1 << 20
_POSITION = np.uint64((1 << 21) - 1)


def segments(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one text: where segments start, how many strings of ``length`` each has, and their anchors' hashes."""
    starts, counts, anchors = [np.zeros(0, "i8")], [np.zeros(0, "i8")], [np.zeros(0, "u8")]
    total, at = len(data) - length + 1, 0
    while at < total:
        n = min(CHUNK, total - at)  # strings of this piece; their bytes overlap the next one's
        part = data[at : at + n + length - 1]
        up, down = _powers(1 << 21)
        sums = np.zeros(len(part) + 1, "u8")
        np.cumsum((part.astype("u8") + np.uint64(1)) * up[: len(part)], out=sums[1:])
        count = len(part) - ANCHOR + 1
        hashes = scrambled((sums[ANCHOR:] - sums[:count]) * down[:count])
        # the least hash, and of equal ones the first, of each run of ``length - ANCHOR + 1`` substrings
        least = (hashes & ~_POSITION) | np.arange(count, dtype="u8")
        reach, width = 1, length - ANCHOR + 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        place = (least[:n] & _POSITION).astype("i8")
        edges = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        starts.append(edges + at)
        counts.append(np.diff(np.append(edges, n)))
        anchors.append(hashes[place[edges]])
        at += n
    return np.concatenate(starts), np.concatenate(counts), np.concatenate(anchors)


def _sorted_suffixes(x: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of ``x`` in the order of their first ``depth`` symbols (below 512)."""
    n, known = len(x), 7
    padded = np.concatenate([x.astype("u8"), np.zeros(known, "u8")])
    key = np.zeros(n, "u8")
    for k in range(known):
        key = key << np.uint64(9) | padded[k : k + n]
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, "u8")
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])).astype("u8")
        if known >= depth:
            return order
        step = min(known, depth - known)
        after = np.zeros(n, "u8")
        after[: max(n - step, 0)] = rank[step:] + np.uint64(1)
        key = rank * np.uint64(n + 1) + after
        known += step


def equal_strings(x: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of ``x`` in order, and for each whether it shares its first ``depth`` symbols with the one before.

    ``x`` ends in a symbol that occurs nowhere else and is the least. Level by level,
    each interval of suffixes that begin with a string w is extended backwards by the
    symbols in front of them: the suffixes that begin with cw are the images of those with
    c in front. An interval whose right edge has no value yet gets the
    length of w as the common prefix there and is extended at the next level.
    """
    order = _sorted_suffixes(x, depth)
    n = len(x)
    rank = np.empty(n, "i8")
    rank[order] = np.arange(n)
    front, image = x[order - 1].astype("i8"), rank[order - 1]
    unset = np.ones(n + 1, bool)
    unset[0] = unset[n] = False
    left, right = np.array([0]), np.array([n - 1])
    for _ in range(depth):
        sizes = right - left + 1
        starts = np.cumsum(sizes) - sizes
        inside = np.repeat(left - starts, sizes) + np.arange(int(sizes.sum()))
        key = np.repeat(np.arange(len(left)), sizes) * 512 + front[inside]
        by = np.argsort(key)
        key, to = key[by], image[inside[by]]
        edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        low, high = np.minimum.reduceat(to, edges), np.maximum.reduceat(to, edges)
        new = unset[high + 1]
        unset[high + 1] = False
        left, right = low[new], high[new]
        if not len(left) or not unset.any():
            break
    return order, unset[:n]


def _string_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of each ``length`` bytes that follow each other."""
    total = max(len(data) - length + 1, 0)
    up, down = _powers(1 << 21)
    out = np.empty(total, "u8")
    for at in range(0, total, CHUNK):
        n = min(CHUNK, total - at)
        part = data[at : at + n + length - 1]
        sums = np.zeros(len(part) + 1, "u8")
        np.cumsum((part.astype("u8") + np.uint64(1)) * up[: len(part)], out=sums[1:])
        out[at : at + n] = scrambled((sums[length:] - sums[:n]) * down[:n])
    return out


def may_repeat(data: np.ndarray, sizes: np.ndarray, anchors: np.ndarray, length: int) -> np.ndarray:
    """Which of the segments laid end to end hold a string whose hash occurs again under their anchor."""
    owner = np.repeat(np.arange(len(sizes)), np.maximum(sizes - length + 1, 0))
    first = np.repeat(np.cumsum(sizes) - sizes, np.maximum(sizes - length + 1, 0))
    _, runs = np.unique(owner, return_index=True)
    at = first + np.arange(len(owner)) - np.repeat(runs, np.diff(np.append(runs, len(owner))))
    key = scrambled(_string_hashes(data, length)[at] + anchors.view("u8")[owner])
    # most hashes are alone in their cell and need not be sorted
    cell = (key >> np.uint64(42)).astype("i8")
    met = np.flatnonzero(np.bincount(cell, minlength=1 << 22)[cell] > 1)
    met = met[np.argsort(key[met])]
    same = key[met][1:] == key[met][:-1]
    found = np.zeros(len(sizes), bool)
    found[owner[met[1:][same]]] = True
    found[owner[met[:-1][same]]] = True
    return found


def _first_places(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Of segments sorted by anchor and place: the strings of each that an earlier segment has too."""

    def settle(rows: list) -> pa.RecordBatch:
        joined = np.frombuffer(b"".join(r[1] for r in rows), "u1")
        found = may_repeat(joined, np.array([len(r[1]) for r in rows]), np.array([r[0] for r in rows], "i8"), length)
        rows = [r for r, again in zip(rows, found.tolist(), strict=True) if again]
        if not rows:
            return pa.RecordBatch.from_arrays([pa.array([], place_type), pa.array([], pa.list_(pa.int32()))], names=["place", "gone"])
        data = [np.frombuffer(r[1], "u1") for r in rows]
        sizes = np.array([len(d) + 1 for d in data])
        x = np.ones(int(sizes.sum()) + 1, "i2")  # 1 parts the segments, 0 ends them all
        ends = np.cumsum(sizes)
        x[-1] = 0
        owner = np.repeat(np.arange(len(rows)), sizes)
        inside = np.ones(len(owner), bool)
        inside[ends - 1] = False
        x[:-1][inside] = np.concatenate(data).astype("i2") + 2
        order, equal = equal_strings(x, length)
        # runs of equal suffixes: all but the one in the first segment (they are in order of place) are repeats
        run = np.cumsum(~equal)
        position = order
        whole = np.zeros(len(x), bool)
        whole[:-1] = np.arange(len(owner)) + length <= (ends - 1)[owner]
        keep = whole[position]
        run, position = run[keep], position[keep]
        by = np.lexsort((position, run))
        run, position = run[by], position[by]
        again = np.concatenate([[False], run[1:] == run[:-1]]) if len(run) else np.zeros(0, bool)
        gone = np.sort(position[again])
        begins = ends - sizes
        lists = np.split(gone - begins[owner[gone]], np.searchsorted(owner[gone], np.arange(1, len(rows))))
        filled = [i for i, g in enumerate(lists) if len(g)]
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i][2] for i in filled], place_type), pa.array([lists[i].astype("i4") for i in filled], pa.list_(pa.int32()))], names=["place", "gone"]
        )

    rows, held, place_type = [], 0, None
    for batch in batches:
        place_type = batch.schema.field(2).type
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held > CHUNK and row[0] != rows[-1][0]:
                yield settle(rows)
                rows, held = [], 0
            rows.append(row)
            held += len(row[1])
    if rows:
        yield settle(rows)


def _covered(spots: pa.Array, offsets: np.ndarray, length: int) -> np.ndarray:
    """Which bytes of texts laid end to end lie in a repeated string; ``spots`` are segments with the strings that go, null for all."""
    counts = pc.fill_null(pc.list_value_length(spots), 0).to_numpy(zero_copy_only=False)
    base = np.repeat(np.asarray(offsets[:-1], "i8"), counts)
    fields = spots.flatten()
    start, n = base + fields.field(0).to_numpy(), fields.field(1).to_numpy()
    whole = fields.field(2).is_null().to_numpy(zero_copy_only=False)
    each = pc.fill_null(pc.list_value_length(fields.field(2)), 0).to_numpy(zero_copy_only=False)
    single = np.repeat(start, each) + fields.field(2).flatten().to_numpy()
    begins = np.concatenate([start[whole], single])
    ends = np.concatenate([start[whole] + n[whole] + length - 1, single + length])
    size = int(offsets[-1]) + 1
    return np.cumsum(np.bincount(begins, minlength=size) - np.bincount(ends, minlength=size))[:-1] > 0


def _unique_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key`` and ``text``; the key is the id, or the id with a hash of the text if ids repeat."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    plain = rows.schema["id"].dataType.simpleString() in ("bigint", "int") and rows.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1 or id is null").isEmpty()
    if plain:
        return rows.select(F.col("id").cast("long").alias("key"), "text")
    key = F.struct(F.col("id").isNotNull().alias("known"), "id", F.xxhash64("text").alias("print"))
    return rows.select(key.alias("key"), "text")


def _place(key: Column, start: Column, plain: bool) -> Column:
    """Orders places in the corpus: by key, then by start. A number where it can be, as numbers are aggregated faster."""
    if plain:
        return (key.cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + start).cast("decimal(38,0)")
    return F.struct(key.alias("key"), start.cast("int").alias("start"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, slices: int = 2) -> DataFrame:
    """One row per row: its id, ``n_bytes``, ``n_removed``, ``n_spans``, the removed ``spans`` and the bytes ``kept``.

    A byte is removed if a string of ``length`` bytes around it also starts earlier: in a text
    with a smaller id, or earlier in the same text. Strings overlap, none reaches across texts, and
    all are judged on the input. ``spans`` are (begin, end) pairs in bytes. A null text counts as empty. Rows
    that repeat an id are told apart by a hash of their texts, which orders them, and are one text if these
    agree. A null id is smaller than any other. ``kept`` may begin or end inside a character. The bytes of
    repeated segments are shuffled in ``slices`` by anchor, one after the other, to use less disk at a time.
    """
    if length < 2 * ANCHOR:
        raise ValueError(f"length is at least {2 * ANCHOR}")
    rows = _unique_rows(docs, id_col, text_col)
    key_type = rows.schema["key"].dataType.simpleString()
    plain = key_type == "bigint"
    if not plain:
        rows = rows.dropDuplicates(["key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_runs(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                data, offsets = text_bytes(part.column(1))
                found = [segments(data[offsets[i] : offsets[i + 1]], length) for i in range(hi - lo)]
                owner = np.repeat(np.arange(hi - lo), [len(f[0]) for f in found])
                s, n, a = (np.concatenate([f[k] for f in found]) for k in range(3))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), pa.array(s.astype("i4")), pa.array(n.astype("i4")), pa.array(a.view("i8"))], names=["key", "start", "n", "anchor"])

    dealt = stored(rows.mapInArrow(cut, f"key {key_type}, start int, n int, anchor long"), "segments")
    twice = stored(dealt.groupBy("anchor").agg(F.count("*").alias("times")).filter("times > 1").select("anchor"), "anchors")
    again = stored(dealt.join(twice, "anchor"), "repeated-segments")
    release(docs.sparkSession, dealt, twice)

    def with_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_runs(batch.column(1), 1 << 20):
                part = batch.slice(lo, hi - lo)
                data, offsets = text_bytes(part.column(1))
                lists = part.column(2)
                counts = np.diff(lists.offsets.to_numpy())
                fields = lists.flatten()
                start, n, anchor = (fields.field(k).to_numpy() for k in range(3))
                owner = np.repeat(np.arange(hi - lo), counts)
                begin = offsets[owner] + start
                raw = data.tobytes()
                pieces = [raw[b : b + k + length - 1] for b, k in zip(begin.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owner)), pa.array(start), pa.array(anchor), pa.array(pieces, pa.binary())], names=["key", "start", "anchor", "bytes"])

    def merged_slice(number: int) -> DataFrame:
        """The different segments of a part of the anchors, with the first place of each."""
        part = again.filter(F.pmod(F.xxhash64("anchor"), F.lit(slices)) == number)
        listed = part.groupBy("key").agg(F.collect_list(F.struct("start", "n", "anchor")).alias("segments"))
        cut_out = rows.join(listed, "key").select("key", "text", "segments").mapInArrow(with_bytes, f"key {key_type}, start int, anchor long, bytes binary")
        placed = cut_out.select("anchor", "bytes", _place(F.col("key"), F.col("start"), plain).alias("place"))
        return placed.groupBy("anchor", "bytes").agg(F.min("place").alias("place"))

    merged = None
    for number in range(slices):
        done = stored(merged_slice(number), "distinct-segments")
        merged = done if merged is None else merged.union(done)
        release(docs.sparkSession)
    kinds = stored(merged.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "mixed-anchors")
    mixed = stored(merged.join(kinds, "anchor"), "mixed-segments")
    release(docs.sparkSession)

    place_type = merged.schema["place"].dataType.simpleString()
    few = mixed.filter(F.col("kinds") <= MOST_SEGMENTS).select("anchor", "bytes", "place")
    gone = (
        few.repartition(4 * tasks(docs.sparkSession), "anchor")
        .sortWithinPartitions("anchor", "place")
        .mapInArrow(lambda b: _first_places(b, length), f"place {place_type}, gone array<int>")
    )
    # of anchors with very many segments each string is grouped on its own
    strings = mixed.filter(F.col("kinds") > MOST_SEGMENTS).select(
        "place", F.posexplode(F.transform(F.sequence(F.lit(1), F.octet_length("bytes") - (length - 1)), lambda i: F.substring(F.col("bytes"), i, F.lit(length)))).alias("at", "string")
    )
    moved = F.col("place") + F.col("at") if plain else F.struct(F.col("place.key"), (F.col("place.start") + F.col("at")).alias("start"))
    strings = strings.withColumn("here", moved.cast(place_type))
    first = stored(strings.groupBy("string").agg(F.min("here").alias("first"), F.count("*").alias("n")).filter("n > 1").select("string", "first"), "first-strings")
    later = strings.join(first, "string").filter("here <> first").groupBy("place").agg(F.collect_list("at").alias("gone"))
    gone = stored(gone.union(later), "repeated-strings")

    firsts = merged.select("place").withColumn("is_first", F.lit(True)).join(gone, "place", "left")
    spots = again.select("key", "start", "n", _place(F.col("key"), F.col("start"), plain).alias("place")).join(firsts, "place", "left")
    spots = spots.filter("is_first is null or gone is not null")
    spots = stored(spots.groupBy("key").agg(F.collect_list(F.struct("start", "n", "gone")).alias("spots")), "repeats")
    release(docs.sparkSession)

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_runs(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                data, offsets = text_bytes(part.column(1))
                raw = data.tobytes()
                covered = _covered(part.column(2), offsets, length)
                out = []
                for i in range(hi - lo):
                    begin, end = int(offsets[i]), int(offsets[i + 1])
                    gone = np.concatenate([[False], covered[begin:end], [False]])
                    edges = np.flatnonzero(gone[1:] != gone[:-1])
                    kept = raw[begin:end] if not len(edges) else np.frombuffer(raw[begin:end], "u1")[~gone[1:-1]].tobytes()
                    out.append((end - begin, end - begin - len(kept), len(edges) // 2, edges.reshape(-1, 2).tolist(), kept))
                cols = list(zip(*out, strict=True))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=["key", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    done = rows.join(spots, "key", "left").select("key", "text", "spots").mapInArrow(drop, f"key {key_type}, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept binary")
    out = ["n_bytes", "n_removed", "n_spans", "spans", "kept"]
    if plain:
        return done.select(F.col("key").alias(id_col), *out)
    # each of several equal rows gets the result
    key = F.struct(F.col(id_col).isNotNull().alias("known"), F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("print"))
    return docs.select(F.col(id_col).alias("__id"), key.alias("key")).join(done, "key").select(F.col("__id").alias(id_col), *out)


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 100 bytes and more that stand earlier in the corpus."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
