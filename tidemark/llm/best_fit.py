"""Best-fit packing of token sequences in bulk-synchronous supersteps.

Pieces of documents are dealt out to shards, and each shard is packed by sweeps in a
task of its own. Both sides of a sweep are sorted by size: the pieces in runs of equal
length, longest first, the open sequences in runs of equal gap. One sweep takes all
pieces of a length at once to their successors, the smallest gaps that hold them; pieces
that want the same gap are told apart by rank, which gives each a sequence and a place
in it. Then the gaps are updated, and the sweep of the next length begins. What passes
through a task are counts by length, at most ``capacity`` of them, and ranks: never
the pieces of a shard at once.

A superstep ends when its result is written. The emptiest sequences of each shard are
then opened again, and the pieces in them are packed in the next superstep together with
those of other shards, until one shard is left.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import release, stored, table, tasks, text_runs

#: A sequence's number is made of superstep, shard and its place in the shard.
SHARD_BITS, PLACE_BITS = 20, 40
#: Rows of places that a task holds at once.
BATCH = 1 << 16


class Encoder:
    """Ids of whole texts, as packed unsigned 32-bit integers, by way of the chunks between ASCII white space.

    The tokenizer sees white space only as a border, so a text's ids are those of its
    chunks, one after the other; so is the border between an ASCII letter or digit and
    closing punctuation. Short chunks are remembered in two generations of at most
    ``most_chunks``: what is met again passes from the old one to the new.
    """

    LONGEST = 40
    #: Lower-case letters that normalisation leaves as one letter: chunks of them are one word each.
    PLAIN = re.compile("[a-zß-öø-įı-ɏ]+")

    def __init__(self, model: bytes, most_chunks: int = 3 << 18) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(model)
        self.most_chunks = most_chunks
        self.seen: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        # lower-casing ASCII first gives fewer chunks; special tokens are found before that
        marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lower = self._ids(["A b", "İ"]) == self._ids(["a b", "İ"])
        self.marks = {m.encode()[:2] for m in marks}
        vocabulary = self.tokenizer.get_vocab()
        suffix = json.loads(model)["model"].get("end_of_word_suffix")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for word, i in vocabulary.items() if word.endswith(suffix)]] = True

    def _words(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks that are one word each: many at a time, parted where a word ends."""
        texts = [" ".join(chunks[i : i + 1024]) for i in range(0, len(chunks), 1024)]
        ids = np.frombuffer(b"".join(self._ids(texts)), "<u4")
        edges = [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
        if len(edges) != len(chunks) + 1 or edges[-1] != 4 * len(ids):
            return self._ids(chunks)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        """Remembers the chunks; gives back those too long to be remembered."""
        seen, old = self.seen, self.old
        wanted, joined, long = set(), [], {}
        for chunk in chunks:
            if chunk in old:
                seen[chunk] = old[chunk]
                continue
            core = chunk.rstrip(b".,;:!?")
            if core and len(core) < len(chunk) and core[-1:].isalnum():
                parts = (core, chunk[len(core) :])
                joined.append((chunk, parts))
                for part in parts:
                    if part in old:
                        seen[part] = old[part]
                    elif part not in seen:
                        wanted.add(part)
            else:
                wanted.add(chunk)
        plain, other = [], []
        for chunk in wanted:
            (plain if self.PLAIN.fullmatch(text := chunk.decode()) else other).append(text)
        for texts, ids_of in ((plain, self._words), (other, self._ids)):
            for i in range(0, len(texts), 1 << 15):
                part = texts[i : i + (1 << 15)]
                for chunk, ids in zip(part, ids_of(part), strict=True):
                    (seen if len(chunk) <= self.LONGEST else long)[chunk.encode()] = ids
        for chunk, (core, tail) in joined:
            (seen if len(chunk) <= self.LONGEST else long)[chunk] = (seen.get(core) or long[core]) + (seen.get(tail) or long[tail])
        return long

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        chunks = []
        for text in texts:
            data = text.encode()
            if self.lower and not any(m in data for m in self.marks):
                data = data.lower()
            chunks.append(data.split())
        if len(self.seen) > self.most_chunks:
            self.seen, self.old = {}, self.seen
        long = self._learn(set().union(*chunks).difference(self.seen))
        seen = self.seen
        for own in chunks:
            if long:
                yield b"".join([seen[c] if c in seen else long[c] for c in own])
            else:
                yield b"".join(map(seen.__getitem__, own))


@lru_cache(maxsize=1)
def _encoder(model: bytes) -> Encoder:
    return Encoder(model)


def token_pieces(docs: DataFrame, model: bytes, end_id: int = 1, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """The tokens of whole texts, closed by ``end_id``, in pieces of at most ``capacity``.

    One row per piece: the id, ``piece`` (from 0), ``start`` (the text's tokens before
    it), ``length``, ``ids_crc32`` and, if asked for, ``ids``, packed little-endian
    unsigned 32-bit integers. Only texts of more than ``capacity`` tokens are cut. A null
    text counts as empty: its one piece is the end id. Repeated rows give repeated pieces;
    other columns are ignored.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in batches:
            for lo, hi in text_runs(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                owner, number, ids = [], [], []
                for i, own in enumerate(encoder.encode([t or "" for t in part.column(1).to_pylist()])):
                    own += end
                    for k in range(0, len(own), 4 * capacity):
                        owner.append(i)
                        number.append(k // (4 * capacity))
                        ids.append(own[k : k + 4 * capacity])
                piece = np.array(number, "i4")
                columns = [
                    part.column(0).take(pa.array(owner, pa.int64())),
                    pa.array(piece),
                    pa.array(piece.astype("i8") * capacity),
                    pa.array(np.array([len(x) // 4 for x in ids], "i8")),
                    pa.array(np.array([zlib.crc32(x) for x in ids], "i8")),
                ]
                if with_ids:
                    columns.append(pa.array(ids, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


class Sweeps:
    """The sequences of one shard, in runs of equal gap: where each run begins and how many it has."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.many = np.zeros(capacity + 1, "i8")
        self.sequences = 0

    def _put(self, gap: int, first: int, n: int) -> None:
        self.gaps[gap].append((first, n))
        self.many[gap] += n

    def _fill(self, length: int, rank: int, left: int, gap: int, first: int, n: int) -> Iterator[tuple[int, int, int, int, int]]:
        """Pieces of one length into a run of ``n`` sequences: rank, sequence, sequences, pieces in each, offset."""
        each = gap // length
        full = min(n, left // each)
        if full:
            yield rank, first, full, each, self.capacity - gap
            self._put(gap - each * length, first, full)
        rest = min(left - full * each, each) if full < n else 0
        if rest:
            yield rank + full * each, first + full, 1, rest, self.capacity - gap
            self._put(gap - rest * length, first + full, 1)
        used = full + (rest > 0)
        if used < n:
            self._put(gap, first + used, n - used)

    def sweep(self, length: int, n: int) -> Iterator[tuple[int, int, int, int, int]]:
        """All ``n`` pieces of one length; lengths come in descending order."""
        rank = 0
        for gap in (np.flatnonzero(self.many[length:]) + length).tolist():
            if rank == n:
                return
            runs, self.gaps[gap], self.many[gap] = self.gaps[gap], [], 0
            for first, many in runs:
                if rank == n:
                    self._put(gap, first, many)
                    continue
                for move in self._fill(length, rank, n - rank, gap, first, many):
                    rank = move[0] + move[2] * move[3]
                    yield move
        if rank < n:
            new = -(-(n - rank) // (self.capacity // length))
            self.sequences += new
            yield from self._fill(length, rank, n - rank, self.capacity, self.sequences - new, new)

    def emptiest(self, most: int, least_gap: int) -> list[int]:
        found: list[int] = []
        for gap in np.flatnonzero(self.many[least_gap:])[::-1] + least_gap:
            for first, n in self.gaps[gap]:
                found.extend(range(first, first + min(n, most - len(found))))
        return found


def _shard_places(counts: list[tuple[int, int]], shard: int, capacity: int, reopen: int) -> Iterator[pa.RecordBatch]:
    """A place for each piece of one shard, from its counts by length (longest first)."""
    sweeps = Sweeps(capacity)
    moves = [(length, *move) for length, n in counts for move in sweeps.sweep(length, n)]
    again = np.array(sweeps.emptiest(reopen, max(1, capacity // 64)) if reopen else [], "i8")
    waiting: list[tuple[np.ndarray, ...]] = []
    held = 0
    for length, rank, first, n, each, offset in moves:
        for lo in range(0, n * each, BATCH):
            i = np.arange(lo, min(lo + BATCH, n * each), dtype="i8")
            waiting.append((np.full(len(i), length, "i8"), rank + i, first + i // each, offset + i % each * length))
            held += len(i)
            if held >= BATCH:
                yield _batch(waiting, shard, again)
                waiting, held = [], 0
    if waiting:
        yield _batch(waiting, shard, again)


def _batch(parts: list[tuple[np.ndarray, ...]], shard: int, again: np.ndarray) -> pa.RecordBatch:
    length, rank, place, offset = (np.concatenate(c) for c in zip(*parts, strict=True))
    columns = [np.full(len(rank), shard, "i4"), length, rank, place, offset, np.isin(place, again)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["__shard", "__length", "__rank", "__place", "__offset", "__again"])


def _places(counts: DataFrame, shards: int, capacity: int, reopen: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, []
        for batch in batches:
            for shard, length, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != at and own:
                    yield from _shard_places(own, at, capacity, reopen)
                    own = []
                at = shard
                own.append((length, n))
        if own:
            yield from _shard_places(own, at, capacity, reopen)

    dealt = counts.repartition(shards, "__shard").sortWithinPartitions("__shard", F.desc("__length"))
    return dealt.mapInArrow(run, "__shard int, __length long, __rank long, __place long, __offset long, __again boolean")


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = 4096, shards: int | None = None, fan_in: int = 16, reopen: int = 32) -> DataFrame:
    """The rows with ``sequence_id`` and ``offset``: sequences of at most ``capacity``, filled without gaps from 0.

    ``shards`` (as many as shuffle partitions) are packed side by side; the at most
    ``reopen`` emptiest sequences of each are packed again with those of ``fan_in``
    shards, until one shard is left. Numbers of sequences are any; columns of the same
    names are replaced, other columns travel along. Rows whose length is null, below 1
    or above ``capacity`` fit nowhere: both columns are null. Repeated rows get places of
    their own.
    """
    spark = pieces.sparkSession
    shards = max(1, min(shards or tasks(spark), 1 << SHARD_BITS))
    others = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    fits = F.coalesce(F.col(length_col).between(1, capacity), F.lit(False))
    source = stored(pieces.select(*others, fits.alias("__fits")), "pieces")
    row = F.struct(*others)
    rows = source.filter("__fits").select(
        row.alias("__row"), F.col(length_col).cast("long").alias("__length"), F.monotonically_increasing_id().alias("__number"),
        (F.monotonically_increasing_id() % shards).cast("int").alias("__shard"),
    )
    rank = F.row_number().over(Window.partitionBy("__shard", "__length").orderBy("__number")) - 1
    out, step = source.filter("not __fits").select(row.alias("__row"), F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset")), 0
    while True:
        ranked = stored(rows.withColumn("__rank", rank.cast("long")), "ranked-pieces")
        counts = ranked.groupBy("__shard", "__length").agg(F.count("*").alias("__n"))
        places = _places(counts, shards, capacity, reopen if shards > 1 else 0)
        placed = stored(ranked.join(places, ["__shard", "__length", "__rank"]), "placed-pieces")
        release(spark, ranked)
        number = (F.shiftleft(F.lit(step << SHARD_BITS).cast("long") + F.col("__shard"), PLACE_BITS) + F.col("__place")).alias("sequence_id")
        out = out.union(placed.filter("not __again").select("__row", number, F.col("__offset").alias("offset")))
        if shards == 1:
            break
        step, shards = step + 1, -(-shards // fan_in)
        rows = placed.filter("__again").select("__row", "__length", "__number", F.expr(f"__shard div {fan_in}").cast("int").alias("__shard"))
    return out.select("__row.*", "sequence_id", "offset")


def sequences(packed: DataFrame, ids_col: str = "ids") -> DataFrame:
    """One row per sequence: ``sequence_id``, ``length`` and ``ids``, its pieces' ids joined in order of offset.

    A sequence has at most as many pieces as tokens, so its group is bounded. Rows without
    a sequence are left out.
    """
    rows = packed.filter("sequence_id is not null").groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", F.hex(ids_col).alias("ids")))).alias("parts"))
    joined = F.unhex(F.array_join(F.col("parts.ids"), ""))
    return rows.select("sequence_id", F.expr("aggregate(parts, 0L, (n, p) -> n + length(p.ids) div 8)").alias("length"), joined.alias("ids"))


def public_words() -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
        return file.read()


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return pack(token_pieces(table(spark, sf_dir, "documents"), public_words(), with_ids=False))
