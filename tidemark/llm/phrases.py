"""Phrase collocation mining with HAT-trie counting.

Phrases of a task are counted in a trie of word ids: a shallow trie leads by the first
words to hash containers that hold the rest of a phrase and its count. A container that
grows too large bursts: it becomes a trie node with a container for each next word. When
the trie holds too much, its largest subtrees are written out whole, as runs sorted by
word id, and taken off; Spark deals the runs out by language and the first three words
and merges them there. So a task's memory is bounded, however many phrases there are.

Word ids are the task's own. Phrases are counted only where all their words and all
their pairs of words are frequent, for no phrase is more frequent than a part of it.
Tasks know those by bit maps of bounded size: that of the words is made of their counts,
that of the pairs of slots that a pair is hashed to and that are counted beforehand. A
wrongly set bit costs a little work and changes no count.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table, text_runs
from tidemark.llm.shingles import scrambled

#: A container of more entries bursts; a trie of more entries writes out its largest subtrees; rows of a run at once.
BURST, MOST_ENTRIES, BATCH = 1 << 12, 1 << 19, 1 << 15
#: With more languages in a task, all is written out and counting begins anew.
MOST_LANGUAGES = 64
#: Bits of the map of frequent words: sixteen for each, within these bounds (2 to 128 MB).
LEAST_BITS, MOST_BITS = 1 << 24, 1 << 30
#: Slots that pairs of words are hashed to (an 8 MB map), and how many of them travel together.
PAIR_SLOTS, SLOT_ROW = 1 << 26, 1 << 16
#: Pairs whose slots a task holds before they are written out.
MOST_PAIRS = 1 << 22
#: Bits that Spark packs into one row of a bit map.
ROW_BITS = 1 << 15

#: Pieces end at these; tabs part words like spaces.
_CUTS = b".,;:!?\n\x0b\x0c\r"
_MAP = bytes.maketrans(_CUTS + b"\t", b"\xff" * len(_CUTS) + b" ")
#: Stands between pieces; no UTF-8 text holds this byte.
_CUT = b"\xff"


class HatTrie:
    """Counts of rows of word ids, all of one width."""

    def __init__(self, burst: int = BURST) -> None:
        self.burst = burst
        self.root: dict = {}
        #: entries below each first word
        self.sizes: dict[int, int] = {}
        self.entries = 0

    def add(self, rows: np.ndarray, counts: np.ndarray) -> None:
        """``rows`` are different, sorted, and big-endian 32-bit integers."""
        counts = counts.tolist()
        for first, lo, hi in _parts(rows[:, 0]):
            if rows.shape[1] == 1:
                known = first in self.root
                self.root[first] = self.root.get(first, 0) + counts[lo]
                grown = not known
            else:
                grown = self._add(self.root, first, rows[lo:hi, 1:], counts[lo:hi])
            self.sizes[first] = self.sizes.get(first, 0) + grown
            self.entries += grown

    def _add(self, parent: dict, word: int, rows: np.ndarray, counts: list[int]) -> int:
        node = parent.get(word)
        if node is None:
            node = parent[word] = {}
        width = rows.shape[1]
        if node and isinstance(next(iter(node)), int):  # a trie node
            return sum(self._add(node, second, rows[lo:hi, 1:], counts[lo:hi]) for second, lo, hi in _parts(rows[:, 0]))
        before = len(node)
        for key, n in zip(_packed(rows), counts, strict=True):
            node[key] = node.get(key, 0) + n
        grown = len(node) - before
        if len(node) > self.burst and width > 1:
            children: dict = {}
            for key, n in node.items():
                children.setdefault(int.from_bytes(key[:4], "big"), {})[key[4:]] = n
            parent[word] = children
        return grown

    def spill(self, most: int) -> Iterator[tuple[bytes, int]]:
        """Takes off the largest subtrees until at most ``most`` entries are left; each comes whole and sorted."""
        taken = []
        for first in sorted(self.sizes, key=self.sizes.__getitem__, reverse=True):
            if self.entries <= most:
                break
            self.entries -= self.sizes.pop(first)
            taken.append(first)
        for first in sorted(taken):
            yield from _walk(first.to_bytes(4, "big"), self.root.pop(first))


def _packed(rows: np.ndarray) -> list[bytes]:
    raw, size = rows.tobytes(), 4 * rows.shape[1]
    return [raw[i : i + size] for i in range(0, len(raw), size)]


def _parts(column: np.ndarray) -> Iterator[tuple[int, int, int]]:
    edges = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), len(column)]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        yield int(column[lo]), lo, hi


def _walk(prefix: bytes, node: dict | int) -> Iterator[tuple[bytes, int]]:
    if isinstance(node, int):
        yield prefix, node
    elif node and isinstance(next(iter(node)), int):
        for word in sorted(node):
            yield from _walk(prefix + word.to_bytes(4, "big"), node[word])
    else:
        for key in sorted(node):
            yield prefix + key, node[key]


class _Words(dict):
    """Ids of words from 1 on; 0 for cuts and for words that are not frequent."""

    def __init__(self, frequent: bytes | None, lang: bytes, most: int) -> None:
        super().__init__({_CUT: 0})
        self.frequent, self.most = frequent, most
        self.seed = crc32(lang + b"\xff")
        self.spelled: list[bytes] = [b""]
        self.hashes = array("I", [0])

    def __missing__(self, word: bytes) -> int:
        own = crc32(word, self.seed)
        if self.frequent is not None:
            at = own & (len(self.frequent) * 8 - 1)
            if not self.frequent[at >> 3] >> (at & 7) & 1:
                if len(self) < self.most:
                    self[word] = 0
                return 0
        self.spelled.append(word)
        self.hashes.append(own)
        self[word] = len(self.spelled) - 1
        return self[word]

    def ids(self, texts: list[str]) -> np.ndarray:
        """The words of the texts; a cut stands between pieces and behind each text."""
        tokens: list[bytes] = []
        for text in texts:
            tokens += text.encode().lower().translate(_MAP).replace(_CUT, b" \xff ").split()
            tokens.append(_CUT)
        self.total = len(tokens) - tokens.count(_CUT)
        return np.fromiter(map(self.__getitem__, tokens), "i8", len(tokens))

    def pair_slots(self, ids: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
        """Where pairs of frequent words begin, and the slot of each."""
        both = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        own = np.array(self.hashes, "u8")
        keys = own[ids[both]] << np.uint64(32) | own[ids[both + 1]]
        return both, scrambled(keys) & np.uint64(slots - 1)


class Counter:
    """The phrases of one language in one task, of ``widths`` words."""

    def __init__(self, lang: str, widths: range, words: bytes | None, pairs: np.ndarray | None, most: int) -> None:
        self.lang, self.widths, self.pairs, self.most = lang, widths, pairs, most
        self.words = _Words(words, lang.encode(), 2 * most)
        self.tries = {width: HatTrie() for width in widths}
        self.total = 0

    def count(self, texts: list[str]) -> Iterator[pa.RecordBatch]:
        ids = self.words.ids(texts)
        self.total += self.words.total
        good = ids > 0
        if self.pairs is not None:
            both, slots = self.words.pair_slots(ids, 8 * len(self.pairs))
            good = np.zeros(max(len(ids) - 1, 0), bool)
            good[both] = self.pairs[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype("u1") & 1
        for width in self.widths:
            reach = width - (self.pairs is not None)  # a phrase is a chain of words, or of pairs
            starts = good[: len(good) - reach + 1].copy() if len(good) >= reach else np.zeros(0, bool)
            for k in range(1, reach):
                starts &= good[k : len(good) - reach + 1 + k]
            at = np.flatnonzero(starts)
            if len(at):
                rows = np.stack([ids[at + k] for k in range(width)], axis=1).astype(">u4")
                self.tries[width].add(*_distinct(rows))
        if sum(t.entries for t in self.tries.values()) > self.most or len(self.words.spelled) > self.most:
            # with too many words, all is written out and ids begin anew
            yield from self.spill(0 if len(self.words.spelled) > self.most else self.most // 2)

    def spill(self, most: int) -> Iterator[pa.RecordBatch]:
        spelled = [w.decode() for w in self.words.spelled]
        share = most // len(self.tries)
        for width, trie in self.tries.items():
            keys: list[bytes] = []
            counts: list[int] = []
            for key, n in trie.spill(share):
                keys.append(key)
                counts.append(n)
                if len(keys) == BATCH:
                    yield self._spelled(width, keys, counts, spelled)
                    keys, counts = [], []
            if keys:
                yield self._spelled(width, keys, counts, spelled)
        if not most:
            if self.widths[0] == 1:
                yield _run(self.lang, [""], [self.total])
            self.total = 0
            self.words = _Words(self.words.frequent, self.lang.encode(), 2 * self.most)

    def _spelled(self, width: int, keys: list[bytes], counts: list[int], spelled: list[str]) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(keys), ">u4").reshape(-1, width)
        columns = [[spelled[i] for i in ids[:, k].tolist()] for k in range(width)]
        texts = list(map(" ".join, zip(*columns, strict=True))) if width > 1 else columns[0]
        return _run(self.lang, texts, counts)


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows, sorted, with their counts."""
    wide = np.ascontiguousarray(rows)
    if wide.shape[1] <= 2:  # as one number
        packed, counts = np.unique(wide[:, 0].astype("u8") << np.uint64(32) * np.uint64(wide.shape[1] - 1) | wide[:, -1], return_counts=True)
        parts = [packed >> np.uint64(32), packed & np.uint64(0xFFFFFFFF)][-wide.shape[1] :]
        return np.stack(parts, axis=1).astype(">u4"), counts
    order = np.lexsort(wide.T[::-1])
    wide = wide[order]
    edges = np.flatnonzero(np.concatenate([[True], (wide[1:] != wide[:-1]).any(axis=1)]))
    return wide[edges], np.diff(np.append(edges, len(wide)))


def _run(lang: str, phrases: list[str], counts: list[int]) -> pa.RecordBatch:
    # one column for language and phrase, parted by a line end, which no phrase holds: rows that are dealt out are small
    columns = [pa.array([f"{lang}\n{p}" for p in phrases], pa.string()), pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["key", "n"])


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """The texts of a run of rows, one language after the other."""
    for batch in batches:
        for lo, hi in text_runs(batch.column(1)):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0)[lo:hi].to_pylist(), batch.column(1)[lo:hi].to_pylist(), strict=True):
                if text:
                    by_lang.setdefault(lang, []).append(text)
            yield from by_lang.items()


def _rows(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))


def phrase_counts(docs: DataFrame, widths: range, lang_col: str = "lang", text_col: str = "text", words=None, pairs=None, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """``lang``, ``width``, ``phrase`` and ``n``: how often each phrase of ``widths`` words stands in the texts.

    ``words`` and ``pairs`` are broadcast bit maps (``frequent_bits``, ``pair_bits``):
    phrases with a word or a pair of words that is not set are left out. With words
    among the widths, an empty phrase of width 0 has the number of all words. A null
    language is ``und``, a null text has no words. Repeated rows count each; other
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_map = None if words is None else words.value
        pair_map = None if pairs is None else np.frombuffer(pairs.value, "u1")
        counters: dict[str, Counter] = {}
        for lang, texts in _by_lang(batches):
            if lang not in counters:
                if len(counters) >= MOST_LANGUAGES:
                    for other in counters.values():
                        yield from other.spill(0)
                    counters = {}
                counters[lang] = Counter(lang, widths, word_map, pair_map, most_entries)
            yield from counters[lang].count(texts)
        for counter in counters.values():
            yield from counter.spill(0)

    runs = _rows(docs, lang_col, text_col).mapInArrow(run, "key string, n long")
    # runs are merged where their prefix lies; three words, as a pair may begin a great many phrases
    dealt = runs.withColumn("part", F.xxhash64(F.substring_index("key", " ", 3))).repartition("part")
    merged = dealt.groupBy("part", "key").agg(F.sum("n").alias("n"))
    phrase = F.substring_index("key", "\n", -1)
    lang = F.expr("substring(key, 1, length(key) - length(substring_index(key, '\\n', -1)) - 1)")
    return merged.select(lang.alias("lang"), F.when(phrase == "", 0).otherwise(F.size(_words(phrase))).alias("width"), phrase.alias("phrase"), "n")


def pair_bits(docs: DataFrame, least: int, words, lang_col: str = "lang", text_col: str = "text", slots: int = PAIR_SLOTS):
    """A broadcast bit map of the slots whose pairs of frequent words stand ``least`` times at least, taken together.

    A pair that stands so often has its bit set; others may share it.
    """
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_map, own, held, n = words.value, {}, [], 0
        for lang, texts in _by_lang(batches):
            if lang not in own:
                own = own if len(own) < MOST_LANGUAGES else {}
                own[lang] = _Words(word_map, lang.encode(), 2 * MOST_ENTRIES)
            ids = own[lang].ids(texts)
            held.append(own[lang].pair_slots(ids, slots)[1].astype("u4"))
            if len(own[lang].spelled) > MOST_ENTRIES:
                del own[lang]
            n += len(held[-1])
            if n > MOST_PAIRS:
                yield _slot_rows(held)
                held, n = [], 0
        if n:
            yield _slot_rows(held)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, places, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row not in sums:
                    sums[row] = np.zeros(SLOT_ROW, "i8")
                sums[row][np.frombuffer(places, "<u2")] += np.frombuffer(counts, "<u4")
        if sums:
            bits = [np.packbits(c >= least, bitorder="little").tobytes() for c in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(bits, pa.binary())], names=["row", "bits"])

    slot_rows = _rows(docs, lang_col, text_col).mapInArrow(count, "row int, places binary, counts binary")
    out = np.zeros((max(1, slots // SLOT_ROW), SLOT_ROW // 8), "u1")
    for row, bits in slot_rows.repartition("row").mapInArrow(total, "row int, bits binary").toLocalIterator():
        out[row] = np.frombuffer(bits, "u1")
    return spark.sparkContext.broadcast(out.tobytes())


def _slot_rows(held: list[np.ndarray]) -> pa.RecordBatch:
    """Counts of the slots, those of a row of the map together: places and counts packed as integers."""
    slots, counts = np.unique(np.concatenate(held), return_counts=True)
    rows = slots // SLOT_ROW
    edges = [0, *(np.flatnonzero(rows[1:] != rows[:-1]) + 1).tolist(), len(slots)]
    places, counts = (slots % SLOT_ROW).astype("<u2").tobytes(), counts.astype("<u4").tobytes()
    parts = list(zip(edges[:-1], edges[1:], strict=True))
    columns = [pa.array(rows[edges[:-1]].astype("i4")), pa.array([places[2 * a : 2 * b] for a, b in parts], pa.binary()), pa.array([counts[4 * a : 4 * b] for a, b in parts], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["row", "places", "counts"])


def frequent_bits(spark: SparkSession, frequent: DataFrame):
    """A broadcast bit map in which the bit of each word (``lang``, ``phrase``) is set.

    Sixteen bits for each word, but 128 MB at most: beyond that the map only tells
    fewer words apart.
    """
    n = frequent.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * n).bit_length()))
    key = F.concat(F.encode("lang", "utf-8"), F.lit(b"\xff"), F.encode("phrase", "utf-8"))
    at = F.crc32(key).bitwiseAND(bits - 1)
    rows = frequent.select((at / ROW_BITS).cast("long").alias("row"), (at % ROW_BITS).alias("bit"))
    out = np.zeros((bits // ROW_BITS, ROW_BITS // 8), "u1")
    for row, packed in rows.groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        out[row, : len(packed)] = np.frombuffer(packed, "u1")
    return spark.sparkContext.broadcast(out.tobytes())


def _words(phrase: Column) -> Column:
    return F.split(phrase, " ", -1)


def collocations(docs: DataFrame, least: int = 100, most_words: int = 5, inside_percent: int = 100, top: int = 2000, lang_col: str = "lang", text_col: str = "text", most_entries: int = MOST_ENTRIES) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    Texts in lower case (A-Z) are cut at ``. , ; : ! ?`` and line ends, words at spaces
    and tabs. Candidates have 2 to ``most_words`` words and stand ``a >= least`` times. Of
    the cuts in two parts, which stand ``l`` and ``r`` times, the one with the smallest
    ``score``, floor(1000 a n / (l r)), counts, and of equal ones the first; ``n`` are
    all words of the language. Candidates within a longer one that stands at least
    ``inside_percent`` per cent as often go. Ranks go by score, ``a`` (both descending) and
    phrase. A null language is ``und``; null and empty texts have no words; repeated rows
    count each; a table without phrases gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    if least < 1 or not 2 <= most_words <= 8:
        raise ValueError("least must be 1 at least, most_words 2 to 8")

    def frequent(widths: range, words=None, pairs=None) -> DataFrame:
        counted = phrase_counts(docs, widths, lang_col, text_col, words, pairs, most_entries)
        return stored(counted.filter((F.col("n") >= least) | (F.col("width") == 0)), "frequent-phrases")

    singles = frequent(range(1, 2))
    words = frequent_bits(spark, singles.filter("width = 1"))
    pairs = pair_bits(docs, least, words, lang_col, text_col)
    known = singles.union(frequent(range(2, most_words + 1), words, pairs))
    words.unpersist()
    pairs.unpersist()
    return _ranked(_outermost(_scored(known), inside_percent), top)


def _scored(known: DataFrame) -> DataFrame:
    """Candidates with the cut that counts; all parts of a frequent phrase are in ``known``."""
    parts = known.filter("width > 0").select("lang", "phrase", "n")
    # a table of its own, one row a language, so that Spark sees how small it is
    totals = stored(known.filter("width = 0").select("lang", F.col("n").alias("total")).coalesce(1), "words-by-language")
    words = _words(F.col("phrase"))
    cut = F.explode(F.sequence(F.lit(1), F.col("width") - 1)).alias("k")
    cuts = known.filter("width > 1").select("lang", "phrase", "width", F.col("n").alias("a"), cut)
    cuts = cuts.withColumns({"left": F.array_join(F.slice(words, 1, F.col("k")), " "), "right": F.array_join(F.slice(words, F.col("k") + 1, F.col("width") - F.col("k")), " ")})
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals, "lang")
    cuts = cuts.withColumn("score", F.expr("(cast(a as decimal(16,0)) * cast(total as decimal(16,0)) * 1000BD) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    best = cuts.groupBy("lang", "phrase", "width").agg(F.min(F.struct("score", "k", "a", "l", "r", "total")).alias("best"))
    return best.select("lang", "phrase", "width", "best.a", "best.l", "best.r", F.col("best.total").alias("n"), "best.score")


def _outermost(scored: DataFrame, inside_percent: int) -> DataFrame:
    """Without those that stand inside a longer candidate nearly as often."""
    words = _words(F.col("phrase"))
    size = F.explode(F.sequence(F.lit(2), F.col("width") - 1)).alias("size")
    inner = scored.filter("width > 2").select("lang", "phrase", "width", F.col("a").alias("longer"), size)
    inner = inner.select("lang", "longer", words.alias("words"), "size", F.explode(F.sequence(F.lit(1), F.col("width") - F.col("size") + 1)).alias("first"))
    inner = inner.select("lang", "longer", F.array_join(F.slice("words", F.col("first"), F.col("size")), " ").alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    inside = F.lit(100).cast("decimal(3,0)") * F.col("longer") >= F.lit(inside_percent).cast("decimal(10,0)") * F.col("a")
    return scored.join(most, ["lang", "phrase"], "left").filter(F.coalesce(~inside, F.lit(True))).drop("longer", "width")


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    """Ranks from 1 to ``top``, step by step: counts of score classes, of finer ones, then ranks within those.

    A class is a power of 2, a finer one a 64th of it, so that only a few counts of a
    whole language come together; classes that lie beyond ``top`` are not sorted.
    """
    fine = F.floor(64 * F.log2(F.greatest(F.col("score"), F.lit(0)) + F.lit(1.0))).cast("int")
    rows = stored(rows.withColumns({"fine": fine, "band": F.floor(fine / 64).cast("int")}), "scored-phrases")
    bands = _ahead(rows, ["lang"], "band").filter(F.col("ahead") < top)
    fines = _ahead(rows, ["lang", "band"], "fine").withColumnRenamed("ahead", "more")
    ahead = fines.join(bands, ["lang", "band"]).select("lang", "fine", (F.col("ahead") + F.col("more")).alias("ahead")).filter(F.col("ahead") < top)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = rows.join(ahead, ["lang", "fine"]).withColumn("place", F.row_number().over(Window.partitionBy("lang", "fine").orderBy(*order)))
    ranked = ranked.filter(F.col("place") <= top).withColumn("rank", (F.col("ahead") + F.col("place")).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _ahead(rows: DataFrame, keys: list[str], by: str) -> DataFrame:
    """How many rows of the same keys have a greater value of ``by``."""
    before = Window.partitionBy(*keys).orderBy(F.desc(by)).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*keys, by).agg(F.count("*").alias("many"))
    return counts.select(*keys, by, F.coalesce(F.sum("many").over(before), F.lit(0)).alias("ahead"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases by how much oftener they stand than their parts would by chance."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = {
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), words AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), sizes AS (
            SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
        ), grams AS (
            SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)
            GROUP BY ALL HAVING count(*) >= 100
        ), cuts AS (
            SELECT g.lang, g.phrase, g.k, c.cut_at, g.f AS a, l.f AS l, r.f AS r, s.n,
                   CAST(CAST(1000 AS HUGEINT) * g.f * s.n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
            FROM grams g, (SELECT unnest(range(1, 5)) AS cut_at) c, grams l, grams r, sizes s
            WHERE g.k > 1 AND c.cut_at < g.k AND l.lang = g.lang AND r.lang = g.lang AND s.lang = g.lang AND l.k = c.cut_at
              AND l.phrase = array_to_string(string_split(g.phrase, ' ')[:c.cut_at], ' ')
              AND r.phrase = array_to_string(string_split(g.phrase, ' ')[c.cut_at + 1:], ' ')
        ), best AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1
        ), outer_ones AS (
            SELECT * FROM best b WHERE NOT EXISTS (
                SELECT 1 FROM best o WHERE o.lang = b.lang AND o.k > b.k AND 100 * o.a >= 100 * b.a
                                       AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' '))
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM outer_ones QUALIFY rank <= 2000
    """,
}
