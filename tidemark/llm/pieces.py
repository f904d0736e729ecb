"""SentencePiece encoding that keeps source offsets, and decoding.

Text goes through the model's compiled character map, longest prefix first; every
normalised character remembers the source byte it came from. The normalised text is
merged by byte-pair ranks, and each piece is projected to its span of source bytes.

No piece of such a model has a space mark behind another character, so nothing
merges across the start of a run of marks: the text falls apart into chunks that are
merged independently. Chunks repeat a lot; each task keeps a bounded table of those
it has seen and merges the new ones of a batch side by side in arrays.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, text_runs

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
TOKEN = np.dtype([("id", "<u4"), ("width", "<u2")])
NEVER = np.iinfo(np.int64).max


class CharMap:
    """The compiled map: a double-array trie over UTF-8 keys and the strings that replace them."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[str, int] | None:
        """What replaces the longest key that starts at ``at``, and the key's length."""
        units, best = self.units, None
        node = self._offset(units[0])
        for length, byte in enumerate(data[at:], 1):
            node ^= byte
            if node >= len(units):
                break
            unit = units[node]
            if (unit & 0x800000FF) != byte:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                best = units[node] & 0x7FFFFFFF, length
        if best is None:
            return None
        start = best[0]
        return self.strings[start : self.strings.index(b"\0", start)].decode(), best[1]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)


class Pieces:
    """A BPE model with byte fallback, ready for encoding and decoding in one task.

    Other kinds of models, and pieces that users defined or left unused, are refused.
    """

    def __init__(self, model: bytes, most_chunks: int = 250_000):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        spec, kinds = proto.normalizer_spec, {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback:
            raise ValueError("only BPE models with byte fallback are supported")
        if kinds & {USER, UNUSED} or not spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("user-defined or unused pieces, unescaped or trailing white space are not supported")
        blob = spec.precompiled_charsmap
        self.char_map = CharMap(blob) if blob else None
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.begin, self.end = proto.trainer_spec.bos_id, proto.trainer_spec.eos_id
        self.kind = np.array([p.type for p in proto.pieces], "u1")
        self.byte_of = {i: int(p.piece[3:5], 16) for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        self.shown = [
            p.piece.replace(MARK, " ") if p.type == NORMAL
            else proto.trainer_spec.unk_surface if p.type == UNKNOWN
            else chr(self.byte_of[i]) if p.type == BYTE and self.byte_of[i] < 128
            else ""
            for i, p in enumerate(proto.pieces)
        ]
        self.high_bytes = np.array([i for i, b in sorted(self.byte_of.items()) if b >= 128], "u4")
        self._merges([(p.piece, p.score, i) for i, p in enumerate(proto.pieces) if p.type == NORMAL])
        self.fast = self.char_map is None and self.prefix and not self.squeeze
        self.most = most_chunks
        self.seen: dict[str, bytes] = {}
        self.seen_chunks: dict[str, bytes] = {}

    def _merges(self, normal: list[tuple[str, float, int]]) -> None:
        """Symbols are all pieces, then the characters that only occur inside pieces."""
        if any(MARK in p.lstrip(MARK) for p, _, _ in normal):
            raise ValueError("a piece has a space mark behind another character")
        self.newline_alone = not any("\n" in p and len(p) > 1 for p, _, _ in normal)
        names = [p for p, _, _ in normal]
        symbol = {p: i for i, p in enumerate(names)}
        for c in sorted({c for p in names for c in p} - symbol.keys()):
            symbol[c] = len(symbol)
        self.symbol, self.count = symbol, len(symbol)
        self.piece_id = np.full(self.count, -1, "i8")
        self.piece_id[: len(names)] = [i for _, _, i in normal]
        self.source_width = np.array([len(s.encode()) - 2 * s.count(MARK) for s in symbol], "i8")
        rank = {s: r for r, s in enumerate(sorted({s for _, s, _ in normal}, reverse=True))}
        self.pairs: dict[int, tuple[int, int]] = {}
        for piece, score, _ in normal:
            for cut in range(1, len(piece)):
                left, right = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if left is not None and right is not None:
                    self.pairs[left * self.count + right] = (rank[score], symbol[piece])
        keys = sorted(self.pairs)
        self.keys = np.array([*keys, NEVER], "i8")
        self.ranks = np.array([*(self.pairs[k][0] for k in keys), 0], "i8")
        self.merged = np.array([*(self.pairs[k][1] for k in keys), 0], "i4")
        self.of_char = np.full(0x110000, -1, "i4")
        for s, i in symbol.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i

    # -- normalisation ---------------------------------------------------------------

    def normalised(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its characters and its end, the source byte offset."""
        if self.char_map is None and not self.squeeze:
            if not text:
                return "", np.zeros(1, "u4")
            code = np.frombuffer(text.encode("utf-32-le"), "<u4")
            width = 1 + (code >= 0x80).astype("u4") + (code >= 0x800) + (code >= 0x10000)
            at = np.concatenate([np.zeros(1 + self.prefix, "u4"), np.cumsum(width, dtype="u4")])
            return MARK * self.prefix + text.replace(" ", MARK), at
        data = text.encode()
        at, out, offsets = 0, [], []
        steps = []
        while at < len(data):
            found = self.char_map.longest(data, at) if self.char_map else None
            if found is None:
                byte = data[at]
                length = 1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                found = data[at : at + length].decode(), length
            steps.append((*found, at))
            at += found[1]
        first, end = 0, len(data)
        if self.squeeze:
            while first < len(steps) and steps[first][0] == " ":
                first += 1
        if first == len(steps):
            return "", np.zeros(1, "u4")
        if self.prefix:
            out.append(MARK)
            offsets.append(steps[first][2])
        blank = self.squeeze
        for shown, _, start in steps[first:]:
            if blank:
                shown = shown.lstrip(" ")
            out.append(shown.replace(" ", MARK))
            offsets.extend([start] * len(shown))
            if shown:
                blank = self.squeeze and shown.endswith(" ")
        whole = "".join(out)
        if self.squeeze:
            while whole.endswith(MARK):
                whole, end = whole[:-1], offsets.pop()
        return whole, np.array([*offsets, end], "u4")

    # -- merging ---------------------------------------------------------------------

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype("i8") * self.count + right
        at = np.searchsorted(self.keys, key)
        fits = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(fits, self.ranks[at], NEVER), self.merged[at]

    def _merge_long(self, symbols: list[int]) -> tuple[list[int], list[int]]:
        """One long chunk, with a heap: symbols that remain and the characters in each."""
        n = len(symbols)
        after, before, wide, heap = list(range(1, n + 1)), list(range(-1, n - 1)), [1] * n, []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else n
            if j < n and symbols[i] >= 0 and symbols[j] >= 0:
                found = self.pairs.get(symbols[i] * self.count + symbols[j])
                if found:
                    heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], found[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, right, both = heapq.heappop(heap)
            j = after[i]
            if not wide[i] or symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], wide[i], wide[j], after[i] = both, wide[i] + wide[j], 0, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        stay = [i for i in range(n) if wide[i]]
        return [symbols[i] for i in stay], [wide[i] for i in stay]

    def merged_chunks(self, chunks: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Groups of chunks: their numbers, lengths in symbols, and symbols after merging with their characters.

        A negative symbol is a character without piece.
        """
        short = []
        for i, c in enumerate(chunks):
            if len(c) > 48:
                sym, wide = self._merge_long(self.of_char[np.frombuffer(c.encode("utf-32-le"), "<u4")].tolist())
                yield np.array([i]), np.array([len(sym)]), np.array(sym, "i4"), np.array(wide, "i4")
            else:
                short.append(i)
        if not short:
            return
        numbers = np.array(short)
        sizes = np.array([len(chunks[i]) for i in short])
        sym = self.of_char[np.frombuffer("".join(chunks[i] for i in short).encode("utf-32-le"), "<u4")]
        word, wide = np.repeat(np.arange(len(short)), sizes), np.ones(len(sym), "i4")
        rank, target = np.full(len(sym), NEVER), np.zeros(len(sym), "i4")
        same = np.flatnonzero(word[1:] == word[:-1])
        rank[same], target[same] = self._lookup(sym[same], sym[same + 1])
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lengths = np.diff(np.append(starts, len(word)))
            least = np.minimum.reduceat(rank, starts)
            done = least == NEVER
            ends = np.repeat(done, lengths)
            if done.any():
                yield numbers[word[starts[done]]], lengths[done], sym[ends], wide[ends]
            # of each other chunk the leftmost pair of the least rank
            hits = np.flatnonzero((rank == np.repeat(least, lengths)) & ~ends)
            hits = hits[np.concatenate([[True], word[hits][1:] != word[hits][:-1]])] if len(hits) else hits
            sym[hits] = target[hits]
            wide[hits] += wide[hits + 1]
            rank[hits] = rank[hits + 1]
            keep = ~ends
            keep[hits + 1] = False
            at = np.cumsum(keep) - 1
            hits = at[hits]
            sym, word, wide, rank, target = sym[keep], word[keep], wide[keep], rank[keep], target[keep]
            changed = np.union1d(hits, hits[hits > 0] - 1)
            last = changed == len(sym) - 1
            if last.any():
                rank[-1], changed = NEVER, changed[~last]
            inside = word[changed] == word[changed + 1] if len(changed) else changed.astype(bool)
            rank[changed[~inside]] = NEVER
            changed = changed[inside]
            rank[changed], target[changed] = self._lookup(sym[changed], sym[changed + 1])

    def _records(self, chunks: list[str], keys: list[str], of_source: bool) -> dict[str, bytes]:
        """Packed tokens by key; widths in source bytes (a mark counts one) or in characters."""
        found = {}
        for numbers, lengths, sym, wide in self.merged_chunks(chunks):
            tokens = np.empty(len(sym), TOKEN)
            ids = np.where(sym >= 0, self.piece_id[sym], -1)
            tokens["id"] = np.maximum(ids, 0)
            tokens["width"] = self.source_width[sym] if of_source else wide
            packed, size = tokens.tobytes(), TOKEN.itemsize
            stops = np.cumsum(lengths)
            spelled = np.minimum.reduceat(ids, stops - lengths) < 0
            for n, lo, hi, spell in zip(numbers.tolist(), (stops - lengths).tolist(), stops.tolist(), spelled.tolist(), strict=True):
                found[keys[n]] = self._spelled(chunks[n], ids[lo:hi].tolist(), wide[lo:hi].tolist(), of_source) if spell else packed[lo * size : hi * size]
        return found

    def _spelled(self, chunk: str, ids: list[int], wide: list[int], of_source: bool) -> bytes:
        """Tokens of a chunk some of whose characters have no piece and are spelled in bytes."""
        at, tokens = 0, []
        for i, w in zip(ids, wide, strict=True):
            part = chunk[at : at + w]
            at += w
            size = (len(part.encode()) - 2 * part.count(MARK)) if of_source else w
            if i >= 0:
                tokens.append((i, size))
            else:  # the last byte stands for the whole character
                data = part.encode()
                tokens += [(self.byte_id[b], 0) for b in data[:-1]] + [(self.byte_id[data[-1]], size)]
        return np.array(tokens, TOKEN).tobytes()

    # -- whole texts -----------------------------------------------------------------

    def _plain(self, text: str) -> bool:
        """Whether a space always stands between two words, so that splitting at spaces gives the chunks."""
        return bool(text) and self.fast and self.newline_alone and text[0] != " " and MARK not in text and "  " not in text and " \n" not in text

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids, with begin and end id, and their (begin, end) byte spans in the source."""
        # A line break merges with nothing: what follows it is a chunk without mark.
        split = [t.replace("\n", " \n").split(" ") if self._plain(t) else None for t in texts]
        new = set(chain.from_iterable(s for s in split if s)) - self.seen.keys()
        if len(self.seen) + len(new) > self.most:
            self.seen.clear()
            new = set(chain.from_iterable(s for s in split if s))
        if new:
            keys = list(new)
            self.seen.update(self._records([k if k[:1] == "\n" else MARK + k for k in keys], keys, True))
        for text, words in zip(texts, split, strict=True):
            if words is not None:
                tokens = np.frombuffer(b"".join(map(self.seen.__getitem__, words)), TOKEN)
                width = tokens["width"].astype("u4")
                width[0] -= 1  # the first mark has no source
                stops = np.cumsum(width, dtype="u4")
                starts = stops - width
            else:
                shown, offsets = self.normalised(text)
                chunks = re.findall(f"{MARK}+[^{MARK}]*|^[^{MARK}]+", shown)
                tokens = np.frombuffer(b"".join(map(self._chunk, chunks)), TOKEN)
                stops = np.cumsum(tokens["width"], dtype="u4")
                starts, stops = offsets[stops - tokens["width"]], offsets[stops]
            n = len(tokens)
            ids, spans = np.empty(n + 2, "<u4"), np.zeros((n + 2, 2), "<u4")
            ids[0], ids[-1], ids[1:-1] = self.begin, self.end, tokens["id"]
            spans[1:-1, 0], spans[1:-1, 1] = starts, stops
            spans[-1] = len(text.encode()) if n else 0
            yield ids, spans

    def _chunk(self, chunk: str) -> bytes:
        found = self.seen_chunks.get(chunk)
        if found is None:
            if len(self.seen_chunks) >= self.most // 10:
                self.seen_chunks.clear()
            found = self.seen_chunks[chunk] = self._records([chunk], [chunk], False)[chunk]
        return found

    def decode(self, ids: np.ndarray) -> str:
        """As the library's decode(ids): control ids vanish, runs of byte ids are read as UTF-8."""
        shown = list(map(self.shown.__getitem__, ids.tolist()))
        if len(ids) and np.isin(ids, self.high_bytes).any():
            self._read_bytes(ids, shown)
        kinds = self.kind[ids]
        first = int(np.argmax(kinds != CONTROL)) if (kinds != CONTROL).any() else -1
        if first >= 0 and kinds[first] == NORMAL and (self.prefix or self.squeeze):
            while shown[first].startswith(" "):
                shown[first] = shown[first][1:]
                if not self.squeeze:
                    break
        return "".join(shown)

    def _read_bytes(self, ids: np.ndarray, shown: list[str]) -> None:
        is_byte = np.concatenate([[False], self.kind[ids] == BYTE, [False]])
        edges = np.flatnonzero(is_byte[1:] != is_byte[:-1])
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            data, at, out = bytes(self.byte_of[i] for i in ids[lo:hi].tolist()), 0, []
            while at < len(data):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(data[at : at + n].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    n = 1
                at += n
            shown[lo:hi] = ["".join(out), *[""] * (hi - lo - 1)]


@lru_cache(maxsize=1)
def _pieces(model: bytes) -> Pieces:
    return Pieces(model)


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """One row per row: its id, ``ids``, ``spans`` and, if asked for, ``decoded``.

    ``ids`` packs the token ids, with begin and end id, as little-endian unsigned
    32-bit integers; ``spans`` packs a begin and an end for each of them: the bytes of the
    source text that the piece stands for. The begin id's span lies before the first
    byte, the end id's behind the last; of a character spelled in bytes the last byte's
    span is the character and the others' are empty. ``decoded`` is what the ids decode
    to. A null text is encoded as an empty one: begin and end id alone.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, ids binary, spans binary" + ", decoded string" * decode

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for batch in batches:
            for lo, hi in text_runs(batch.column(1), 1 << 19):
                part = batch.slice(lo, hi - lo)
                done = list(pieces.encode([t or "" for t in part.column(1).to_pylist()]))
                columns = [part.column(0), pa.array([i.tobytes() for i, _ in done], pa.binary()), pa.array([s.tobytes() for _, s in done], pa.binary())]
                if decode:
                    columns.append(pa.array([pieces.decode(i) for i, _ in done], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "ids", "spans", "decoded"][: len(columns)])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row: its id and ``decoded``, the text of its packed ids; null ids give an empty text."""
    schema = f"`{id_col}` {encoded.schema[id_col].dataType.simpleString()}, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        for batch in batches:
            texts = [pieces.decode(np.frombuffer(i or b"", "<u4")) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "decoded"])

    return encoded.select(id_col, ids_col).mapInArrow(run, schema)


def public_model() -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    encoded = encode(docs, model, decode=True)
    return encoded.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.sha2("spans", 256).alias("spans_sha256"),
    )


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, their spans and the text they decode to, as digests."""
    return digests(table(spark, sf_dir, "documents"), public_model())
