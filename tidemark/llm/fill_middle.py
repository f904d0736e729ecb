"""Fill-in-middle transformation by in-place block rotation.

A text is cut into prefix, middle and suffix at two token borders. Sentinels are put
in front of the three segments in a bytearray, ``<P>prefix<M>middle<S>suffix``; then
neighbouring blocks exchange their places by a rotation, which is three reversals:
of the first block, of the second, and of both together. Rotating back and taking the
sentinels out restores the text exactly. Texts that hold a sentinel stay plain, so the
sentinels of an output are found without doubt.

Each text is worked on for itself in one task; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, text_runs
from tidemark.llm.shingles import SPACES

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"


def rotate(buffer: bytearray, low: int, mid: int, high: int) -> None:
    """Exchanges the neighbouring blocks ``low:mid`` and ``mid:high`` where they stand."""
    for a, b in ((low, mid), (mid, high), (low, high)):
        buffer[a:b] = buffer[a:b][::-1]


def token_ends(raw: bytes) -> np.ndarray:
    """Where the tokens end: a word with the white space before it, or white space at the end of the text."""
    if not raw:
        return np.zeros(0, "i8")
    blank = np.append(SPACES[np.frombuffer(raw, "u1")], True)
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return ends if len(ends) and ends[-1] == len(raw) else np.append(ends, len(raw))


def draws(key: str, seed: int) -> list[int]:
    digest = sha256(f"{seed}:{key}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def transformed(raw: bytes, key: str, seed: int, rate: int, spm_rate: int) -> tuple[int, str, int | None, int | None, bytes]:
    """Number of tokens, form, code points of prefix and middle, and the output of one text."""
    ends = token_ends(raw)
    first, second, third, fourth = draws(key, seed)
    if not raw or PREFIX in raw or SUFFIX in raw or MIDDLE in raw or third % 100 >= rate:
        return len(ends), "plain", None, None, raw
    borders = sorted((first % (len(ends) + 1), second % (len(ends) + 1)))
    a, b = (int(ends[c - 1]) if c else 0 for c in borders)
    buffer = bytearray(raw)
    for at, sentinel in ((b, SUFFIX), (a, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    middle, suffix, end = a + len(PREFIX), b + len(PREFIX + MIDDLE), len(buffer)
    if fourth % 100 < spm_rate:
        form = "spm"
        rotate(buffer, 0, suffix, end)
    else:
        form = "psm"
        rotate(buffer, middle, suffix, end)
    return len(ends), form, len(raw[:a].decode()), len(raw[a:b].decode()), bytes(buffer)


def untransformed(output: bytes, form: str) -> bytes:
    """The text that ``transformed`` made the output from."""
    if form == "plain":
        return output
    buffer, end = bytearray(output), len(output)
    middle = buffer.find(MIDDLE)
    if form == "spm":  # <S>suffix<P>prefix<M>middle
        prefix = buffer.find(PREFIX)
        rotate(buffer, 0, prefix, end)
        middle, suffix = middle - prefix, end - prefix
    elif form == "psm":  # <P>prefix<S>suffix<M>middle
        suffix = buffer.find(SUFFIX)
        rotate(buffer, suffix, middle, end)
        middle, suffix = suffix, suffix + end - middle
    else:
        raise ValueError(f"unknown form {form!r}")
    for at, sentinel in ((suffix, SUFFIX), (middle, MIDDLE), (0, PREFIX)):
        if buffer[at : at + len(sentinel)] != sentinel:
            raise ValueError(f"no output of form {form}")
        del buffer[at : at + len(sentinel)]
    return bytes(buffer)


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """One row per row: its id, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``n`` counts the tokens, words with the white space before them. The id and ``seed``
    decide on the two cuts, on whether a text is transformed (``rate`` per cent) and on
    its form (``spm_rate`` per cent of those: suffix first). A null text counts as empty;
    empty texts and texts that hold a sentinel stay plain, with null counts. Rows that
    repeat an id and its text give equal rows, a null id draws like an empty one. Other
    columns are ignored.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_runs(batch.column(2)):
                part = batch.slice(lo, hi - lo)
                done = [transformed((t or "").encode(), k or "", seed, rate, spm_rate) for k, t in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)]
                n, form, prefix, middle, output = zip(*done, strict=True)
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col(id_col), F.col(id_col).cast("string").alias("__key"), F.col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(run, schema)


def restore(rows: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """The rows with ``restored`` in the place of the output: the text it was made from.

    Of output and form alone. A null output or form restores to null; a form that is
    not known, or an output without its sentinels, is an error.
    """
    others = [c for c in rows.columns if c not in (output_col, "restored")]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in others) + ", restored string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_runs(batch.column(0)):
                part = batch.slice(lo, hi - lo)
                texts = [
                    None if output is None or form is None else untransformed(output.encode(), form)
                    for output, form in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[2:], pa.array(texts, pa.binary()).cast(pa.string())], names=[*others, "restored"])

    return rows.select(F.col(output_col).alias("__output"), F.col(form_col).alias("__form"), *others).mapInArrow(run, schema)


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's form, and digests of its output and of the text restored from that."""
    made = fill_middle(table(spark, sf_dir, "documents"))
    kept = made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), "output")
    return restore(kept).select(*kept.columns[:-1], F.sha2("restored", 256).alias("restored_sha256"))


SQL = {
    "op13_fill_middle": r"""
        WITH tokens AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || CAST(doc_id AS VARCHAR)) AS h,
                   regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t
            FROM documents
        ), drawn AS (
            SELECT doc_id, text, t, len(t) AS n,
                   CAST('0x' || h[1:8] AS BIGINT) % (len(t) + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (len(t) + 1) AS c2,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
                        WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM tokens
        ), cut AS (
            SELECT doc_id, text, n, form, array_to_string(t[1:least(c1, c2)], '') AS p,
                   array_to_string(t[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
                   array_to_string(t[greatest(c1, c2) + 1:], '') AS s
            FROM drawn
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                                ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM cut
    """,
}
