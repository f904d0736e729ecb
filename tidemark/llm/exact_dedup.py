"""Exact deduplication by skew-safe combining, with DataFrame functions only.

Copies are merged three times, each time comparing the whole text next to its
digest: within a task (the map side of the first aggregation), within a salted
digest group (its reduce side), and over the salts of a digest (a window over at
most ``salts`` rows per text). However many copies a text has, a task sends one row
per salt, and no later step sees more than ``salts`` rows of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table, tasks


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _salted(docs: DataFrame, id_col: str, text_col: str, salts: int | None, digest) -> DataFrame:
    salts = salts or max(64, tasks(docs.sparkSession))
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns(
        {
            "__text": text,
            "__digest": digest(text),
            "__salt": F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int"),
        }
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int | None = None,
    digest=sha256,
) -> DataFrame:
    """One row per input row: its id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Rows with the same text form a group; the largest id is kept. A null text counts
    as empty. A null id loses against any other; a group of null ids keeps null.
    Rows that repeat an id and its text are all marked as kept (``deduplicate`` leaves
    one of them). Other columns are ignored. ``digest`` only deals out the rows: texts
    that share a digest are told apart by their content.
    """
    rows = _salted(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")), "__id", "__t", salts, digest)
    salted = rows.groupBy("__digest", "__salt", "__text").agg(
        F.max("__id").alias("__id"), F.count("*").alias("__n")
    )
    same_digest, same_text = Window.partitionBy("__digest"), Window.partitionBy("__digest", "__text")
    winners = stored(
        salted.select(
            "__digest",
            "__salt",
            F.max("__id").over(same_text).alias("keep_id"),
            F.sum("__n").over(same_text).alias("group_size"),
            # the text is needed further only where a digest stands for several
            F.when(
                F.min("__text").over(same_digest) != F.max("__text").over(same_digest),
                F.col("__text"),
            ).alias("__shared"),
        ),
        "exact-groups",
    )
    match = ["__digest", "__salt"]
    several = not winners.filter(F.col("__shared").isNotNull()).isEmpty()
    right = winners.select(*[F.col(c).alias(f"{c}_r") for c in match], "keep_id", "group_size", "__shared")
    on = [F.col(c) == F.col(f"{c}_r") for c in match]
    if several:
        on.append(F.coalesce(F.col("__shared"), F.col("__text")) == F.col("__text"))
    return rows.join(right, on).select(
        F.col("__id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.sha2("__text", 256).alias("text_sha256") if several or digest is not sha256 else F.lower(F.hex("__digest")).alias("text_sha256"),
    )


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int | None = None,
    digest=sha256,
) -> DataFrame:
    """The input's columns, one row for each distinct text: that of the largest id.

    The row travels with its text through the same three merges, so nothing is joined
    back. A null and an empty text are the same. Equal ids are told apart by their
    other columns, so the result does not depend on the order of rows.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    rows = _salted(docs, id_col, text_col, salts, digest)
    key = F.struct(F.col(id_col), *[F.col(c) for c in others], F.col(text_col).isNull().alias("__null"))
    best = rows.groupBy("__digest", "__salt", "__text").agg(F.max(key).alias("__row"))
    best = best.groupBy("__digest", "__text").agg(F.max("__row").alias("__row"))
    return best.select(
        *[
            F.when(~F.col("__row.__null"), F.col("__text")).alias(c) if c == text_col else F.col("__row")[c].alias(c)
            for c in docs.columns
        ]
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id of the copy that stays."""
    return exact_groups(table(spark, sf_dir, "documents"))


SQL = {
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
}
