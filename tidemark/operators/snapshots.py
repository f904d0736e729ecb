"""Changes between two snapshots of a table, deletes by absence among them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import orderable

CHANGE = "change"
INSERT, UPDATE, DELETE = "insert", "update", "delete"


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int = 1024) -> DataFrame:
    """What turns ``old`` into ``new``: their columns and ``change`` (insert, update, delete).

    A key stands once in each snapshot; null key parts compare as equal. An inserted or
    updated row has its new content, a deleted one its old. Each side is summed up in
    ``buckets`` of keys by count, sum and exclusive or of row hashes; only rows of buckets
    whose sums differ are joined and compared, so snapshots that hardly differ shuffle
    little. (Two different contents with the same sums, a chance of about 2^-100, would
    pass as equal.) Both sides need the same columns.
    """
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("the snapshots have different columns")
    if not set(keys) <= set(new.columns):
        raise ValueError("a key is not among the columns")
    columns = new.columns
    before, after = (_dealt(side.select(*columns), keys, buckets) for side in (old, new))
    sums = _sums(before).join(_sums(after).withColumnsRenamed({"n": "n2", "s": "s2", "x": "x2"}), "_part", "full")
    same = F.col("n").eqNullSafe(F.col("n2")) & F.col("s").eqNullSafe(F.col("s2")) & F.col("x").eqNullSafe(F.col("x2"))
    # one row per bucket at most, which Spark may broadcast by its size
    differing = sums.filter(~same).select("_part")
    before = before.join(differing, "_part", "left_semi").select(*[F.col(c).alias(f"_old_{c}") for c in before.columns])
    after = after.join(differing, "_part", "left_semi")
    match = F.col("_part") == F.col("_old__part")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_old_{k}"))
    joined = after.join(before, match, "full")
    gone, came = F.col("_part").isNull(), F.col("_old__part").isNull()
    change = F.when(gone, DELETE).when(came, INSERT).when(~_equal(new, columns), UPDATE)
    return (
        joined.withColumn(CHANGE, change)
        .filter(F.col(CHANGE).isNotNull())
        .select(*[F.when(gone, F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) for c in columns], CHANGE)
    )


def _dealt(side: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return side.withColumn("_part", F.pmod(F.xxhash64(*[orderable(side, k) for k in keys]), F.lit(buckets)))


def _sums(side: DataFrame) -> DataFrame:
    content = F.xxhash64(*[_content(side, c) for c in side.columns])
    rows = side.select("_part", content.alias("h"))
    return rows.groupBy("_part").agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64("h")).alias("x"))


def _content(side: DataFrame, name: str) -> Column:
    """The column and whether it is null, as a hash skips nulls."""
    return F.struct(orderable(side, name), F.col(name).isNull())


def _equal(side: DataFrame, columns: Sequence[str]) -> Column:
    same = F.lit(True)
    for c in columns:
        comparable = orderable(side, c)
        if comparable is not None and side.schema[c].dataType.simpleString().startswith("map"):
            same = same & F.to_json(F.struct(F.col(c).alias("v"))).eqNullSafe(F.to_json(F.struct(F.col(f"_old_{c}").alias("v"))))
        else:
            same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    return same
