"""Surrogate keys that stay the same when a dimension is recomputed.

``ordinal``: the position of a row in key order, counted from zero. No long dimension
is sorted in one task: the key range is cut at markers taken from the keys
themselves (see ``functions.search``), about one in ``rows_per_bucket``, so a short
dimension has none. Rows are numbered within their bucket and shifted by the number
of rows in the buckets before it. Only the markers and the bucket sizes pass through
a scalar subquery; nothing is counted when the plan is built.

``hash``: a 64-bit hash of the key. Two keys may share one (to be expected from some
10^9 keys), which fails the job under ``unique``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.search import count_not_above, is_marker

METHODS = ("ordinal", "hash")
ROWS_PER_BUCKET = 1_000_000


def surrogate_key(
    df: DataFrame,
    keys: str | list[str],
    name: str,
    method: str = "ordinal",
    rows_per_bucket: int = ROWS_PER_BUCKET,
    unique: bool = True,
) -> DataFrame:
    """Append the surrogate ``name`` for the business ``keys``.

    With ``unique`` (the rule for a dimension) a repeated key fails the job when
    it is met. ``unique=False`` numbers repeated keys one by one, ordered by a
    hash of the whole row, which also spreads a hot key over several buckets.
    """
    key_names = [keys] if isinstance(keys, str) else list(keys)
    if not key_names:
        raise ValueError("a surrogate key needs at least one business key column")
    if name in df.columns:
        raise ValueError(f"column {name!r} exists already")
    if method == "hash":
        hashed = df.withColumn(name, F.xxhash64(*[F.col(k) for k in key_names]))
        return _checked(hashed, name) if unique else hashed
    if method != "ordinal":
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    return _ordinal(df, key_names, name, rows_per_bucket, unique)


def _checked(df: DataFrame, name: str) -> DataFrame:
    """Fails the job where two rows share the hash id; ids are shuffled once for it."""
    rows = F.count(F.lit(1)).over(Window.partitionBy(name))
    complaint = F.raise_error(F.concat(F.lit("repeated hash id "), F.col(name))).cast("long")
    return df.withColumn(name, F.when(rows > 1, complaint).otherwise(F.col(name)))


def duplicate_keys(df: DataFrame, keys: str | list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    key_names = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*key_names).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def _order_parts(df: DataFrame, key_names: list[str], unique: bool) -> list[Column]:
    parts = [F.col(k) for k in key_names]
    if not unique:
        parts.append(F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in df.columns]))))
    return [p.alias(f"k{i}") for i, p in enumerate(parts)]


def _ordinal(
    df: DataFrame, key_names: list[str], name: str, rows_per_bucket: int, unique: bool
) -> DataFrame:
    ordered = df.withColumn("_order", F.struct(*_order_parts(df, key_names, unique)))
    markers = _markers(ordered, rows_per_bucket)
    placed = _bucketed(ordered, markers).withColumn("_offsets", _offsets(ordered, markers))
    # Bucket b > 0 holds at least marker b, so only bucket 0 can be missing from the list.
    position = F.col("_bucket") + 1 - F.col("_offsets")[0]["_bucket"]
    start = F.element_at("_offsets", position)["offset"]

    by_order = Window.partitionBy("_bucket").orderBy("_order")
    ordinal = start + F.row_number().over(by_order) - 1
    if unique:
        repeated = F.lag("_order").over(by_order) == F.col("_order")
        complaint = F.concat(F.lit("repeated business key "), F.to_json(F.col("_order")))
        ordinal = F.when(repeated, F.raise_error(complaint).cast("long")).otherwise(ordinal)
    return placed.withColumn(name, ordinal.cast("long")).select(*df.columns, name)


def _markers(ordered: DataFrame, rows_per_bucket: int) -> Column:
    return (
        ordered.filter(is_marker(F.col("_order"), rows_per_bucket))
        .agg(F.sort_array(F.collect_set("_order")).alias("markers"))
        .scalar()
    )


def _bucketed(ordered: DataFrame, markers: Column) -> DataFrame:
    return (
        ordered.withColumn("_markers", markers)
        .withColumn("_bucket", count_not_above(F.col("_markers"), F.col("_order")))
        .drop("_markers")
    )


def _offsets(ordered: DataFrame, markers: Column) -> Column:
    """Per bucket the rows before it, as one sorted array of ``(_bucket, offset)``."""
    sizes = (
        _bucketed(ordered.select("_order"), markers)
        .groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("size"))
    )
    # One row per bucket, so this running total is a window over a short list.
    before = F.sum("size").over(
        Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    listed = sizes.select("_bucket", F.coalesce(before, F.lit(0)).alias("offset"))
    return listed.agg(
        F.sort_array(F.collect_list(F.struct("_bucket", "offset"))).alias("offsets")
    ).scalar()
