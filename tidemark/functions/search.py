"""Deterministic split points for sorted data and the lookup into them.

A sorted run too long for one task is cut at *markers*: order values whose hash
falls into a fixed residue class. Which values are markers depends on the data
alone, never on the partitioning or on a sampling seed, so two evaluations of a
plan (or a recomputed task) always agree on the cuts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Binary search over an array of at most 2**SEARCH_STEPS - 1 elements.
SEARCH_STEPS = 20


def is_marker(order: Column, every: int, seed: int = 17) -> Column:
    """True for about one in ``every`` distinct order values."""
    return F.pmod(F.xxhash64(order, F.lit(seed)), F.lit(max(1, every)).cast("long")) == 0


def count_not_above(bounds: Column, value: Column) -> Column:
    """How many elements of the ascending array ``bounds`` are <= ``value``.

    A binary search in SEARCH_STEPS steps, so the cost per row does not grow
    with the number of bounds. ``bounds`` must be a plain column: Spark accepts
    no subquery inside a higher-order function. More bounds than the steps can tell
    apart are an error.
    """
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(SEARCH_STEPS))])

    def advance(low: Column, step: Column) -> Column:
        probe = low + step
        return F.when(
            (probe <= F.size(bounds)) & (F.try_element_at(bounds, probe) <= value), probe
        ).otherwise(low)

    too_many = F.raise_error(F.lit(f"more than {2**SEARCH_STEPS - 1} split points; use larger runs")).cast("int")
    return F.when(F.size(bounds) >= 1 << SEARCH_STEPS, too_many).otherwise(
        F.aggregate(steps, F.lit(0), advance)
    )


def hash_bucket(parts: list[Column], buckets: Column | int, salt: str) -> Column:
    """A reproducible pick in ``[0, buckets)`` from a row's own columns."""
    size = F.lit(buckets) if isinstance(buckets, int) else buckets
    return F.pmod(F.xxhash64(*parts, F.lit(salt)), size.cast("long"))
