"""Join salts that keep rows without a key, and hot keys, out of a single task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rows without a key match nothing; they are spread over this many join buckets.
NULL_KEY_BUCKETS = 4096


def key_salt(key: Column) -> Column:
    """The salt of a key, the same on both sides of a join, so equal keys still meet.

    It is computed from the key because the optimizer would fold a constant away,
    and with it the part of the join key that spreads the NULLs of the other side.
    """
    return F.pmod(F.xxhash64(key), F.lit(NULL_KEY_BUCKETS).cast("long"))


def spreading_salt(
    key: Column, row_hash: Column, hot: list | None = None, hot_buckets: int = 1
) -> Column:
    """``key_salt``, but NULL keys and the listed hot keys go by a hash of their row.

    Hot keys get -1 .. -hot_buckets; the other side needs a copy per such salt.
    """
    salt = F.when(key.isNull(), F.pmod(row_hash, F.lit(NULL_KEY_BUCKETS).cast("long")))
    if hot:
        salt = salt.when(key.isin(hot), -1 - F.pmod(row_hash, F.lit(hot_buckets).cast("long")))
    return salt.otherwise(key_salt(key))


def hot_copies(key: Column, hot: list, hot_buckets: int) -> Column:
    """The salts under which the other side offers a key, as an array to explode."""
    return F.when(
        key.isin(hot),
        F.transform(F.sequence(F.lit(1), F.lit(hot_buckets)), lambda i: (-i).cast("long")),
    ).otherwise(F.array(key_salt(key)))
