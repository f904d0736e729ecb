"""Dimensions, facts and the lookup of surrogate ids by business key.

Naming rule: ``<dim>_key`` is the business key of dimension ``<dim>``, and
``<dim>_<role>_key`` the same key in a role of its own (a calendar used as order
and as ship date). The lookup replaces them by ``<dim>_id`` and ``<dim>_<role>_id``.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.salting import hot_copies, key_salt, spreading_salt
from tidemark.operators.surrogate import ROWS_PER_BUCKET, duplicate_keys, surrogate_key

KEY_SUFFIX = "_key"
ID_SUFFIX = "_id"

# Dimensions whose size does not depend on the data: a calendar has one row per day.
BOUNDED_DIMENSIONS = ("calendar",)


@dataclass(frozen=True)
class KeyRole:
    """Where a fact's key column is looked up and under which id it comes back."""

    dimension: str
    role: str | None = None

    @property
    def id_column(self) -> str:
        middle = f"_{self.role}" if self.role else ""
        return f"{self.dimension}{middle}{ID_SUFFIX}"


def dimension(
    df: DataFrame,
    name: str,
    business_key: str,
    method: str = "ordinal",
    keep_business_key: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Base table -> dimension: the business id becomes ``<name>_key``, plus a new ``<name>_id``.

    ``keep_business_key`` copies the column instead of renaming it, as the
    calendar does with its ``date``.
    """
    key = f"{name}{KEY_SUFFIX}"
    renamed = (
        df.withColumn(key, F.col(business_key))
        if keep_business_key
        else df.withColumnRenamed(business_key, key)
    )
    return surrogate_key(renamed, key, f"{name}{ID_SUFFIX}", method, rows_per_bucket)


def parse_key_column(column: str) -> KeyRole:
    """Read dimension and role from a key column's name; ambiguous names are refused."""
    if not column.endswith(KEY_SUFFIX):
        raise ValueError(f"{column!r} does not end in {KEY_SUFFIX!r}")
    parts = column[: -len(KEY_SUFFIX)].split("_")
    if not all(parts) or len(parts) > 2:
        raise ValueError(
            f"cannot read a dimension and role from {column!r}; name it in `roles`"
        )
    return KeyRole(parts[0], parts[1] if len(parts) == 2 else None)


def key_roles(
    columns: Iterable[str], roles: Mapping[str, KeyRole | tuple[str, str | None]] | None = None
) -> dict[str, KeyRole]:
    """The lookup of every ``_key`` column: given explicitly, else by the naming rule."""
    given = {
        c: r if isinstance(r, KeyRole) else KeyRole(*r) for c, r in (roles or {}).items()
    }
    names = list(columns)
    unknown = set(given) - set(names)
    if unknown:
        raise ValueError(f"no such key column: {sorted(unknown)}")
    return {
        c: given[c] if c in given else parse_key_column(c)
        for c in names
        if c in given or c.endswith(KEY_SUFFIX)
    }


def lookup_keys(
    fact: DataFrame,
    dimensions: Mapping[str, DataFrame],
    roles: Mapping[str, KeyRole | tuple[str, str | None]] | None = None,
    hot_keys: Mapping[str, list] | None = None,
    hot_key_buckets: int = 64,
    spread_by: list[str] | None = None,
    bounded: Collection[str] = BOUNDED_DIMENSIONS,
    spread_nulls: bool = False,
) -> DataFrame:
    """Replace the key columns of ``fact`` by surrogate ids.

    Each key is a left equi-join with two columns of its dimension, so a key
    without a match gives a NULL id and a repeated dimension key repeats the fact
    row. Only ``bounded`` dimensions are hinted as broadcast; for any other Spark
    broadcasts it when its size is below ``spark.sql.autoBroadcastJoinThreshold``
    and otherwise shuffles.

    A shuffled lookup joins on the key alone; adaptive execution splits an oversized
    partition of a left join, that of the rows without a key too. Where a column has
    values listed in ``hot_keys[column]`` (see ``hot_values``), or with ``spread_nulls``,
    it also keys on a salt: the listed values go over ``hot_key_buckets`` tasks by
    repeating just those few dimension rows, and rows without a key are spread by a
    hash of the ``spread_by`` columns (default: the fact's own ids and its keys; few,
    so that a query on the fact still reads few columns).
    """
    lookups = key_roles(fact.columns, roles)
    missing = sorted({r.dimension for r in lookups.values()} - set(dimensions))
    if missing:
        raise ValueError(f"no dimension given for {missing}")

    taken = sorted({r.id_column for r in lookups.values()} & set(fact.columns))
    if taken:
        raise ValueError(f"the fact has id columns of the same name: {taken}")

    spread = spread_by or [c for c in fact.columns if c in lookups or c.endswith(ID_SUFFIX)]
    row_hash = F.xxhash64(*[F.col(c) for c in spread])
    result = fact
    for column, role in lookups.items():
        slim = dimensions[role.dimension].select(
            F.col(f"{role.dimension}{KEY_SUFFIX}").alias(f"_dim_{column}"),
            F.col(f"{role.dimension}{ID_SUFFIX}").alias(role.id_column),
        )
        match = F.col(column) == F.col(f"_dim_{column}")
        if role.dimension in bounded:
            result = result.join(F.broadcast(slim), match, "left").drop(f"_dim_{column}")
            continue
        hot = list((hot_keys or {}).get(column, []))
        if not hot and not spread_nulls:
            result = result.join(slim, match, "left").drop(f"_dim_{column}")
            continue
        result = (
            result.withColumn(
                "_salt", spreading_salt(F.col(column), row_hash, hot, hot_key_buckets)
            )
            .join(
                _salted(slim, F.col(f"_dim_{column}"), hot, hot_key_buckets),
                match & (F.col("_salt") == F.col("_dim_salt")),
                "left",
            )
            .drop("_salt", "_dim_salt", f"_dim_{column}")
        )
    return ids_first(drop_keys(result, lookups))


def _salted(slim: DataFrame, key: Column, hot: list, buckets: int) -> DataFrame:
    if hot:
        return slim.withColumn("_dim_salt", F.explode(hot_copies(key, hot, buckets)))
    return slim.withColumn("_dim_salt", key_salt(key))


def hot_values(fact: DataFrame, column: str, share: float = 0.01) -> list:
    """Values of ``column`` that hold more than ``share`` of the rows (at most 1/share of them)."""
    if not 0 < share < 1:
        raise ValueError("share must lie between 0 and 1")
    counts = fact.filter(F.col(column).isNotNull()).groupBy(column).count()
    total = fact.agg(F.count(F.lit(1))).scalar()
    return [r[0] for r in counts.filter(F.col("count") > total * share).collect()]


def drop_keys(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Drop the business keys: those given, else all that end in ``_key``."""
    drop = set(columns) if columns is not None else {
        c for c in df.columns if c.endswith(KEY_SUFFIX)
    }
    return df.select(*[c for c in df.columns if c not in drop])


def ids_first(df: DataFrame) -> DataFrame:
    """Columns ending in ``_id`` first, everything else after, each in its given order."""
    ids = [c for c in df.columns if c.endswith(ID_SUFFIX)]
    return df.select(*ids, *[c for c in df.columns if not c.endswith(ID_SUFFIX)])


def fact(
    df: DataFrame,
    renames: Mapping[str, str],
    dimensions: Mapping[str, DataFrame],
    roles: Mapping[str, KeyRole | tuple[str, str | None]] | None = None,
    hot_keys: Mapping[str, list] | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Base table -> fact: name the key columns, then look all of them up."""
    absent = sorted(set(renames) - set(df.columns))
    if absent:
        raise ValueError(f"no such column to rename: {absent}")
    named = df.withColumnsRenamed(dict(renames))
    return lookup_keys(named, dimensions, roles, hot_keys, spread_by=spread_by)


def fan_out(dimensions: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Per dimension, the business keys that would repeat fact rows in a lookup."""
    return {
        name: duplicate_keys(dim, f"{name}{KEY_SUFFIX}") for name, dim in dimensions.items()
    }
