"""Change data capture: a feed of keyed changes -> the current table or its history.

A feed is first brought into *log form* (``to_log``): key columns, ``_seq``,
``_op`` (upsert, delete, truncate) and the target's other columns. Logs of any
batches can be united and reduced (``reduce_log``) in any order and grouping with
the same outcome, because every reduction is a maximum over
``(sequence, operation, content)``; that is what makes late data, replays and
compaction safe. ``finish`` turns a reduced log into the target table.

Ties. On an equal sequence a truncate beats a delete, a delete beats an upsert,
and among upserts the row with the greater content wins; with ``ignore_null_updates``
tied upserts merge column by column, in the order of a content hash. Rows whose
sequence is null are rejected (``rejected`` lists them). Null key parts compare as
equal.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import history
from tidemark.operators.latest import greatest_row, is_orderable, orderable

SEQ = "_seq"
OP = "_op"
TIE = "_tie"
UPSERT, DELETE, TRUNCATE = 0, 1, 2

VALID_FROM = history.VALID_FROM
VALID_TO = history.VALID_TO


@dataclass(frozen=True)
class ChangeSpec:
    """How one target follows its feed.

    ``sequence`` is a SQL expression over the feed, so a struct field such as
    ``_metadata["ingest_timestamp"]`` works. ``columns``/``except_columns``
    project the target; ``track``/``except_track`` name the columns whose change
    opens a new version (type 2 only; by default every change row opens one).
    """

    keys: Sequence[str]
    sequence: str
    scd_type: int = 1
    ignore_null_updates: bool = False
    deletes: str | None = None
    truncates: str | None = None
    columns: Sequence[str] | None = None
    except_columns: Sequence[str] | None = None
    track: Sequence[str] | None = None
    except_track: Sequence[str] | None = None
    name: str | None = None
    once: bool = False
    max_run_rows: int = field(default=history.MAX_RUN_ROWS)

    def __post_init__(self) -> None:
        if self.scd_type not in (1, 2):
            raise ValueError("scd_type must be 1 or 2")
        if isinstance(self.keys, str) or not self.keys:
            raise ValueError("keys must be a non-empty list of column names")
        if not self.sequence:
            raise ValueError("a sequence expression is needed")
        if self.columns is not None and self.except_columns is not None:
            raise ValueError("give columns or except_columns, not both")
        if self.track is not None and self.except_track is not None:
            raise ValueError("give track or except_track, not both")
        if self.scd_type == 1 and (self.track is not None or self.except_track is not None):
            raise ValueError("tracked columns need scd_type 2")
        if self.scd_type == 2 and self.truncates:
            raise ValueError("truncates need scd_type 1")
        if self.columns is not None and not set(self.keys) <= set(self.columns):
            raise ValueError("columns must include all keys")
        if self.except_columns is not None and set(self.keys) & set(self.except_columns):
            raise ValueError("except_columns must not include a key")

    @property
    def tracks(self) -> bool:
        return self.track is not None or self.except_track is not None

    def target_columns(self, available: Sequence[str]) -> list[str]:
        """The target's columns in feed order."""
        known = set(available)
        for name in [*self.keys, *(self.columns or []), *(self.except_columns or [])]:
            if name not in known:
                raise ValueError(f"the feed has no column {name!r}")
        if self.columns is not None:
            return [c for c in available if c in set(self.columns)]
        return [c for c in available if c not in set(self.except_columns or [])]

    def tracked_columns(self, payload: Sequence[str]) -> list[str]:
        for name in [*(self.track or []), *(self.except_track or [])]:
            if name not in payload:
                raise ValueError(f"the target has no column {name!r} to track")
        if self.track is not None:
            return list(self.track)
        return [c for c in payload if c not in set(self.except_track or [])]


def apply_changes(
    changes: DataFrame, spec: ChangeSpec, log: DataFrame | None = None
) -> DataFrame:
    """The target after ``changes``, on top of an earlier ``log`` (in log form) if given."""
    rows = to_log(changes, spec)
    if log is not None:
        rows = log.unionByName(rows)
    columns = output_order(changes, spec)
    if spec.truncates:  # what a truncate clears need not be reduced
        rows = after_truncate(rows, spec).filter(F.col(OP) != TRUNCATE)
        spec = replace(spec, truncates=None)
    if spec.scd_type == 2:  # the window over a key sorts its rows anyway and reduces them there
        return finish(rows, spec, columns)
    return finish(reduce_log(rows, spec), spec, columns)


def output_order(changes: DataFrame, spec: ChangeSpec) -> list[str]:
    return spec.target_columns(changes.columns)


def rejected(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Feed rows that have no place in the sequence."""
    return changes.filter(F.expr(spec.sequence).isNull())


def to_log(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Feed rows in log form, one per row; nothing is shuffled."""
    target = spec.target_columns(changes.columns)
    payload = [c for c in target if c not in spec.keys]
    operation = F.lit(UPSERT)
    if spec.deletes:
        operation = F.when(F.expr(spec.deletes), DELETE).otherwise(operation)
    if spec.truncates:
        operation = F.when(F.expr(spec.truncates), TRUNCATE).otherwise(operation)
    rows = changes.select(
        F.expr(spec.sequence).alias(SEQ),
        operation.cast("int").alias(OP),
        *[F.col(c) for c in target],
    ).filter(F.col(SEQ).isNotNull())

    is_change = F.col(OP) != TRUNCATE if spec.truncates else F.lit(True)
    keys = [F.when(is_change, F.col(k)).alias(k) if spec.truncates else F.col(k) for k in spec.keys]
    if spec.scd_type == 1 and spec.ignore_null_updates:
        return _lift(rows, keys, payload)
    return rows.select(*keys, SEQ, OP, *payload)


def _lift(rows: DataFrame, keys: list[Column], payload: list[str]) -> DataFrame:
    """Each column with the position it was set at, so that columns merge one by one.

    A delete sets every column to null at its own position; a null in an upsert
    sets nothing.
    """
    tie = F.xxhash64(*[orderable(rows, c) for c in payload]) if payload else F.lit(0)
    placed = rows.withColumn(TIE, tie.cast("long"))

    def entry(name: str) -> Column:
        value = F.when(F.col(OP) == UPSERT, F.col(name)).alias("v")
        setting = F.struct(SEQ, OP, TIE, value)
        return F.when((F.col(OP) == DELETE) | F.col(name).isNotNull(), setting).alias(name)

    return placed.select(*keys, SEQ, OP, *[entry(c) for c in payload])


def after_truncate(log: DataFrame, spec: ChangeSpec) -> DataFrame:
    """The log without the rows that its last truncate clears; truncates stay."""
    if not spec.truncates:
        return log
    cut = log.filter(F.col(OP) == TRUNCATE).agg(F.max(SEQ)).scalar()
    alive = F.col("_cut").isNull() | (F.col(OP) == TRUNCATE) | (F.col(SEQ) > F.col("_cut"))
    return log.withColumn("_cut", cut).filter(alive).drop("_cut")


def reduce_log(log: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Keep only what any later change can still need; the result is again a log.

    Type 1 keeps one row per key (a delete stays as a tombstone) and the last
    truncate; type 2 keeps one row per key and sequence, with ignored nulls one of
    each content, as tied updates merge column by column. The reduction starts
    before the shuffle, so a key with a huge number of changes sends one row per
    task.
    """
    payload = [c for c in log.columns if c not in (*spec.keys, SEQ, OP)]
    if spec.scd_type == 2 and spec.ignore_null_updates:
        tie = F.xxhash64(*[orderable(log, c) for c in payload]) if payload else F.lit(0).cast("long")
        by = [*spec.keys, SEQ, OP, TIE]
        return greatest_row(log.withColumn(TIE, tie), by, [], payload).select(*log.columns)
    if spec.scd_type == 2:
        return greatest_row(log, [*spec.keys, SEQ], [OP], payload)
    if not spec.ignore_null_updates:
        return _by_kind(log, spec, lambda rows, by: greatest_row(rows, by, [SEQ, OP], payload))
    return _by_kind(log, spec, lambda rows, by: _merge_columns(rows, by, payload))


def _by_kind(log: DataFrame, spec: ChangeSpec, reduction) -> DataFrame:
    """Truncates form a group of their own, apart from any key."""
    if not spec.truncates:
        return reduction(log, list(spec.keys)).select(*log.columns)
    marked = log.withColumn("_truncate", F.col(OP) == TRUNCATE)
    return reduction(marked, [*spec.keys, "_truncate"]).select(*log.columns)


def _merge_columns(rows: DataFrame, by: list[str], payload: list[str]) -> DataFrame:
    def latest(name: str) -> Column:
        entry = F.col(name)
        if is_orderable(rows.schema[name].dataType):
            return F.max(entry).alias(name)
        position = F.when(entry.isNotNull(), F.struct(entry[SEQ], entry[OP], entry[TIE]))
        return F.max_by(entry, position).alias(name)

    return (
        rows.groupBy(*by)
        .agg(F.max(F.struct(SEQ, OP)).alias("_last"), *[latest(c) for c in payload])
        .select(*by, "_last.*", *payload)
    )


def finish(log: DataFrame, spec: ChangeSpec, columns: Sequence[str]) -> DataFrame:
    """A log as the target table, with the target's ``columns`` in order.

    The log must be reduced for type 1; for type 2 it may be.
    """
    if spec.scd_type == 2:
        payload = [c for c in columns if c not in spec.keys]
        return history.versions(
            log,
            keys=list(spec.keys),
            payload=payload,
            tracked=spec.tracked_columns(payload) if spec.tracks else None,
            fill_nulls=spec.ignore_null_updates,
            max_run_rows=spec.max_run_rows,
        ).select(*columns, VALID_FROM, VALID_TO)

    rows = log
    if spec.truncates:
        cut = log.filter(F.col(OP) == TRUNCATE).agg(F.max(SEQ)).scalar()
        rows = (
            log.withColumn("_cut", cut)
            .filter((F.col(OP) != TRUNCATE) & (F.col("_cut").isNull() | (F.col(SEQ) > F.col("_cut"))))
        )
    rows = rows.filter(F.col(OP) == UPSERT)
    if not spec.ignore_null_updates:
        return rows.select(*columns)

    def value(name: str) -> Column:
        if name in spec.keys:
            return F.col(name)
        if spec.truncates:
            alive = F.col("_cut").isNull() | (F.col(name)[SEQ] > F.col("_cut"))
            return F.when(alive, F.col(name)["v"]).alias(name)
        return F.col(name)["v"].alias(name)

    return rows.select(*[value(c) for c in columns])
