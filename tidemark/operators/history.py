"""Type 2 history: change rows of a key, in sequence, as versions with validity.

The work is a window per key. One key may own a large part of all rows, so runs
longer than ``max_run_rows`` are cut into chunks at markers taken from the
sequence values themselves; chunks are windowed on their own and joined up by
what each passes to its neighbours: the columns filled so far, the open version
and the next row. Those *edges* are one row per chunk. Cuts and edges are joined as
Spark sees fit; nothing is broadcast by hand, as both grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.search import count_not_above, is_marker
from tidemark.operators.latest import greatest_row, orderable

VALID_FROM = "valid_from"
VALID_TO = "valid_to"
MAX_RUN_ROWS = 1_000_000

_SEQ, _OP, _CHUNK, _DELETE = "_seq", "_op", "_chunk", 1


def cut_long_runs(log: DataFrame, keys: list[str], max_run_rows: int) -> DataFrame | None:
    """Keys with too many rows for one window, with their ascending cut points.

    Runs one aggregation over the key columns now, to decide the plan's shape;
    returns None when no key needs cutting, which is the normal case. Rows of equal
    sequence are all counted here, so a run may be cut a little too often.
    """
    counts = log.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    longest = counts.agg(F.max("_rows")).first()[0]
    limit = max(1, max_run_rows)
    if not longest or longest <= limit:
        return None
    long_keys = counts.filter(F.col("_rows") > limit).select(
        *[F.col(k).alias(f"_cut_{k}") for k in keys]
    )
    same = _same_keys(keys)
    return (
        log.select(*keys, _SEQ)
        .filter(is_marker(F.col(_SEQ), limit))
        .join(long_keys, same, "left_semi")
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_set(_SEQ)).alias("_cuts"))
        .select(*[F.col(k).alias(f"_cut_{k}") for k in keys], "_cuts")
    )


def _same_keys(keys: list[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_cut_{k}"))
    return same


def versions(
    log: DataFrame,
    keys: list[str],
    payload: list[str],
    tracked: list[str] | None,
    fill_nulls: bool,
    max_run_rows: int = MAX_RUN_ROWS,
) -> DataFrame:
    """Versions of every key from its log; of rows with equal sequence the greatest counts.
    With ``fill_nulls`` tied updates merge column by column, in the order of a content hash.

    ``tracked=None``: every upsert opens a version. Otherwise a version runs as
    long as the tracked columns stay equal and carries the last values of the
    others. A delete closes the open version. ``fill_nulls`` carries earlier
    values into nulls, never past a delete.

    Without cut keys rows are shuffled once, by key: the choice among equal sequences
    and all windows then work on the same partitions and sort order.
    """
    cuts = cut_long_runs(log, keys, max_run_rows)
    if cuts is None:
        rows, by = log, keys
    else:
        rows = (
            log.join(cuts, _same_keys(keys), "left")
            .withColumn("_is_cut", F.col("_cuts").isNotNull())
            .withColumn(
                _CHUNK,
                F.when(
                    F.col("_is_cut"), count_not_above(F.col("_cuts"), F.col(_SEQ))
                ).otherwise(0),
            )
            .drop("_cuts", *[f"_cut_{k}" for k in keys])
        )
        by = [*keys, _CHUNK]
    chunked = cuts is not None
    # A cut key may repeat one sequence very often, so there the choice among equal
    # sequences starts before the shuffle.
    marks = ["_is_cut"] if chunked else []
    spread = rows if chunked else rows.repartition(*by)
    if fill_nulls:
        rows = _fill(_merge_ties(spread, by, payload, marks), keys, by, payload, chunked)
    else:
        rows = greatest_row(spread, [*by, _SEQ], [_OP], [*payload, *marks])
    state = _state(rows, tracked)
    return _close(rows.withColumn("_state", state), keys, by, payload, tracked, chunked)


def _merge_ties(rows: DataFrame, by: list[str], payload: list[str], marks: list[str]) -> DataFrame:
    """One row per key and sequence: a delete if there is one, else each column's last value that is set."""
    tie = F.xxhash64(*[orderable(rows, c) for c in payload]) if payload else F.lit(0).cast("long")
    placed = rows.withColumn("_tie", tie)

    def last_set(name: str) -> Column:
        position = F.when((F.col(_OP) != _DELETE) & F.col(name).isNotNull(), F.col("_tie"))
        return F.max_by(name, position).alias(name)

    columns = [F.max(_OP).alias(_OP), *[last_set(c) for c in payload], *[F.max(m).alias(m) for m in marks]]
    return placed.groupBy(*by, _SEQ).agg(*columns)


def _state(rows: DataFrame, tracked: list[str] | None) -> Column:
    """What must stay equal within a version: the operation and the tracked columns."""
    parts = [F.col(_OP).alias("op")]
    for i, c in enumerate(tracked or []):
        comparable = F.to_json(F.struct(c)) if _has_map(rows.schema[c].dataType) else F.col(c)
        parts.append(comparable.alias(f"c{i}"))
    return F.struct(*parts)


def _has_map(dtype: T.DataType) -> bool:
    return "map<" in dtype.simpleString() or isinstance(dtype, T.VariantType)


def _join_edges(rows: DataFrame, edges: DataFrame, keys: list[str]) -> DataFrame:
    """Attach the per-chunk edges; one row per chunk of a cut key."""
    renamed = edges.select(
        *[F.col(k).alias(f"_cut_{k}") for k in keys],
        F.col(_CHUNK).alias("_cut_chunk"),
        *[c for c in edges.columns if c not in (*keys, _CHUNK)],
    )
    same = _same_keys(keys) & (F.col(_CHUNK) == F.col("_cut_chunk")) & F.col("_is_cut")
    return rows.join(renamed, same, "left").drop(
        "_cut_chunk", *[f"_cut_{k}" for k in keys]
    )


def _fill(
    rows: DataFrame, keys: list[str], by: list[str], payload: list[str], chunked: bool
) -> DataFrame:
    def setting(name: str) -> Column:
        # A delete sets null; a null in an upsert sets nothing.
        value = F.when(F.col(_OP) != _DELETE, F.col(name)).alias("v")
        return F.when((F.col(_OP) == _DELETE) | F.col(name).isNotNull(), F.struct(value))

    so_far = Window.partitionBy(*by).orderBy(_SEQ).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    carried: dict[str, str] = {}
    source = rows
    if chunked:
        last = [
            F.max_by(setting(c), F.when(setting(c).isNotNull(), F.col(_SEQ))).alias(f"_in_{i}")
            for i, c in enumerate(payload)
        ]
        before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(
            Window.unboundedPreceding, -1
        )
        edges = (
            rows.filter("_is_cut")
            .groupBy(*by)
            .agg(F.count(F.lit(1)).alias("_n"), *last)
            .select(
                *by,
                *[
                    F.last(f"_in_{i}", ignorenulls=True).over(before).alias(f"_carry_{i}")
                    for i in range(len(payload))
                ],
            )
        )
        source = _join_edges(rows, edges, keys)
        carried = {c: f"_carry_{i}" for i, c in enumerate(payload)}

    def filled(name: str) -> Column:
        current = F.last(setting(name), ignorenulls=True).over(so_far)
        if name in carried:
            current = F.coalesce(current, F.col(carried[name]))
        return current["v"].alias(name)

    return source.select(
        *[c for c in rows.columns if c not in payload], *[filled(c) for c in payload]
    )


def _close(
    rows: DataFrame,
    keys: list[str],
    by: list[str],
    payload: list[str],
    tracked: list[str] | None,
    chunked: bool,
) -> DataFrame:
    run = Window.partitionBy(*by).orderBy(_SEQ)
    so_far = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    next_seq, next_state = F.lead(_SEQ).over(run), F.lead("_state").over(run)
    prev_state = F.lag("_state").over(run)
    started = None
    if chunked:
        rows = _join_edges(rows, _edges(rows, keys, by), keys)
        next_seq = F.coalesce(next_seq, F.col("_next_seq"))
        next_state = F.coalesce(next_state, F.col("_next_state"))
        prev_state = F.coalesce(prev_state, F.col("_prev_state"))
        started = F.col("_open_since")

    upsert = F.col(_OP) != _DELETE
    if tracked is None:
        return (
            rows.withColumn(VALID_TO, next_seq)
            .filter(upsert)
            .select(*keys, *payload, F.col(_SEQ).alias(VALID_FROM), VALID_TO)
        )

    starts = ~prev_state.eqNullSafe(F.col("_state"))
    ends = ~next_state.eqNullSafe(F.col("_state"))
    marked = (
        rows.withColumn("_starts", starts)
        .withColumn("_ends", ends)
        .withColumn(VALID_TO, next_seq)
        .withColumn(
            VALID_FROM, F.last(F.when(F.col("_starts"), F.col(_SEQ)), ignorenulls=True).over(so_far)
        )
    )
    if started is not None:
        marked = marked.withColumn(VALID_FROM, F.coalesce(F.col(VALID_FROM), started))
    return marked.filter(F.col("_ends") & upsert).select(*keys, *payload, VALID_FROM, VALID_TO)


def _edges(rows: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """What each chunk of a cut key learns from its neighbours."""
    run = Window.partitionBy(*by).orderBy(_SEQ)
    inner = rows.filter("_is_cut").select(*by, _SEQ, "_state")
    inner = inner.withColumn("_before", F.lag("_state").over(run))
    changed = F.col("_before").isNotNull() & ~F.col("_before").eqNullSafe(F.col("_state"))
    chunks = inner.groupBy(*by).agg(
        F.min(_SEQ).alias("_first_seq"),
        F.min_by("_state", _SEQ).alias("_first_state"),
        F.max_by("_state", _SEQ).alias("_last_state"),
        F.max(F.when(changed, F.col(_SEQ))).alias("_last_change"),
    )
    order = Window.partitionBy(*keys).orderBy(_CHUNK)
    linked = (
        chunks.withColumn("_prev_state", F.lag("_last_state").over(order))
        .withColumn("_next_seq", F.lead("_first_seq").over(order))
        .withColumn("_next_state", F.lead("_first_state").over(order))
    )
    # The version open at a chunk's end began at its last change, else at its first
    # row if that differs from the chunk before, else still further back.
    opened = F.coalesce(
        F.col("_last_change"),
        F.when(~F.col("_prev_state").eqNullSafe(F.col("_first_state")), F.col("_first_seq")),
    )
    return (
        linked.withColumn("_opened", opened)
        .withColumn(
            "_open_since",
            F.last("_opened", ignorenulls=True).over(
                order.rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .select(*by, "_prev_state", "_next_seq", "_next_state", "_open_since")
    )
