"""Writing DataFrames: file sinks, materialised tables, views, appended rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.curve import with_curve_position
from tidemark.operators.quality import Rule, expectations, row_filter
from tidemark.workspace import discard, publish, staging_folder

FILE_FORMATS = ("csv", "json", "parquet", "orc")
WRITE_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


@dataclass(frozen=True)
class TableLayout:
    """How a table lies on disk.

    ``partition_cols`` become folders. ``cluster_by`` sorts the data by range, so
    that a filter on those columns reads few row groups; a filter on a later column
    alone reads nearly all. ``interleave`` orders by the interleaved bits of several
    columns' range numbers instead, so that a filter on any one of them skips most
    row groups. ``files`` fixes the number of write tasks; by default Spark chooses.
    """

    partition_cols: Sequence[str] = ()
    cluster_by: Sequence[str] = ()
    interleave: Sequence[str] = ()
    files: int | None = None
    path: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)


def arrange(df: DataFrame, layout: TableLayout) -> DataFrame:
    """Distribute rows for the write so that no value of a column is one task's burden.

    Clustering ranges over the columns *and* a row hash: a value holding a large
    share of the rows fills several ranges. Folder partitioning uses the rebalance
    hint, under which adaptive execution splits oversized partitions and merges
    small ones.
    """
    if layout.interleave and layout.cluster_by:
        raise ValueError("a table is clustered by columns in order or interleaved, not both")
    if layout.interleave:
        return _interleaved(df, layout)
    if layout.cluster_by:
        order = [F.col(c) for c in layout.cluster_by]
        spread = F.xxhash64(*[F.col(c) for c in df.columns if _is_atomic(df, c)])
        parts = [F.col(c) for c in layout.partition_cols]
        ranged = (
            df.repartitionByRange(layout.files, *parts, *order, spread)
            if layout.files
            else df.repartitionByRange(*parts, *order, spread)
        )
        return ranged.sortWithinPartitions(*parts, *order)
    if layout.partition_cols:
        if layout.files:
            return df.hint("rebalance", layout.files, *layout.partition_cols)
        return df.hint("rebalance", *layout.partition_cols)
    return df.repartition(layout.files) if layout.files else df


_CURVE = "_curve_position"


def _interleaved(df: DataFrame, layout: TableLayout) -> DataFrame:
    parts = [F.col(c) for c in layout.partition_cols]
    spread = F.xxhash64(*[F.col(c) for c in df.columns if _is_atomic(df, c)])
    placed = with_curve_position(df, layout.interleave, _CURVE)
    order = [*parts, F.col(_CURVE), spread]
    ranged = placed.repartitionByRange(layout.files, *order) if layout.files else placed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*parts, _CURVE).drop(_CURVE)


def _is_atomic(df: DataFrame, column: str) -> bool:
    return not isinstance(df.schema[column].dataType, (T.MapType, T.ArrayType, T.StructType))


def write_files(
    df: DataFrame,
    path: str,
    file_format: str = "csv",
    mode: str = "overwrite",
    layout: TableLayout | None = None,
) -> None:
    """A file sink. CSV holds atomic columns only, as in Spark itself.

    An overwrite is written next to ``path`` and takes its place when it is complete;
    if it fails, what was there stays.
    """
    if file_format not in FILE_FORMATS:
        raise ValueError(f"format must be one of {FILE_FORMATS}, not {file_format!r}")
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, not {mode!r}")
    layout = layout or TableLayout()
    writer = arrange(df, layout).write.mode(mode).format(file_format)
    if file_format == "csv":
        writer = writer.option("header", "true")
    if layout.partition_cols:
        writer = writer.partitionBy(*layout.partition_cols)
    if mode != "overwrite":
        writer.save(path)
        return
    with _staged(df.sparkSession, path) as staged:
        writer.save(staged)


@contextmanager
def _staged(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to write to; it is published as ``path`` if nothing fails, else removed."""
    staged = staging_folder(path)
    try:
        yield staged
    except BaseException:
        discard(spark, staged)
        raise
    publish(spark, staged, path)


def enforce_schema(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Bring ``df`` to the declared schema by name, or raise.

    Missing and surplus columns raise now; values are cast under ANSI rules, so
    one that does not fit raises in its task. A null in a column declared not
    nullable raises too.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = declared.fieldNames()
    missing = [n for n in names if n not in df.columns]
    surplus = [c for c in df.columns if c not in names]
    if missing or surplus:
        raise ValueError(f"schema mismatch: missing {missing}, not declared {surplus}")

    def bring(fld: T.StructField):
        value = F.col(fld.name).cast(fld.dataType)
        if not fld.nullable:
            complaint = F.raise_error(F.lit(f"null in column {fld.name}, declared not null"))
            value = F.coalesce(value, complaint.cast(fld.dataType))
        return value.alias(fld.name)

    return df.select(*[bring(f) for f in declared.fields])


@contextmanager
def spark_settings(spark: SparkSession, settings: Mapping[str, str] | None) -> Iterator[None]:
    """Session settings for the duration of one write."""
    before = {k: spark.conf.get(k, None) for k in (settings or {})}
    try:
        for key, value in (settings or {}).items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def materialize(
    df: DataFrame,
    name: str,
    comment: str | None = None,
    layout: TableLayout | None = None,
    schema: T.StructType | str | None = None,
    rules: list[Rule] | None = None,
    visible_rows: str | None = None,
    spark_conf: Mapping[str, str] | None = None,
    private: bool = False,
    checkpoint: str | None = None,
    once: bool = True,
    file_format: str = "parquet",
    mode: str = "overwrite",
):
    """Build the table ``name`` from ``df``.

    A batch is written and replaces (or appends to) the table; a stream is started
    into it and returned. ``private`` registers a temporary view and stores
    nothing. An overwrite becomes the table when it is complete; if a rule or a task
    fails, the earlier table stays. ``visible_rows`` is a row filter for readers: all
    rows are stored, under ``hidden_name(name)``, and ``name`` is a view of the visible ones.
    """
    spark = df.sparkSession
    layout = layout or TableLayout()
    if schema is not None:
        df = enforce_schema(df, schema)
    counters = None
    if rules:
        df, counters = expectations(df, rules, _view_safe(name))
    if private:
        row_filter(df, visible_rows).createOrReplaceTempView(_view_safe(name))
        return counters
    stored = hidden_name(name) if visible_rows else name
    with spark_settings(spark, spark_conf):
        if df.isStreaming:
            query = stream_to_table(df, stored, checkpoint, once, layout, file_format)
        elif mode == "overwrite" and table_exists(spark, stored):
            _replace_table(df, stored, layout, file_format)
        else:
            _table_writer(df, layout, file_format, layout.path).mode(mode).saveAsTable(stored)
    _describe(spark, stored, comment, layout.properties)
    if visible_rows:
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {stored} WHERE {visible_rows}")
    return query if df.isStreaming else counters


def hidden_name(name: str) -> str:
    """Where a table with a row filter stores all its rows."""
    return f"{name.rstrip('`')}__all_rows" + "`" * name.endswith("`")


def _table_writer(df: DataFrame, layout: TableLayout, file_format: str, path: str | None):
    writer = arrange(df, layout).write.format(file_format)
    if layout.partition_cols:
        writer = writer.partitionBy(*layout.partition_cols)
    return writer.option("path", path) if path else writer


def _replace_table(df: DataFrame, name: str, layout: TableLayout, file_format: str) -> None:
    """Writes the new version beside the table, then lets it take its place."""
    spark = df.sparkSession
    if layout.path:
        with _staged(spark, layout.path) as staged:
            _table_writer(df, layout, file_format, None).save(staged)
        spark.sql(f"DROP TABLE {name}")
        spark.catalog.createTable(name, path=layout.path, source=file_format)
        if layout.partition_cols:
            spark.sql(f"MSCK REPAIR TABLE {name}")
        spark.catalog.refreshTable(name)
        return
    fresh = f"{name.rstrip('`')}__{uuid.uuid4().hex}" + "`" * name.endswith("`")
    try:
        _table_writer(df, layout, file_format, None).saveAsTable(fresh)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def _describe(
    spark: SparkSession, name: str, comment: str | None, properties: Mapping[str, str]
) -> None:
    entries = dict(properties)
    if comment:
        entries["comment"] = comment
    if entries:
        listed = ", ".join(f"'{_quoted(k)}' = '{_quoted(v)}'" for k, v in entries.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def _quoted(text: str) -> str:
    return str(text).replace("\\", "\\\\").replace("'", "\\'")


def _view_safe(name: str) -> str:
    return name.replace("`", "").replace(".", "_")


def trigger_options(once: bool, interval: str = "1 minute") -> dict:
    """Run once over what is there, or keep running."""
    return {"availableNow": True} if once else {"processingTime": interval}


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait for all streams; when one fails the others are stopped and its error is raised."""
    running = list(queries)
    try:
        while running:
            running = [q for q in running if not q.awaitTermination(1)]
    except BaseException:
        for query in running:
            query.stop()
        raise


def stream_to_table(
    stream: DataFrame,
    name: str,
    checkpoint: str | None,
    once: bool = True,
    layout: TableLayout | None = None,
    file_format: str = "parquet",
    interval: str = "1 minute",
) -> StreamingQuery:
    """Append a stream to a table; the checkpoint makes each input row count once."""
    if not checkpoint:
        raise ValueError("a streaming table needs a checkpoint folder")
    layout = layout or TableLayout()
    writer = (
        stream.writeStream.format(file_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .queryName(_view_safe(name))
        .trigger(**trigger_options(once, interval))
    )
    if layout.partition_cols:
        writer = writer.partitionBy(*layout.partition_cols)
    if layout.path:
        writer = writer.option("path", layout.path)
    return writer.toTable(name)


def stream_to_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    file_format: str = "parquet",
    once: bool = True,
    layout: TableLayout | None = None,
    name: str | None = None,
    interval: str = "1 minute",
) -> StreamingQuery:
    """A generic sink: each micro-batch lands in a folder of its own, ``batch=<id>``.

    A replayed batch overwrites its folder, so the sink holds every row once.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        write_files(batch, f"{path}/batch={batch_id}", file_format, "overwrite", layout)

    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger_options(once, interval)).start()


def create_streaming_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    comment: str | None = None,
    layout: TableLayout | None = None,
    file_format: str = "parquet",
) -> None:
    """The empty target of a stream, if it is not there yet."""
    if table_exists(spark, name):
        return
    layout = layout or TableLayout()
    writer = spark.createDataFrame([], schema).write.format(file_format)
    if layout.partition_cols:
        writer = writer.partitionBy(*layout.partition_cols)
    if layout.path:
        writer = writer.option("path", layout.path)
    writer.saveAsTable(name)
    _describe(spark, name, comment, layout.properties)


def view_name(catalog: str, schema: str, name: str) -> str:
    return f"{catalog}_{schema}_{name}_view"


def create_view(df: DataFrame, catalog: str, schema: str, name: str) -> str:
    """Register ``df`` as a view; returns the view's name."""
    view = view_name(catalog, schema, name)
    df.createOrReplaceTempView(view)
    return view


def create_table_if_absent(
    spark: SparkSession,
    name: str,
    schema_ddl: str,
    file_format: str = "parquet",
    path: str | None = None,
) -> None:
    location = f" LOCATION '{_quoted(path)}'" if path else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING {file_format}{location}"
    )


def table_exists(spark: SparkSession, name: str) -> bool:
    """By exact name, with or without catalog and schema."""
    return spark.catalog.tableExists(name)


def append_rows(df: DataFrame, name: str) -> None:
    """Append all rows in one job; columns are matched by name and must fit the table."""
    declared = df.sparkSession.read.table(name).schema
    enforce_schema(df, declared).write.mode("append").insertInto(name)
