"""Rules on streams: kept, dropped or refused batch by batch, with counters by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.quality import Rule, expectations, row_filter
from tidemark.sinks.tables import TableLayout, enforce_schema, trigger_options, write_files

COUNTERS = "batch long, rule string, action string, rows long, violations long"


def checked(batch: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, tuple[Observation, Sequence[Rule]] | None]:
    """The batch under its rules, and what counts them once the batch has been written."""
    if not rules:
        return batch, None
    rows, observation = expectations(batch, list(rules))
    return rows, (observation, rules)


def write_counters(spark: SparkSession, counters: tuple[Observation, Sequence[Rule]], path: str, batch_id: int) -> None:
    """One row per rule; writing a batch again replaces its rows."""
    observation, rules = counters
    seen = observation.get
    rows = [(batch_id, r.description, r.action, seen["rows"], seen[r.description]) for r in rules]
    write_files(spark.createDataFrame(rows, COUNTERS).coalesce(1), path, "parquet")


def stream_with_rules(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    rules: Sequence[Rule] = (),
    schema: T.StructType | str | None = None,
    layout: TableLayout | None = None,
    once: bool = True,
    interval: str = "1 minute",
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to the target below ``path``, with schema, rules and layout.

    Each micro-batch is brought to ``schema`` and checked, and lands as ``rows/batch=<id>``
    when all its tasks have succeeded; then its counters land as ``counters/batch=<id>``.
    A batch that violates a failing rule stops the query, and nothing of it is visible;
    earlier batches stay. A replayed batch overwrites its own folders.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        rows, counters = checked(enforce_schema(batch, schema) if schema is not None else batch, rules)
        write_files(rows, f"{path}/rows/batch={batch_id}", "parquet", "overwrite", layout)
        if counters is not None:
            write_counters(batch.sparkSession, counters, f"{path}/counters/batch={batch_id}", batch_id)

    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger_options(once, interval)).start()


def read_target(spark: SparkSession, path: str, schema: T.StructType | None = None, visible_rows: str | None = None) -> DataFrame:
    """The rows that ``stream_with_rules`` stored, as far as readers may see them."""
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    rows = reader.parquet(f"{path}/rows")
    return row_filter(rows.drop("batch") if schema is None or "batch" not in schema.fieldNames() else rows, visible_rows)


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """Rows checked and violations, by batch and rule."""
    return spark.read.schema(COUNTERS).option("recursiveFileLookup", "true").parquet(f"{path}/counters").select(*[F.col(c) for c in ("batch", "rule", "action", "rows", "violations")])
