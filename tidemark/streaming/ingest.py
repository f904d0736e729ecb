"""Incremental ingest of landed files that loses no column."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.sinks.tables import TableLayout, trigger_options, write_files
from tidemark.sources.files import NEW_COLUMNS, file_stream, guarded, remembered_schema


def start_ingest(
    spark: SparkSession,
    landing: str,
    file_format: str,
    path: str,
    checkpoint: str,
    schema_location: str,
    audit_source: str | None = None,
    once: bool = True,
    interval: str = "1 minute",
    max_files_per_trigger: int | None = None,
    layout: TableLayout | None = None,
) -> StreamingQuery:
    """Follow a landing folder into ``path``, a folder ``batch=<id>`` for each micro-batch.

    The columns are those of all files so far. A file that brings a new one while the
    stream runs stops it before the batch is committed; started again, the stream reads
    that file with all its columns.
    """
    schema = remembered_schema(spark, landing, file_format, schema_location)
    stream = file_stream(spark, landing, file_format, schema, audit_source=audit_source, max_files_per_trigger=max_files_per_trigger, name_files=True)

    def land(batch: DataFrame, batch_id: int) -> None:
        write_files(batch, f"{path}/batch={batch_id}", "parquet", "overwrite", layout)

    writer = stream.writeStream.foreachBatch(guarded(land, file_format, schema, schema_location))
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger_options(once, interval)).start()


def ingest(spark: SparkSession, landing: str, file_format: str, path: str, checkpoint: str, schema_location: str, starts: int = 10, **settings) -> int:
    """Ingest all that has landed, starting again as often as new columns turn up; returns the number of starts."""
    for number in range(1, starts + 1):
        query = start_ingest(spark, landing, file_format, path, checkpoint, schema_location, **settings)
        try:
            query.awaitTermination()
            return number
        except StreamingQueryException as error:
            if NEW_COLUMNS not in str(error) or number == starts:
                raise
    return starts


def read_ingested(spark: SparkSession, path: str) -> DataFrame:
    """All rows so far; a column that came later is null in the rows before it."""
    return spark.read.option("mergeSchema", "true").parquet(path).drop("batch")
