"""The audit struct carried by every raw and base row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT_COLUMN = "_metadata"
INGEST_SEQUENCE = f'{AUDIT_COLUMN}["ingest_timestamp"]'


def audit_struct(source_system: str) -> Column:
    return F.struct(
        F.lit(source_system).alias("SourceSystem"),
        F.current_timestamp().alias("ingest_timestamp"),
    )


def add_audit(df: DataFrame, source_system: str) -> DataFrame:
    """Append ``_metadata{SourceSystem, ingest_timestamp}``.

    ``current_timestamp()`` is one value per batch query and per micro-batch, so
    rows of one micro-batch share their ingest time.
    """
    return df.withColumn(AUDIT_COLUMN, audit_struct(source_system))
