"""What the corpus operators share: reading the tables, and tables written between jobs."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.workspace import discard, shared_folder

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` to the cluster's shared folder and reads it back: the lineage ends there."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    read.stored_at = path
    return read


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_runs(texts: pa.Array, most_bytes: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``most_bytes`` of text, so that tasks hold little at once; no text is cut."""
    if not len(texts):
        return
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).tolist()
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most_bytes:
            yield first, i
            first, total = i, 0
        total += n
    yield first, len(sizes)


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes tables that ``stored`` wrote, and lets Spark delete shuffle files that nothing refers to any more."""
    for df in tables:
        discard(spark, df.stored_at)
    for _ in range(2):  # the second round finds what the first one's finalizers let go
        gc.collect()
        spark.sparkContext._jvm.System.gc()
