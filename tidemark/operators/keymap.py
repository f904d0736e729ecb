"""Surrogate ids that survive inserts: an append-only map from business key to id.

The map lies in a folder of Parquet parts, one per load that brought new keys. A load
looks up which of its keys the map holds already and numbers only the others, in key
order, from the highest id on; a key never gets another id. The look-up streams the
stored keys past the load's: they are shuffled at most, never sorted, and where the
load is small Spark sends the load to them instead.

A load that fails leaves a part without a success marker, which nobody reads and the
next load overwrites; a load that is run again finds its keys and adds nothing. One
writer at a time. Keys with a null in any column have no id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.surrogate import ROWS_PER_BUCKET, surrogate_key
from tidemark.workspace import child_names, is_complete

PART = "part-"


class KeyMap:
    """The map of ``keys`` to the id column ``name``, kept below ``path``."""

    def __init__(
        self, path: str, keys: str | list[str], name: str, rows_per_bucket: int = ROWS_PER_BUCKET
    ) -> None:
        self.path = path.rstrip("/")
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.name = name
        self.rows_per_bucket = rows_per_bucket
        if not self.keys:
            raise ValueError("a key map needs at least one business key column")
        if name in self.keys:
            raise ValueError(f"{name!r} is a key column")

    def parts(self, spark: SparkSession) -> list[str]:
        """Folders of the complete loads, in order."""
        named = [n for n in child_names(spark, self.path) if n.startswith(PART)]
        return [f"{self.path}/{n}" for n in named if is_complete(spark, f"{self.path}/{n}")]

    def table(self, spark: SparkSession) -> DataFrame:
        """All keys with their ids; an error before the first load."""
        parts = self.parts(spark)
        if not parts:
            raise FileNotFoundError(f"no key map in {self.path}")
        return spark.read.parquet(*parts)

    def extend(self, df: DataFrame) -> None:
        """Give ids to the keys of ``df`` that have none yet; repeated keys count once."""
        spark = df.sparkSession
        parts = self.parts(spark)
        fresh = self._new_keys(df, parts)
        numbered = surrogate_key(fresh, self.keys, self.name, rows_per_bucket=self.rows_per_bucket)
        shifted = numbered.withColumn(self.name, F.col(self.name) + self._next_id(spark, parts))
        shifted.write.mode("overwrite").parquet(f"{self.path}/{PART}{len(parts):06d}")

    def _new_keys(self, df: DataFrame, parts: list[str]) -> DataFrame:
        keys = df.select(*self.keys).dropna("any").distinct()
        if not parts:
            return keys
        known = df.sparkSession.read.parquet(*parts).select(*self.keys)
        # The load's keys are the hashed side, so the stored ones are only streamed past;
        # what is found is no larger than the load.
        found = known.join(keys.hint("shuffle_hash"), self.keys, "left_semi")
        return keys.join(found, self.keys, "left_anti")

    def _next_id(self, spark: SparkSession, parts: list[str]) -> int:
        """Ids run without gaps from zero, so the rows of the map tell the next one."""
        return spark.read.parquet(*parts).count() if parts else 0

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` with the id of each row's key; null where the map has none."""
        if self.name in df.columns:
            raise ValueError(f"column {self.name!r} exists already")
        return df.join(self.table(df.sparkSession), self.keys, "left").select(*df.columns, self.name)
