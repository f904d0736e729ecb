"""A change target whose table is stored, in buckets of keys.

Layout below ``root``::

    state/batch=<id>/_part=<bucket>/   what later changes may still need, in log form
    table/batch=<id>/_part=<bucket>/   the finished rows: current ones, or versions
    counters/batch=<id>/               rows checked and violations per rule
    manifest=<id>/                     which batch wrote each bucket last, and the schemas

A batch touches the buckets of its keys only: their state is read, merged with the
batch and written anew, and so is their part of the table. Reading the table is a scan
of the folders that the last manifest names: no shuffle, no window, no footers but
those. A manifest is published when all else is written, so a batch is visible as a
whole or not at all, and a replayed one overwrites its own folders.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import OP, SEQ, TRUNCATE, ChangeSpec, after_truncate, finish, reduce_log, to_log
from tidemark.operators.quality import Rule, row_filter
from tidemark.sinks.tables import write_files
from tidemark.sources.files import evolved
from tidemark.streaming.rules import checked, write_counters
from tidemark.streaming.upsert import ChangeTarget, _numbers
from tidemark.workspace import discard, is_complete, publish, staging_folder

BUCKET, PART = "_bucket", "_part"


@dataclass(frozen=True)
class Manifest:
    """The state of a target after one batch."""

    written: dict[int, int]  # bucket -> the batch that wrote it last
    state: T.StructType
    table: T.StructType


@dataclass(frozen=True)
class BucketedTarget(ChangeTarget):
    """A target of type 1 or 2 whose table is kept up to date batch by batch.

    ``buckets`` is fixed for the life of a target: choose it so that a bucket's history
    is some hundred megabytes. ``rules`` check the feed's rows before they are merged, and
    their counters are kept by batch; if a failing rule is violated, the batch leaves no
    trace. ``visible_rows`` filters what readers of the table see. A truncate touches all
    buckets. Columns that come later are null in what is older.
    """

    buckets: int = 64
    rules: Sequence[Rule] = ()
    visible_rows: str | None = None

    @property
    def _inner(self) -> ChangeSpec:
        """The spec over log rows, with the bucket as a further key."""
        return replace(self.spec, keys=[*self.spec.keys, BUCKET], columns=None, except_columns=None)

    def write_batch(self, changes: DataFrame, batch_id: int) -> None:
        """Merge one batch of feed rows into the buckets of its keys."""
        spark = changes.sparkSession
        rows, counters = checked(changes, self.rules)
        incoming = f"{self.root}/incoming/batch={batch_id}"
        write_files(reduce_log(self._dealt(to_log(rows, self.spec)), self._inner), incoming, "parquet")
        log = spark.read.parquet(incoming)
        before = self.manifest(spark, batch_id - 1)
        touched = [r[0] for r in log.select(BUCKET).distinct().collect()]
        known = before or Manifest({}, T.StructType([]), T.StructType([]))
        written = {**known.written, **dict.fromkeys(touched, batch_id)}

        schema = evolved(known.state, log.schema)
        state, table = schema, known.table
        if touched or not before:
            old = self._read(spark, "state", {b: known.written[b] for b in touched if b in known.written}, schema)
            every = old.unionByName(log, allowMissingColumns=True)
            merged = reduce_log(after_truncate(every, self._inner), self._inner)
            self._store(merged, f"{self.root}/state/batch={batch_id}")
            again = self._read(spark, "state", dict.fromkeys(touched, batch_id), schema)
            rows = finish(again, self._inner, [c for c in again.columns if c not in (SEQ, OP)])
            self._store(rows, f"{self.root}/table/batch={batch_id}")
            table = evolved(known.table, rows.schema)
        if counters is not None:
            write_counters(spark, counters, f"{self.root}/counters/batch={batch_id}", batch_id)
        self._publish(spark, Manifest(written, state, table), batch_id)
        discard(spark, incoming)

    def _dealt(self, log: DataFrame) -> DataFrame:
        """Log rows with their bucket; a truncate goes to every bucket."""
        own = F.pmod(F.xxhash64(*self.spec.keys), F.lit(self.buckets)).cast("int")
        if not self.spec.truncates:
            return log.withColumn(BUCKET, own)
        every = F.transform(F.sequence(F.lit(0), F.lit(self.buckets - 1)), lambda b: b.cast("int"))
        return log.withColumn(BUCKET, F.explode(F.when(F.col(OP) == TRUNCATE, every).otherwise(F.array(own))))

    def _store(self, rows: DataFrame, path: str) -> None:
        dealt = rows.withColumn(PART, F.col(BUCKET)).hint("rebalance", F.col(PART))
        staged = staging_folder(path)
        dealt.write.partitionBy(PART).parquet(staged)
        publish(rows.sparkSession, staged, path)

    def _read(self, spark: SparkSession, kind: str, written: dict[int, int], schema: T.StructType) -> DataFrame:
        """Folders of buckets; a bucket whose rows are all gone has no folder."""
        folders = []
        for batch in sorted(set(written.values())):
            there = set(_numbers(spark, f"{self.root}/{kind}/batch={batch}", PART))
            folders += [f"{self.root}/{kind}/batch={batch}/{PART}={b}" for b, at in sorted(written.items()) if at == batch and b in there]
        if not folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*folders)

    # -- manifests ---------------------------------------------------------------

    def _publish(self, spark: SparkSession, manifest: Manifest, batch_id: int) -> None:
        text = json.dumps({"written": {str(b): at for b, at in manifest.written.items()}, "state": manifest.state.jsonValue(), "table": manifest.table.jsonValue()})
        path = f"{self.root}/manifest={batch_id}"
        staged = staging_folder(path)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(staged)
        publish(spark, staged, path)

    def manifest(self, spark: SparkSession, last: int | None = None) -> Manifest | None:
        """The latest complete manifest, or the latest up to batch ``last``; None before any."""
        for number in reversed(_numbers(spark, self.root, "manifest")):
            path = f"{self.root}/manifest={number}"
            if (last is None or number <= last) and is_complete(spark, path):
                found = json.loads(spark.read.text(path, wholetext=True).first()[0])
                schemas = (T.StructType.fromJson(found[kind]) for kind in ("state", "table"))
                return Manifest({int(b): at for b, at in found["written"].items()}, *schemas)
        return None

    def vacuum(self, spark: SparkSession, keep: int = 2) -> int:
        """Deletes folders that the last ``keep`` manifests don't name; returns how many."""
        numbers = _numbers(spark, self.root, "manifest")
        kept = [m for n in numbers[-keep:] if (m := self.manifest(spark, n))]
        named = {(b, at) for m in kept for b, at in m.written.items()}
        gone = 0
        for kind in ("state", "table"):
            for batch in _numbers(spark, f"{self.root}/{kind}", "batch"):
                if numbers and batch > numbers[-1]:
                    continue  # being written
                folder = f"{self.root}/{kind}/batch={batch}"
                for b in _numbers(spark, folder, PART):
                    if (b, batch) not in named:
                        discard(spark, f"{folder}/{PART}={b}")
                        gone += 1
        for number in numbers[:-keep]:
            discard(spark, f"{self.root}/manifest={number}")
        return gone

    # -- reading -----------------------------------------------------------------

    def table(self, spark: SparkSession) -> DataFrame:
        """The stored table, as of the last complete batch: keys first, then the other columns."""
        manifest = self.manifest(spark)
        if manifest is None:
            raise FileNotFoundError(f"no complete batch below {self.root}")
        rows = self._read(spark, "table", manifest.written, manifest.table).drop(BUCKET)
        # columns that came later stand before the validity
        ends = [c for c in ("valid_from", "valid_to") if self.spec.scd_type == 2]
        rows = rows.select(*[c for c in rows.columns if c not in ends], *ends)
        return row_filter(rows, self.visible_rows)

    def register(self, spark: SparkSession, name: str) -> None:
        """Make the table readable under a name in this session; call again after new batches."""
        self.table(spark).createOrReplaceTempView(name)

    def log(self, spark: SparkSession) -> DataFrame | None:
        """What the target keeps for later changes, in log form; None before any batch."""
        manifest = self.manifest(spark)
        return None if manifest is None else self._read(spark, "state", manifest.written, manifest.state).drop(BUCKET)

    def compact(self, spark: SparkSession) -> None:
        """Nothing to do: each batch leaves its buckets merged."""
