"""Keyed upserts from a stream into plain files: a change log plus snapshots.

Layout below ``root``::

    log/batch=<id>/       one micro-batch, reduced, in log form
    snapshot=<id>/        everything up to and including batch <id>, reduced

A batch is written by overwriting its own folder, so replaying it after a crash
changes nothing. Readers see only folders with a success marker. Because reduced
logs merge in any order and grouping, ``snapshot + later batches`` always gives
the same table as all changes at once, also when a later batch brings older rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import (
    OP,
    SEQ,
    ChangeSpec,
    after_truncate,
    finish,
    reduce_log,
    to_log,
)
from tidemark.sinks.tables import trigger_options, write_files
from tidemark.workspace import child_names, is_complete

@dataclass(frozen=True)
class ChangeTarget:
    """A target table kept as change log and snapshots in the folder ``root``."""

    root: str
    spec: ChangeSpec

    # -- writing ---------------------------------------------------------------

    def write_batch(self, changes: DataFrame, batch_id: int) -> None:
        """Reduce one batch of feed rows and put it into the log, replacing batch ``batch_id``."""
        reduced = reduce_log(to_log(changes, self.spec), self.spec)
        write_files(reduced, self._batch(batch_id), "parquet", "overwrite")

    def start(
        self,
        stream: DataFrame,
        checkpoint: str,
        once: bool | None = None,
        interval: str = "1 minute",
    ) -> StreamingQuery:
        """Follow ``stream``. Each progress event counts rows and rejected rows under ``feed``."""
        counted = stream.observe(
            "feed",
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.expr(self.spec.sequence).isNull()).alias("rejected"),
        )
        writer = counted.writeStream.foreachBatch(self.write_batch).option(
            "checkpointLocation", checkpoint
        )
        if self.spec.name:
            writer = writer.queryName(self.spec.name)
        run_once = self.spec.once if once is None else once
        return writer.trigger(**trigger_options(run_once, interval)).start()

    def compact(self, spark: SparkSession) -> int | None:
        """Fold all complete batches into a new snapshot; returns its id, or None if none is new."""
        snapshot, batches = self._state(spark)
        if not batches:
            return None
        last = max(batches)
        write_files(self._merged(spark, snapshot, batches), self._snapshot(last), "parquet", "overwrite")
        return last

    # -- reading ---------------------------------------------------------------

    def log(self, spark: SparkSession) -> DataFrame | None:
        """The latest snapshot and the batches after it, in log form; None before any batch."""
        snapshot, batches = self._state(spark)
        if snapshot is None and not batches:
            return None
        return self._read(spark, snapshot, batches)

    def table(self, spark: SparkSession) -> DataFrame:
        """The target table as of the complete batches: keys first, then the other columns."""
        snapshot, batches = self._state(spark)
        if snapshot is None and not batches:
            raise FileNotFoundError(f"no complete batch below {self.root}")
        if self.spec.scd_type == 2:
            log = self._read(spark, snapshot, batches)
        else:
            log = self._merged(spark, snapshot, batches)
        return finish(log, self.spec, [c for c in log.columns if c not in (SEQ, OP)])

    def _merged(self, spark: SparkSession, snapshot: int | None, batches: list[int]) -> DataFrame:
        """Snapshot and batches as one reduced log.

        A snapshot is reduced already: only its rows with a key of the log take part
        in the reduction, all others pass as they are. Spark joins the log's keys as
        their size allows. Rows that a truncate has cleared are left out.
        """
        if not batches:
            return self._read(spark, snapshot, [])
        if snapshot is None or self.spec.truncates:
            every = self._read(spark, snapshot, batches)
            return reduce_log(after_truncate(every, self.spec), self.spec)
        log = self._read(spark, None, batches)
        stored = self._read(spark, snapshot, [])
        changed = log.select(*[F.col(k).alias(f"_in_{k}") for k in self.spec.keys]).distinct()
        same = F.lit(True)
        for k in self.spec.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_in_{k}"))
        touched = stored.join(changed, same, "left_semi").unionByName(log, allowMissingColumns=True)
        untouched = stored.join(changed, same, "left_anti")
        reduced = reduce_log(touched, self.spec)
        return reduced.unionByName(untouched, allowMissingColumns=True)

    # -- folders ---------------------------------------------------------------

    def _batch(self, batch_id: int) -> str:
        return f"{self.root}/log/batch={batch_id}"

    def _snapshot(self, batch_id: int) -> str:
        return f"{self.root}/snapshot={batch_id}"

    def _state(self, spark: SparkSession) -> tuple[int | None, list[int]]:
        """The latest complete snapshot and the complete batches after it."""
        snapshot = None
        for number in reversed(_numbers(spark, self.root, "snapshot")):
            if is_complete(spark, self._snapshot(number)):
                snapshot = number
                break
        later = [
            b
            for b in _numbers(spark, f"{self.root}/log", "batch")
            if snapshot is None or b > snapshot
        ]
        return snapshot, [b for b in later if is_complete(spark, self._batch(b))]

    def _read(self, spark: SparkSession, snapshot: int | None, batches: list[int]) -> DataFrame:
        folders = [] if snapshot is None else [self._snapshot(snapshot)]
        # a column that came later is null in the batches before it
        return spark.read.option("mergeSchema", "true").parquet(*folders, *[self._batch(b) for b in batches])


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    found = []
    for name in child_names(spark, folder):
        kind, _, number = name.partition("=")
        if kind == prefix and number.isdigit():
            found.append(int(number))
    return sorted(found)


def specs_from_config(
    config: Mapping[str, Mapping], sequence_default: str | None = None
) -> dict[str, ChangeSpec]:
    """Load settings per table (``keys``, ``sequence_column``, ``stored_as_scd_type``) as specs."""
    specs = {}
    for table, settings in config.items():
        unknown = set(settings) - {"keys", "sequence_column", "stored_as_scd_type"}
        if unknown:
            raise ValueError(f"table {table!r}: unknown settings {sorted(unknown)}")
        sequence = settings.get("sequence_column", sequence_default)
        if not settings.get("keys") or not sequence:
            raise ValueError(f"table {table!r}: keys and sequence_column are required")
        specs[table] = ChangeSpec(
            keys=list(settings["keys"]),
            sequence=sequence,
            scd_type=settings.get("stored_as_scd_type", 1),
            name=f"base_load_{table}",
            once=True,
        )
    return specs


def start_flows(
    streams: Mapping[str, DataFrame],
    specs: Mapping[str, ChangeSpec],
    root: str,
    checkpoint_root: str,
    once: bool | None = None,
) -> dict[str, tuple[ChangeTarget, StreamingQuery]]:
    """One change flow per dataset; a dataset without a spec fails before any flow starts."""
    missing = sorted(set(streams) - set(specs))
    if missing:
        raise ValueError(f"no load settings for {missing}")
    flows = {}
    for name, stream in streams.items():
        target = ChangeTarget(f"{root}/{name}", specs[name])
        flows[name] = (target, target.start(stream, f"{checkpoint_root}/{name}", once))
    return flows
