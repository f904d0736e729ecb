"""Change targets followed continuously: keyed state passes on only the changes that matter.

The state of a key is what the reduction of its changes so far gives. A change that
leaves it as it is (one that came late, or again) goes no further, so the change log
and whatever follows it see each effective change once.

The state decides only what is worth logging. Reduced logs merge in any order and
grouping, so a key whose state is forgotten costs a repeated log row and never a wrong
table. That is why the state may be bounded by time, tombstones included.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isnan

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.operators.changes import OP, SEQ, ChangeSpec, to_log
from tidemark.operators.latest import is_orderable
from tidemark.sinks.tables import spark_settings, trigger_options, write_files
from tidemark.streaming.upsert import ChangeTarget

# State that expires would have a query that runs once go on with empty batches for ever.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}

# Columns that Arrow sorts as Spark does.
SORTED = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampNTZType)

# What a task holds at most while it reduces a log, beside one Arrow batch.
RUN_ROWS, RUN_BYTES = 50_000, 16 << 20


def plain(value):
    """A value without Row or dict, structs as tuples."""
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if isinstance(value, tuple):
        return tuple(plain(v) for v in value)
    return [plain(v) for v in value] if isinstance(value, list) else value


def position(value):
    """What orders values as Spark does: null first, NaN last, structs and arrays from left to right."""
    if value is None:
        return (False,)
    if isinstance(value, (tuple, list)):
        return (True, tuple(position(v) for v in value))
    if isinstance(value, float):
        return (True, isnan(value), 0.0 if isnan(value) else value)
    return (True, value)


def merged(a: tuple | None, b: tuple, by_column: bool) -> tuple:
    """Two log rows of a key, without the key, as one: the greater, or sequence and operation and then each column for itself."""
    if a is None:
        return b
    if not by_column:
        return max(a, b, key=position)
    return (*max(a[:2], b[:2], key=position), *[max(x, y, key=position) for x, y in zip(a[2:], b[2:], strict=True)])


class _Latest(StatefulProcessor):
    def __init__(self, log: T.StructType, width: int, by_column: bool, ttl_ms: int | None) -> None:
        self.log, self.width, self.by_column, self.ttl_ms = log, width, by_column, ttl_ms
        self.value = T.StructType(log.fields[width:])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", self.value, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.latest.get()  # each call to the state is a round trip
        before = None if known is None else plain(tuple(known))
        now = before
        for row in rows:
            now = merged(now, plain(tuple(row))[self.width :], self.by_column)
        if before is None or position(now) != position(before):
            self.latest.update(now)
            yield Row(**_in_fields((*key, *now), self.log))

    def close(self) -> None:
        pass


def _reduced(log: DataFrame, width: int, by_column: bool) -> DataFrame:
    """The log reduced within runs of Arrow batches, in bounded memory."""
    schema = log.schema
    sorts = not by_column and all(isinstance(f.dataType, SORTED) for f in schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in held) >= RUN_ROWS or sum(t.nbytes for t in held) >= RUN_BYTES:
                held = [reduce(held)]
                if held[0].num_rows > RUN_ROWS // 2 or held[0].nbytes > RUN_BYTES // 2:
                    yield from held.pop().to_batches()
        if held:
            yield from reduce(held).to_batches()

    def reduce(held: list[pa.Table]) -> pa.Table:
        rows = pa.concat_tables(held).combine_chunks()
        return _greatest_by_sorting(rows, width) if sorts else _greatest_by_row(rows, schema, width, by_column)

    return log.mapInArrow(run, schema)


def _greatest_by_row(rows: pa.Table, schema: T.StructType, width: int, by_column: bool) -> pa.Table:
    best: dict = {}
    for row in zip(*[[plain(v) for v in c.to_pylist()] for c in rows.columns], strict=True):
        key = position(row[:width])
        known = best.get(key)
        best[key] = row if known is None else (*row[:width], *merged(known[width:], row[width:], by_column))
    return pa.Table.from_pylist([_in_fields(row, schema) for row in best.values()], rows.schema)


def _greatest_by_sorting(rows: pa.Table, width: int) -> pa.Table:
    """The same for whole rows of plain columns: the last of each key in the order of ``position``."""
    if not rows.num_rows:
        return rows
    parts, keys = {}, []
    for i, column in enumerate(rows.columns):
        if pa.types.is_floating(column.type):  # a NaN is equal to itself and last, zeros are equal
            zero, nan = pa.scalar(0, column.type), pc.is_nan(column)
            parts[f"{i}_nan"] = nan
            column = pc.add(pc.if_else(nan, zero, column), zero)
        parts[f"{i}"] = column
        if i < width:
            keys = [*parts]
    parts["row"] = pa.array(range(rows.num_rows, 0, -1))  # of equal rows the first
    order = pc.sort_indices(pa.table(parts), [(name, "ascending") for name in parts], null_placement="at_start")
    last = None
    for name in keys:
        part = parts[name].take(order)
        here, after = part.slice(0, len(part) - 1), part.slice(1)
        differ = pc.or_(pc.fill_null(pc.not_equal(here, after), False), pc.xor(here.is_null(), after.is_null()))
        last = differ if last is None else pc.or_(last, differ)
    ends = pa.chunked_array([*last.chunks, pa.array([True])])
    return rows.take(order.filter(ends))


def _in_fields(value, kind: T.DataType):
    """Structs from tuples back to fields by name."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return {f.name: _in_fields(v, f.dataType) for f, v in zip(kind.fields, value, strict=True)}
    return [_in_fields(v, kind.elementType) for v in value] if isinstance(kind, T.ArrayType) else value


def _holds_time(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_time(f.dataType) for f in kind.fields)
    return _holds_time(kind.elementType) if isinstance(kind, T.ArrayType) else isinstance(kind, T.TimestampType)


def effective_changes(stream: DataFrame, spec: ChangeSpec, forget_after: str | None = None) -> DataFrame:
    """The changes of a feed that change something, in log form, as a stream.

    Type 1 without truncates. Of a key's changes in a micro-batch one log row comes out,
    their reduction with the key's state, or none if that is the state already. Null keys
    are a key, rows with a null sequence are left out, ties are decided as everywhere.
    ``forget_after`` (an interval such as ``"7 days"``) drops what the state holds of a
    key that long after its last effective change; without it the state holds all keys.
    Columns with maps are refused, and timestamps with a time zone inside structs.
    """
    if spec.scd_type != 1 or spec.truncates:
        raise ValueError("keyed state serves type 1 without truncates")
    log = to_log(stream, spec)
    for field in log.schema.fields:
        if not is_orderable(field.dataType):
            raise ValueError(f"column {field.name!r} has no order")
    # instants go through Python as numbers, which no time zone can change
    instants = [f.name for f in log.schema.fields if isinstance(f.dataType, T.TimestampType)]
    rows = log.withColumns({c: F.unix_micros(c) for c in instants})
    held = [f.name for f in rows.schema.fields if _holds_time(f.dataType)]
    if held:
        raise ValueError(f"timestamps with a time zone inside structs: {held}")
    schema, width = rows.schema, len(spec.keys)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    ttl = None if forget_after is None else int(_milliseconds(stream.sparkSession, forget_after))
    latest = _Latest(schema, width, spec.ignore_null_updates, ttl)
    # a hot key sends few rows to the task of its key, and the state gets about one row a key
    few = _reduced(rows, width, spec.ignore_null_updates).repartition(*spec.keys)
    fewer = _reduced(few, width, spec.ignore_null_updates)
    passed = fewer.groupBy(*spec.keys).transformWithState(latest, schema, "Update", "None" if ttl is None else "ProcessingTime")
    return passed.withColumns({c: F.timestamp_micros(c) for c in instants})


def _milliseconds(spark: SparkSession, interval: str) -> int:
    return spark.sql(f"SELECT unix_millis(timestamp'1970-01-01 00:00:00Z' + interval {interval})").first()[0]


@dataclass(frozen=True)
class StatefulTarget(ChangeTarget):
    """A change target of type 1 whose stream logs effective changes only; read and compacted as any other."""

    forget_after: str | None = None

    def start(self, stream: DataFrame, checkpoint: str, once: bool | None = None, interval: str = "1 minute") -> StreamingQuery:
        """Follow ``stream``; the state lies below ``checkpoint``, so a restart goes on with it."""

        def land(batch: DataFrame, batch_id: int) -> None:
            write_files(batch, self._batch(batch_id), "parquet", "overwrite")

        writer = effective_changes(stream, self.spec, self.forget_after).writeStream.outputMode("update").foreachBatch(land).option("checkpointLocation", checkpoint)
        if self.spec.name:
            writer = writer.queryName(self.spec.name)
        run_once = self.spec.once if once is None else once
        with spark_settings(stream.sparkSession, SETTINGS):  # a query takes the settings of its start
            return writer.trigger(**trigger_options(run_once, interval)).start()
