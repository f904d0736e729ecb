"""The event table as a change feed: current state, history, streams, late batches.

An event is a change of its user; ``ts`` is the sequence, an ``error`` deletes the
user and an exceptionally large value truncates the target.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.audit import AUDIT_COLUMN, INGEST_SEQUENCE
from tidemark.operators.changes import ChangeSpec, apply_changes
from tidemark.operators.star import lookup_keys
from tidemark.plans.sales import dim_calendar, dim_customer, table
from tidemark.sinks.tables import (
    TableLayout,
    materialize,
    stream_to_files,
    stream_to_table,
    write_files,
)
from tidemark.sources.files import file_stream
from tidemark.sources.load import LoadSpec, load
from tidemark.streaming.upsert import ChangeTarget, specs_from_config, start_flows
from tidemark.workspace import folder_tag, shared_folder

DELETES = "event_type = 'error'"
TRUNCATES = "value > 300"

# A micro-batch takes this many files, so that a failure repeats a part and not everything.
FILES_PER_BATCH = 1000

ORDERS_CONFIG = {
    "orders": {
        "keys": ["o_orderkey"],
        "sequence_column": INGEST_SEQUENCE,
        "stored_as_scd_type": 1,
    }
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def sparse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that leave some columns unset."""
    return events(spark, sf_dir).withColumns(
        {
            "value": F.when(F.col("event_type") != "view", F.col("value")),
            "props": F.when(~F.col("event_type").isin("click", "signup"), F.col("props")),
        }
    )


def _spec(**settings) -> ChangeSpec:
    return ChangeSpec(**{"keys": ["user_id"], "sequence": "ts", **settings})


def scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_changes(events(spark, sf_dir), _spec())


def scd1_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_changes(events(spark, sf_dir), _spec(keys=["user_id", "event_type"]))


def scd1_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_changes(events(spark, sf_dir), _spec(deletes=DELETES))


def scd1_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_changes(events(spark, sf_dir), _spec(deletes=DELETES, truncates=TRUNCATES))


def scd1_ignore_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _spec(deletes=DELETES, ignore_null_updates=True)
    return apply_changes(sparse_events(spark, sf_dir), spec)


def scd1_ignore_nulls_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _spec(truncates=TRUNCATES, ignore_null_updates=True)
    return apply_changes(sparse_events(spark, sf_dir), spec)


def scd1_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_changes(events(spark, sf_dir), _spec(columns=["user_id", "event_type", "value"]))


def scd1_except_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_changes(events(spark, sf_dir), _spec(except_columns=["props", "event_id"]))


def scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_changes(events(spark, sf_dir), _spec(scd_type=2))


def scd2_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_changes(events(spark, sf_dir), _spec(scd_type=2, deletes=DELETES))


def scd2_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _spec(scd_type=2, deletes=DELETES, track=["event_type"])
    return apply_changes(events(spark, sf_dir), spec)


def scd2_tracked_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history with every long run of a key cut into chunks."""
    spec = _spec(scd_type=2, deletes=DELETES, track=["event_type"], max_run_rows=20)
    return apply_changes(events(spark, sf_dir), spec)


def scd2_except_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _spec(scd_type=2, except_track=["event_id", "ts", "value", "props"])
    return apply_changes(events(spark, sf_dir), spec)


def scd2_ignore_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _spec(scd_type=2, deletes=DELETES, ignore_null_updates=True)
    return apply_changes(sparse_events(spark, sf_dir), spec)


def scd2_ignore_nulls_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sequence for a whole day, so that most updates of a user are tied and merge column by column.

    Each column is set by one event of a user and day, the smallest, so that what they merge to does not hang on a hash.
    """
    day = F.to_date("ts")
    first = F.row_number().over(Window.partitionBy("user_id", day).orderBy("event_id"))
    feed = events(spark, sf_dir).select("user_id", day.alias("ts"), "event_type", "value", "props", first.alias("nth"))
    columns = ("event_type", "value", "props")
    sparse = {c: F.when(F.col("nth") == i + 1, F.col(c)) for i, c in enumerate(columns)}
    spec = _spec(scd_type=2, ignore_null_updates=True)
    return apply_changes(feed.withColumns(sparse).drop("nth"), spec)


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed in two steps, the second with two more columns, which the second start of the stream adds."""
    root = shared_folder(spark, "drift")
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    steps = [orders.filter(early).select("o_orderkey", "o_custkey", "o_totalprice"), orders.filter(~early)]
    for step in steps:
        write_files(step, f"{root}/landing", "parquet", "append")
        stream = file_stream(spark, f"{root}/landing", "parquet", schema_location=f"{root}/schema", max_files_per_trigger=FILES_PER_BATCH)
        stream_to_files(stream, f"{root}/raw", f"{root}/checkpoint").awaitTermination()
    raw = spark.read.option("mergeSchema", "true").parquet(f"{root}/raw")
    return raw.select(*orders.columns)


def late_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in batches that ignore its order, one replayed, a snapshot in between."""
    target = ChangeTarget(shared_folder(spark, "late"), _spec(deletes=DELETES))
    feed = events(spark, sf_dir)
    batch = F.pmod(F.xxhash64("event_id"), F.lit(3))
    target.write_batch(feed.filter(batch == 2), 0)
    target.write_batch(feed.filter(batch == 0), 1)
    target.compact(spark)
    target.write_batch(feed.filter(batch == 1), 2)
    target.write_batch(feed.filter(batch == 1), 2)
    return target.table(spark).select(*feed.columns)


def late_batches_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with unset columns, which merge column by column across snapshots."""
    spec = _spec(deletes=DELETES, ignore_null_updates=True)
    target = ChangeTarget(shared_folder(spark, "late-sparse"), spec)
    feed = sparse_events(spark, sf_dir)
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    target.write_batch(feed.filter(~early), 0)
    target.compact(spark)
    target.write_batch(feed.filter(early), 1)
    return target.table(spark).select(*feed.columns)


def in_loads(rows: DataFrame, key: str, loads: int) -> list[DataFrame]:
    """Rows dealt into so many loads by a hash of ``key``, without a shuffle."""
    load = F.pmod(F.hash(key), F.lit(loads))
    return [rows.filter(load == number) for number in range(loads)]


def follow_loads(loads: Sequence[DataFrame], landing: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Each load lands, in as many files as tasks read it, and is followed as one micro-batch before the next one lands.

    So the number of batches is that of the loads, and no task has to write or read one whole.
    """
    for rows in loads:
        write_files(rows, landing, "parquet", "append")
        start(file_stream(rows.sparkSession, landing, "parquet")).awaitTermination()


def _follow_events(spark: SparkSession, sf_dir: str, target: ChangeTarget, root: str) -> DataFrame:
    """Events land in several loads without order, so that later batches bring older rows."""
    loads = in_loads(events(spark, sf_dir), "event_id", 4)
    follow_loads(loads, f"{root}/landing", lambda stream: target.start(stream, f"{root}/checkpoint"))
    return target.table(spark)


def upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event files as a stream, upserted batch by batch until all are read."""
    root = shared_folder(spark, "upsert")
    return _follow_events(spark, sf_dir, ChangeTarget(f"{root}/target", _spec(name="events_upsert", once=True)), root)


def history_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream kept as type 2 history."""
    root = shared_folder(spark, "history")
    spec = _spec(scd_type=2, deletes=DELETES, name="events_history", once=True)
    return _follow_events(spark, sf_dir, ChangeTarget(f"{root}/target", spec), root)


def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as JSON and ingested file by file, all values as text, then typed.

    The columns are known, so no pass over the text is spent on inferring them.
    """
    root = shared_folder(spark, "json")
    as_text = T.StructType([T.StructField(c, T.StringType()) for c in events(spark, sf_dir).columns])
    write_files(events(spark, sf_dir), f"{root}/landing", "json")
    raw = load(
        spark,
        LoadSpec(
            "volume",
            path=f"{root}/landing",
            filetype="json",
            source_system="events",
            schema=as_text,
            max_files_per_trigger=FILES_PER_BATCH,
        ),
    )
    stream_to_files(raw, f"{root}/raw", f"{root}/checkpoint", "parquet").awaitTermination()
    return spark.read.parquet(f"{root}/raw").select(
        F.col("event_id").cast("long").alias("event_id"),
        F.col("user_id").cast("long").alias("user_id"),
        "event_type",
        F.col("value").cast("double").alias("value"),
        "props",
        F.col(AUDIT_COLUMN)["SourceSystem"].alias("source_system"),
    )


def ingest_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders ingested with the audit struct; every row has an ingest time."""
    root = shared_folder(spark, "parquet")
    raw = load(
        spark,
        LoadSpec(
            "volume",
            path=f"{sf_dir}/orders.parquet",
            filetype="parquet",
            source_system="orders",
            max_files_per_trigger=FILES_PER_BATCH,
        ),
    )
    stream_to_files(raw, f"{root}/raw", f"{root}/checkpoint", "parquet").awaitTermination()
    return spark.read.parquet(f"{root}/raw").select(
        *table(spark, sf_dir, "orders").columns,
        F.col(AUDIT_COLUMN)["SourceSystem"].alias("source_system"),
        F.expr(INGEST_SEQUENCE).isNotNull().alias("has_ingest_time"),
    )


def stream_table_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table streamed into another one."""
    root = shared_folder(spark, "tables")
    tag = folder_tag(root)
    source, copy = f"customer_{tag}", f"customer_copy_{tag}"
    customers = table(spark, sf_dir, "customer")
    materialize(customers, source, "customers", TableLayout(path=f"{root}/source"))
    stream = load(spark, LoadSpec("table_stream", name=source, source_system="sales"))
    stream_to_table(
        stream, copy, f"{root}/checkpoint", layout=TableLayout(path=f"{root}/copy")
    ).awaitTermination()
    return load(spark, LoadSpec("table", name=copy)).select(
        *customers.columns, F.col(AUDIT_COLUMN)["SourceSystem"].alias("source_system")
    )


def layered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing to report: orders ingested raw, upserted into base, looked up, summed by year."""
    root = shared_folder(spark, "layers")
    raw = load(
        spark,
        LoadSpec(
            "volume",
            path=f"{sf_dir}/orders.parquet",
            filetype="parquet",
            source_system="orders",
            max_files_per_trigger=FILES_PER_BATCH,
        ),
    )
    flows = start_flows(
        {"orders": raw}, specs_from_config(ORDERS_CONFIG), f"{root}/base", f"{root}/checkpoints"
    )
    target, query = flows["orders"]
    query.awaitTermination()
    base = target.table(spark).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_key"),
        F.to_date("o_orderdate").alias("calendar_order_key"),
        "o_totalprice",
    )
    calendar = dim_calendar(spark)
    facts = lookup_keys(base, {"customer": dim_customer(spark, sf_dir), "calendar": calendar})
    years = calendar.select(F.col("calendar_id").alias("calendar_order_id"), "year")
    return (
        facts.groupBy("calendar_order_id")
        .agg(
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"),
            F.count("customer_id").alias("n"),
        )
        .join(years, "calendar_order_id", "left")
        .groupBy(F.col("year").alias("order_year"))
        .agg(
            F.sum("total").cast("double").alias("total"),
            F.sum("n").alias("orders_with_customer"),
        )
    )
