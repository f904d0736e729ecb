"""Streams into stored targets: tables kept in buckets, rules by batch, files whose columns grow, snapshots compared."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import ChangeSpec
from tidemark.operators.quality import Rule
from tidemark.operators.snapshots import snapshot_diff
from tidemark.plans.feeds import follow_loads, in_loads
from tidemark.plans.sales import table
from tidemark.sinks.tables import write_files
from tidemark.sources.files import file_stream
from tidemark.streaming.buckets import BucketedTarget
from tidemark.streaming.effective import StatefulTarget
from tidemark.streaming.ingest import ingest, read_ingested, start_ingest
from tidemark.streaming.rules import read_counters, read_target, stream_with_rules
from tidemark.workspace import shared_folder

LINE_RULES = [
    Rule("small discount", "l_discount <= 0.08", "expect_or_drop"),
    Rule("few", "l_quantity < 45", "expect"),
]


def _stored_events(spark: SparkSession, sf_dir: str, **settings) -> BucketedTarget:
    """Events landed in four loads without order, a load a batch, followed into buckets."""
    root = shared_folder(spark, "stored")
    target = BucketedTarget(f"{root}/target", ChangeSpec(["user_id"], "ts", once=True, **settings), buckets=8)
    loads = in_loads(table(spark, sf_dir, "events"), "event_id", 4)
    follow_loads(loads, f"{root}/landing", lambda stream: target.start(stream, f"{root}/checkpoint"))
    return target


def history_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event files as type 2 history that is stored, and read as it is."""
    return _stored_events(spark, sf_dir, scd_type=2, deletes="event_type = 'error'").table(spark)


def upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event files as a stored table of each user's last event."""
    return _stored_events(spark, sf_dir).table(spark)


def upsert_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event files by keyed state: three loads land without order, then all events once more, of which only news are logged."""
    root = shared_folder(spark, "stateful")
    feed = table(spark, sf_dir, "events")
    target = StatefulTarget(f"{root}/target", ChangeSpec(["user_id"], "ts", deletes="event_type = 'error'", once=True))
    part = F.pmod(F.xxhash64("event_id"), F.lit(4))
    loads = [*in_loads(feed.filter(part > 0), "event_id", 3), feed]
    follow_loads(loads, f"{root}/landing", lambda stream: target.start(stream, f"{root}/checkpoint"))
    return target.table(spark).select(*feed.columns)


def _checked_lines(spark: SparkSession, sf_dir: str) -> str:
    root = shared_folder(spark, "checked")
    lines = table(spark, sf_dir, "lineitem")

    def start(stream: DataFrame) -> StreamingQuery:
        return stream_with_rules(stream, f"{root}/target", f"{root}/checkpoint", LINE_RULES, schema=lines.schema)

    follow_loads(in_loads(lines, "l_orderkey", 3), f"{root}/landing", start)
    return f"{root}/target"


def stream_expect_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines streamed in three batches; those that violate a dropping rule stay out."""
    return read_target(spark, _checked_lines(spark, sf_dir), table(spark, sf_dir, "lineitem").schema)


def stream_rule_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules met in those batches: the counters of all batches, by rule."""
    counters = read_counters(spark, _checked_lines(spark, sf_dir))
    return counters.groupBy("rule", "action").agg(F.sum("rows").alias("rows"), F.sum("violations").alias("violations"), F.count_distinct("batch").alias("batches"))


def stream_expect_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders land and are streamed; then open ones land, which stop the stream and leave no trace."""
    root = shared_folder(spark, "refused")
    orders = table(spark, sf_dir, "orders")
    rules = [Rule("finished", "o_orderstatus = 'F'", "expect_or_fail")]
    for step in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'"):
        write_files(orders.filter(step), f"{root}/landing", "parquet", "append")
        stream = file_stream(spark, f"{root}/landing", "parquet", orders.schema)
        query = stream_with_rules(stream, f"{root}/target", f"{root}/checkpoint", rules)
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            if "expectation violated: finished" not in str(error):
                raise
    return read_target(spark, f"{root}/target", orders.schema)


def ingest_late_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose later files bring more columns while the stream runs: none of them is lost."""
    root = shared_folder(spark, "late-column")
    places = (f"{root}/landing", "parquet", f"{root}/raw", f"{root}/checkpoint", f"{root}/schema")
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    write_files(orders.filter(early).select("o_orderkey", "o_custkey", "o_totalprice"), places[0], "parquet", "append")
    running = start_ingest(spark, *places, once=False, interval="1 second")
    try:
        running.processAllAvailable()
        write_files(orders.filter(~early), places[0], "parquet", "append")
        running.processAllAvailable()
    except StreamingQueryException:
        pass  # it stops when it meets the new columns
    finally:
        running.stop()
    ingest(spark, *places)
    return read_ingested(spark, f"{root}/raw").select(*orders.columns)


def ingest_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as JSON twice, the second time with more columns; nobody names the columns."""
    root = shared_folder(spark, "json-inferred")
    places = (f"{root}/landing", "json", f"{root}/raw", f"{root}/checkpoint", f"{root}/schema")
    events = table(spark, sf_dir, "events")
    clicks = F.col("event_type") == "click"
    for step in (events.filter(clicks).select("event_id", "user_id"), events.filter(~clicks).select("event_id", "user_id", "event_type", "value")):
        write_files(step, places[0], "json", "append")
        ingest(spark, *places)
    raw = read_ingested(spark, f"{root}/raw")
    return raw.select(F.col("event_id").cast("long").alias("event_id"), F.col("user_id").cast("long").alias("user_id"), "event_type", F.col("value").cast("double").alias("value"))


def orders_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of the orders, compared: some are missing in each, some have another price or none."""
    orders = table(spark, sf_dir, "orders")
    digit = F.col("o_orderkey") % 100
    old = orders.filter(digit != 1)
    price = F.when(digit == 3, F.col("o_totalprice") + 1).when(digit != 4, F.col("o_totalprice"))
    new = orders.filter(digit != 2).withColumn("o_totalprice", price)
    return snapshot_diff(old, new, ["o_orderkey"])
