from __future__ import annotations

import datetime
import random
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import feeds, targets
from tidemark.plans.feeds import in_loads
from tidemark.streaming.effective import _greatest_by_row, _greatest_by_sorting, _reduced


def stored(rows, path):
    rows.repartition(4).write.parquet(str(path))


def lines(spark):
    return spark.range(400).select(
        F.when(F.col("id") % 10 > 0, F.col("id") % 100).alias("l_orderkey"),
        F.col("id").alias("l_linenumber"),
        F.when(F.col("id") % 7 > 0, (F.col("id") % 12) / 100).alias("l_discount"),
        (F.col("id") % 50).cast("double").alias("l_quantity"),
    )


def users(spark):
    return spark.range(400).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id)").alias("ts"),
        F.when(F.col("id") % 20 > 0, F.col("id") % 20).alias("user_id"),
        F.when(F.col("id") % 3 > 0, "view").otherwise("error").alias("event_type"),
        F.lit(1.5).alias("value"),
        F.lit("{}").alias("props"),
    )


def test_loads_hold_each_row_once(spark):
    loads = in_loads(lines(spark), "l_orderkey", 3)
    assert all("Exchange" not in x._jdf.queryExecution().executedPlan().toString() for x in loads)
    found = [[r.l_linenumber for r in x.collect()] for x in loads]
    assert all(found) and sorted(sum(found, [])) == [*range(400)]


def test_no_batch_of_lines_is_one_task(spark, tmp_path):
    stored(lines(spark), tmp_path / "lineitem.parquet")
    target = targets._checked_lines(spark, str(tmp_path))
    written = targets.read_target(spark, target, lines(spark).schema)
    assert sorted(r.l_linenumber for r in written.collect()) == [i for i in range(400) if i % 7 and i % 12 <= 8]
    per_batch = written.select(F.regexp_extract("_metadata.file_path", r"/(batch=\d+)/", 1).alias("b"), "_metadata.file_path").distinct().groupBy("b").count().collect()
    assert len(per_batch) == 3 and all(r["count"] > 1 for r in per_batch)
    counted = targets.read_counters(spark, target).groupBy("rule").agg(F.sum("rows"), F.sum("violations"), F.count_distinct("batch")).collect()
    dropped = sum(i % 7 == 0 or i % 12 > 8 for i in range(400))
    assert {tuple(r) for r in counted} == {("small discount", 400, dropped, 3), ("few", 400, 40, 3)}


def test_batches_do_not_grow_with_the_files_of_a_table(spark, tmp_path, monkeypatch):
    stored(users(spark), tmp_path / "events.parquet")
    for plans, query, log in ((targets, "upsert_stateful", "target/log"), (targets, "upsert_stored", "target/state"), (feeds, "upsert_stream", "target/log")):
        root = tmp_path / query
        monkeypatch.setattr(plans, "shared_folder", lambda spark, purpose, root=root: str(root))
        got = {r.user_id: r.event_id for r in getattr(plans, query)(spark, str(tmp_path)).collect()}
        last = {i % 20 or None: i for i in range(400)}
        assert got == {u: i for u, i in last.items() if query != "upsert_stateful" or i % 3}
        assert len(list((root / log).glob("batch=*"))) == 4
        assert len(list((root / "landing").glob("part-*"))) > (7 if query == "upsert_stateful" else 4)


def test_sorting_finds_the_rows_that_comparing_finds():
    rng = random.Random(3)
    kinds = {
        "k": (T.DoubleType(), pa.float64(), [None, float("nan"), -0.0, 0.0, 1.5]),
        "s": (T.StringType(), pa.string(), [None, "", "é", "z", "\U0001f600", "�"]),
        "seq": (T.LongType(), pa.int64(), [1, 2]),
        "f": (T.FloatType(), pa.float32(), [None, float("nan"), float("inf"), float("-inf"), -0.0, 0.0, -1.5]),
        "d": (T.DecimalType(9, 2), pa.decimal128(9, 2), [None, Decimal("-1.00"), Decimal("10.50"), Decimal("9.99")]),
        "t": (T.TimestampNTZType(), pa.timestamp("us"), [None, datetime.datetime(2024, 1, 1), datetime.datetime(1960, 1, 1, 0, 0, 0, 1)]),
        "y": (T.DateType(), pa.date32(), [None, datetime.date(1960, 1, 1), datetime.date(2024, 1, 1)]),
        "b": (T.BooleanType(), pa.bool_(), [None, False, True]),
        "x": (T.BinaryType(), pa.binary(), [None, b"", b"\x7f", b"\xff"]),
    }
    schema = T.StructType([T.StructField(n, kind) for n, (kind, _, _) in kinds.items()])
    for count in (0, 1, 2, 30, 2000):
        rows = pa.table({n: pa.array([rng.choice(values) for _ in range(count)], kind) for n, (_, kind, values) in kinds.items()})
        by_row, by_sorting = _greatest_by_row(rows, schema, 2, False), _greatest_by_sorting(rows, 2)
        seen = [sorted(str([float(v) + 0 if isinstance(v, float) else v for v in r.values()]) for r in t.to_pylist()) for t in (by_row, by_sorting)]
        assert seen[0] == seen[1] and by_sorting.schema == rows.schema


def test_a_run_is_reduced_across_arrow_batches(spark):
    log = spark.range(100_000, numPartitions=1).selectExpr("id % 7 as k", "id as _seq", "0 as _op", "named_struct('v', id) as s")
    for rows in (log, log.drop("s")):
        got = _reduced(rows, 1, False).collect()
        assert len(got) <= 2 * 7  # runs of 50,000 rows
        assert {max(r._seq for r in got if r.k == k) for k in range(7)} == {*range(99_993, 100_000)}
    own = log.drop("s").withColumn("k", F.col("_seq"))
    assert _reduced(own, 1, False).agg(F.count_distinct("k")).first()[0] == 100_000
