from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests import model
from tests.test_changes import current, frame, history, random_rows, row, spec
from tidemark.operators.quality import Rule
from tidemark.sinks.tables import write_files
from tidemark.sources.files import file_stream
from tidemark.streaming.buckets import BucketedTarget
from tidemark.streaming.rules import read_counters, read_target, stream_with_rules
from tidemark.workspace import shared_folder


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), ignore_nulls=st.booleans())
def test_any_split_gives_the_current_rows(spark, seed, ignore_nulls):
    rows = random_rows(seed, 30, ops="uuuuudt", seqs=200)
    rows = list({(r["k"], r["seq"]): r for r in rows}.values())
    target = BucketedTarget(shared_folder(spark, "buckets"), spec(ignore_null_updates=ignore_nulls, truncates="op = 't'"), buckets=3)
    for number in range(3):
        target.write_batch(frame(spark, rows[number::3]), number)
    target.write_batch(frame(spark, rows[2::3]), 2)  # a replay
    assert current(target.table(spark).select("k", "a", "b")) == model.scd1(rows, ignore_nulls)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), ignore_nulls=st.booleans())
def test_any_split_gives_the_history(spark, seed, ignore_nulls):
    rows = random_rows(seed, 40, seqs=60)
    target = BucketedTarget(shared_folder(spark, "buckets"), spec(scd_type=2, track=["a"], ignore_null_updates=ignore_nulls), buckets=4)
    for number in range(3):
        target.write_batch(frame(spark, rows[number::3]), number)
    assert history(target.table(spark)) == model.scd2(rows, ignore_nulls, [0])


def test_only_touched_buckets_are_rewritten_and_reading_is_a_scan(spark):
    target = BucketedTarget(shared_folder(spark, "buckets"), spec(scd_type=2), buckets=16)
    target.write_batch(frame(spark, [row(f"k{i}", 1, a=i) for i in range(60)]), 0)
    before = target.manifest(spark).written
    target.write_batch(frame(spark, [row("k7", 5, a=1), row("k7", 3, a=2)]), 1)
    after = target.manifest(spark).written
    changed = [b for b in after if after[b] != before.get(b)]
    assert len(before) > 8 and len(changed) == 1 and after[changed[0]] == 1
    table = target.table(spark)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert [(r.valid_from, r.valid_to) for r in table.filter("k = 'k7'").orderBy("valid_from").collect()] == [(1, 3), (3, 5), (5, None)]
    # what no manifest names goes, and the table stays
    target.write_batch(frame(spark, []), 2)
    expected = history(table)
    assert target.vacuum(spark, keep=1) == 2 and target.vacuum(spark, keep=1) == 0
    assert history(target.table(spark)) == expected and target.table(spark).count() == 62


def test_new_columns_nulls_deletes_and_an_empty_start(spark):
    target = BucketedTarget(shared_folder(spark, "buckets"), spec(deletes="op = 'd'"), buckets=2)
    with pytest.raises(FileNotFoundError):
        target.table(spark)
    target.write_batch(frame(spark, []), 0)
    assert target.table(spark).count() == 0
    target.write_batch(frame(spark, [row("x", 1, a=1), row("y", 1, a=2)]), 1)
    target.write_batch(frame(spark, [row("z", 2, a=3)]).withColumn("more", F.lit("m")), 2)
    target.write_batch(frame(spark, [row("x", 3, "d")]), 3)
    target.register(spark, "bucketed_rows")
    got = {r.k: r.more for r in spark.table("bucketed_rows").collect()}
    assert got == {"y": None, "z": "m"}
    assert target.log(spark).count() == 3  # the tombstone stays


def test_rules_and_row_filter_of_a_change_target(spark):
    rules = [Rule("a is set", "a is not null", "expect_or_drop"), Rule("small", "a < 100", "expect_or_fail")]
    target = BucketedTarget(shared_folder(spark, "buckets"), spec(), buckets=2, rules=rules, visible_rows="a > 1")
    target.write_batch(frame(spark, [row("x", 1, a=1), row("y", 1, a=2), row("z", 1)]), 0)
    with pytest.raises(Exception, match="expectation violated: small"):
        target.write_batch(frame(spark, [row("y", 2, a=500)]), 1)
    assert current(target.table(spark)) == {"y": (2, None)}
    counted = {(r.batch, r.rule): (r.rows, r.violations) for r in read_counters(spark, target.root).collect()}
    assert counted == {(0, "a is set"): (3, 1), (0, "small"): (3, 1)}


def test_a_stream_with_rules_stops_before_the_batch_that_fails(spark):
    root = shared_folder(spark, "rules")
    for low in (0, 10, 20):
        write_files(spark.range(low, low + 10).coalesce(1), f"{root}/landing", "parquet", "append")
    rules = [Rule("even", "id % 2 = 0", "expect_or_drop"), Rule("below", "id < 25", "expect_or_fail")]

    def follow():
        stream = file_stream(spark, f"{root}/landing", "parquet", max_files_per_trigger=1)
        query = stream_with_rules(stream, f"{root}/target", f"{root}/checkpoint", rules, schema="id long")
        with pytest.raises(Exception, match="below"):
            query.awaitTermination()

    for _ in range(2):  # a restart meets the same batch again
        follow()
        got = sorted(r.id for r in read_target(spark, f"{root}/target").collect())
        assert got == list(range(0, 20, 2))
        assert read_target(spark, f"{root}/target", visible_rows="id > 10").count() == 4
        counted = sorted(tuple(r) for r in read_counters(spark, f"{root}/target").filter("rule = 'even'").collect())
        assert counted == [(0, "even", "expect_or_drop", 10, 5), (1, "even", "expect_or_drop", 10, 5)]
