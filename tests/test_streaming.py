from __future__ import annotations

import json
import random
import shutil

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests import model
from tests.test_changes import current, frame, history, random_rows, row, spec
from tidemark.functions.audit import INGEST_SEQUENCE
from tidemark.operators.changes import ChangeSpec, apply_changes
from tidemark.sinks.tables import await_all, write_files
from tidemark.sources.files import file_stream
from tidemark.streaming import upsert
from tidemark.streaming.upsert import ChangeTarget, specs_from_config, start_flows
from tidemark.workspace import shared_folder


def land(spark, rows, path, mode="overwrite"):
    write_files(frame(spark, rows).coalesce(1), path, "parquet", mode)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), ignore_nulls=st.booleans())
def test_any_split_with_snapshots_gives_the_same_table(spark, seed, ignore_nulls):
    rows = random_rows(seed, 30, ops="uuuuudt", seqs=200)
    rows = list({(r["k"], r["seq"]): r for r in rows}.values())
    s = spec(ignore_null_updates=ignore_nulls, truncates="op = 't'")
    rng = random.Random(seed)
    rng.shuffle(rows)
    batches = [[r for i, r in enumerate(rows) if i % 3 == part] for part in range(3)]
    target = ChangeTarget(shared_folder(spark, "split"), s)
    for number, batch in enumerate(batches):
        target.write_batch(frame(spark, batch), number)
        if rng.random() < 0.6:
            target.compact(spark)
    found = current(target.table(spark).select("k", "a", "b"))
    assert found == model.scd1(rows, ignore_nulls)


def test_type_2_target_across_snapshots(spark):
    rows = random_rows(5, 60, seqs=60)
    s = spec(scd_type=2, track=["a"], ignore_null_updates=True)
    target = ChangeTarget(shared_folder(spark, "history"), s)
    for number in range(3):
        target.write_batch(frame(spark, rows[number::3]), number)
        target.compact(spark)
    assert history(target.table(spark)) == model.scd2(rows, True, [0])


def test_replaying_a_batch_changes_nothing(spark):
    target = ChangeTarget(shared_folder(spark, "replay"), spec())
    rows = [row("x", 1, a=1), row("y", 2, a=2)]
    for _ in range(2):
        target.write_batch(frame(spark, rows), 0)
    assert current(target.table(spark)) == {"x": (1, None), "y": (2, None)}
    assert target.compact(spark) == 0 and target.compact(spark) is None
    target.write_batch(frame(spark, rows), 0)
    assert current(target.table(spark)) == {"x": (1, None), "y": (2, None)}


def test_a_tombstone_survives_compaction(spark):
    target = ChangeTarget(shared_folder(spark, "tombstone"), spec())
    target.write_batch(frame(spark, [row("x", 5, "d")]), 0)
    target.compact(spark)
    target.write_batch(frame(spark, [row("x", 3, a=3)]), 1)
    assert current(target.table(spark)) == {}
    target.write_batch(frame(spark, [row("x", 6, a=6)]), 2)
    assert current(target.table(spark)) == {"x": (6, None)}


def test_unfinished_folders_are_not_read(spark, tmp_path):
    target = ChangeTarget(str(tmp_path / "t"), spec())
    with pytest.raises(FileNotFoundError):
        target.table(spark)
    target.write_batch(frame(spark, [row("x", 1, a=1)]), 0)
    target.write_batch(frame(spark, [row("x", 2, a=2)]), 1)
    (tmp_path / "t" / "log" / "batch=1" / "_SUCCESS").unlink()
    shutil.copytree(tmp_path / "t" / "log" / "batch=1", tmp_path / "t" / "snapshot=7")
    assert current(target.table(spark)) == {"x": (1, None)}


def test_a_snapshot_is_read_without_a_shuffle(spark):
    target = ChangeTarget(shared_folder(spark, "plan"), spec())
    target.write_batch(frame(spark, [row("x", 1, a=1)]), 0)
    target.compact(spark)
    assert "Exchange" not in target.table(spark)._jdf.queryExecution().executedPlan().toString()


def test_stream_equals_batch_and_continues(spark, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "cp")
    rows = random_rows(11, 60, seqs=80)
    s = spec(name="stream_equals_batch", once=True, ignore_null_updates=False)
    target = ChangeTarget(str(tmp_path / "target"), s)

    def follow():
        stream = file_stream(spark, landing, "parquet", max_files_per_trigger=1)
        query = target.start(stream, checkpoint)
        query.awaitTermination()
        return query

    for part in (rows[:20], rows[20:40]):
        land(spark, part, landing, "append")
    query = follow()
    expected = current(apply_changes(frame(spark, rows[:40]), s))
    assert current(target.table(spark)) == expected
    feed = [json.loads(p.json)["observedMetrics"]["feed"] for p in query.recentProgress if p.observedMetrics]
    assert sum(m["rows"] for m in feed) == 40
    assert sum(m["rejected"] for m in feed) == sum(r["seq"] is None for r in rows[:40])

    target.compact(spark)
    land(spark, rows[40:], landing, "append")
    follow()
    follow()
    assert current(target.table(spark)) == current(apply_changes(frame(spark, rows), s))
    assert target.table(spark).columns == ["k", "a", "b"]


def test_flows_from_config(spark, tmp_path):
    config = {"things": {"keys": ["k"], "sequence_column": INGEST_SEQUENCE, "stored_as_scd_type": 1}}
    specs = specs_from_config(config)
    assert specs["things"].keys == ["k"] and specs["things"].scd_type == 1
    landing = str(tmp_path / "landing")
    land(spark, [row("x", 1, a=1), row("y", 1, a=2)], landing)
    stream = file_stream(spark, landing, "parquet", audit_source="s")
    with pytest.raises(ValueError, match="other"):
        start_flows({"other": stream}, specs, str(tmp_path), str(tmp_path))
    flows = start_flows({"things": stream}, specs, str(tmp_path / "base"), str(tmp_path / "cp"))
    target, query = flows["things"]
    query.awaitTermination()
    base = target.table(spark)
    assert base.select(F.col("_metadata.SourceSystem")).distinct().count() == 1
    assert current(base) == {"x": (1, None), "y": (2, None)}


@pytest.mark.parametrize(
    "bad", [{"keys": []}, {"keys": ["k"], "typo": 1}, {"sequence_column": "s"}, {"keys": ["k"], "sequence_column": "s", "stored_as_scd_type": 4}]
)
def test_bad_config_is_refused(bad):
    with pytest.raises(ValueError):
        specs_from_config({"t": bad})


def test_a_continuous_flow_follows_new_files_until_stopped(spark, tmp_path):
    landing = str(tmp_path / "landing")
    land(spark, [row("x", 1, a=1)], landing)
    target = ChangeTarget(str(tmp_path / "target"), spec(name="continuous"))
    stream = file_stream(spark, landing, "parquet")
    query = target.start(stream, str(tmp_path / "cp"), once=False, interval="200 milliseconds")
    try:
        query.processAllAvailable()
        land(spark, [row("x", 2, a=2)], landing, "append")
        query.processAllAvailable()
        assert query.isActive and query.name == "continuous"
        assert current(target.table(spark)) == {"x": (2, None)}
    finally:
        query.stop()


def test_a_column_that_comes_later_is_kept(spark, tmp_path):
    target = ChangeTarget(str(tmp_path / "later"), ChangeSpec(["k"], "seq"))
    target.write_batch(spark.sql("select 'x' k, 1L seq, 1 a"), 0)
    target.compact(spark)
    target.write_batch(spark.sql("select 'y' k, 2L seq, 2 a, 'new' b"), 1)
    want = {("x", 1, None), ("y", 2, "new")}
    assert {(r.k, r.a, r.b) for r in target.table(spark).collect()} == want
    target.compact(spark)
    assert {(r.k, r.a, r.b) for r in target.table(spark).collect()} == want


def test_truncated_rows_leave_the_snapshot(spark, tmp_path):
    target = ChangeTarget(str(tmp_path / "cut"), ChangeSpec(["k"], "seq", truncates="op = 't'"))
    target.write_batch(spark.range(100).selectExpr("cast(id as string) k", "id seq", "'u' op"), 0)
    target.write_batch(spark.sql("select cast(null as string) k, 98L seq, 't' op"), 1)
    target.compact(spark)
    assert target.log(spark).count() == 2 and target.table(spark).count() == 1


def test_a_failing_stream_stops_the_others(spark, tmp_path):
    def failing(batch, number):
        raise ValueError("no batch today")

    rate = spark.readStream.format("rate").load()
    long = rate.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "a")).start()
    short = rate.writeStream.foreachBatch(failing).option("checkpointLocation", str(tmp_path / "b")).start()
    with pytest.raises(Exception, match="no batch today"):
        await_all([long, short])
    assert not long.isActive
