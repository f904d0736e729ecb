from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests import model
from tests.test_changes import current, frame, random_rows, row, spec
from tidemark.operators.changes import SEQ, ChangeSpec
from tidemark.sinks.tables import write_files
from tidemark.sources.files import file_stream
from tidemark.streaming.effective import StatefulTarget, effective_changes, merged, position
from tidemark.workspace import shared_folder


class Feed:
    """Files that land one by one and are followed with a restart after each."""

    def __init__(self, spark, spec_, forget_after=None):
        self.spark, self.root = spark, shared_folder(spark, "effective")
        self.target = StatefulTarget(f"{self.root}/target", spec_, forget_after)

    def land(self, *files):
        for rows in files:
            df = rows if hasattr(rows, "rdd") else frame(self.spark, rows)
            write_files(df.coalesce(1), f"{self.root}/landing", "parquet", "append")
        stream = file_stream(self.spark, f"{self.root}/landing", "parquet", max_files_per_trigger=1)
        self.target.start(stream, f"{self.root}/checkpoint", once=True).awaitTermination()

    def logged(self):
        return self.target.log(self.spark).count()


@pytest.mark.parametrize("ignore_nulls", [False, True])
def test_late_and_replayed_batches_give_the_state_of_the_model(spark, ignore_nulls):
    rows = random_rows(11, 60, seqs=200)
    rows = list({(r["k"], r["seq"]): r for r in rows}.values())
    feed = Feed(spark, spec(ignore_null_updates=ignore_nulls))
    feed.land(rows[::2], rows[1::2])
    expected = model.scd1(rows, ignore_nulls)
    assert current(feed.target.table(spark)) == expected
    before = feed.logged()
    feed.land(rows[::2])  # again, after a restart
    assert feed.logged() == before
    assert current(feed.target.table(spark)) == expected
    feed.target.compact(spark)
    assert current(feed.target.table(spark)) == expected


def test_only_effective_changes_are_logged_and_tombstones_hold(spark):
    feed = Feed(spark, spec())
    feed.land([row("x", 5, "d"), row("y", 2, a=2), row(None, 1, a=7), row("z", None, a=1)])
    assert feed.logged() == 3
    feed.land([row("x", 3, a=3), row("y", 1, a=1), row("y", 2, a=2)])
    assert feed.logged() == 3 and current(feed.target.table(spark)) == {"y": (2, None), None: (7, None)}
    feed.land([row("x", 6, a=6)] + [row("y", 2, a=n % 50) for n in range(20_000)])
    assert feed.logged() == 5
    assert current(feed.target.table(spark)) == {"x": (6, None), "y": (49, None), None: (7, None)}


def test_forgotten_state_repeats_log_rows_and_changes_no_table(spark):
    feed = Feed(spark, spec(), forget_after="1 millisecond")
    feed.land([row("x", 5, "d"), row("y", 2, a=2)])
    feed.land([row("x", 3, a=3), row("y", 2, a=2)])
    assert feed.logged() == 4 and current(feed.target.table(spark)) == {"y": (2, None)}


def test_values_of_all_kinds_survive_the_state(spark):
    rows = spark.sql(
        "SELECT 1L AS k, timestamp_ntz'2024-03-31 02:30:00.000001' AS n, timestamp'2024-10-27 00:30:00.000001Z' AS t, date'2024-01-02' AS d, cast(1.50 AS decimal(9,2)) AS p,"
        " double('nan') AS f, -0.0D AS g, true AS b, X'00ff' AS x, named_struct('u', 9007199254740993L, 'v', array(1, null)) AS s, 'é' AS w"
        " UNION ALL SELECT 2L, null, timestamp'2024-10-27 01:30:00Z', null, null, null, null, null, null, null, null"
    )
    feed = Feed(spark, ChangeSpec(["k"], "t"))
    feed.land(rows)
    feed.land(rows)
    assert feed.logged() == 2
    got = feed.target.table(spark).select(*rows.columns)
    assert got.dtypes == rows.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.collect()))


def test_what_state_cannot_serve_is_refused(spark):
    empty = frame(spark, [])
    for bad in (spec(scd_type=2), spec(truncates="op = 't'")):
        with pytest.raises(ValueError, match="type 1"):
            effective_changes(empty, bad)
    with pytest.raises(ValueError, match="no order"):
        effective_changes(empty.withColumn("m", F.create_map("k", "a")), spec())
    with pytest.raises(ValueError, match="inside structs"):
        effective_changes(empty.withColumn("m", F.struct(F.current_timestamp())), spec())


def test_positions_are_ordered_as_in_spark(spark):
    values = [float("nan"), None, 1.5, float("-inf"), -0.0, float("inf")]
    in_spark = [r.v for r in spark.createDataFrame([(v,) for v in values], "v double").orderBy("v").collect()]
    assert repr(sorted(values, key=position)) == repr(in_spark)
    assert merged((1, 0, "b"), (1, 0, "a"), False) == (1, 0, "b")
    assert SEQ == "_seq" and merged((1, 0, (1, "b")), (2, 1, None), True) == (2, 1, (1, "b"))
