from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.snapshots import snapshot_diff

DDL = "k int, j string, v double, m map<string,int>"


def plain(old, new):
    before, after = ({r[:2]: r for r in rows} for rows in (old, new))
    out = [(*r, "delete") for k, r in before.items() if k not in after]
    out += [(*r, "insert") for k, r in after.items() if k not in before]
    return out + [(*r, "update") for k, r in after.items() if k in before and before[k] != r]


@pytest.mark.parametrize("seed", range(3))
def test_differences_match_a_plain_comparison(spark, seed):
    draw = random.Random(seed)

    def rows():
        keys = {(draw.choice([None, *range(30)]), draw.choice([None, "a"])) for _ in range(60)}
        return [(*k, draw.choice([None, 1.0, 2.0]), draw.choice([None, {"x": 1}])) for k in keys]

    old, new = rows(), rows()
    got = snapshot_diff(spark.createDataFrame(old, DDL), spark.createDataFrame(new, DDL), ["k", "j"], buckets=7)
    assert got.columns == ["k", "j", "v", "m", "change"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, plain(old, new)))


def test_equal_and_empty_snapshots(spark):
    rows = spark.createDataFrame([(1, None, 1.0, None), (None, "a", None, None)], DDL)
    none = rows.limit(0)
    assert snapshot_diff(rows, rows, ["k", "j"]).count() == 0
    assert [r.change for r in snapshot_diff(none, rows, ["k", "j"]).collect()] == ["insert"] * 2
    assert [r.change for r in snapshot_diff(rows, none, ["k", "j"]).collect()] == ["delete"] * 2
    with pytest.raises(ValueError):
        snapshot_diff(rows, rows.drop("v"), ["k"])


def test_only_rows_of_buckets_that_differ_are_compared(spark):
    old = spark.range(20000).select(F.col("id").alias("k"), F.lit("a").alias("j"), F.lit(1.0).alias("v"))
    new = old.withColumn("v", F.when(F.col("k") == 7, 2.0).otherwise(1.0))
    diff = snapshot_diff(old, new, ["k"], buckets=512)
    assert [(r.k, r.change) for r in diff.collect()] == [(7, "update")]
    nodes = diff._jdf.queryExecution().executedPlan().toString()
    assert nodes.count("LeftSemi") >= 2
