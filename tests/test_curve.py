"""Interleaved layouts: nothing is lost, and a filter on any of the columns skips most files."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.functions.curve import with_curve_position
from tidemark.sinks.tables import TableLayout, arrange, write_files

FILES = 36


def touched(folder, column, value):
    """Files whose statistics allow the value, and all files with rows."""
    hit = total = 0
    for path in glob.glob(f"{folder}/*.parquet"):
        file = pq.ParquetFile(path)
        for group in range(file.metadata.num_row_groups):
            stats = file.metadata.row_group(group).column(file.schema_arrow.names.index(column)).statistics
            total += 1
            hit += stats.min <= value <= stats.max
    return hit, total


def test_either_column_skips_most_files(spark, tmp_path):
    rows = spark.range(60_000).select(
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5000)).alias("x"),
        F.format_string("u%05d", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(7000))).alias("y"),
    )
    layouts = {
        "curve": TableLayout(interleave=["x", "y"], files=FILES),
        "sorted": TableLayout(cluster_by=["x", "y"], files=FILES),
    }
    for name, layout in layouts.items():
        write_files(rows, str(tmp_path / name), "parquet", layout=layout)
    assert spark.read.parquet(str(tmp_path / "curve")).exceptAll(rows).count() == 0
    assert spark.read.parquet(str(tmp_path / "curve")).count() == 60_000
    share = {}
    for name in layouts:
        for column, value in (("x", 3210), ("y", "u04321")):
            hit, total = touched(tmp_path / name, column, value)
            assert hit >= 1
            share[name, column] = hit / total
    assert share["curve", "x"] < 0.4 and share["curve", "y"] < 0.4
    assert share["sorted", "x"] < 0.1 and share["sorted", "y"] > 0.9


def test_positions_by_hand(spark):
    rows = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)], "x int, y int")
    placed = with_curve_position(rows, ["x", "y"], "p").collect()
    order = [(r["x"], r["y"]) for r in sorted(placed, key=lambda r: r["p"])]
    # The curve stays in one corner of four places before it goes to the next.
    assert len({r["p"] for r in placed}) == 16
    for corner in range(0, 16, 4):
        xs, ys = zip(*order[corner : corner + 4], strict=True)
        assert max(xs) - min(xs) <= 1 and max(ys) - min(ys) <= 1


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz", "boolean", "decimal(10,2)", "double"])
def test_types_nulls_and_ties(spark, kind):
    values = {"string": "array('', 'a', 'ab', 'é', null)", "boolean": "array(true, false, null)"}
    made = values.get(kind)
    if made is None:
        base = "array(1, 2, 2, 3, null)" if kind in ("decimal(10,2)", "double") else "array('2001-01-01', '1950-05-05', null)"
        made = f"transform({base}, v -> cast(v as {kind}))"
    rows = spark.range(3).select(F.explode(F.expr(made)).alias("v"), "id")
    placed = with_curve_position(rows, ["v", "id"], "p")
    got = placed.filter("id = 0").select("v", "p").distinct().collect()
    known = sorted((r for r in got if r["v"] is not None), key=lambda r: r["v"])
    assert [r["p"] for r in known] == sorted(r["p"] for r in known)
    assert all(r["p"] <= min(k["p"] for k in known) for r in got if r["v"] is None)
    assert placed.filter("p is null").count() == 0


def test_empty_table_and_refused_layouts(spark, tmp_path):
    empty = spark.createDataFrame([], "x int, y int, z array<int>")
    write_files(empty, str(tmp_path / "e"), "parquet", layout=TableLayout(interleave=["x", "y"]))
    assert spark.read.schema(empty.schema).parquet(str(tmp_path / "e")).count() == 0
    for layout in (
        TableLayout(interleave=["x"]),
        TableLayout(interleave=["x", "x"]),
        TableLayout(interleave=["x", "z"]),
        TableLayout(interleave=["x", "y"], cluster_by=["x"]),
    ):
        with pytest.raises(ValueError):
            arrange(empty, layout)
