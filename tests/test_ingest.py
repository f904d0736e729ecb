from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from tidemark.sinks.tables import write_files
from tidemark.sources import files
from tidemark.sources.files import infer_schema, remembered_schema
from tidemark.streaming.ingest import ingest, read_ingested, start_ingest
from tidemark.workspace import shared_folder


def folders(spark):
    root = shared_folder(spark, "ingest")
    return f"{root}/landing", f"{root}/raw", f"{root}/checkpoint", f"{root}/schema"


def rows(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: str(r["a"]))


@pytest.mark.parametrize("kind", ["parquet", "json"])
def test_a_column_that_lands_while_the_stream_runs_is_kept(spark, kind):
    landing, raw, checkpoint, schema = folders(spark)
    a = F.col("a").cast("string") if kind == "json" else F.col("a")
    one, two = spark.sql("select 1L a"), spark.sql("select 2L a, 'new' b")
    write_files(one.coalesce(1), landing, kind, "append")
    query = start_ingest(spark, landing, kind, raw, checkpoint, schema, once=False, interval="200 milliseconds")
    deadline = time.time() + 60
    while not query.lastProgress and time.time() < deadline:
        time.sleep(0.2)
    write_files(two.coalesce(1), landing, kind, "append")
    with pytest.raises(Exception, match="new columns in landed files"):
        query.awaitTermination(60)
    assert rows(read_ingested(spark, raw).select(a.cast("long").alias("a"))) == [{"a": 1}]
    assert ingest(spark, landing, kind, raw, checkpoint, schema) == 1
    got = rows(read_ingested(spark, raw).select(a.cast("long").alias("a"), "b"))
    assert got == [{"a": 1, "b": None}, {"a": 2, "b": "new"}]


def test_a_changed_type_stops_the_stream_and_loses_nothing(spark):
    landing, raw, checkpoint, schema = folders(spark)
    write_files(spark.sql("select 1L a").coalesce(1), landing, "parquet", "append")
    assert ingest(spark, landing, "parquet", raw, checkpoint, schema) == 1
    write_files(spark.sql("select 'x' a").coalesce(1), landing, "parquet", "append")
    with pytest.raises(Exception, match="another type|CANNOT_MERGE_SCHEMAS"):
        ingest(spark, landing, "parquet", raw, checkpoint, schema)
    assert rows(read_ingested(spark, raw)) == [{"a": 1}]


def test_a_later_start_opens_new_files_only(spark, monkeypatch, tmp_path):
    landing, schema = str(tmp_path / "landing"), str(tmp_path / "schema")
    write_files(spark.sql("select 1L a").coalesce(1), landing, "parquet", "append")
    assert remembered_schema(spark, landing, "parquet", schema).fieldNames() == ["a"]
    old = time.time() - 3600
    import os

    for name in os.listdir(landing):
        os.utime(f"{landing}/{name}", (old, old))
    asked = []
    monkeypatch.setattr(files, "infer_schema", lambda *a: asked.append(a) or infer_schema(*a))
    assert remembered_schema(spark, landing, "parquet", schema).fieldNames() == ["a"] and not asked
    # the old file is broken by now: it is not opened again
    for name in os.listdir(landing):
        if name.startswith("part"):
            (tmp_path / "landing" / name).write_bytes(b"no longer a parquet file")
            os.utime(f"{landing}/{name}", (old, old))
    time.sleep(3)
    write_files(spark.sql("select 2L a, 'x' b").coalesce(1), landing, "parquet", "append")
    assert remembered_schema(spark, landing, "parquet", schema).fieldNames() == ["a", "b"] and len(asked) == 1
