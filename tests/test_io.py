from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.audit import add_audit
from tidemark.sinks.tables import (
    TableLayout,
    append_rows,
    create_streaming_table,
    create_table_if_absent,
    create_view,
    enforce_schema,
    hidden_name,
    materialize,
    spark_settings,
    stream_to_files,
    stream_to_table,
    table_exists,
    write_files,
)
from tidemark.operators.quality import Rule
from tidemark.sources.files import (
    CORRUPT_RECORD,
    discover,
    evolved,
    file_stream,
    infer_schema,
    read_files,
)
from tidemark.sources.load import LoadSpec, load
from tidemark.sources.tables import list_tables, qualified_name, read_table, table_stream
from tidemark.workspace import shared_folder


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id bigint, name string")


def test_discover_folders_files_and_compression(spark, tmp_path):
    root = tmp_path / "landing"
    spark.range(10).repartition(3).write.parquet(str(root / "landing"))
    spark.range(3).write.json(str(root / "bookings"), compression="gzip")
    spark.range(3).write.option("header", True).csv(str(root / "with.dot"))
    (root / "single.json").write_text('{"a": 1}')
    (root / "notes.txt").write_text("not a dataset")
    found = {(r.dataset, r.format) for r in discover(spark, str(root)).collect()}
    assert found == {("landing", "parquet"), ("bookings", "json"), ("with", "csv"), ("single", "json"), ("notes", "txt")}


def test_discover_raises_for_a_missing_root(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        discover(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_file_sinks_read_back(spark, frame, tmp_path, fmt):
    path = str(tmp_path / fmt)
    write_files(frame, path, fmt)
    write_files(frame, path, fmt, "append")
    back = read_files(spark, path, fmt, frame.schema)
    assert back.count() == 6 and set(frame.columns) <= set(back.columns)


def test_file_sink_checks_arguments(frame, tmp_path):
    with pytest.raises(ValueError):
        write_files(frame, str(tmp_path / "x"), "xlsx")
    with pytest.raises(ValueError):
        write_files(frame, str(tmp_path / "x"), "json", "upsert")


def test_clustering_spreads_a_hot_value_over_files(spark, tmp_path):
    df = spark.range(4000).select(F.lit("hot").alias("k"), "id", (F.col("id") % 3).alias("p"))
    path = str(tmp_path / "clustered")
    write_files(df, path, "parquet", layout=TableLayout(cluster_by=["k"], files=8))
    counts = [r.n for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(counts) > 4 and max(counts) < 1500
    parts = str(tmp_path / "parts")
    write_files(df, parts, "parquet", layout=TableLayout(partition_cols=["p"]))
    assert spark.read.parquet(parts).filter("p = 1").count() == 1333


def test_json_values_stay_text_and_bad_lines_are_kept(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "1.json").write_text("{'guid': 'g1', 'name': 'O\\'Neil', 'n': 1}")
    (landing / "2.json").write_text('{"guid": "g2"}\n{broken')
    schema = infer_schema(spark, str(landing), "json")
    assert {f.dataType for f in schema.fields} == {T.StringType()}
    rows = read_files(spark, str(landing), "json", schema).collect()
    assert {(r.guid, r.name, r.n) for r in rows} >= {("g1", "O'Neil", "1"), ("g2", None, None)}
    assert [r[CORRUPT_RECORD] for r in rows if r.guid is None] == ["{broken"]


def test_stream_reads_each_file_once_with_a_remembered_schema(spark, frame, tmp_path):
    landing, raw, checkpoint = (str(tmp_path / n) for n in ("landing", "raw", "checkpoint"))
    write_files(frame, landing, "json")

    def ingest():
        stream = file_stream(
            spark, landing, "json", schema_location=str(tmp_path / "schema"),
            audit_source="test", max_files_per_trigger=1,
        )
        stream_to_files(stream, raw, checkpoint, "parquet", name="raw_test").awaitTermination()
        return spark.read.parquet(raw)

    assert ingest().count() == 3
    assert ingest().count() == 3
    more = frame.select((F.col("id") + 10).alias("id"), "name", F.lit(1).alias("surplus"))
    write_files(more, landing, "json", "append")
    df = ingest()
    assert df.count() == 6 and "surplus" not in df.columns
    assert {r[0] for r in df.select("_metadata.SourceSystem").collect()} == {"test"}
    assert df.filter("_metadata.ingest_timestamp is null").count() == 0


def test_load_types(spark, frame, tmp_path):
    name = "load_types"
    materialize(frame, name, layout=TableLayout(path=str(tmp_path / name)))
    assert load(spark, LoadSpec("table", name=name)).columns == ["id", "name"]
    assert load(spark, LoadSpec("dataframe", dataframe=frame)) is frame
    streamed = load(spark, LoadSpec("table_stream", name=name))
    assert streamed.isStreaming and "_metadata" in streamed.columns
    assert not table_stream(spark, name).columns.count("_metadata")
    assert read_table(spark, name, "s").select("_metadata.SourceSystem").first()[0] == "s"
    for bad in ({"loadtype": "other"}, {"loadtype": "volume", "path": "x"}, {"loadtype": "table"}):
        with pytest.raises(ValueError):
            LoadSpec(**bad)


def test_audit_shadows_the_hidden_metadata_column(spark, frame, tmp_path):
    write_files(frame, str(tmp_path / "x"), "parquet")
    df = add_audit(spark.read.parquet(str(tmp_path / "x")), "src")
    assert df.select("_metadata.*").columns == ["SourceSystem", "ingest_timestamp"]


def test_table_listing_and_names(spark, frame, tmp_path):
    materialize(frame, "listed_external", layout=TableLayout(path=str(tmp_path / "e")))
    materialize(frame, "listed_managed")
    names = {r.table_name for r in list_tables(spark, "default").collect()}
    assert "listed_external" in names and "listed_managed" not in names
    assert "listed_managed" in {r.table_name for r in list_tables(spark, "default", None).collect()}
    assert qualified_name("c", None, "t") == "`c`.`t`"


def test_materialize_applies_schema_rules_filter_and_comment(spark, frame, tmp_path):
    counters = materialize(
        frame,
        "made",
        comment="it's made",
        layout=TableLayout(path=str(tmp_path / "made"), partition_cols=["name"], properties={"team": "sales"}),
        schema="id int, name string",
        rules=[Rule("named", "name is not null", "expect_or_drop")],
        visible_rows="id < 3",
        spark_conf={"spark.sql.shuffle.partitions": "3"},
    )
    assert {tuple(r) for r in spark.table("made").select("id", "name").collect()} == {(1, "a"), (2, "b")}
    assert counters.get == {"rows": 3, "named": 1}
    assert spark.table("made").schema["id"].dataType == T.IntegerType()
    assert spark.table(hidden_name("made")).count() == 2  # all that the rules left
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {hidden_name('made')}").collect()}
    assert described["Comment"] == "it's made"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


@pytest.mark.parametrize("external", [False, True])
def test_a_failed_overwrite_keeps_the_table(spark, frame, tmp_path, external):
    name = f"stays_{external}"
    layout = TableLayout(path=str(tmp_path / "stays")) if external else TableLayout()
    materialize(frame, name, layout=layout)
    rules = [Rule("small", "id < 2", "expect_or_fail")]
    bad_cast = frame.withColumn("id", F.col("name").cast("int"))
    for rows, checked in ((frame, rules), (bad_cast, None)):
        with pytest.raises(Exception):  # noqa: B017 - a rule or a cast
            materialize(rows, name, layout=layout, rules=checked)
        assert spark.table(name).count() == 3
    materialize(frame.filter("id = 1"), name, layout=layout)
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 1
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(f"{name}__")]


def test_a_failed_overwrite_keeps_the_files(spark, frame, tmp_path):
    path = str(tmp_path / "parent" / "files")
    write_files(frame, path, "parquet")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        write_files(frame.withColumn("id", F.col("name").cast("int")), path, "parquet")
    assert spark.read.parquet(path).count() == 3
    # what a task wrote after the failure is hidden from readers
    assert [p.name for p in (tmp_path / "parent").iterdir() if p.name[0] not in "_."] == ["files"]


def test_new_columns_are_added_at_the_next_start(spark, tmp_path):
    landing, seen = str(tmp_path / "landing"), str(tmp_path / "schema")
    spark.range(3).write.parquet(landing)
    assert file_stream(spark, landing, "parquet", schema_location=seen).columns == ["id"]
    spark.range(3).selectExpr("id", "'x' as more").write.mode("append").parquet(landing)
    assert file_stream(spark, landing, "parquet", schema_location=seen).columns == ["id", "more"]
    spark.read.parquet(landing).limit(0)
    with pytest.raises(ValueError, match="more"):
        evolved(T.StructType([T.StructField("more", T.LongType())]), T.StructType([T.StructField("more", T.StringType())]))


def test_files_of_unknown_kinds_are_listed(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "good"))
    for name in ("odd/x.jsonl", "plain/x"):
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_text("{}")
    found = {(r.dataset, r.format) for r in discover(spark, str(tmp_path)).collect()}
    assert found == {("good", "parquet"), ("odd", "jsonl"), ("plain", "unknown")}


def test_private_tables_are_not_stored(spark, frame):
    materialize(frame, "a.b.hidden", private=True)
    assert spark.table("a_b_hidden").count() == 3
    assert not table_exists(spark, "default.a_b_hidden")


def test_schema_enforcement(frame):
    with pytest.raises(ValueError, match="missing"):
        enforce_schema(frame, "id bigint, name string, more int")
    with pytest.raises(ValueError, match="not declared"):
        enforce_schema(frame, "id bigint")
    with pytest.raises(Exception, match="declared not null"):
        enforce_schema(frame, "id bigint, name string not null").collect()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        enforce_schema(frame, "id bigint, name int").collect()


def test_settings_are_scoped(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), spark_settings(spark, {key: "1m"}):
        assert spark.conf.get(key) == "1m"
        raise RuntimeError
    assert spark.conf.get(key) == before


def test_create_check_and_append(spark, tmp_path):
    name = "confirmations"
    assert not table_exists(spark, name)
    for _ in range(2):
        create_table_if_absent(spark, name, "guid string, n bigint", path=str(tmp_path / name))
    assert table_exists(spark, name) and table_exists(spark, f"spark_catalog.default.{name}")
    append_rows(spark.createDataFrame([(1, "x")], "n int, guid string"), name)
    assert [tuple(r) for r in spark.table(name).collect()] == [("x", 1)]
    with pytest.raises(ValueError):
        append_rows(spark.createDataFrame([(1,)], "n int"), name)


def test_views(spark, frame):
    assert create_view(frame, "c", "s", "o") == "c_s_o_view"
    assert spark.table("c_s_o_view").count() == 3


def test_streaming_table_target(spark, frame, tmp_path):
    source, target = "stream_source", "stream_target"
    materialize(frame, source, layout=TableLayout(path=str(tmp_path / source)))
    layout = TableLayout(path=str(tmp_path / target))
    for _ in range(2):
        create_streaming_table(spark, target, frame.schema, "copied", layout)
    stream_to_table(
        table_stream(spark, source), target, str(tmp_path / "cp"), layout=layout
    ).awaitTermination()
    assert spark.read.table(target).count() == 3
    with pytest.raises(ValueError):
        stream_to_table(table_stream(spark, source), target, None)


def test_stream_observes_rules(spark, frame, tmp_path):
    from tidemark.operators.quality import expect

    write_files(frame, str(tmp_path / "in"), "parquet")
    kept, name = expect(
        file_stream(spark, str(tmp_path / "in"), "parquet"), {"named": "name is not null"},
        "expect_or_drop", "stream_rules",
    )
    query = stream_to_files(kept, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    seen = [p["observedMetrics"][name] for p in map(json.loads, (p.json for p in query.recentProgress)) if name in p.get("observedMetrics", {})]
    assert sum(m["rows"] for m in seen) == 3 and sum(m["named"] for m in seen) == 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_shared_folder_is_below_the_configured_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(root) and first != second


def test_dates_survive_the_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2020, 1, 2),)], "d date")
    write_files(df, str(tmp_path / "d"), "orc")
    assert read_files(spark, str(tmp_path / "d"), "orc").first().d == dt.date(2020, 1, 2)
