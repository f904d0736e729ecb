"""Ids that survive inserts, against a map kept in a dict."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.keymap import KeyMap


def ids(spark, key_map):
    return {tuple(r)[:-1]: r[key_map.name] for r in key_map.table(spark).collect()}


def plain(loads):
    """Each load's new keys in order, numbered from the last id on."""
    known = {}
    for load in loads:
        for key in sorted({k for k in load if k is not None} - set(known)):
            known[key] = len(known)
    return {(k,): i for k, i in known.items()}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.one_of(st.none(), st.integers(-50, 50)), max_size=40), min_size=1, max_size=4))
def test_loads_against_a_dict(spark, tmp_path_factory, loads):
    key_map = KeyMap(str(tmp_path_factory.mktemp("map")), "k", "k_id", rows_per_bucket=7)
    for load in loads:
        key_map.extend(spark.createDataFrame([(k,) for k in load], "k long"))
    assert ids(spark, key_map) == plain(loads)


def test_old_ids_stay_when_keys_come_in_between(spark, tmp_path):
    key_map = KeyMap(str(tmp_path / "m"), ["a", "b"], "id")
    key_map.extend(spark.createDataFrame([("m", 5), ("z", 1), (None, 3)], "a string, b int"))
    before = ids(spark, key_map)
    assert before == {("m", 5): 0, ("z", 1): 1}
    rows = spark.createDataFrame([("m", 5), ("m", 5), ("a", 1), ("n", 0), (None, 3)], "a string, b int")
    key_map.extend(rows)
    assert ids(spark, key_map) == {**before, ("a", 1): 2, ("n", 0): 3}
    attached = key_map.attach(rows).collect()
    assert sorted((r["id"] for r in attached if r["id"] is not None)) == [0, 0, 2, 3]
    assert [r["id"] for r in attached if r["a"] is None] == [None]


def test_a_load_run_again_adds_nothing(spark, tmp_path):
    key_map = KeyMap(str(tmp_path / "m"), "k", "k_id")
    load = spark.range(100).withColumnRenamed("id", "k")
    key_map.extend(load)
    once = ids(spark, key_map)
    key_map.extend(load)
    assert ids(spark, key_map) == once


def test_a_part_without_marker_is_overwritten(spark, tmp_path):
    key_map = KeyMap(str(tmp_path / "m"), "k", "k_id")
    key_map.extend(spark.range(3).withColumnRenamed("id", "k"))
    torn = tmp_path / "m" / "part-000001"
    torn.mkdir()
    (torn / "part-0.parquet").write_bytes(b"torn")
    assert len(ids(spark, key_map)) == 3
    key_map.extend(spark.range(5).withColumnRenamed("id", "k"))
    assert ids(spark, key_map) == {(k,): k for k in range(5)}


def test_stored_keys_are_not_sorted(spark, tmp_path):
    key_map = KeyMap(str(tmp_path / "m"), "k", "k_id")
    key_map.extend(spark.range(1000).withColumnRenamed("id", "k"))
    load = spark.range(900, 1100).withColumnRenamed("id", "k")
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = key_map._new_keys(load, key_map.parts(spark))._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    semi = plan[plan.index("LeftSemi") - 60 :]
    assert "ShuffledHashJoin" in semi.split("LeftSemi")[0]
    assert "Sort " not in semi


def test_names_are_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        KeyMap("m", [], "id")
    with pytest.raises(ValueError):
        KeyMap("m", ["id"], "id")
    with pytest.raises(FileNotFoundError):
        KeyMap(str(tmp_path / "none"), "k", "id").table(spark)
