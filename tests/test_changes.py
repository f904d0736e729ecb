from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests import model
from tidemark.operators.changes import ChangeSpec, apply_changes, reduce_log, rejected, to_log
from tidemark.operators.history import cut_long_runs

SCHEMA = "k string, seq bigint, op string, a bigint, b string"


def frame(spark, rows):
    return spark.createDataFrame(
        [(r["k"], r["seq"], r["op"], r["a"], r["b"]) for r in rows], SCHEMA
    )


def spec(**settings_):
    base = {"keys": ["k"], "sequence": "seq", "deletes": "op = 'd'", "except_columns": ["seq", "op"]}
    return ChangeSpec(**{**base, **settings_})


def row(k, seq, op="u", a=None, b=None):
    return {"k": k, "seq": seq, "op": op, "a": a, "b": b}


def current(df):
    return {r.k: (r.a, r.b) for r in df.collect()}


def history(df):
    return {(r.k, r.a, r.b, r.valid_from, r.valid_to) for r in df.collect()}


def random_rows(seed, size, keys=4, seqs=12, ops="uuuuud"):
    rng = random.Random(seed)
    return [
        row(
            rng.choice([*"wxyz"[:keys], None]),
            rng.choice([*range(seqs), None]),
            rng.choice(ops),
            rng.choice([None, 1, 2, 3]),
            rng.choice([None, "p", "q"]),
        )
        for _ in range(size)
    ]


@pytest.mark.parametrize(
    "bad",
    [
        {"scd_type": 3},
        {"keys": []},
        {"keys": "k"},
        {"sequence": ""},
        {"columns": ["k"], "except_columns": ["a"]},
        {"columns": ["a"], "except_columns": None},
        {"except_columns": ["k"]},
        {"track": ["a"]},
        {"scd_type": 2, "track": ["a"], "except_track": ["b"]},
        {"scd_type": 2, "truncates": "op = 't'"},
    ],
)
def test_invalid_specs_are_refused(bad):
    with pytest.raises(ValueError):
        spec(**bad)


def test_unknown_columns_are_named(spark):
    with pytest.raises(ValueError, match="nope"):
        apply_changes(frame(spark, [row("x", 1)]), spec(keys=["nope"], except_columns=None))
    with pytest.raises(ValueError, match="zz"):
        apply_changes(frame(spark, [row("x", 1)]), spec(scd_type=2, track=["zz"]))


def test_highest_sequence_wins_and_late_rows_are_ignored(spark):
    rows = [row("x", 5, a=5), row("x", 3, a=3), row("y", 1, a=1)]
    assert current(apply_changes(frame(spark, rows), spec())) == {"x": (5, None), "y": (1, None)}


def test_ties_do_not_depend_on_row_order(spark):
    rows = [row("x", 1, a=2, b="p"), row("x", 1, a=1, b="q"), row("x", 1, a=2, b="q")]
    for order in (rows, rows[::-1]):
        assert current(apply_changes(frame(spark, order), spec())) == {"x": (2, "q")}


def test_delete_hides_older_inserts_only(spark):
    gone = [row("x", 2, "d"), row("x", 1, a=1)]
    back = [*gone, row("x", 3, a=3)]
    tie = [row("x", 2, "d"), row("x", 2, a=1)]
    assert current(apply_changes(frame(spark, gone), spec())) == {}
    assert current(apply_changes(frame(spark, back), spec())) == {"x": (3, None)}
    assert current(apply_changes(frame(spark, tie), spec())) == {}


def test_truncate_between_inserts(spark):
    rows = [row("x", 1, a=1), row("y", 2, "t"), row("z", 2, a=2), row("x", 3, a=3)]
    assert current(apply_changes(frame(spark, rows), spec(truncates="op = 't'"))) == {
        "x": (3, None)
    }


def test_null_sequence_is_rejected_and_listed(spark):
    rows = [row("x", None, a=1), row("y", 1, a=1)]
    assert current(apply_changes(frame(spark, rows), spec())) == {"y": (1, None)}
    assert rejected(frame(spark, rows), spec()).count() == 1


def test_null_and_composite_keys(spark):
    rows = [row(None, 1, a=1, b="p"), row(None, 2, a=1, b="q"), row(None, 1, a=2, b="r")]
    found = apply_changes(frame(spark, rows), spec(keys=["k", "a"])).collect()
    assert {(r.k, r.a, r.b) for r in found} == {(None, 1, "q"), (None, 2, "r")}


def test_empty_feed(spark):
    for scd_type in (1, 2):
        assert apply_changes(frame(spark, []), spec(scd_type=scd_type)).count() == 0


def test_column_lists_keep_feed_order(spark):
    df = frame(spark, [row("x", 1, a=1, b="p")])
    assert apply_changes(df, spec(except_columns=None, columns=["b", "k"])).columns == ["k", "b"]
    assert apply_changes(df, spec(except_columns=["a", "op"])).columns == ["k", "seq", "b"]


def test_struct_field_as_sequence(spark):
    df = frame(spark, [row("x", 1, a=1), row("x", 2, a=2)]).withColumn(
        "_metadata", F.struct(F.col("seq").alias("ingest_timestamp"))
    )
    result = apply_changes(df, spec(sequence='_metadata["ingest_timestamp"]'))
    assert {(r.k, r.a) for r in result.collect()} == {("x", 2)}


@pytest.mark.parametrize("ignore_nulls", [False, True])
def test_map_columns_are_carried(spark, ignore_nulls):
    df = spark.sql(
        "select * from values ('x', 1L, map('p', 1)), ('x', 2L, map('q', 2)), ('x', 3L, null)"
        " as t(k, seq, m)"
    )
    s = ChangeSpec(["k"], "seq", ignore_null_updates=ignore_nulls)
    expected = {"q": 2} if ignore_nulls else None
    assert apply_changes(df, s).first().m == expected
    s2 = ChangeSpec(["k"], "seq", scd_type=2, track=["m"], ignore_null_updates=ignore_nulls)
    assert apply_changes(df, s2).count() == (2 if ignore_nulls else 3)


def test_nulls_never_reach_back_past_a_delete(spark):
    rows = [row("x", 1, a=1, b="p"), row("x", 2, "d"), row("x", 3, b="q"), row("x", 4, a=4)]
    s = spec(ignore_null_updates=True)
    assert current(apply_changes(frame(spark, rows[:3]), s)) == {"x": (None, "q")}
    assert current(apply_changes(frame(spark, rows), s)) == {"x": (4, "q")}


def test_tracked_history_a_b_a(spark):
    rows = [row("x", 1, a=1, b="p"), row("x", 2, a=1, b="q"), row("x", 3, a=2), row("x", 4, a=1)]
    found = history(apply_changes(frame(spark, rows), spec(scd_type=2, track=["a"])))
    assert found == {("x", 1, "q", 1, 3), ("x", 2, None, 3, 4), ("x", 1, None, 4, None)}


def test_late_insert_splits_an_interval(spark):
    rows = [row("x", 1, a=1), row("x", 9, a=9), row("x", 5, a=5)]
    found = history(apply_changes(frame(spark, rows), spec(scd_type=2)))
    assert found == {("x", 1, None, 1, 5), ("x", 5, None, 5, 9), ("x", 9, None, 9, None)}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), ignore_nulls=st.booleans(), truncates=st.booleans())
def test_type_1_equals_the_model_for_any_split(spark, seed, ignore_nulls, truncates):
    rows = random_rows(seed, 40, ops="uuuuudt" if truncates else "uuuud", seqs=100)
    if ignore_nulls:  # equal positions merge by a hash there, so keep them apart
        rows = list({(r["k"], r["seq"]): r for r in rows}.values())
    s = spec(ignore_null_updates=ignore_nulls, truncates="op = 't'" if truncates else None)
    expected = model.scd1(rows, ignore_nulls)
    assert current(apply_changes(frame(spark, rows), s)) == expected

    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    cut = seed % (len(rows) + 1)
    first = reduce_log(to_log(frame(spark, shuffled[:cut]), s), s)
    assert current(apply_changes(frame(spark, shuffled[cut:]), s, first)) == expected


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    seed=st.integers(0, 10_000),
    ignore_nulls=st.booleans(),
    tracked=st.sampled_from([None, ["a"], ["b"], ["a", "b"]]),
    run=st.sampled_from([1, 2, 5, 1000]),
)
def test_type_2_equals_the_model_for_any_cut(spark, seed, ignore_nulls, tracked, run):
    rows = random_rows(seed, 80, keys=2, seqs=40)
    if ignore_nulls:  # tied updates of one column go by a hash, so each column is set once
        taken = set()
        for r in rows:
            for c in ("a", "b"):
                if r["op"] == "u" and r[c] is not None:
                    r[c] = None if (r["k"], r["seq"], c) in taken else r[c]
                    taken.add((r["k"], r["seq"], c))
    s = spec(scd_type=2, track=tracked, ignore_null_updates=ignore_nulls, max_run_rows=run)
    positions = None if tracked is None else [["a", "b"].index(c) for c in tracked]
    assert history(apply_changes(frame(spark, rows), s)) == model.scd2(
        rows, ignore_nulls, positions
    )


@pytest.mark.parametrize("scd_type", [1, 2])
def test_tied_updates_merge_with_ignored_nulls(spark, scd_type):
    rows = [row("x", 1, a=1), row("x", 1, b="p"), row("x", 2, a=2)]
    s = spec(scd_type=scd_type, ignore_null_updates=True)
    first = reduce_log(to_log(frame(spark, rows[:1]), s), s)
    both = reduce_log(first.union(to_log(frame(spark, rows[1:2]), s)), s)
    found = apply_changes(frame(spark, rows[2:]), s, both)
    if scd_type == 1:
        assert current(found) == {"x": (2, "p")}
    else:
        assert history(found) == {("x", 1, "p", 1, 2), ("x", 2, "p", 2, None)}


def test_truncated_rows_are_not_reduced(spark, tmp_path):
    s = spec(truncates="op = 't'")
    frame(spark, [row("x", 1), row("y", 5)]).write.parquet(str(tmp_path / "feed"))
    plan = apply_changes(spark.read.parquet(str(tmp_path / "feed")), s)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_only_long_runs_are_cut(spark):
    log = spark.range(300).select(
        F.when(F.col("id") < 200, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
        F.col("id").alias("_seq"),
    )
    cuts = cut_long_runs(log, ["k"], 20).collect()
    assert [c["_cut_k"] for c in cuts] == ["hot"]
    assert 1 <= len(cuts[0]["_cuts"]) <= 40
    assert cut_long_runs(log, ["k"], 200) is None


def test_a_hot_key_repeating_one_sequence_is_reduced_before_the_shuffle(spark):
    log = spark.range(400).select(
        F.when(F.col("id") % 4 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
        (F.col("id") % 3).alias("seq"),
        F.lit("u").alias("op"),
        F.col("id").alias("a"),
        F.lit(None).cast("string").alias("b"),
    )
    cut = apply_changes(log, spec(scd_type=2, max_run_rows=10))
    whole = apply_changes(log, spec(scd_type=2))
    assert history(cut) == history(whole)
    assert len([v for v in history(cut) if v[0] == "hot"]) == 3


def test_history_takes_one_shuffle_and_one_sort(spark):
    changes = apply_changes(frame(spark, [row("x", 1)]), spec(scd_type=2, track=["a"]))
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_the_reduction_starts_before_the_shuffle(spark):
    plan = apply_changes(frame(spark, [row("x", 1)]), spec())._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.index("Exchange") < physical.index("partial_max")
    assert "Window" not in physical
