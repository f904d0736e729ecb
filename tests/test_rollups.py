"""Stored roll-ups against the view over the fact, and bit words against distinct counts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators.metrics import Join, Measure, MetricView
from tidemark.operators.rollups import Rollup, RollupStore

FACTS = "day_id int, flag string, user long, cost double"
LATTICE = {
    "month": Rollup(["Year", "Month", "Flag"], ["Cost", "Mean", "Rows", "Best"], {"Users": "User"}),
    "year": Rollup(["Year"], ["Cost", "Mean"], {"Users": "User"}),
    "flag": Rollup(["Flag"], ["Rows"]),
}


def facts(first, last):
    rows = []
    for i in range(first, last):
        user = None if i % 7 == 0 else [i % 13, -i % 5 - 3, 64 * (i % 3), 2**62 + i % 2][i % 4]
        rows.append((None if i % 11 == 0 else i % 30, "abc"[i % 3] if i % 5 else None, user, float(i % 17) if i % 6 else None))
    return rows


def view_of(spark, rows):
    days = spark.createDataFrame([(d, 2000 + d // 12, d % 12 + 1) for d in range(28)], "day_id int, year int, month int")
    return MetricView(
        spark.createDataFrame(rows, FACTS),
        {"day": Join(days, {"day_id": "day_id"})},
        {"Year": "day.year", "Month": "day.month", "Flag": "flag", "User": "user"},
        {
            "Cost": Measure("sum", "cost"),
            "Mean": Measure("avg", "cost"),
            "Rows": Measure("count", "1"),
            "Best": Measure("max", "cost"),
            "Houses": Measure("count_distinct", "user"),
        },
    )


@pytest.fixture(scope="module")
def whole(spark):
    return view_of(spark, facts(0, 400))


@pytest.fixture(scope="module")
def store(spark, whole, tmp_path_factory):
    made = RollupStore(whole, str(tmp_path_factory.mktemp("rollups")), LATTICE)
    made.add("a", view_of(spark, facts(0, 150)))
    made.add("b", view_of(spark, facts(150, 400)))
    made.add("b", view_of(spark, facts(150, 400)))  # replayed
    return made


def rows(df):
    return sorted(map(repr, ([round(v, 9) if isinstance(v, float) else v for v in r] for r in df.collect())))


SETS = [["Year", "Month"], ["Year"], []]
QUESTIONS = [
    (["Year", "Month"], ["Cost", "Mean", "Rows", "Best"], {"Users": "User"}, {}, None),
    (["Year", "Month"], ["Cost", "Mean"], {"Users": "User"}, {}, SETS),
    (["Year"], ["Cost"], {"Users": "User"}, {}, None),
    (["Flag"], ["Rows"], {}, {}, None),
    (["Flag"], [], {"Users": "User"}, {"Year": [2000, 2001]}, [["Flag"], []]),
    (["Year"], ["Rows"], {"Users": "User"}, {"Flag": None}, None),
    ([], ["Cost", "Mean"], {"Users": "User"}, {}, None),
    ([], ["Rows"], {"Users": "User"}, {"Flag": "none of them"}, None),
]


@pytest.mark.parametrize("question", QUESTIONS)
def test_same_as_the_fact(store, whole, question):
    dimensions, measures, distinct, filters, sets = question
    extra = {name: ("count_distinct", label) for name, label in distinct.items()}
    stored = store.query(dimensions, measures, distinct, filters, sets, total_flags=True)
    direct = whole.query(dimensions, measures, extra, filters, sets, total_flags=True)
    assert stored.columns == direct.columns
    assert rows(stored) == rows(direct)


def test_smallest_fitting_rollup(spark, store):
    assert store.choose(spark, {"Year"}, {"Cost"}, {}) == "year"
    assert store.choose(spark, {"Flag"}, {"Rows"}, {}) == "flag"
    assert store.choose(spark, {"Flag"}, {"Cost"}, {}) == "month"
    assert store.choose(spark, {"Year"}, {"Cost"}, {"Users": "Flag"}) is None


def test_fact_is_not_read(store):
    plan = store.query(["Year"], ["Cost"], {"Users": "User"}, grouping_sets=[["Year"], []])._jdf.queryExecution().toString()
    assert "/year/a/measures" in plan or "year/a" in plan
    assert "LocalTableScan" not in plan and "ExistingRDD" not in plan


def test_coarser_rollup_comes_from_the_finer(spark, whole, tmp_path, monkeypatch):
    asked = []
    original = MetricView.partials

    def noted(self, labels, measures):
        asked.append(tuple(labels))
        return original(self, labels, measures)

    monkeypatch.setattr(MetricView, "partials", noted)
    RollupStore(whole, str(tmp_path), LATTICE).add("a")
    assert asked == [("Year", "Month", "Flag")]


def test_grouping_sets_multiply_words_not_facts(store):
    plan = store.query(["Year", "Month"], [], {"Users": "User"}, grouping_sets=SETS)._jdf.queryExecution().toString()
    assert "count(distinct" not in plan.lower()


def test_incomplete_batch_is_not_read(spark, whole, tmp_path):
    made = RollupStore(whole, str(tmp_path), LATTICE)
    made.add("a", view_of(spark, facts(0, 150)))
    before = rows(made.query(["Year"], ["Cost"], {"Users": "User"}))
    made._write(spark, whole, "year", "torn", None)
    assert rows(made.query(["Year"], ["Cost"], {"Users": "User"})) == before


def test_no_rollup(whole, store):
    with pytest.raises(LookupError):
        store.query(["User"], ["Cost"])
    assert rows(store.query(["User"], ["Cost"], fall_back=True)) == rows(whole.query(["User"], ["Cost"]))
    with pytest.raises(ValueError):
        whole.partials(["Year"], ["Houses"])
    with pytest.raises(ValueError):
        store.query(["Year"], ["Cost"], grouping_sets=[["Year"], ["Year"]])
    with pytest.raises(ValueError):
        store.query(["Year"], ["Cost"], grouping_sets=[["Flag"]])


def test_empty_fact(spark, tmp_path):
    empty = view_of(spark, facts(0, 1)[:0])
    made = RollupStore(empty, str(tmp_path), LATTICE)
    made.add("a")
    assert made.query(["Year"], ["Cost"], {"Users": "User"}).count() == 0
    total = made.query([], ["Rows"], {"Users": "User"}).first()
    assert (total["Rows"], total["Users"]) == (0, 0)
