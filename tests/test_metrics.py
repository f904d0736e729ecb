from __future__ import annotations

from tidemark.plans import sales

import pytest

from tidemark.operators.metrics import Dimension, Join, Measure, MetricView


@pytest.fixture(scope="module")
def tables(spark):
    facts = spark.createDataFrame(
        [
            (1, 1, 10, 10.0, 1),
            (1, 2, 10, 20.0, 2),
            (2, 1, 11, 30.0, None),
            (None, 3, 12, 40.0, 4),
            (9, 1, 10, 50.0, 5),
        ],
        "seller_id int, day_id int, house_id int, cost double, rating int",
    )
    seller = spark.createDataFrame([(1, "Ann", "N"), (2, None, "S")], "seller_id int, name string, region string")
    day = spark.createDataFrame([(1, 2020), (2, 2021), (3, 2021)], "day_id int, year int")
    house = spark.createDataFrame(
        [(10, True, False), (11, False, True), (12, None, True)], "house_id int, pets boolean, tub boolean"
    )
    return facts, seller, day, house


@pytest.fixture(scope="module")
def view(tables):
    facts, seller, day, house = tables
    return MetricView(
        facts,
        {
            "seller": Join(seller, {"seller_id": "seller_id"}),
            "day": Join(day, {"day_id": "day_id"}),
            "house": Join(house, {"house_id": "house_id"}),
        },
        {
            "Seller_ID": "seller_id",
            "Seller": "seller.name",
            "Region": "seller.region",
            "Year": "day.year",
            "Decade": Dimension("year div 10 * 10", "day"),
            "Pets": "house.pets",
            "Tub": "house.tub",
        },
        {
            "Cost": Measure("sum", "cost"),
            "Rating": Measure("avg", "rating"),
            "Rated": Measure("count", "rating"),
            "Best": Measure("max", "rating"),
            "Houses": Measure("count_distinct", "house_id"),
        },
    )


def rows(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("reduced", [None, False, True])
def test_measures_at_a_joined_dimension(view, reduced):
    df = view.query(["Year"], ["Cost", "Rating", "Rated", "Best"], pre_aggregate=reduced)
    assert rows(df) == {(2020, 90.0, 3.0, 2, 5), (2021, 60.0, 3.0, 2, 4)}


@pytest.mark.parametrize("reduced", [None, False, True])
def test_null_label_stands_next_to_the_grand_total(view, reduced):
    df = view.query(
        ["Seller"],
        ["Cost", "Rating"],
        grouping_sets=[["Seller"], []],
        total_flags=True,
        order_by=["Seller", ("Seller_is_total", "desc")],
        pre_aggregate=reduced,
    )
    assert [tuple(r) for r in df.collect()] == [
        (None, 150.0, 3.0, 1),
        (None, 120.0, 4.5, 0),
        ("Ann", 30.0, 1.5, 0),
    ]


def test_average_is_recomputed_at_each_grouping(view):
    df = view.query(
        ["Year", "Region"], ["Rating"], grouping_sets=[["Year", "Region"], ["Year"], []], total_flags=True
    )
    totals = {(r.Year, r.Region_is_total, r.Year_is_total): r.Rating for r in df.collect() if r.Region_is_total}
    assert totals == {(2020, 1, 0): 3.0, (2021, 1, 0): 3.0, (None, 1, 1): 3.0}


@pytest.mark.parametrize("reduced", [None, False, True])
def test_distinct_counts_over_a_label(view, reduced):
    df = view.query(
        ["Year"], extra={"sellers": ("count_distinct", "Seller_ID"), "n": ("count", "Seller_ID")}, pre_aggregate=reduced
    )
    assert rows(df) == {(2020, 3, 3), (2021, 1, 1)}


def test_distinct_measure(view):
    assert rows(view.query(["Year"], ["Houses"])) == {(2020, 2), (2021, 2)}
    with pytest.raises(ValueError, match="partial"):
        view.query(["Year"], ["Houses"], pre_aggregate=True)


def test_filters(view):
    assert rows(view.query([], ["Cost"], filters={"Pets": True})) == {(80.0,)}
    assert rows(view.query([], ["Cost"], filters={"Pets": None})) == {(40.0,)}
    assert rows(view.query([], ["Cost"], filters={"Year": [2021], "Tub": True})) == {(40.0,)}
    assert rows(view.query([], ["Cost"], filters={"Seller_ID": 1})) == {(30.0,)}
    assert rows(view.query(["Year"], ["Cost"], filters={"Year": 1999})) == set()


def test_expression_dimension(view):
    assert rows(view.query(["Decade"], ["Cost"])) == {(2020, 150.0)}


def test_filter_values_count_rows_passing_the_other_filters(view):
    counts = view.filter_values("Pets", {"Pets": True, "Tub": True})
    assert rows(counts) == {(True, 0), (False, 1), (None, 1)}
    two_joins = view.filter_values("Pets", {"Year": 2020})
    assert rows(two_joins) == {(True, 2), (False, 1), (None, 0)}


def test_only_needed_joins_are_planned(view):
    one = view.query(["Seller"], ["Cost"])._jdf.queryExecution().optimizedPlan().toString()
    none = view.query(["Seller_ID"], ["Cost"])._jdf.queryExecution().optimizedPlan().toString()
    assert one.count("Join") == 1 and none.count("Join") == 0


def test_one_join_aggregates_before_it(view):
    plan = view.query(["Seller"], ["Cost"])._jdf.queryExecution().optimizedPlan().toString()
    below_join = plan[plan.index("Join") :]
    assert "Aggregate" in below_join


def test_repeated_join_keys(view, tables):
    assert all(df.count() == 0 for df in view.repeated_join_keys().values())


def test_mistakes_are_reported(view, tables):
    for bad in (
        lambda: view.query(["Nope"], ["Cost"]),
        lambda: view.query(["Year"], ["Nope"]),
        lambda: view.query(["Year"]),
        lambda: view.query(["Year"], ["Cost"], grouping_sets=[["Region"]]),
        lambda: view.query(["Year"], ["Cost"], order_by=[("Year", "up")]),
        lambda: Measure("median", "x"),
        lambda: MetricView(tables[0], {}, {"X": Dimension("a", "nowhere")}, {}),
        lambda: MetricView(tables[0], {}, {"X": "a"}, {"X": Measure("sum", "b")}),
    ):
        with pytest.raises(ValueError):
            bad()


def test_filter_lists_need_one_scan(spark):
    df = sales.filter_value_counts(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey" not in plan and plan.count("Relation [") == 2
