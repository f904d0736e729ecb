from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.calendar import calendar, calendar_spanning
from tidemark.operators.star import (
    KeyRole,
    dimension,
    drop_keys,
    fact,
    fan_out,
    hot_values,
    ids_first,
    key_roles,
    lookup_keys,
    parse_key_column,
)
from tidemark.operators.surrogate import duplicate_keys, surrogate_key


def test_calendar_span_and_leap_years(spark):
    days = calendar(spark)
    assert days.count() == 73_414
    per_year = {r["year"]: r["n"] for r in days.groupBy("year").agg(F.count("*").alias("n")).collect()}
    assert (per_year[1900], per_year[2000], per_year[2004], per_year[2100]) == (365, 366, 366, 365)


def test_calendar_attributes(spark):
    days = {
        r["date"]: r for r in calendar(spark, dt.date(2020, 12, 31), dt.date(2021, 1, 4)).collect()
    }
    new_year = days[dt.date(2021, 1, 1)]
    assert (new_year.week_of_year, new_year.day_of_week, new_year.quarter) == (53, 6, 1)
    weekend = {d for d, r in days.items() if r.is_weekend}
    assert weekend == {dt.date(2021, 1, 2), dt.date(2021, 1, 3)}
    assert days[dt.date(2021, 1, 3)].day_of_week == 1


def test_calendar_bounds(spark):
    with pytest.raises(ValueError):
        calendar(spark, dt.date(2021, 1, 2), dt.date(2021, 1, 1))
    empty = spark.createDataFrame([], "d date")
    assert calendar_spanning(empty, F.col("d")).count() == 0


@pytest.mark.parametrize("rows_per_bucket", [1, 7, 50, 10_000])
@pytest.mark.parametrize("partitions", [1, 5])
def test_ordinal_keys_are_positions_for_any_layout(spark, rows_per_bucket, partitions):
    df = spark.range(200).select((F.col("id") * 37 % 1009).alias("k")).repartition(partitions)
    found = surrogate_key(df, "k", "id", rows_per_bucket=rows_per_bucket).collect()
    assert [r.id for r in sorted(found, key=lambda r: r.k)] == list(range(200))


def test_ordinal_keys_on_strings_dates_nulls_and_pairs(spark):
    rows = [("b", dt.date(2020, 1, 1)), ("a", dt.date(2021, 1, 1)), (None, None), ("a", None)]
    df = spark.createDataFrame(rows, "s string, d date")
    for size in (1, 100):
        found = {(r.s, r.d): r.id for r in surrogate_key(df, ["s", "d"], "id", rows_per_bucket=size).collect()}
        assert found == {rows[2]: 0, rows[3]: 1, rows[1]: 2, rows[0]: 3}


def test_ordinal_keys_of_small_frames(spark):
    for count in (0, 1):
        df = spark.range(count)
        for size in (1, 100):
            ids = [r.sid for r in surrogate_key(df, "id", "sid", rows_per_bucket=size).collect()]
            assert ids == list(range(count))


@pytest.mark.parametrize("size", [2, 100])
def test_repeated_keys_fail_unless_allowed(spark, size):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k bigint, v string")
    with pytest.raises(Exception, match="repeated business key"):
        surrogate_key(df, "k", "id", rows_per_bucket=size).collect()
    allowed = surrogate_key(df, "k", "id", rows_per_bucket=size, unique=False).collect()
    assert sorted(r.id for r in allowed) == [0, 1, 2]
    assert {r.k for r in duplicate_keys(df, "k").collect()} == {1}


def test_repeated_hash_keys_are_refused(spark):
    twice = spark.range(3).union(spark.range(1)).withColumnRenamed("id", "k")
    with pytest.raises(Exception, match="repeated hash id"):
        surrogate_key(twice, "k", "sid", method="hash").collect()
    assert surrogate_key(twice, "k", "sid", method="hash", unique=False).count() == 4


def test_hash_keys_and_bad_methods(spark):
    df = spark.range(100)
    assert surrogate_key(df, "id", "sid", method="hash").select("sid").distinct().count() == 100
    for bad in ({"method": "other"}, {"keys": []}, {"name": "id"}):
        with pytest.raises(ValueError):
            surrogate_key(df, **{"keys": "id", "name": "sid", **bad})


def test_dimension_renames_or_copies_the_business_key(spark):
    df = spark.createDataFrame([(7, "x")], "customer_id bigint, name string")
    assert dimension(df, "customer", "customer_id").columns == ["customer_key", "name", "customer_id"]
    day = calendar(spark, dt.date(2021, 1, 1), dt.date(2021, 1, 2)).select("date")
    kept = dimension(day, "calendar", "date", keep_business_key=True)
    assert kept.columns == ["date", "calendar_key", "calendar_id"]


def test_key_names():
    assert parse_key_column("customer_key") == KeyRole("customer")
    assert parse_key_column("calendar_order_key").id_column == "calendar_order_id"
    for bad in ("monkey", "key", "_key", "a__key", "calendar_check_in_key"):
        with pytest.raises(ValueError):
            parse_key_column(bad)
    roles = key_roles(["monkey", "a_b_c_key"], {"a_b_c_key": ("a", "bc")})
    assert roles == {"a_b_c_key": KeyRole("a", "bc")}
    with pytest.raises(ValueError):
        key_roles(["x_key"], {"y_key": ("y", None)})


@pytest.fixture(scope="module")
def small_star(spark):
    customer = spark.createDataFrame([(10, 100), (11, 101)], "customer_key bigint, customer_id bigint")
    day = spark.createDataFrame(
        [(dt.date(2021, 1, d), d) for d in (1, 2)], "calendar_key date, calendar_id bigint"
    )
    facts = spark.createDataFrame(
        [
            (1, 10, dt.date(2021, 1, 1), dt.date(2021, 1, 2), 5),
            (2, None, dt.date(2021, 1, 2), None, 6),
            (3, 99, dt.date(2020, 1, 1), dt.date(2021, 1, 2), 7),
        ],
        "rental_id bigint, customer_key bigint, calendar_order_key date, calendar_ship_key date, monkey int",
    )
    return facts, {"customer": customer, "calendar": day}


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
@pytest.mark.parametrize("hot", [None, {"customer_key": [10, 99]}])
def test_lookup_with_roles_nulls_and_misses(spark, small_star, threshold, hot):
    facts, dims = small_star
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = lookup_keys(facts, dims, hot_keys=hot)
        assert df.columns == [
            "rental_id", "customer_id", "calendar_order_id", "calendar_ship_id", "monkey",
        ]
        assert {tuple(r) for r in df.collect()} == {
            (1, 100, 1, 2, 5), (2, None, 2, None, 6), (3, None, None, 2, 7),
        }
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_null_keys_are_spread_over_the_shuffle(spark, small_star):
    _, dims = small_star
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(100).select(
            F.col("id").alias("rental_id"), F.when(F.col("id") > 50, F.col("id")).alias("customer_key")
        )
        for spread in (False, True):
            found = lookup_keys(facts, {"customer": dims["customer"]}, spread_nulls=spread)
            plan = found._jdf.queryExecution().toString()
            physical = plan[plan.index("== Physical Plan ==") :]
            assert ("_salt" in physical[physical.index("hashpartitioning") :].split("\n")[0]) == spread
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookup_reports_what_is_wrong(spark, small_star):
    facts, dims = small_star
    with pytest.raises(ValueError, match="calendar"):
        lookup_keys(facts, {"customer": dims["customer"]})
    with pytest.raises(ValueError, match="customer_id"):
        lookup_keys(facts.withColumn("customer_id", F.lit(1)), dims)
    with pytest.raises(ValueError, match="absent"):
        fact(facts, {"absent": "x_key"}, dims)


def test_repeated_dimension_keys_fan_out_and_are_reported(spark, small_star):
    facts, dims = small_star
    doubled = {**dims, "customer": dims["customer"].union(dims["customer"])}
    assert lookup_keys(facts, doubled).count() == 4
    assert {r.customer_key for r in fan_out(doubled)["customer"].collect()} == {10, 11}
    assert fan_out(dims)["customer"].count() == 0


def test_hot_values(spark):
    df = spark.range(100).select(F.when(F.col("id") < 40, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    assert hot_values(df, "k", 0.3) == [-1]


def test_column_order_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "v int, b_id int, x_key int, a_id int")
    assert drop_keys(df).columns == ["v", "b_id", "a_id"]
    assert ids_first(df).columns == ["b_id", "a_id", "v", "x_key"]
