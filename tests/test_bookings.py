from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import amounts
from tidemark.operators.bookings import BOOKING_COLUMNS, CONFIRMED_SCHEMA, confirm, pending, submit, typed
from tidemark.plans.rentals import ingest_bookings
from tidemark.sinks.tables import append_rows, create_table_if_absent, write_files

DAY = dt.date(2024, 5, 1)


@pytest.fixture(scope="module")
def requests(spark):
    return spark.createDataFrame(
        [
            ("Ida", "i@x", DAY, DAY, "ok"),
            ("Karl", "k@x", DAY, DAY - dt.timedelta(1), "ends before it begins"),
            ("", "e@x", DAY, DAY, "no name"),
            ("Emma", None, DAY, DAY, "no email"),
            ("Noah", "n@x", DAY, None, "no end"),
        ],
        "name string, email string, from_date date, to_date date, notes string",
    )


def test_submit_validates_and_stamps(spark, requests):
    landed, counters = submit(requests)
    rows = landed.collect()
    assert [r.name for r in rows] == ["Ida"] and landed.columns == list(BOOKING_COLUMNS)
    assert len(rows[0].guid) == 36 and rows[0].from_date == "2024-05-01"
    assert counters.get == {"rows": 5, "name given": 1, "email given": 1, "stay not negative": 2}


def test_repeatable_guids(requests):
    first, second = (submit(requests, repeatable_guid=True)[0].first().guid for _ in range(2))
    assert first == second and len(first) == 36 and first.count("-") == 4
    assert submit(requests)[0].first().guid != submit(requests)[0].first().guid


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "guid string")


@pytest.mark.parametrize(
    ("confirmed", "plain", "null_aware"),
    [
        (["a"], {"b", None}, {"b"}),
        (["a", None], {"b", None}, set()),
        ([None], {"a", "b", None}, set()),
        ([], {"a", "b", None}, {"a", "b", None}),
    ],
)
def test_pending_with_nulls_on_either_side(spark, confirmed, plain, null_aware):
    bookings, done = keys(spark, "a", "b", None), keys(spark, *confirmed)
    assert {r.guid for r in pending(bookings, done).collect()} == plain
    assert {r.guid for r in pending(bookings, done, null_aware=True).collect()} == null_aware
    bookings.createOrReplaceTempView("t_bookings")
    done.createOrReplaceTempView("t_done")
    spark_rows = spark.sql("select * from t_bookings where guid not in (select guid from t_done)")
    assert {r.guid for r in spark_rows.collect()} == null_aware


def test_not_in_does_not_force_a_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pending(keys(spark, "a"), keys(spark, "b"), null_aware=True)._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_land_ingest_confirm(spark, requests, tmp_path):
    landed, _ = submit(requests, repeatable_guid=True)
    for _ in range(2):  # the same request twice is one booking by guid
        write_files(landed, str(tmp_path / "landing" / "bookings"), "json", "append")
    bookings = ingest_bookings(spark, str(tmp_path / "landing"), str(tmp_path / "lake"))
    assert bookings.count() == 1 and dict(bookings.dtypes)["from_date"] == "date"
    name = "bookings_confirmed_test"
    create_table_if_absent(spark, name, CONFIRMED_SCHEMA, path=str(tmp_path / "confirmed"))
    append_rows(confirm(bookings, bookings.select("guid")), name)
    stored = spark.table(name).first()
    assert stored.is_confirmed and stored.confirmation_date is not None and stored.name == "Ida"
    assert pending(bookings, spark.table(name)).count() == 0
    assert confirm(bookings, keys(spark, "none")).count() == 0


def test_typed(spark):
    df = spark.createDataFrame([("2024-05-01", "2024-05-02", "2024-05-01T10:11:12")], "from_date string, to_date string, booking_time string")
    assert tuple(typed(df).first()) == (DAY, dt.date(2024, 5, 2), dt.datetime(2024, 5, 1, 10, 11, 12))


def test_amounts(spark):
    df = spark.createDataFrame([(2.68, DAY, 42), (1000.0, DAY, 123456)], "v double, d date, n bigint")
    rows = df.select(
        amounts.tax_on(F.col("v")).alias("tax"),
        amounts.total_with_tax(F.col("v")).alias("total"),
        amounts.transaction_id(F.col("d"), F.col("n")).alias("id"),
        amounts.days_after("d", 3).alias("after"),
        amounts.iso_date(F.col("d")).alias("iso"),
    ).collect()
    assert [str(r.tax) for r in rows] == ["0.34", "125.00"]  # 0.335 rounds up
    assert [str(r.total) for r in rows] == ["3.02", "1125.00"]
    assert [r.id for r in rows] == ["TXN-20240501-00042", "TXN-20240501-123456"]
    assert rows[0].after == dt.date(2024, 5, 4) and rows[0].iso == "2024-05-01"
