"""The layered pipeline from generated landing data to the dashboard."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.star import fan_out
from tidemark.plans import landing, rentals

TODAY = dt.date(2024, 6, 30)
SIZES = {"customer": 60, "lakehouse": 20, "seller": 15, "lakehouse_rentals": 300}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    folders = landing.land(spark, str(root / "all"), TODAY, SIZES)
    for entity, folder in folders.items():
        system = "review" if entity == "reviews" else "lakehouse"
        spark.read.parquet(folder).write.parquet(str(root / "landing" / system / entity))
    data = {e: spark.read.parquet(f) for e, f in folders.items()}
    curated = rentals.run(spark, str(root / "landing"), str(root / "lake"))
    return root, data, curated


def test_landing_sizes_and_columns(lake):
    _, data, _ = lake
    assert {e: df.count() for e, df in data.items()} == {**SIZES, "reviews": 300}
    assert {e: len(df.columns) for e, df in data.items()} == {
        "customer": 18, "lakehouse": 21, "seller": 16, "lakehouse_rentals": 26, "reviews": 6,
    }


def test_landing_values_obey_their_rules(lake):
    _, data, _ = lake
    r = data["lakehouse_rentals"]
    stay = F.datediff("check_out_date", "check_in_date")
    assert r.filter(~stay.between(2, 7) | (F.col("order_date") > F.col("check_in_date"))).count() == 0
    assert r.filter(F.col("total_cost") != F.col("nightly_rate") * stay).count() == 0
    assert r.filter(F.col("check_in_date") > F.lit(TODAY)).count() == 0
    for parent, key in (("customer", "customer_id"), ("seller", "seller_id"), ("lakehouse", "lakehouse_id")):
        assert r.join(data[parent].select(key), key, "left_anti").count() == 0
        assert r.select(key).distinct().count() > SIZES[parent] * 0.7
    h = data["lakehouse"]
    assert h.filter(~F.size("amenities").between(3, 6)).count() == 0
    assert h.filter(F.size(F.array_distinct("amenities")) != F.size("amenities")).count() == 0
    assert h.filter(~F.col("rating").between(3.5, 5.0) | ~F.col("nightly_rate").between(850, 2500)).count() == 0
    c = data["customer"]
    assert c.filter(F.col("last_purchase_date") < F.col("registration_date")).count() == 0
    assert {x[0] for x in c.select("loyalty_tier").distinct().collect()} <= set(landing.LOYALTY_TIERS)
    s = data["seller"].select("seller_id", F.explode("assigned_lakehouses").alias("name"))
    assert s.join(h.select("name").distinct(), "name", "left_anti").count() == 0


def test_landing_repeats_exactly_and_changes_with_the_seed(spark):
    ids = spark.range(1, 50)
    first = landing.customers(ids, TODAY).collect()
    again = landing.customers(ids.repartition(7), TODAY).orderBy("customer_id").collect()
    assert sorted(first) == sorted(again)
    assert sorted(landing.customers(ids, TODAY, "43").collect()) != sorted(first)


def test_facts_have_ids_first_and_no_misses(lake):
    _, data, curated = lake
    ids = [c for c in curated.rentals.columns if c.endswith("_id")]
    assert curated.rentals.columns[:8] == ids and set(ids) == {
        "rental_id", "transaction_id", "seller_id", "customer_id", "lakehouse_id",
        "calendar_order_id", "calendar_checkin_id", "calendar_checkout_id",
    }
    assert curated.rentals.count() == 300
    assert curated.rentals.filter(" or ".join(f"{c} is null" for c in ids)).count() == 0
    assert curated.reviews.columns[:2] == ["rental_id", "calendar_review_id"]
    assert all(df.count() == 0 for df in fan_out(curated.dimensions).values())
    for df, system in ((curated.rentals, "lakehouse"), (curated.reviews, "review")):
        assert {r[0] for r in df.select("_metadata.SourceSystem").collect()} == {system}


def test_surrogates_lead_back_to_the_business_keys(lake):
    _, data, curated = lake
    d = curated.dimensions
    back = (
        curated.rentals.join(d["customer"].select("customer_id", "customer_key"), "customer_id")
        .join(d["calendar"].select(F.col("calendar_id").alias("calendar_checkin_id"), "calendar_key"), "calendar_checkin_id")
        .select("rental_id", F.col("customer_key").alias("customer_id"), F.col("calendar_key").alias("check_in_date"))
    )
    source = data["lakehouse_rentals"].select(*back.columns)
    assert back.exceptAll(source).count() == 0 and source.exceptAll(back).count() == 0


def test_dashboard_agrees_with_the_landed_rentals(lake):
    _, data, curated = lake
    r = data["lakehouse_rentals"].join(
        data["lakehouse"].select("lakehouse_id", F.col("is_pet_friendly").alias("pets"), "has_hot_tub"), "lakehouse_id"
    )
    chosen = r.filter("pets")
    page = rentals.dashboard(curated.metrics, {"Lakehouse_Is_Pet_Friendly": True})
    by_year = {x.Order_Year: x.Total_Cost for x in page["total_cost_by_year"].collect()}
    expected = {x[0]: x[1] for x in chosen.groupBy(F.year("order_date")).agg(F.sum("total_cost")).collect()}
    assert by_year == {**expected, None: chosen.agg(F.sum("total_cost")).first()[0]}
    assert all(2020 < y < 2030 for y in expected)
    months = {x.Order_Month: x.Total_Cost for x in page["total_cost_by_month"].collect()}
    assert sum(months.values()) == by_year[None] and all(1 <= m <= 12 for m in months)
    customers = {x.Order_Year: x.Customers for x in page["customers_by_year"].collect()}
    assert customers == {
        x[0]: x[1] for x in chosen.groupBy(F.year("order_date")).agg(F.count_distinct("customer_id")).collect()
    }
    assert sum(x.Total_Reviews for x in page["reviews_by_seller"].collect()) == chosen.count()
    pets = {x[0]: x[1] for x in page["values_of_Lakehouse_Is_Pet_Friendly"].collect()}
    assert pets == {x[0]: x[1] for x in r.groupBy("pets").count().collect()}
    tubs = {x[0]: x[1] for x in page["values_of_Lakehouse_Has_Hot_tub"].collect()}
    assert {k: v for k, v in tubs.items() if v} == {x[0]: x[1] for x in chosen.groupBy("has_hot_tub").count().collect()}


def test_every_label_and_measure_can_be_queried(lake):
    _, _, curated = lake
    labels = list(rentals.RENTAL_DIMENSIONS)
    assert len(labels) == 23
    everything = curated.metrics.query(labels, list(rentals.RENTAL_MEASURES))
    assert everything.columns == labels + list(rentals.RENTAL_MEASURES)
    assert everything.agg(F.sum("Total_Reviews")).first()[0] == 300
    row = everything.first()
    assert row.Order_Date.year == row.Order_Year and row.Order_Date.month == row.Order_Month


def test_a_second_run_picks_up_only_new_files(spark, lake):
    root, data, _ = lake
    folder = str(root / "landing" / "lakehouse" / "customer")
    changed = data["customer"].limit(2).withColumn("city", F.lit("Nyby"))
    extra = landing.customers(spark.range(1000, 1001), TODAY)
    changed.unionByName(extra).write.mode("append").parquet(folder)
    curated = rentals.run(spark, str(root / "landing"), str(root / "lake"))
    customers = curated.dimensions["customer"]
    assert customers.count() == SIZES["customer"] + 1
    assert customers.filter("city = 'Nyby'").count() == 2
    assert curated.rentals.count() == 300
