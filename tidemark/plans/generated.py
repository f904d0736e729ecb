"""Rentals generated for the parties of the order tables, and what must hold for them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.amounts import TAX_RATE, money
from tidemark.plans import landing
from tidemark.plans.sales import table
from tidemark.sinks.tables import write_files
from tidemark.workspace import shared_folder

LANDING_DAY = dt.date(2024, 6, 30)


def generated_parties_of(spark: SparkSession, sf_dir: str, root: str) -> dict[str, DataFrame]:
    """One house per part and one seller per supplier."""
    house = _stored(
        landing.lakehouses(_ids(spark, sf_dir, "part", "p_partkey"), LANDING_DAY),
        f"{root}/lakehouse",
    )
    suppliers = _ids(spark, sf_dir, "supplier", "s_suppkey")
    seller = _stored(landing.sellers(suppliers, house, LANDING_DAY), f"{root}/seller")
    return {"lakehouse": house, "seller": seller}


def generated_entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Those, one customer per customer, and one rental with its review per order."""
    root = shared_folder(spark, "landing")
    data = generated_parties_of(spark, sf_dir, root)
    buyers = _ids(spark, sf_dir, "customer", "c_custkey")
    data["customer"] = _stored(landing.customers(buyers, LANDING_DAY), f"{root}/customer")
    rentals = landing.rentals(
        _ids(spark, sf_dir, "orders", "o_orderkey"),
        data["customer"],
        data["seller"],
        data["lakehouse"],
        LANDING_DAY,
    )
    data["lakehouse_rentals"] = _stored(rentals, f"{root}/lakehouse_rentals")
    data["reviews"] = _stored(landing.reviews(data["lakehouse_rentals"]), f"{root}/reviews")
    return data


def _stored(df: DataFrame, path: str) -> DataFrame:
    write_files(df, path, "parquet")
    return df.sparkSession.read.parquet(path)


def _ids(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return table(spark, sf_dir, name).select(key)


def generated_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over the generated rentals: all there, no key open, no rule broken."""
    data = generated_entities(spark, sf_dir)
    tax = F.round(money("total_cost") * F.lit(TAX_RATE).cast("decimal(4,3)"), 2)
    nights = F.datediff("check_out_date", "check_in_date")
    rentals = data["lakehouse_rentals"]
    parents = {"customer": "customer_id", "seller": "seller_id", "lakehouse": "lakehouse_id"}
    for name, key in parents.items():
        known = data[name].select(F.col(key).alias(f"_{key}"))
        rentals = rentals.join(known, F.col(key) == F.col(f"_{key}"), "left")
    reviewed = data["reviews"].select(
        F.col("rental_id").alias("_reviewed"), "review_date", F.col("rating").alias("stars")
    )
    rentals = rentals.join(reviewed, F.col("rental_id") == F.col("_reviewed"), "left")
    waited = F.datediff("review_date", "check_out_date")
    return rentals.agg(
        F.count(F.lit(1)).alias("rentals"),
        F.count("_reviewed").alias("reviews"),
        *[F.count_if(F.col(f"_{k}").isNull()).alias(f"open_{k}") for k in parents.values()],
        F.count_if(~nights.between(2, 7)).alias("wrong_stays"),
        F.count_if(F.col("order_date") > F.col("check_in_date")).alias("late_orders"),
        F.count_if(F.col("total_cost") != F.col("nightly_rate") * nights).alias("wrong_totals"),
        F.count_if(money("tax_amount") != tax).alias("wrong_taxes"),
        F.count_if(~F.col("transaction_id").rlike("^TXN-[0-9]{8}-[0-9]{5}$")).alias("wrong_ids"),
        F.count_if(~waited.between(1, 7) | ~F.col("stars").between(1, 5)).alias("wrong_reviews"),
    )


def generated_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for houses and sellers: amenities differ, guests fit, assigned names exist."""
    data = generated_parties_of(spark, sf_dir, shared_folder(spark, "parties"))
    houses = data["lakehouse"].agg(
        F.count(F.lit(1)).alias("houses"),
        F.count_if(~F.size("amenities").between(3, 6)).alias("wrong_amenity_counts"),
        F.count_if(F.size("amenities") != F.size(F.array_distinct("amenities"))).alias(
            "repeated_amenities"
        ),
        F.count_if(~(F.col("max_guests") / F.col("bedrooms")).isin(2, 3)).alias("wrong_guests"),
    )
    names = data["lakehouse"].select("name").distinct().withColumnRenamed("name", "_known")
    sellers = (
        data["seller"]
        .select("seller_id", F.explode("assigned_lakehouses").alias("house"))
        .join(names, F.col("house") == F.col("_known"), "left")
        .groupBy("seller_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("_known").isNull()).alias("unknown"),
        )
        .agg(
            F.count(F.lit(1)).alias("sellers"),
            F.count_if(~F.col("n").between(1, 3)).alias("wrong_assignments"),
            F.coalesce(F.sum("unknown"), F.lit(0)).alias("unknown_houses"),
        )
    )
    checks = [
        houses.select(F.explode(F.create_map(*_pairs(houses.columns))).alias("check", "rows")),
        sellers.select(F.explode(F.create_map(*_pairs(sellers.columns))).alias("check", "rows")),
    ]
    return checks[0].unionByName(checks[1])


def _pairs(names: list[str]) -> list:
    return [part for n in names for part in (F.lit(n), F.col(n))]
