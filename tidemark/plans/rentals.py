"""The layered rental pipeline: landing -> raw -> base -> enriched -> curated -> metrics.

Each step is a function from DataFrames to DataFrames; ``run`` calls them in layer
order and keeps every layer as files below one folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.audit import INGEST_SEQUENCE
from tidemark.functions.calendar import CALENDAR_START, calendar
from tidemark.operators import bookings as booking_ops
from tidemark.operators.metrics import Join, Measure, MetricView
from tidemark.operators.star import dimension, fact
from tidemark.sinks.tables import await_all, write_files
from tidemark.sources.files import discover, file_stream
from tidemark.streaming.upsert import ChangeTarget, specs_from_config, start_flows

# Load settings per source system and table.
LAKEHOUSE_CONFIG = {
    "customer": {"keys": ["customer_id"], "sequence_column": INGEST_SEQUENCE, "stored_as_scd_type": 1},
    "lakehouse": {"keys": ["lakehouse_id"], "sequence_column": INGEST_SEQUENCE, "stored_as_scd_type": 1},
    "lakehouse_rentals": {"keys": ["rental_id"], "sequence_column": INGEST_SEQUENCE, "stored_as_scd_type": 1},
    "seller": {"keys": ["seller_id"], "sequence_column": INGEST_SEQUENCE, "stored_as_scd_type": 1},
}
REVIEW_CONFIG = {
    "reviews": {"keys": ["rental_id"], "sequence_column": INGEST_SEQUENCE, "stored_as_scd_type": 1},
}
BOOKINGS_CONFIG = {
    "bookings": {"keys": ["guid"], "sequence_column": INGEST_SEQUENCE, "stored_as_scd_type": 1},
}

# Business columns of the facts and the roles they take.
RENTAL_KEYS = {
    "seller_id": "seller_key",
    "customer_id": "customer_key",
    "lakehouse_id": "lakehouse_key",
    "order_date": "calendar_order_key",
    "check_in_date": "calendar_checkin_key",
    "check_out_date": "calendar_checkout_key",
}
REVIEW_KEYS = {"review_date": "calendar_review_key"}

# Labels of the metric view and the columns behind them.
RENTAL_DIMENSIONS = {
    "Seller_ID": "seller_id",
    "Seller_Name": "seller.name",
    "Seller_Phone_Number": "seller.phone_number",
    "Seller_Region": "seller.region",
    "Customer_ID": "customer.customer_id",
    "Customer_Name": "customer.name",
    "Customer_Email": "customer.email",
    "Customer_Postcode": "customer.postal_code",
    "Customer_City": "customer.city",
    "Customer_Country": "customer.country",
    "Calendar_Order_ID": "calendar.calendar_id",
    "Order_Date": "calendar.date",
    "Order_Year": "calendar.year",
    "Order_Month": "calendar.month",
    "Order_Day": "calendar.day",
    "Order_Day_Of_Week": "calendar.day_of_week",
    "Order_Week_Of_Year": "calendar.week_of_year",
    "Lakehouse_ID": "lakehouse.lakehouse_id",
    "Lakehouse_Name": "lakehouse.name",
    "Lakehouse_Location": "lakehouse.location",
    "Lakehouse_Is_Pet_Friendly": "lakehouse.is_pet_friendly",
    "Lakehouse_Has_Lake_View": "lakehouse.has_lake_view",
    "Lakehouse_Has_Hot_tub": "lakehouse.has_hot_tub",
}
# Total_Reviews counts rentals whose order date is in the calendar; Average_Rating is the rental's.
RENTAL_MEASURES = {
    "Total_Cost": Measure("sum", "total_cost"),
    "Average_Rating": Measure("avg", "rating"),
    "Total_Reviews": Measure("count", "calendar_order_id"),
}
FILTER_LABELS = (
    "Lakehouse_Is_Pet_Friendly",
    "Lakehouse_Has_Hot_tub",
    "Lakehouse_Has_Lake_View",
)


# A micro-batch takes this many files, so that a first run over a large folder is many batches.
FILES_PER_BATCH = 1000


def ingest_raw(
    spark: SparkSession, landing: str, raw: str, checkpoints: str, source_system: str
) -> list[str]:
    """Every dataset found in a landing folder, each file once, with the audit struct."""
    found = discover(spark, landing).orderBy("dataset").collect()
    twice = {r.dataset for r in found if [x.dataset for x in found].count(r.dataset) > 1}
    if twice:
        raise ValueError(f"datasets with files of several formats: {sorted(twice)}")
    queries = []
    for row in found:
        stream = file_stream(
            spark,
            f"{landing}/{row.dataset}",
            row.format,
            schema_location=f"{raw}/_schemas/{row.dataset}",
            audit_source=source_system,
            max_files_per_trigger=FILES_PER_BATCH,
        )
        queries.append(
            stream.writeStream.format("parquet")
            .option("checkpointLocation", f"{checkpoints}/raw/{row.dataset}")
            .trigger(availableNow=True)
            .start(f"{raw}/{row.dataset}")
        )
    await_all(queries)
    return [row.dataset for row in found]


def load_base(
    spark: SparkSession, raw: str, base: str, checkpoints: str, config: dict, datasets: list[str]
) -> dict[str, ChangeTarget]:
    """The raw tables followed into base tables, one change flow each."""
    specs = {name: specs_from_config(config)[name] for name in datasets if name in config}
    streams = {
        name: file_stream(spark, f"{raw}/{name}", "parquet", max_files_per_trigger=FILES_PER_BATCH)
        for name in datasets
    }
    flows = start_flows(streams, specs, base, f"{checkpoints}/base", once=True)
    await_all(query for _, query in flows.values())
    return {name: target for name, (target, _) in flows.items()}


def dim_calendar(days: DataFrame) -> DataFrame:
    return dimension(days, "calendar", "date", keep_business_key=True)


def dim_customer(base: DataFrame) -> DataFrame:
    return dimension(base, "customer", "customer_id")


def dim_seller(base: DataFrame) -> DataFrame:
    return dimension(base, "seller", "seller_id")


def dim_lakehouse(base: DataFrame) -> DataFrame:
    return dimension(base, "lakehouse", "lakehouse_id")


def fact_rentals(base: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    return fact(base, RENTAL_KEYS, dimensions)


def fact_reviews(base: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    return fact(base, REVIEW_KEYS, dimensions)


def rental_metrics(rentals: DataFrame, dimensions: dict[str, DataFrame]) -> MetricView:
    """The metric view over the rentals star; the calendar joins in its order role."""
    joins = {
        "seller": Join(dimensions["seller"], {"seller_id": "seller_id"}),
        "customer": Join(dimensions["customer"], {"customer_id": "customer_id"}),
        "calendar": Join(dimensions["calendar"], {"calendar_order_id": "calendar_id"}),
        "lakehouse": Join(dimensions["lakehouse"], {"lakehouse_id": "lakehouse_id"}),
    }
    return MetricView(rentals, joins, RENTAL_DIMENSIONS, RENTAL_MEASURES)


def dashboard(view: MetricView, filters: dict | None = None) -> dict[str, DataFrame]:
    """The page's queries, all under the same filters, and the value lists of the filters."""
    page = {
        "total_cost_by_month": view.query(["Order_Month"], ["Total_Cost"], filters=filters),
        "total_cost_by_year": view.query(
            ["Order_Year"],
            ["Total_Cost"],
            filters=filters,
            grouping_sets=[["Order_Year"], []],
            total_flags=True,
            order_by=["Order_Year"],
        ),
        "customers_by_year": view.query(
            ["Order_Year"],
            extra={"Customers": ("count_distinct", "Customer_ID")},
            filters=filters,
        ),
        "reviews_by_seller": view.query(["Seller_Name"], ["Total_Reviews"], filters=filters),
    }
    for label in FILTER_LABELS:
        page[f"values_of_{label}"] = view.filter_values(label, filters)
    return page


@dataclass(frozen=True)
class Curated:
    dimensions: dict[str, DataFrame]
    rentals: DataFrame
    reviews: DataFrame
    metrics: MetricView


def curate(spark: SparkSession, root: str, base: dict[str, DataFrame]) -> Curated:
    """Enriched calendar, dimensions and facts, each written before the next reads it."""

    def store(df: DataFrame, name: str) -> DataFrame:
        write_files(df, f"{root}/{name}", "parquet")
        return spark.read.parquet(f"{root}/{name}")

    days = store(calendar(spark, CALENDAR_START), "enriched/calendar")
    dims = {
        "calendar": store(dim_calendar(days), "curated/dim_calendar"),
        "customer": store(dim_customer(base["customer"]), "curated/dim_customer"),
        "seller": store(dim_seller(base["seller"]), "curated/dim_seller"),
        "lakehouse": store(dim_lakehouse(base["lakehouse"]), "curated/dim_lakehouse"),
    }
    rentals = store(fact_rentals(base["lakehouse_rentals"], dims), "curated/fact_rentals")
    reviews = store(fact_reviews(base["reviews"], dims), "curated/fact_reviews")
    return Curated(dims, rentals, reviews, rental_metrics(rentals, dims))


def run(spark: SparkSession, landing: str, root: str) -> Curated:
    """All layers over the two source systems ``lakehouse`` and ``review`` below ``landing``.

    The audit struct stays on every row, up to the curated tables.
    """
    base: dict[str, DataFrame] = {}
    for system, config in (("lakehouse", LAKEHOUSE_CONFIG), ("review", REVIEW_CONFIG)):
        names = ingest_raw(
            spark, f"{landing}/{system}", f"{root}/raw/{system}", f"{root}/state/{system}", system
        )
        targets = load_base(
            spark,
            f"{root}/raw/{system}",
            f"{root}/base/{system}",
            f"{root}/state/{system}",
            config,
            names,
        )
        base.update({n: t.table(spark) for n, t in targets.items()})
    return curate(spark, root, base)


def ingest_bookings(spark: SparkSession, landing: str, root: str) -> DataFrame:
    """Booking requests landed as JSON -> raw -> base by guid, as typed rows."""
    names = ingest_raw(spark, landing, f"{root}/raw", f"{root}/state", "bookings")
    targets = load_base(
        spark, f"{root}/raw", f"{root}/base", f"{root}/state", BOOKINGS_CONFIG, names
    )
    rows = targets["bookings"].table(spark).select(*booking_ops.BOOKING_COLUMNS)
    return booking_ops.typed(rows)
