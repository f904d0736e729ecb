"""Tables that are stored and extended: ids that stay, roll-ups, interleaved layouts, catalog tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import amounts
from tidemark.functions.audit import add_audit
from tidemark.operators.keymap import KeyMap
from tidemark.operators.metrics import Dimension, Join, Measure, MetricView
from tidemark.operators.rollups import Rollup, RollupStore
from tidemark.operators.star import fact
from tidemark.plans.sales import AVERAGE_QUANTITY, TOTAL_COST, TOTAL_LINES, dim_calendar, sales_lines, table
from tidemark.sinks.tables import TableLayout, materialize, table_exists, write_files
from tidemark.sources.files import discover, read_files
from tidemark.sources.tables import list_tables, read_table
from tidemark.workspace import folder_tag, shared_folder

LATTICE = {
    "by_month": Rollup(
        ["Order_Year", "Order_Month", "Return_Flag"],
        ["Total_Cost", "Average_Quantity", "Total_Lines"],
        {"Customers": "Customer"},
    ),
    "by_year": Rollup(["Order_Year"], ["Total_Cost", "Total_Lines"], {"Customers": "Customer"}),
}


def dim_customer_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in two loads, the second with keys between those of the first, which keep their ids."""
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "customer_key")
    ids = KeyMap(shared_folder(spark, "ids"), "customer_key", "customer_id")
    ids.extend(customers.filter("customer_key % 3 <> 1"))
    ids.extend(customers)
    return ids.attach(customers)


def _line_metrics(spark: SparkSession, lines: DataFrame) -> MetricView:
    days = dim_calendar(spark)
    dated = lines.select("o_custkey", "o_orderdate", "l_returnflag", "l_quantity", "l_extendedprice")
    return MetricView(
        fact(dated, {"o_orderdate": "calendar_order_key"}, {"calendar": days}),
        {"calendar": Join(days, {"calendar_order_id": "calendar_id"})},
        {
            "Order_Year": Dimension("year", "calendar"),
            "Order_Month": Dimension("month", "calendar"),
            "Return_Flag": Dimension("l_returnflag"),
            "Customer": Dimension("o_custkey"),
        },
        {"Total_Cost": TOTAL_COST, "Average_Quantity": AVERAGE_QUANTITY, "Total_Lines": TOTAL_LINES},
    )


def _rolled_up(spark: SparkSession, sf_dir: str) -> RollupStore:
    """The lines in two batches: returned ones come later."""
    lines = sales_lines(spark, sf_dir)
    store = RollupStore(_line_metrics(spark, lines), shared_folder(spark, "rollups"), LATTICE)
    store.add("kept", _line_metrics(spark, lines.filter("l_returnflag is distinct from 'R'")))
    store.add("returned", _line_metrics(spark, lines.filter("l_returnflag = 'R'")))
    return store


def rollup_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers, cost and average by month, by year and in total, from the stored roll-ups."""
    result = _rolled_up(spark, sf_dir).query(
        ["Order_Year", "Order_Month"],
        ["Total_Cost", "Average_Quantity"],
        {"Customers": "Customer"},
        grouping_sets=[["Order_Year", "Order_Month"], ["Order_Year"], []],
        total_flags=True,
    )
    return result.withColumns(
        {"Total_Cost": F.col("Total_Cost").cast("double"), "Average_Quantity": F.round("Average_Quantity", 6)}
    )


def rollup_total_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per year and in all from the smallest roll-up; no order line is read for it."""
    result = _rolled_up(spark, sf_dir).query(
        ["Order_Year"], ["Total_Cost"], grouping_sets=[["Order_Year"], []], total_flags=True
    )
    return result.withColumn("Total_Cost", F.col("Total_Cost").cast("double"))


def interleaved_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored along a curve by date and customer, read back by a range of each."""
    path = shared_folder(spark, "curve")
    orders = table(spark, sf_dir, "orders")
    write_files(orders, path, "parquet", layout=TableLayout(interleave=["o_orderdate", "o_custkey"]))
    stored = spark.read.parquet(path)
    by_day = stored.filter("o_orderdate >= '1995-01-01' and o_orderdate < '1995-07-01'").withColumn("read_by", F.lit("date"))
    by_customer = stored.filter("o_custkey between 20 and 60").withColumn("read_by", F.lit("customer"))
    return by_day.unionByName(by_customer)


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables stored under a flow's own settings, found in the catalog and read with and without audit."""
    root = shared_folder(spark, "catalog")
    tag = folder_tag(root)
    codec = "spark.sql.parquet.compression.codec"
    before = spark.conf.get(codec)
    for name in ("orders", "customer"):
        materialize(
            table(spark, sf_dir, name),
            f"{name}_{tag}",
            layout=TableLayout(path=f"{root}/{name}"),
            spark_conf={codec: "gzip"},
        )
    restored = F.lit(spark.conf.get(codec) == before)
    found = list_tables(spark, spark.catalog.currentDatabase()).filter(F.endswith("table_name", F.lit(f"_{tag}")))
    read = []
    for row in found.orderBy("table_name").collect():
        name = row["table_name"]
        plain, audited = read_table(spark, name), read_table(spark, name, "catalog")
        read.append(
            audited.select(F.input_file_name().alias("file"), F.lit(len(audited.columns) - len(plain.columns)).alias("n"))
            .agg(
                F.lit(name.removesuffix(f"_{tag}")).alias("table_name"),
                F.lit(row["table_type"]).alias("table_type"),
                F.count(F.lit(1)).alias("rows"),
                F.bool_and(F.endswith("file", F.lit(".gz.parquet"))).alias("under_settings"),
                F.max("n").alias("audit_columns"),
                F.lit(table_exists(spark, name)).alias("exists"),
                F.lit(table_exists(spark, f"{name}_none")).alias("other_exists"),
                restored.alias("settings_restored"),
            )
        )
    return reduce(DataFrame.unionByName, read)


def row_guids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A random guid for each event, as many as rows and all of the usual shape."""
    path = shared_folder(spark, "guids")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    write_files(events.withColumn("guid", amounts.random_guid()), path, "parquet")
    shape = F.col("guid").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return (
        spark.read.parquet(path)
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_distinct("guid").alias("guids"),
            F.count_if(shape).alias("well_formed"),
        )
    )


def discover_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table of the given folder, found by its files, and the rows that each has."""
    counts = [
        read_files(spark, f"{sf_dir.rstrip('/')}/{r['dataset']}.{r['format']}", r["format"]).agg(
            F.lit(r["dataset"]).alias("dataset"), F.lit(r["format"]).alias("format"), F.count(F.lit(1)).alias("rows")
        )
        for r in discover(spark, sf_dir).orderBy("dataset").collect()
    ]
    return reduce(DataFrame.unionByName, counts)
