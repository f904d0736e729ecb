"""The sales star over the order tables: dimensions, facts, metrics, bookings.

Seller, customer and house of the rental model appear as supplier, customer and
part; a line item with its order is the rental.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import amounts
from tidemark.functions.calendar import CALENDAR_START, calendar, calendar_spanning
from tidemark.operators import bookings as booking_ops
from tidemark.operators.metrics import Dimension, Join, Measure, MetricView
from tidemark.operators.quality import Rule, expect, row_filter
from tidemark.operators.star import dimension, fact, hot_values, lookup_keys
from tidemark.operators.surrogate import ROWS_PER_BUCKET
from tidemark.sinks.tables import (
    TableLayout,
    append_rows,
    create_table_if_absent,
    create_view,
    enforce_schema,
    materialize,
    write_files,
)
from tidemark.sources.files import discover, read_files
from tidemark.workspace import folder_tag, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- calendar and dimensions ------------------------------------------------------


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from the first to the last order, with its orders (days without any kept)."""
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("order_day"))
    spine = calendar_spanning(orders, F.col("order_day"))
    per_day = orders.groupBy("order_day").agg(F.count(F.lit(1)).alias("n"))
    return (
        spine.join(per_day, F.col("date") == F.col("order_day"), "left")
        .withColumn("orders", F.coalesce("n", F.lit(0)))
        .drop("order_day", "n")
    )


def dim_calendar_spanning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar dimension of the shipping dates."""
    shipped = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    spine = calendar_spanning(shipped, F.col("d"))
    return dimension(spine, "calendar", "date", keep_business_key=True)


def dim_calendar(spark: SparkSession) -> DataFrame:
    """The full calendar; in a spine without gaps the position of a day is its distance."""
    days = calendar(spark)
    return days.withColumn(
        "calendar_id", F.datediff("date", F.lit(CALENDAR_START)).cast("long")
    ).withColumn("calendar_key", F.col("date"))


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension(table(spark, sf_dir, "customer"), "customer", "c_custkey")


def dim_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension(table(spark, sf_dir, "supplier"), "supplier", "s_suppkey")


def dim_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension(table(spark, sf_dir, "part"), "part", "p_partkey")


def dim_part_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ids when the dimension is too long for one window: numbered in 16 ranges or more."""
    parts = table(spark, sf_dir, "part")
    bucket = max(1, min(ROWS_PER_BUCKET, parts.count() // 16))
    return dimension(parts, "part", "p_partkey", rows_per_bucket=bucket)


def dim_part_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash ids: no numbers to compare, so what is shown is that they stay distinct."""
    dim = dimension(table(spark, sf_dir, "part"), "part", "p_partkey", method="hash")
    return dim.groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("parts"), F.count_distinct("part_id").alias("ids")
    )


# -- facts -----------------------------------------------------------------------

SALES_KEYS = {
    "o_custkey": "customer_key",
    "l_suppkey": "supplier_key",
    "l_partkey": "part_key",
    "o_orderdate": "calendar_order_key",
    "l_shipdate": "calendar_ship_key",
}


def sales_lines(spark: SparkSession, sf_dir: str, with_orders: bool = True) -> DataFrame:
    """Line items, with their order unless that is not needed; both sides are large and meet by a shuffle."""
    lines = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    if not with_orders:
        return lines.withColumnRenamed("l_orderkey", "order_id")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderstatus"
    )
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.drop("o_orderkey").withColumnRenamed("l_orderkey", "order_id")


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five lookups, the calendar in two roles."""
    dims = {
        "customer": dim_customer(spark, sf_dir),
        "supplier": dim_supplier(spark, sf_dir),
        "part": dim_part(spark, sf_dir),
        "calendar": dim_calendar(spark),
    }
    return fact(sales_lines(spark, sf_dir), SALES_KEYS, dims)


def fact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One calendar role; the event keeps its own id and has no other dimension."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.to_date("ts"))
    return fact(events, {"ts": "calendar_event_key"}, {"calendar": dim_calendar(spark)})


def lookup_miss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against the customers of one segment: found and missing ids per status."""
    customers = row_filter(table(spark, sf_dir, "customer"), "c_mktsegment = 'BUILDING'")
    dims = {"customer": dimension(customers, "customer", "c_custkey")}
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    found = lookup_keys(orders.withColumnRenamed("o_custkey", "customer_key"), dims)
    return found.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.count("customer_id").alias("found")
    )


def lookup_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup whose fact has hot values and many null keys; the hot ones are found and spread."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.lit(7).cast("long"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("long"))
        .when(F.col("o_orderstatus") == "O", F.lit(11).cast("long"))
        .otherwise(F.col("o_custkey"))
        .alias("customer_key"),
    )
    dims = {"customer": dim_customer(spark, sf_dir)}
    hot = hot_values(orders, "customer_key", share=0.1)
    return lookup_keys(orders, dims, hot_keys={"customer_key": hot})


# -- metrics ---------------------------------------------------------------------

TOTAL_COST = Measure("sum", "cast(l_extendedprice as decimal(18,2))")
AVERAGE_QUANTITY = Measure("avg", "l_quantity")
# Counts lines whose order date was found in the calendar.
TOTAL_LINES = Measure("count", "calendar_order_id")

METRIC_DIMENSIONS = {
    "Order_Date": ("calendar", "date"),
    "Order_Year": ("calendar", "year"),
    "Order_Month": ("calendar", "month"),
    "Customer_ID": ("customer", "c_custkey"),
    "Customer_Segment": ("customer", "c_mktsegment"),
    "Supplier_Name": ("supplier", "s_name"),
    "Part_Brand": ("part", "p_brand"),
    "Part_Is_Large": ("part", "p_size > 25"),
    "Part_Is_Economy": ("part", "p_type = 'ECONOMY'"),
    "Part_Is_Premium": ("part", "p_retailprice > 950"),
}
METRIC_JOINS = {
    "calendar": ("o_orderdate", "calendar_order_id", "calendar_id"),
    "customer": ("o_custkey", "o_custkey", "c_custkey"),
    "supplier": ("l_suppkey", "l_suppkey", "s_suppkey"),
    "part": ("l_partkey", "l_partkey", "p_partkey"),
}


def sales_metrics(spark: SparkSession, sf_dir: str, joins: tuple[str, ...]) -> MetricView:
    """The metric view with the named joins.

    Tables are joined on their business keys: a query needs no surrogate ids, so no
    dimension is numbered for it, and orders are joined only for keys that they hold.
    """
    tables = {
        "calendar": lambda: dim_calendar(spark),
        "customer": lambda: table(spark, sf_dir, "customer"),
        "supplier": lambda: table(spark, sf_dir, "supplier"),
        "part": lambda: table(spark, sf_dir, "part"),
    }
    needed = [METRIC_JOINS[j][0] for j in joins]
    facts = sales_lines(spark, sf_dir, with_orders=any(c.startswith("o_") for c in needed))
    facts = facts.drop(*[c for c in SALES_KEYS if c not in needed])
    if "calendar" in joins:
        facts = fact(facts, {"o_orderdate": "calendar_order_key"}, {"calendar": tables["calendar"]()})
    measures = {
        "Total_Cost": TOTAL_COST,
        "Average_Quantity": AVERAGE_QUANTITY,
        "Lines": Measure("count", "1"),
    }
    dimensions: dict[str, Dimension] = {
        "Return_Flag": Dimension("l_returnflag"),
        **{
            label: Dimension(expr, join)
            for label, (join, expr) in METRIC_DIMENSIONS.items()
            if join in joins
        },
    }
    if "calendar" in joins:
        measures["Total_Lines"] = TOTAL_LINES
    return MetricView(
        facts,
        {j: Join(tables[j](), {METRIC_JOINS[j][1]: METRIC_JOINS[j][2]}) for j in joins},
        dimensions,
        measures,
    )


def _as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def total_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = sales_metrics(spark, sf_dir, ("calendar",))
    return _as_double(view.query(["Order_Month"], ["Total_Cost"]), "Total_Cost")


def total_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per year and in all, the grand total marked."""
    view = sales_metrics(spark, sf_dir, ("calendar",))
    totals = view.query(
        ["Order_Year"],
        ["Total_Cost"],
        grouping_sets=[["Order_Year"], []],
        total_flags=True,
        order_by=["Order_Year"],
    )
    return _as_double(totals, "Total_Cost")


def distinct_customers_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = sales_metrics(spark, sf_dir, ("calendar", "customer"))
    return view.query(["Order_Year"], extra={"Customers": ("count_distinct", "Customer_ID")})


def lines_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = sales_metrics(spark, sf_dir, ("calendar", "supplier"))
    return view.query(["Supplier_Name"], ["Total_Lines"])


def average_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The average at three groupings: recomputed each time, never averaged again."""
    view = sales_metrics(spark, sf_dir, ("customer",))
    result = view.query(
        ["Customer_Segment", "Return_Flag"],
        ["Average_Quantity"],
        grouping_sets=[["Customer_Segment", "Return_Flag"], ["Customer_Segment"], []],
        total_flags=True,
    )
    return result.withColumn("Average_Quantity", F.round("Average_Quantity", 6))


def filtered_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = sales_metrics(spark, sf_dir, ("calendar", "part"))
    totals = view.query(
        ["Order_Year"],
        ["Total_Cost", "Total_Lines"],
        filters={"Part_Is_Large": True, "Part_Is_Economy": False, "Order_Month": [1, 2, 3]},
    )
    return _as_double(totals, "Total_Cost")


def filter_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each value of the three filters with the lines that pass the two others.

    The lines are counted once by part; the three lists come from the few
    combinations of filter values.
    """
    view = sales_metrics(spark, sf_dir, ("part",))
    chosen = {"Part_Is_Large": True, "Part_Is_Economy": True, "Part_Is_Premium": False}
    counts = view.query(list(chosen), ["Lines"]).withColumnRenamed("Lines", "n")
    entries = []
    for label in chosen:
        others = F.lit(True)
        for other, value in chosen.items():
            if other != label:
                others = others & F.coalesce(F.col(other) == value, F.lit(False))
        passing = F.when(others, F.col("n")).otherwise(0)
        entries.append(F.struct(F.lit(label).alias("filter"), F.col(label).alias("value"), passing.alias("n")))
    rows = counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    return rows.groupBy("filter", "value").agg(F.sum("n").alias("lines"))


# -- rules, views, layouts ---------------------------------------------------------

LINE_RULES = {
    "some quantity": "l_quantity >= 5",
    "small discount": "l_discount <= 0.08",
    "shipped": "l_linestatus = 'F'",
}


def expect_warn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rule's counters after a run over all lines, which all stay."""
    kept, counters = expect(table(spark, sf_dir, "lineitem"), LINE_RULES, "expect")
    rows = kept.agg(F.count(F.lit(1)).alias("rows")).first()["rows"]
    counted = counters.get
    return spark.createDataFrame(
        [(rule, "expect", rows, int(counted[rule])) for rule in LINE_RULES], "rule string, action string, rows long, violations long"
    )


def expect_fail_keeps_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule and a cast that fail leave the earlier table; its rows are returned."""
    path = shared_folder(spark, "kept")
    name = "kept_" + folder_tag(path)
    orders = table(spark, sf_dir, "orders")
    layout = TableLayout(path=path)
    materialize(orders.filter("o_orderstatus = 'F'"), name, layout=layout)
    rule = [Rule("no large order", "o_totalprice < 100000", "expect_or_fail")]
    wrong = orders.withColumn("o_orderstatus", F.col("o_orderpriority").cast("int").cast("string"))
    failures = 0
    for rows, rules in ((orders, rule), (wrong, None)):
        try:
            materialize(rows, name, layout=layout, rules=rules)
        except Exception:  # noqa: BLE001 - the failure is what is shown
            failures += 1
    if failures != 2:
        raise AssertionError("a failing rule or cast did not fail the write")
    return spark.read.table(name)


def expect_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = {"small discount": LINE_RULES["small discount"]}
    return expect(table(spark, sf_dir, "lineitem"), rule, "expect_or_drop")[0]


def expect_all_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expect(table(spark, sf_dir, "lineitem"), LINE_RULES, "expect_all_or_drop")[0]


def expect_or_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that every line keeps; the first that did not would end the job."""
    rules = {"some quantity": "l_quantity > 0", "discount is a share": "l_discount between 0 and 1"}
    return expect(table(spark, sf_dir, "lineitem"), rules, "expect_all_or_fail")[0]


def row_filter_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view of the orders a reader may see."""
    visible = row_filter(
        table(spark, sf_dir, "orders"), "o_orderstatus <> 'P' and o_totalprice > 100000"
    )
    name = create_view(visible, "sales", "base", "orders")
    return spark.table(name).select("*")


def private_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An intermediate result under a name, not stored."""
    large = table(spark, sf_dir, "orders").filter("o_totalprice > 250000")
    materialize(large, "sales.large_orders", private=True)
    return spark.table("sales_large_orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders")
    )


ORDER_SCHEMA = (
    "o_orderkey bigint not null, o_custkey bigint, o_orderstatus string, "
    "o_totalprice decimal(18,2), o_orderdate date"
)


def stored_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders brought to a declared schema, stored in status folders, sorted by date, read back."""
    path = shared_folder(spark, "layout")
    declared = enforce_schema(
        table(spark, sf_dir, "orders").drop("o_orderpriority"), ORDER_SCHEMA
    )
    layout = TableLayout(partition_cols=["o_orderstatus"], cluster_by=["o_orderdate"])
    write_files(declared, path, "parquet", "overwrite", layout)
    stored = spark.read.parquet(path).filter("o_orderstatus in ('F', 'O')")
    return stored.groupBy("o_orderstatus", F.year("o_orderdate").alias("order_year")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("o_totalprice").cast("double").alias("total"),
    )


# -- amounts and bookings ----------------------------------------------------------


def rental_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check-out date, tax, total and transaction id of every line."""
    lines = table(spark, sf_dir, "lineitem")
    day = F.to_date("l_shipdate")
    total = amounts.money("l_extendedprice")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        amounts.days_after(day, F.col("l_quantity").cast("int")).alias("check_out_date"),
        amounts.tax_on(total).cast("double").alias("tax_amount"),
        amounts.total_with_tax(total).cast("double").alias("total_cost_with_tax"),
        amounts.transaction_id(day, F.col("l_orderkey")).alias("transaction_id"),
    )


def _bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bookings; the urgent ones have no guid."""
    orders = table(spark, sf_dir, "orders")
    guid = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderkey").cast("string"))
    day = F.to_date("o_orderdate")
    return orders.select(
        guid.alias("guid"),
        F.concat(F.lit("Customer "), F.col("o_custkey")).alias("name"),
        F.concat(F.lit("c"), F.col("o_custkey"), F.lit("@example.com")).alias("email"),
        day.alias("from_date"),
        F.date_add(day, F.lit(3)).alias("to_date"),
        F.col("o_orderdate").cast("timestamp").alias("booking_time"),
        F.col("o_orderpriority").alias("notes"),
    )


def _confirmed(spark: SparkSession, sf_dir: str, status: str, with_nulls: bool) -> DataFrame:
    chosen = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == status)
    key = F.col("o_orderkey").cast("string")
    if with_nulls:
        key = F.when(F.col("o_orderpriority") != "5-LOW", key)
    return chosen.select(key.alias("guid"))


def _shown(df: DataFrame) -> DataFrame:
    return df.select("guid", "name", "email", "from_date", "to_date", "notes")


def pending_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    confirmed = _confirmed(spark, sf_dir, "F", with_nulls=False)
    return _shown(booking_ops.pending(_bookings(spark, sf_dir), confirmed, null_aware=True))


def pending_not_in_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a null among the confirmed keys NOT IN holds for no row."""
    confirmed = _confirmed(spark, sf_dir, "F", with_nulls=True)
    return _shown(booking_ops.pending(_bookings(spark, sf_dir), confirmed, null_aware=True))


def pending_left_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    confirmed = _confirmed(spark, sf_dir, "F", with_nulls=True)
    return _shown(booking_ops.pending(_bookings(spark, sf_dir), confirmed))


def confirm_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirm the selected bookings into a confirmations table and read it back."""
    path = shared_folder(spark, "confirmed")
    name = "confirmed_" + folder_tag(path)
    create_table_if_absent(spark, name, booking_ops.CONFIRMED_SCHEMA, path=path)
    selected = _confirmed(spark, sf_dir, "O", with_nulls=True)
    append_rows(booking_ops.confirm(_bookings(spark, sf_dir), selected), name)
    return spark.read.table(name).drop("booking_time", "confirmation_date")


def submit_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests without name or email, or ending before they begin, are turned away."""
    orders = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    requests = orders.select(
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Customer "), F.col("o_custkey")))
        .otherwise("")
        .alias("name"),
        F.when(F.col("o_orderpriority") != "2-HIGH", F.concat(F.lit("c"), F.col("o_custkey")))
        .alias("email"),
        day.alias("from_date"),
        F.date_add(day, (F.col("o_orderkey") % 9 - 2).cast("int")).alias("to_date"),
        F.col("o_orderkey").cast("string").alias("notes"),
        "o_orderdate",
    )
    landed, _ = booking_ops.submit(
        requests, booking_time=F.col("o_orderdate"), repeatable_guid=True
    )
    path = shared_folder(spark, "submitted")
    write_files(landed, path, "json")
    again = read_files(spark, path, "json", landed.schema)
    # the guid comes from the content: each booking finds its own again
    expected = landed.select("notes", F.col("guid").alias("expected"))
    return again.join(expected, "notes").withColumn("guid_holds", F.col("guid") == F.col("expected")).drop("guid", "expected")


def discover_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables landed in different formats, found again, and the rows that each has."""
    root = shared_folder(spark, "found")
    formats = {"nation": "json", "customer": "parquet", "supplier": "csv", "part": "orc"}
    for name, file_format in formats.items():
        write_files(table(spark, sf_dir, name), f"{root}/{name}", file_format)
    counts = [
        read_files(spark, f"{root}/{r['dataset']}", r["format"]).agg(
            F.lit(r["dataset"]).alias("dataset"), F.lit(r["format"]).alias("format"), F.count(F.lit(1)).alias("rows")
        )
        for r in discover(spark, root).orderBy("dataset").collect()
    ]
    return reduce(DataFrame.unionByName, counts)


