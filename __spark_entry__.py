"""The registered queries and, for each, the same result in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import feeds, sales, stored, targets

if all(getattr(find_spec(name), "origin", None) for name in ("tidemark.llm", "corpus_pipeline")):
    import corpus_pipeline
    from tidemark.llm import queries as corpus
else:  # the subpackage and the pipeline can be taken out; any other import error is raised
    corpus = corpus_pipeline = None

SMALLEST = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Total sales per year with the grand total, from the smallest tables."""
    return sales.total_by_year(spark, SMALLEST)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if corpus is None:
        return table_queries()
    return {**table_queries(), **corpus.queries(), "pipeline": corpus_pipeline.run}


def table_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "calendar_spine": sales.order_calendar,
        "dim_calendar": sales.dim_calendar_spanning,
        "dim_customer": sales.dim_customer,
        "dim_supplier": sales.dim_supplier,
        "dim_part": sales.dim_part,
        "dim_part_split": sales.dim_part_split,
        "dim_part_hashed": sales.dim_part_hashed,
        "fact_sales": sales.fact_sales,
        "fact_events": sales.fact_events,
        "lookup_miss": sales.lookup_miss,
        "lookup_hot_key": sales.lookup_hot_key,
        "metric_total_by_month": sales.total_by_month,
        "metric_total_by_year_gs": sales.total_by_year,
        "metric_distinct_customers_by_year": sales.distinct_customers_by_year,
        "metric_count_by_supplier": sales.lines_by_supplier,
        "metric_avg_by_segment": sales.average_by_segment,
        "metric_filtered": sales.filtered_totals,
        "filter_value_counts": sales.filter_value_counts,
        "scd1": feeds.scd1,
        "scd1_composite": feeds.scd1_composite,
        "scd1_deletes": feeds.scd1_deletes,
        "scd1_truncate": feeds.scd1_truncate,
        "scd1_ignore_nulls": feeds.scd1_ignore_nulls,
        "scd1_ignore_nulls_truncate": feeds.scd1_ignore_nulls_truncate,
        "scd1_columns": feeds.scd1_columns,
        "scd1_except_columns": feeds.scd1_except_columns,
        "scd1_late_batches": feeds.late_batches,
        "scd1_late_batches_ignore_nulls": feeds.late_batches_sparse,
        "scd2": feeds.scd2,
        "scd2_deletes": feeds.scd2_deletes,
        "scd2_tracked": feeds.scd2_tracked,
        "scd2_tracked_split": feeds.scd2_tracked_split,
        "scd2_except_track": feeds.scd2_except_track,
        "scd2_ignore_nulls": feeds.scd2_ignore_nulls,
        "scd2_ignore_nulls_ties": feeds.scd2_ignore_nulls_ties,
        "schema_drift": feeds.schema_drift,
        "upsert_stream": feeds.upsert_stream,
        "history_stream": feeds.history_stream,
        "history_stored": targets.history_stored,
        "upsert_stored": targets.upsert_stored,
        "upsert_stateful": targets.upsert_stateful,
        "stream_expect_drop": targets.stream_expect_drop,
        "stream_rule_counters": targets.stream_rule_counters,
        "stream_expect_fail": targets.stream_expect_fail,
        "ingest_late_column": targets.ingest_late_column,
        "ingest_json_inferred": targets.ingest_json_inferred,
        "snapshot_diff": targets.orders_diff,
        "ingest_json": feeds.ingest_json,
        "ingest_parquet_audit": feeds.ingest_parquet,
        "stream_table_copy": feeds.stream_table_copy,
        "layered_orders": feeds.layered_orders,
        "expect_warn": sales.expect_warn,
        "expect_drop": sales.expect_drop,
        "expect_all_drop": sales.expect_all_drop,
        "expect_all_fail": sales.expect_or_fail,
        "expect_fail_keeps_table": sales.expect_fail_keeps_table,
        "row_filter_view": sales.row_filter_view,
        "private_table": sales.private_table,
        "stored_layout": sales.stored_layout,
        "pending_not_in": sales.pending_not_in,
        "pending_not_in_nulls": sales.pending_not_in_nulls,
        "pending_left_anti": sales.pending_left_anti,
        "confirm": sales.confirm_bookings,
        "submit_valid": sales.submit_bookings,
        "discover": sales.discover_datasets,
        "rental_amounts": sales.rental_amounts,
        "dim_customer_grown": stored.dim_customer_grown,
        "rollup_customers": stored.rollup_customers,
        "rollup_total_by_year": stored.rollup_total_by_year,
        "interleaved_layout": stored.interleaved_layout,
        "catalog_tables": stored.catalog_tables,
        "row_guids": stored.row_guids,
        "discover_all": stored.discover_all,
    }


_ATTRIBUTES = """
    CAST(year(d) AS INTEGER) AS "year", CAST(month(d) AS INTEGER) AS "month",
    CAST(day(d) AS INTEGER) AS "day", CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
    CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(quarter(d) AS INTEGER) AS quarter,
    dayofweek(d) IN (0, 6) AS is_weekend
"""

_CALENDAR = """
    SELECT CAST(g AS DATE) AS d,
           row_number() OVER (ORDER BY g) - 1 AS calendar_id
    FROM generate_series(DATE '1900-01-01', DATE '2100-12-31', INTERVAL 1 DAY) AS s(g)
"""


def _numbered(table: str, key: str, name: str) -> str:
    return f"""SELECT * EXCLUDE ({key}), {key} AS {name}_key,
                      row_number() OVER (ORDER BY {key}) - 1 AS {name}_id FROM {table}"""


_STAR = f"""
    calendar AS ({_CALENDAR}),
    customers AS ({_numbered("customer", "c_custkey", "customer")}),
    suppliers AS ({_numbered("supplier", "s_suppkey", "supplier")}),
    parts AS ({_numbered("part", "p_partkey", "part")}),
    lines AS (
        SELECT l.*, o.o_custkey, o.o_orderstatus, CAST(o.o_orderdate AS DATE) AS order_day,
               CAST(l.l_shipdate AS DATE) AS ship_day
        FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
    )
"""

_METRIC = f"""
    WITH {_STAR},
    star AS (
        SELECT lines.*, c.calendar_id AS calendar_order_id, year(c.d) AS order_year,
               month(c.d) AS order_month, cu.customer_id, cu.c_mktsegment, s.s_name,
               p.p_size > 25 AS is_large, p.p_type = 'ECONOMY' AS is_economy,
               p.p_retailprice > 950 AS is_premium
        FROM lines
        LEFT JOIN calendar c ON c.d = lines.order_day
        LEFT JOIN customers cu ON cu.customer_key = lines.o_custkey
        LEFT JOIN suppliers s ON s.supplier_key = lines.l_suppkey
        LEFT JOIN parts p ON p.part_key = lines.l_partkey
    )
"""

_MONEY = "CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)"

_SPARSE = """
    sparse AS (
        SELECT event_id, ts, user_id, event_type,
               CASE WHEN event_type <> 'view' THEN value END AS value,
               CASE WHEN event_type NOT IN ('click', 'signup') THEN props END AS props
        FROM events
    )
"""

_LATEST = """
    SELECT event_id, ts, user_id, event_type, value, props
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events)
    WHERE rn = 1
"""

_LATEST_SPARSE = f"""
    WITH {_SPARSE},
    cleared AS (
        SELECT user_id, max(ts) FILTER (event_type = 'error') AS deleted, max(ts) AS last
        FROM sparse GROUP BY user_id
    ),
    alive AS (
        SELECT s.* FROM sparse s JOIN cleared c USING (user_id)
        WHERE c.deleted IS NULL OR s.ts > c.deleted
    )
    SELECT arg_max(event_id, ts) AS event_id, max(ts) AS ts, user_id,
           arg_max(event_type, ts) AS event_type,
           arg_max(value, ts) FILTER (value IS NOT NULL) AS value,
           arg_max(props, ts) FILTER (props IS NOT NULL) AS props
    FROM alive GROUP BY user_id
"""

_TRACKED = """
    WITH marked AS (
        SELECT *, CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type
                       THEN 1 ELSE 0 END AS starts
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
    ),
    segments AS (
        SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts) AS segment FROM marked
    ),
    versions AS (
        SELECT user_id, segment, min(ts) AS valid_from, arg_max(event_id, ts) AS event_id,
               max(ts) AS ts, arg_max(event_type, ts) AS event_type,
               arg_max(value, ts) AS value, arg_max(props, ts) AS props
        FROM segments GROUP BY user_id, segment
    ),
    closed AS (
        SELECT *, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) AS valid_to
        FROM versions
    )
    SELECT event_id, ts, user_id, event_type, value, props, valid_from, valid_to FROM closed
"""

_HISTORY = """
    SELECT event_id, ts, user_id, event_type, value, props, ts AS valid_from,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
    FROM events
"""

_BOOKINGS = """
    bookings AS (
        SELECT CASE WHEN o_orderpriority <> '1-URGENT'
                    THEN CAST(o_orderkey AS VARCHAR) END AS guid,
               'Customer ' || o_custkey AS name, 'c' || o_custkey || '@example.com' AS email,
               CAST(o_orderdate AS DATE) AS from_date,
               CAST(o_orderdate AS DATE) + 3 AS to_date, o_orderpriority AS notes
        FROM orders
    )
"""

_LINE_RULES = {
    "some quantity": "l_quantity >= 5",
    "small discount": "l_discount <= 0.08",
    "shipped": "l_linestatus = 'F'",
}


_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
_LANDED = {"nation": "json", "customer": "parquet", "supplier": "csv", "part": "orc"}


def oracle_sql() -> dict[str, str]:
    return {**table_sql(), **(corpus.oracle_sql() if corpus else {})}


def table_sql() -> dict[str, str]:
    return {
        "calendar_spine": f"""
            WITH span AS (
                SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi
                FROM orders
            ),
            days AS (
                SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span
            ),
            counted AS (
                SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1
            )
            SELECT d AS date, {_ATTRIBUTES}, coalesce(n, 0) AS orders
            FROM days LEFT JOIN counted USING (d)
        """,
        "dim_calendar": f"""
            WITH span AS (
                SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi
                FROM lineitem
            ),
            days AS (
                SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span
            )
            SELECT d AS date, {_ATTRIBUTES}, d AS calendar_key,
                   row_number() OVER (ORDER BY d) - 1 AS calendar_id
            FROM days
        """,
        "dim_customer": _numbered("customer", "c_custkey", "customer"),
        "dim_supplier": _numbered("supplier", "s_suppkey", "supplier"),
        "dim_part": _numbered("part", "p_partkey", "part"),
        "dim_part_split": _numbered("part", "p_partkey", "part"),
        "dim_part_hashed": """
            SELECT p_brand, count(*) AS parts, count(DISTINCT p_partkey) AS ids
            FROM part GROUP BY p_brand
        """,
        "fact_sales": f"""
            WITH {_STAR}
            SELECT lines.l_orderkey AS order_id, part_id, supplier_id, c2.calendar_id AS calendar_ship_id,
                   customer_id, c1.calendar_id AS calendar_order_id, l_linenumber, l_quantity,
                   l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, o_orderstatus
            FROM lines
            LEFT JOIN calendar c1 ON c1.d = order_day
            LEFT JOIN calendar c2 ON c2.d = ship_day
            LEFT JOIN customers ON customer_key = o_custkey
            LEFT JOIN suppliers ON supplier_key = l_suppkey
            LEFT JOIN parts ON part_key = l_partkey
        """,
        "fact_events": f"""
            WITH calendar AS ({_CALENDAR})
            SELECT event_id, user_id, calendar_id AS calendar_event_id, event_type, value, props
            FROM events LEFT JOIN calendar ON d = CAST(ts AS DATE)
        """,
        "lookup_miss": """
            SELECT o_orderstatus, count(*) AS orders, count(c_custkey) AS found
            FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING')
                 ON o_custkey = c_custkey
            GROUP BY o_orderstatus
        """,
        "lookup_hot_key": f"""
            WITH customers AS ({_numbered("customer", "c_custkey", "customer")}),
            keyed AS (
                SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 7
                            WHEN o_orderpriority = '5-LOW' THEN NULL
                            WHEN o_orderstatus = 'O' THEN 11 ELSE o_custkey END AS k
                FROM orders
            )
            SELECT o_orderkey, customer_id FROM keyed LEFT JOIN customers ON k = customer_key
        """,
        "metric_total_by_month": f"""
            {_METRIC} SELECT CAST(order_month AS INTEGER) AS "Order_Month", {_MONEY} AS "Total_Cost"
            FROM star GROUP BY order_month
        """,
        "metric_total_by_year_gs": f"""
            {_METRIC} SELECT CAST(order_year AS INTEGER) AS "Order_Year", {_MONEY} AS "Total_Cost",
                   CAST(grouping(order_year) AS INTEGER) AS "Order_Year_is_total"
            FROM star GROUP BY GROUPING SETS ((order_year), ())
        """,
        "metric_distinct_customers_by_year": f"""
            {_METRIC} SELECT CAST(order_year AS INTEGER) AS "Order_Year",
                   count(DISTINCT customer_id) AS "Customers"
            FROM star GROUP BY order_year
        """,
        "metric_count_by_supplier": f"""
            {_METRIC} SELECT s_name AS "Supplier_Name", count(calendar_order_id) AS "Total_Lines"
            FROM star GROUP BY s_name
        """,
        "metric_avg_by_segment": f"""
            {_METRIC} SELECT c_mktsegment AS "Customer_Segment", l_returnflag AS "Return_Flag",
                   round(avg(l_quantity), 6) AS "Average_Quantity",
                   CAST(grouping(c_mktsegment) AS INTEGER) AS "Customer_Segment_is_total",
                   CAST(grouping(l_returnflag) AS INTEGER) AS "Return_Flag_is_total"
            FROM star
            GROUP BY GROUPING SETS ((c_mktsegment, l_returnflag), (c_mktsegment), ())
        """,
        "metric_filtered": f"""
            {_METRIC} SELECT CAST(order_year AS INTEGER) AS "Order_Year", {_MONEY} AS "Total_Cost",
                   count(calendar_order_id) AS "Total_Lines"
            FROM star WHERE is_large AND NOT is_economy AND order_month IN (1, 2, 3)
            GROUP BY order_year
        """,
        "filter_value_counts": f"""
            {_METRIC}
            SELECT 'Part_Is_Large' AS "filter", is_large AS "value",
                   count(*) FILTER (is_economy AND NOT is_premium) AS lines
            FROM star GROUP BY is_large
            UNION ALL
            SELECT 'Part_Is_Economy', is_economy, count(*) FILTER (is_large AND NOT is_premium)
            FROM star GROUP BY is_economy
            UNION ALL
            SELECT 'Part_Is_Premium', is_premium, count(*) FILTER (is_large AND is_economy)
            FROM star GROUP BY is_premium
        """,
        "scd1": _LATEST,
        "scd1_composite": """
            SELECT event_id, ts, user_id, event_type, value, props
            FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                               ORDER BY ts DESC) AS rn FROM events)
            WHERE rn = 1
        """,
        "scd1_deletes": f"SELECT * FROM ({_LATEST}) WHERE event_type <> 'error'",
        "scd1_truncate": f"""
            SELECT * FROM ({_LATEST.replace("FROM events", "FROM events WHERE value <= 300")})
            WHERE event_type <> 'error'
              AND ts > coalesce((SELECT max(ts) FROM events WHERE value > 300), TIMESTAMP '1900-01-01')
        """,
        "scd1_ignore_nulls": _LATEST_SPARSE,
        "scd1_ignore_nulls_truncate": f"""
            WITH {_SPARSE},
            alive AS (
                SELECT * FROM sparse WHERE ts > coalesce(
                    (SELECT max(ts) FROM sparse WHERE value > 300), TIMESTAMP '1900-01-01')
            )
            SELECT arg_max(event_id, ts) AS event_id, max(ts) AS ts, user_id,
                   arg_max(event_type, ts) AS event_type,
                   arg_max(value, ts) FILTER (value IS NOT NULL) AS value,
                   arg_max(props, ts) FILTER (props IS NOT NULL) AS props
            FROM alive GROUP BY user_id
        """,
        "scd1_columns": f"SELECT user_id, event_type, value FROM ({_LATEST})",
        "scd1_except_columns": f"SELECT ts, user_id, event_type, value FROM ({_LATEST})",
        "scd1_late_batches": f"SELECT * FROM ({_LATEST}) WHERE event_type <> 'error'",
        "scd1_late_batches_ignore_nulls": _LATEST_SPARSE,
        "scd2": _HISTORY,
        "scd2_deletes": f"SELECT * FROM ({_HISTORY}) WHERE event_type <> 'error'",
        "scd2_tracked": f"SELECT * FROM ({_TRACKED}) WHERE event_type <> 'error'",
        "scd2_tracked_split": f"SELECT * FROM ({_TRACKED}) WHERE event_type <> 'error'",
        "scd2_except_track": _TRACKED,
        "scd2_ignore_nulls": f"""
            WITH {_SPARSE},
            lives AS (
                SELECT *, count(*) FILTER (event_type = 'error')
                              OVER (PARTITION BY user_id ORDER BY ts) AS life
                FROM sparse
            ),
            filled AS (
                SELECT event_id, ts, user_id, event_type,
                       last_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS)
                           OVER w AS value,
                       last_value(CASE WHEN event_type <> 'error' THEN props END IGNORE NULLS)
                           OVER w AS props
                FROM lives WINDOW w AS (PARTITION BY user_id, life ORDER BY ts
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            )
            SELECT * FROM (
                SELECT *, ts AS valid_from,
                       lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
                FROM filled)
            WHERE event_type <> 'error'
        """,
        "scd2_ignore_nulls_ties": """
            WITH numbered AS (
                SELECT *, CAST(ts AS DATE) AS d,
                       row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                                          ORDER BY event_id) AS nth
                FROM events
            ),
            days AS (
                SELECT user_id, d, max(event_type) FILTER (nth = 1) AS event_type,
                       max(value) FILTER (nth = 2) AS value, max(props) FILTER (nth = 3) AS props
                FROM numbered GROUP BY user_id, d
            )
            SELECT user_id, d AS ts, last_value(event_type IGNORE NULLS) OVER w AS event_type,
                   last_value(value IGNORE NULLS) OVER w AS value,
                   last_value(props IGNORE NULLS) OVER w AS props, d AS valid_from,
                   lead(d) OVER (PARTITION BY user_id ORDER BY d) AS valid_to
            FROM days WINDOW w AS (PARTITION BY user_id ORDER BY d
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        """,
        "schema_drift": """
            SELECT o_orderkey, o_custkey, o_totalprice,
                   CASE WHEN late THEN o_orderstatus END AS o_orderstatus,
                   CASE WHEN late THEN o_orderdate END AS o_orderdate,
                   CASE WHEN late THEN o_orderpriority END AS o_orderpriority
            FROM (SELECT *, o_orderdate >= TIMESTAMP '1998-01-01' AS late FROM orders)
        """,
        "upsert_stream": _LATEST,
        "history_stream": f"SELECT * FROM ({_HISTORY}) WHERE event_type <> 'error'",
        "history_stored": f"SELECT * FROM ({_HISTORY}) WHERE event_type <> 'error'",
        "upsert_stored": _LATEST,
        "upsert_stateful": f"SELECT * FROM ({_LATEST}) WHERE event_type <> 'error'",
        "stream_expect_drop": "SELECT * FROM lineitem WHERE l_discount <= 0.08",
        "stream_rule_counters": """
            SELECT 'small discount' AS rule, 'expect_or_drop' AS action, count(*) AS rows,
                   count(*) FILTER (WHERE l_discount > 0.08) AS violations, 3 AS batches FROM lineitem
            UNION ALL
            SELECT 'few', 'expect', count(*), count(*) FILTER (WHERE l_quantity >= 45), 3 FROM lineitem
        """,
        "stream_expect_fail": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
        "ingest_late_column": """
            SELECT o_orderkey, o_custkey, o_totalprice,
                   CASE WHEN late THEN o_orderstatus END AS o_orderstatus,
                   CASE WHEN late THEN o_orderdate END AS o_orderdate,
                   CASE WHEN late THEN o_orderpriority END AS o_orderpriority
            FROM (SELECT *, o_orderdate >= TIMESTAMP '1998-01-01' AS late FROM orders)
        """,
        "ingest_json_inferred": """
            SELECT event_id, user_id, CASE WHEN event_type <> 'click' THEN event_type END AS event_type,
                   CASE WHEN event_type <> 'click' THEN value END AS value FROM events
        """,
        "snapshot_diff": """
            SELECT o_orderkey, o_custkey, o_orderstatus,
                   CASE o_orderkey % 100 WHEN 3 THEN o_totalprice + 1 WHEN 4 THEN NULL ELSE o_totalprice END AS o_totalprice,
                   o_orderdate, o_orderpriority,
                   CASE o_orderkey % 100 WHEN 1 THEN 'insert' WHEN 2 THEN 'delete' ELSE 'update' END AS change
            FROM orders WHERE o_orderkey % 100 BETWEEN 1 AND 4
        """,
        "ingest_json": """
            SELECT event_id, user_id, event_type, value, props, 'events' AS source_system
            FROM events
        """,
        "ingest_parquet_audit": """
            SELECT *, 'orders' AS source_system, TRUE AS has_ingest_time FROM orders
        """,
        "stream_table_copy": "SELECT *, 'sales' AS source_system FROM customer",
        "layered_orders": """
            SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
                   CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
                   count(c_custkey) AS orders_with_customer
            FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1
        """,
        "expect_warn": " UNION ALL ".join(
            f"""SELECT '{name}' AS rule, 'expect' AS action, count(*) AS rows,
                       count(*) FILTER (NOT coalesce({rule}, FALSE)) AS violations FROM lineitem"""
            for name, rule in _LINE_RULES.items()
        ),
        "expect_drop": "SELECT * FROM lineitem WHERE l_discount <= 0.08",
        "expect_all_drop": f"SELECT * FROM lineitem WHERE {' AND '.join(_LINE_RULES.values())}",
        "expect_all_fail": "SELECT * FROM lineitem",
        "expect_fail_keeps_table": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
        "row_filter_view": """
            SELECT * FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 100000
        """,
        "private_table": """
            SELECT o_orderpriority, count(*) AS orders FROM orders WHERE o_totalprice > 250000
            GROUP BY o_orderpriority
        """,
        "stored_layout": """
            SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS order_year,
                   count(*) AS orders,
                   CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
            FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2
        """,
        "pending_not_in": f"""
            WITH {_BOOKINGS}
            SELECT * FROM bookings WHERE guid NOT IN (
                SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F')
        """,
        "pending_not_in_nulls": f"""
            WITH {_BOOKINGS}
            SELECT * FROM bookings WHERE guid NOT IN (
                SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderkey AS VARCHAR) END
                FROM orders WHERE o_orderstatus = 'F')
        """,
        "pending_left_anti": f"""
            WITH {_BOOKINGS}
            SELECT * FROM bookings b WHERE NOT EXISTS (
                SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'
                                       AND CAST(o_orderkey AS VARCHAR) = b.guid)
        """,
        "confirm": f"""
            WITH {_BOOKINGS}
            SELECT *, TRUE AS is_confirmed FROM bookings b WHERE EXISTS (
                SELECT 1 FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW'
                                       AND CAST(o_orderkey AS VARCHAR) = b.guid)
        """,
        "submit_valid": """
            SELECT 'Customer ' || o_custkey AS name, 'c' || o_custkey AS email,
                   strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS from_date,
                   strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 - 2 AS INTEGER),
                            '%Y-%m-%d') AS to_date,
                   strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS booking_time,
                   CAST(o_orderkey AS VARCHAR) AS notes, TRUE AS guid_holds
            FROM orders
            WHERE o_orderstatus <> 'P' AND o_orderpriority <> '2-HIGH' AND o_orderkey % 9 >= 2
        """,
        "discover": " UNION ALL ".join(
            f"SELECT '{name}' AS dataset, '{kind}' AS format, count(*) AS rows FROM {name}"
            for name, kind in _LANDED.items()
        ),
        "dim_customer_grown": """
            SELECT * EXCLUDE (c_custkey), c_custkey AS customer_key,
                   CASE WHEN c_custkey % 3 <> 1 THEN 0
                        ELSE (SELECT count(*) FROM customer WHERE c_custkey % 3 <> 1) END
                   + row_number() OVER (PARTITION BY c_custkey % 3 <> 1 ORDER BY c_custkey) - 1 AS customer_id
            FROM customer
        """,
        "rollup_customers": f"""
            {_METRIC} SELECT CAST(order_year AS INTEGER) AS "Order_Year", CAST(order_month AS INTEGER) AS "Order_Month",
                   {_MONEY} AS "Total_Cost", round(avg(l_quantity), 6) AS "Average_Quantity",
                   count(DISTINCT o_custkey) AS "Customers",
                   CAST(grouping(order_year) AS INTEGER) AS "Order_Year_is_total",
                   CAST(grouping(order_month) AS INTEGER) AS "Order_Month_is_total"
            FROM star GROUP BY GROUPING SETS ((order_year, order_month), (order_year), ())
        """,
        "rollup_total_by_year": f"""
            {_METRIC} SELECT CAST(order_year AS INTEGER) AS "Order_Year", {_MONEY} AS "Total_Cost",
                   CAST(grouping(order_year) AS INTEGER) AS "Order_Year_is_total"
            FROM star GROUP BY GROUPING SETS ((order_year), ())
        """,
        "interleaved_layout": """
            SELECT *, 'date' AS read_by FROM orders WHERE o_orderdate >= '1995-01-01' AND o_orderdate < '1995-07-01'
            UNION ALL SELECT *, 'customer' FROM orders WHERE o_custkey BETWEEN 20 AND 60
        """,
        "catalog_tables": " UNION ALL ".join(
            f"""SELECT '{name}' AS table_name, 'EXTERNAL' AS table_type, count(*) AS rows, TRUE AS under_settings,
                       1 AS audit_columns, TRUE AS "exists", FALSE AS other_exists, TRUE AS settings_restored
                FROM {name}"""
            for name in ("customer", "orders")
        ),
        "row_guids": """
            SELECT event_type, count(*) AS events, count(*) AS guids, count(*) AS well_formed
            FROM events GROUP BY event_type
        """,
        "discover_all": " UNION ALL ".join(
            f"SELECT '{name}' AS dataset, 'parquet' AS format, count(*) AS rows FROM {name}" for name in _TABLES
        ),
        "rental_amounts": """
            WITH priced AS (
                SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS total,
                       CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
                                  * CAST(0.125 AS DECIMAL(4,3)), 2) AS DECIMAL(18,2)) AS tax
                FROM lineitem
            )
            SELECT l_orderkey, l_linenumber,
                   CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS check_out_date,
                   CAST(tax AS DOUBLE) AS tax_amount,
                   CAST(total + tax AS DOUBLE) AS total_cost_with_tax,
                   'TXN-' || strftime(l_shipdate, '%Y%m%d') || '-'
                       || CASE WHEN length(CAST(l_orderkey AS VARCHAR)) < 5
                               THEN lpad(CAST(l_orderkey AS VARCHAR), 5, '0')
                               ELSE CAST(l_orderkey AS VARCHAR) END AS transaction_id
            FROM priced
        """,
    }
