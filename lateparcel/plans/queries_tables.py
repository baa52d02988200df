"""Sources, projections, filters, joins, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lateparcel import functions as X
from lateparcel.operators import clean, join
from lateparcel.operators.profile import describe_numbers
from lateparcel.plans.flagship import late_deliveries_by_state
from lateparcel.plans.registry import QUERIES, ORACLES, query, rounded, text_sql, with_base
from lateparcel.session import scratch_path
from lateparcel.sources import (
    SCHEMAS,
    TableRegistry,
    pass_through,
    preview,
    read_csv,
    table_profile,
    write_csv,
)

ORDER_COLUMNS = (
    "order_id, customer_id, order_status, "
    + text_sql("order_purchase_timestamp") + ", "
    + text_sql("order_approved_at") + ", "
    + text_sql("order_delivered_timestamp") + ", "
    + text_sql("order_estimated_delivery_date")
)
CLEAN_COLUMNS = (
    ORDER_COLUMNS + ", delivery_delay, delivery_time, order_year_month, order_year, order_month"
)
FULL_COLUMNS = CLEAN_COLUMNS + ", customer_zip_code_prefix, customer_city, customer_state"
INPUT_COLUMNS = (
    "customer_id, customer_city, customer_state, customer_zip_code_prefix, delivery_delay,"
    " delivery_time, order_year_month, order_year, order_month, order_status, "
    + text_sql("order_purchase_timestamp")
)

QUERIES["flagship_late_by_state"] = late_deliveries_by_state
ORACLES["flagship_late_by_state"] = with_base("""
SELECT customer_state, count(customer_id) AS customer_id_count,
       CAST(round_even(CAST(avg(delivery_delay) AS DECIMAL(18, 9)), 2) AS DOUBLE) AS delivery_delay_mean,
       CAST(round_even(CAST(median(delivery_delay) AS DECIMAL(18, 9)), 2) AS DOUBLE) AS delivery_delay_median,
       CAST(round_even(CAST(stddev_samp(delivery_delay) AS DECIMAL(18, 9)), 2) AS DOUBLE) AS delivery_delay_std,
       round_even(CAST(count(*) FILTER (delivery_delay > 0) AS DOUBLE) / count(*), 4) AS late_share
FROM full_orders WHERE customer_state IS NOT NULL GROUP BY customer_state
""")


# --- sources and sinks -------------------------------------------------------------------


@query("s1_csv_scan", with_base("""
SELECT CAST(customer_id AS VARCHAR) AS customer_id, customer_zip_code_prefix, customer_city,
       customer_state FROM raw_customers"""))
def _(t):
    path = write_csv(t.customers, scratch_path(t.spark, "customers-csv"))
    return read_csv(t.spark, path, SCHEMAS["customers"])


@query("s2_table_sink", with_base("""
SELECT order_year_month, count(*) AS orders, CAST(sum(delivery_time) AS BIGINT) AS days
FROM orders_clean GROUP BY order_year_month"""))
def _(t):
    registry = TableRegistry(t.spark, scratch_path(t.spark, "tables"))
    saved = registry.save("orders_clean", t.orders_clean, ("order_year_month",))
    return saved.groupBy("order_year_month").agg(
        F.count("*").alias("orders"), F.sum("delivery_time").alias("days")
    )


_DESCRIBE_SQL = """
SELECT '{0}' AS "column", count({0}) AS count, round(avg({0}), 6) AS mean,
       round(stddev_samp({0}), 6) AS std, round(CAST(min({0}) AS DOUBLE), 6) AS min,
       round(quantile_cont(CAST({0} AS DOUBLE), 0.25), 6) AS p25,
       round(quantile_cont(CAST({0} AS DOUBLE), 0.5), 6) AS p50,
       round(quantile_cont(CAST({0} AS DOUBLE), 0.75), 6) AS p75,
       round(CAST(max({0}) AS DOUBLE), 6) AS max FROM {1}"""


@query("s3_labelled_sink", with_base(
    _DESCRIBE_SQL.format("price", "raw_items") + " UNION ALL "
    + _DESCRIBE_SQL.format("shipping_charges", "raw_items")))
def _(t):
    described = describe_numbers(t.items, ["price", "shipping_charges"])
    path = write_csv(described, scratch_path(t.spark, "describe-csv"))
    return rounded(read_csv(t.spark, path, described.schema))


@query("s4_order_items", with_base("""
SELECT order_id, product_id, seller_id, price, round(shipping_charges, 6) AS shipping_charges
FROM raw_items"""))
def _(t):
    return pass_through(t.items).withColumn(
        "shipping_charges", F.round("shipping_charges", 6)
    )


@query("s5_registry", with_base("""
SELECT customer_state, count(*) AS orders FROM raw_orders o
JOIN raw_customers c ON o.customer_id = c.customer_id GROUP BY customer_state"""))
def _(t):
    registry = TableRegistry(t.spark, t.folder)
    registry.register_views({"raw_customers": t.customers, "raw_orders": t.orders})
    return t.spark.sql(
        "SELECT customer_state, count(*) AS orders FROM raw_orders"
        " JOIN raw_customers USING (customer_id) GROUP BY customer_state"
    )


@query("s8_preview", with_base(f"""
SELECT {ORDER_COLUMNS} FROM raw_orders ORDER BY order_id LIMIT 5"""))
def _(t):
    return preview(t.orders, ["order_id"])


@query("s9_table_profile", with_base(" UNION ALL ".join(
    f"""SELECT {i} AS position, '{n}' AS "column", '{d}' AS dtype, count({n}) AS non_null,
    count(*) AS rows FROM raw_orders"""
    for i, (n, d) in enumerate([
        ("order_id", "bigint"), ("customer_id", "bigint"), ("order_status", "string"),
        ("order_purchase_timestamp", "timestamp_ntz"), ("order_approved_at", "timestamp_ntz"),
        ("order_delivered_timestamp", "timestamp_ntz"),
        ("order_estimated_delivery_date", "timestamp_ntz")]))))
def _(t):
    return table_profile(t.orders)


# --- projections and filters -------------------------------------------------------------


@query("p1_model_input", with_base(f"SELECT {INPUT_COLUMNS} FROM full_orders"))
def _(t):
    return clean.model_input(t.full_orders)


@query("p2_narrow", with_base("SELECT customer_id, customer_city, customer_state FROM raw_customers"))
def _(t):
    return t.customers.select("customer_id", "customer_city", "customer_state")


@query("p3_drop_if_present", with_base("""
SELECT customer_id, customer_zip_code_prefix, customer_state FROM raw_customers"""))
def _(t):
    return clean.drop_if_present(t.customers, ["customer_city", "not_there"])


@query("p4_select_numbers", with_base("""
SELECT order_id, customer_id, delivery_delay, delivery_time, order_year, order_month
FROM orders_clean"""))
def _(t):
    return clean.select_kind(t.orders_clean, "number")


@query("p5_only_delivered", with_base(f"""
SELECT {ORDER_COLUMNS} FROM raw_orders WHERE order_status = 'delivered'"""))
def _(t):
    return clean.only_delivered(t.orders)


@query("p6_without_canceled", with_base("""
SELECT order_id, nullif(order_status, 'shipped') AS order_status FROM raw_orders
WHERE nullif(order_status, 'shipped') IS DISTINCT FROM 'canceled'"""))
def _(t):
    gaps = t.orders.select("order_id", F.nullif("order_status", F.lit("shipped")).alias("order_status"))
    return clean.without_canceled(gaps)


@query("p7_drop_null_rows", with_base("""
SELECT order_id, delivery_delay, delivery_time FROM orders_clean
WHERE delivery_delay IS NOT NULL AND delivery_time IS NOT NULL"""))
def _(t):
    return clean.drop_null_rows(t.orders_clean, ["delivery_delay", "delivery_time"]).select(
        "order_id", "delivery_delay", "delivery_time"
    )


@query("p8_fill_nulls", with_base("""
SELECT order_id, coalesce(delivery_delay, 0) AS delivery_delay,
       coalesce(nullif(order_status, 'shipped'), 'unknown') AS order_status FROM orders_clean"""))
def _(t):
    gaps = t.orders_clean.select(
        "order_id", "delivery_delay",
        F.nullif("order_status", F.lit("shipped")).alias("order_status"),
    )
    return clean.fill_nulls(gaps, {"delivery_delay": 0, "order_status": "unknown"})


@query("p9_bools_to_int", with_base("""
SELECT order_id, CAST(order_status = 'delivered' AS INTEGER) AS arrived,
       CAST(delivery_delay IS NULL AS INTEGER) AS open FROM orders_clean"""))
def _(t):
    flags = t.orders_clean.select(
        "order_id",
        (F.col("order_status") == "delivered").alias("arrived"),
        F.col("delivery_delay").isNull().alias("open"),
    )
    return clean.bools_to_int(flags)


@query("p10_rename", with_base("""
SELECT customer_id, customer_city AS city, customer_state AS state,
       customer_zip_code_prefix AS zip FROM raw_customers"""))
def _(t):
    return clean.rename_columns(
        t.customers,
        {"customer_city": "city", "customer_state": "state", "customer_zip_code_prefix": "zip"},
    )


@query("p12_derived_columns", with_base(f"SELECT {CLEAN_COLUMNS} FROM orders_clean"))
def _(t):
    return t.orders_clean


# --- joins -------------------------------------------------------------------------------


@query("j1_orders_customers", with_base(f"SELECT {FULL_COLUMNS} FROM full_orders"))
def _(t):
    return join.orders_with_customers(t.orders_clean, t.customers)


_TOTALS_SQL = """totals AS (
  SELECT order_id, coalesce(sum(price + shipping_charges), 0) AS order_total_value
  FROM raw_items GROUP BY order_id)"""


@query("j2_order_total", with_base("""
SELECT o.order_id, o.order_status, round(order_total_value, 4) AS order_total_value
FROM raw_orders o LEFT JOIN totals s ON o.order_id = s.order_id""", _TOTALS_SQL))
def _(t):
    joined = join.with_order_total(t.orders, t.items)
    return rounded(joined.select("order_id", "order_status", "order_total_value"), 4)


@query("j3_item_grain", with_base("""
SELECT o.order_id, o.customer_id, c.customer_state, i.product_id, i.seller_id, i.price,
       round(i.shipping_charges, 4) AS shipping_charges,
       round(s.order_total_value, 4) AS order_total_value
FROM raw_orders o JOIN totals s ON o.order_id = s.order_id
JOIN raw_customers c ON o.customer_id = c.customer_id
JOIN raw_items i ON o.order_id = i.order_id""", _TOTALS_SQL))
def _(t):
    orders = join.with_order_total(t.orders, t.items).select(
        "order_id", "customer_id", "order_total_value"
    )
    customers = t.customers.select("customer_id", "customer_state")
    full = join.at_item_grain(join.orders_with_customers(orders, customers), t.items)
    return rounded(full, 4)


@query("j4_loyalty_target", with_base("""
SELECT order_id, customer_id, customer_state,
       CAST(count(order_id) OVER (PARTITION BY customer_id) > 1 AS INTEGER) AS loyal_customer
FROM full_orders WHERE customer_id IS NOT NULL"""))
def _(t):
    return join.add_loyalty_target(t.full_orders, t.orders).select(
        "order_id", "customer_id", "customer_state", "loyal_customer"
    )


@query("j5_column_concat", with_base("""
SELECT customer_id, customer_state, customer_city, lower(customer_city) AS city_lower,
       length(customer_state) AS state_length FROM raw_customers"""))
def _(t):
    extra = {"city_lower": F.lower("customer_city"), "state_length": F.length("customer_state")}
    return t.customers.select("customer_id", "customer_state", "customer_city").withColumns(extra)


@query("j6_align_columns", with_base("""
SELECT customer_state, 0 AS delivery_delay, customer_id FROM raw_customers"""))
def _(t):
    return join.align_columns(t.customers, ["customer_state", "delivery_delay", "customer_id"])


# --- set operations ----------------------------------------------------------------------


@query("u1_first_per_key", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) AS place
  FROM lineitem) WHERE place = 1""")
def _(t):
    lines = t.raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"
    )
    return clean.first_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"]).drop(
        "l_shipdate"
    )


@query("u2_distinct_rows", """
SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem""")
def _(t):
    return clean.distinct_rows(
        t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    )


@query("u3_row_union", with_base("""
SELECT order_id, target, delivery_delay FROM delays"""))
def _(t):
    frame = t.delays.select("order_id", "target", "delivery_delay")
    return frame.where("target = 0").unionByName(frame.where("target = 1"))


# --- scalar functions --------------------------------------------------------------------


@query("f1_text_to_timestamp", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS strict,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS lenient
FROM events""")
def _(t):
    text = F.col("ts").cast("string")
    spoiled = F.when(F.col("event_type") == "error", F.concat(F.lit("x"), text)).otherwise(text)
    return t.raw("events").select(
        "event_id",
        X.strict_timestamp(text).alias("strict"),
        X.lenient_timestamp(spoiled).alias("lenient"),
    )


@query("f2_floored_days", """
SELECT event_id, CAST(floor(epoch(ts - TIMESTAMP '2024-01-10 12:00:00.5') / 86400) AS BIGINT) AS days
FROM events""")
def _(t):
    noon = F.lit("2024-01-10 12:00:00.5").cast("timestamp_ntz")
    return t.raw("events").select("event_id", X.floored_days("ts", noon).alias("days"))


@query("f3_year_month", "SELECT event_id, strftime(ts, '%Y-%m') AS year_month FROM events")
def _(t):
    return t.raw("events").select("event_id", X.year_month("ts").alias("year_month"))


@query("f4_year_and_month", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year,
       CAST(month(o_orderdate) AS INTEGER) AS order_month FROM orders""")
def _(t):
    return t.raw("orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("order_year"),
        F.month("o_orderdate").alias("order_month"),
    )


@query("f5_clean_text", with_base("""
SELECT customer_id, coalesce(lower(nullif(customer_city, 'MACHINERY')), 'desconocido') AS city,
       coalesce(upper(nullif(customer_state, 'NATION_3')), 'DESCONOCIDO') AS state
FROM raw_customers"""))
def _(t):
    city = F.concat(F.lit(" \t"), F.nullif("customer_city", F.lit("MACHINERY")), F.lit("\n "))
    state = F.concat(F.lit(" "), F.nullif("customer_state", F.lit("NATION_3")), F.lit("\t"))
    return t.customers.select(
        "customer_id", X.clean_city(city).alias("city"), X.clean_state(state).alias("state")
    )


@query("f6_lenient_number", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS number FROM events""")
def _(t):
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(
        F.col("value").cast("string")
    )
    return t.raw("events").select("event_id", X.lenient_number(text).alias("number"))


@query("f7_late_flag", with_base("""
SELECT order_id, delivery_delay,
       CASE WHEN delivery_delay > 0 THEN 1 ELSE 0 END AS late FROM orders_clean"""))
def _(t):
    return t.orders_clean.select(
        "order_id", "delivery_delay", X.late_flag("delivery_delay").alias("late")
    )


@query("f8_given_target", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 ELSE 0 END AS target
FROM orders""")
def _(t):
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "1")
        .when(F.col("o_orderpriority") == "5-LOW", "not known")
        .when(F.col("o_orderpriority") == "2-HIGH", "0")
    )
    return clean.with_late_target(t.raw("orders").select("o_orderkey", text.alias("target")))


@query("f9_repeat_flag", with_base("""
SELECT customer_id, CAST(count(order_id) > 1 AS INTEGER) AS loyal
FROM raw_orders WHERE customer_id IS NOT NULL GROUP BY customer_id"""))
def _(t):
    counted = join.orders_per_customer(t.orders)
    return counted.select("customer_id", X.repeat_flag("orders").alias("loyal"))


@query("f10_winsorise", with_base("""
SELECT order_id, product_id, round(CASE WHEN price > (SELECT quantile_cont(price, 0.99) FROM raw_items)
         THEN (SELECT quantile_cont(price, 0.99) FROM raw_items) ELSE price END, 6) AS price,
       round(CASE WHEN shipping_charges > (SELECT quantile_cont(shipping_charges, 0.99) FROM raw_items)
         THEN (SELECT quantile_cont(shipping_charges, 0.99) FROM raw_items)
         ELSE shipping_charges END, 6) AS shipping_charges
FROM raw_items"""))
def _(t):
    capped = clean.winsorise(t.items, ["price", "shipping_charges"])
    return rounded(capped.drop("seller_id"))


@query("f11_item_value", with_base("""
SELECT order_id, product_id, round(price + shipping_charges, 4) AS total_item_value
FROM raw_items"""))
def _(t):
    valued = clean.with_item_value(t.items)
    return rounded(valued.select("order_id", "product_id", "total_item_value"), 4)


@query("f12_half_even", """
SELECT l_orderkey, l_linenumber, round_even(l_quantity / 8, 2) AS eighths,
       round_even(l_quantity / 2, 0) AS halves FROM lineitem""")
def _(t):
    return t.raw("lineitem").select(
        "l_orderkey", "l_linenumber",
        X.half_even(F.col("l_quantity") / 8, 2).alias("eighths"),
        X.half_even(F.col("l_quantity") / 2, 0).alias("halves"),
    )


@query("f13_formatted_text", """
SELECT l_returnflag, printf('%.4f ± %.4f', round_even(avg(l_quantity), 4),
       round_even(stddev_pop(l_quantity), 4)) AS cv_scores,
       printf('F1: %.4f', round_even(avg(l_discount), 4)) AS primary_metric
FROM lineitem GROUP BY l_returnflag""")
def _(t):
    stats = t.raw("lineitem").groupBy("l_returnflag").agg(
        F.avg("l_quantity").alias("m"), F.stddev_pop("l_quantity").alias("s"),
        F.avg("l_discount").alias("d"),
    )
    return stats.select(
        "l_returnflag",
        X.mean_pm_std("m", "s").alias("cv_scores"),
        F.format_string("F1: %.4f", X.half_even("d", 4)).alias("primary_metric"),
    )


@query("f14_sqrt_abs", """
SELECT c_custkey, abs(c_acctbal) AS size, round(sqrt(abs(c_acctbal)), 6) AS root FROM customer""")
def _(t):
    size = F.abs("c_acctbal")
    return t.raw("customer").select(
        "c_custkey", size.alias("size"), F.round(F.sqrt(size), 6).alias("root")
    )


@query("f15_gaps", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_tax <> 0 THEN round(abs(l_discount - l_tax) / (abs(l_tax) + 1e-12), 4) END AS relative,
       round(abs(l_discount - l_tax), 4) AS absolute FROM lineitem""")
def _(t):
    return rounded(
        t.raw("lineitem").select(
            "l_orderkey", "l_linenumber",
            X.relative_gap("l_tax", "l_discount").alias("relative"),
            X.absolute_gap("l_tax", "l_discount").alias("absolute"),
        ),
        4,
    )


@query("f16_params_text", with_base("""
SELECT customer_state, '{"latest":' || max(delivery_time) || ',"orders":' || count(*)
       || ',"soonest":' || min(delivery_time) || '}' AS params
FROM full_orders GROUP BY customer_state"""))
def _(t):
    params = X.params_column(
        {
            "soonest": F.min("delivery_time"),
            "latest": F.max("delivery_time"),
            "orders": F.count("*"),
        }
    )
    return t.full_orders.groupBy("customer_state").agg(params.alias("params"))
