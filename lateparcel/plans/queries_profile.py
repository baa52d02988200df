"""Aggregates, reports, relations between columns, orders and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from lateparcel.operators import profile, relate, report
from lateparcel.operators.join import order_totals, orders_per_customer, with_order_total
from lateparcel.plans.queries_tables import _DESCRIBE_SQL, _TOTALS_SQL
from lateparcel.plans.registry import query, rounded, with_base


@query("a1_orders_per_customer", with_base("""
SELECT customer_id, count(order_id) AS orders FROM raw_orders
WHERE customer_id IS NOT NULL GROUP BY customer_id"""))
def _(t):
    return orders_per_customer(t.orders)


@query("a2_loyal_ratio", with_base("""
SELECT round(avg(CASE WHEN n > 1 THEN 1.0 ELSE 0.0 END), 6) AS ratio FROM (
  SELECT count(order_id) OVER (PARTITION BY customer_id) AS n FROM full_orders)"""))
def _(t):
    from lateparcel.operators.join import add_loyalty_target

    return rounded(profile.flag_ratio(add_loyalty_target(t.full_orders), "loyal_customer"))


@query("a3_customers_per_state", with_base("""
SELECT customer_state, count(*) AS count FROM raw_customers
WHERE customer_state IS NOT NULL GROUP BY customer_state"""))
def _(t):
    return profile.customers_per_state(t.customers)


@query("a4_value_counts", with_base("""
SELECT order_status, count(*) AS count FROM raw_orders
WHERE order_status IS NOT NULL GROUP BY order_status ORDER BY count DESC, order_status"""))
def _(t):
    return profile.value_counts(t.orders, "order_status")


@query("a5_value_shares", with_base("""
SELECT target, round_even(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 3) AS share
FROM delays GROUP BY target"""))
def _(t):
    return profile.value_shares(t.delays, "target")


@query("a6_order_totals", with_base("""
SELECT order_id, round(order_total_value, 4) AS order_total_value FROM totals""", _TOTALS_SQL))
def _(t):
    return rounded(order_totals(t.items), 4)


@query("a7_state_report", with_base("""
SELECT customer_state, count(customer_id) AS customer_id_count,
       CAST(round_even(CAST(avg(delivery_delay) AS DECIMAL(18, 9)), 2) AS DOUBLE) AS delivery_delay_mean,
       CAST(round_even(CAST(median(delivery_delay) AS DECIMAL(18, 9)), 2) AS DOUBLE) AS delivery_delay_median,
       CAST(round_even(CAST(stddev_samp(delivery_delay) AS DECIMAL(18, 9)), 2) AS DOUBLE) AS delivery_delay_std
FROM full_orders WHERE customer_state IS NOT NULL GROUP BY customer_state"""))
def _(t):
    return profile.state_report(t.full_orders)


def _describe_sql(name: str, view: str, numeric: bool, text: str | None = None) -> str:
    """One line of the full description of a table."""
    if numeric:
        inner = _DESCRIBE_SQL.format(name, view)
        return f"""SELECT "column", count, NULL::BIGINT AS "unique", NULL::VARCHAR AS top,
          NULL::BIGINT AS freq, mean, std, min, p25, p50, p75, max FROM ({inner})"""
    text = text or name
    return f"""SELECT '{name}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
      (array_agg(v ORDER BY n DESC, v))[1] AS top, max(n) AS freq, NULL::DOUBLE AS mean,
      NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS p25, NULL::DOUBLE AS p50,
      NULL::DOUBLE AS p75, NULL::DOUBLE AS max
      FROM (SELECT {text} AS v, count(*) AS n FROM {view} WHERE {name} IS NOT NULL GROUP BY 1)"""


_INPUT_KINDS = [
    ("customer_id", True), ("customer_city", False), ("customer_state", False),
    ("customer_zip_code_prefix", False), ("delivery_delay", True), ("delivery_time", True),
    ("order_year_month", False), ("order_year", True), ("order_month", True),
    ("order_status", False),
]


@query("a8_describe_all", with_base(" UNION ALL ".join(
    [_describe_sql(n, "full_orders", k) for n, k in _INPUT_KINDS]
    + [_describe_sql("order_purchase_timestamp", "full_orders", False,
                     "strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S')")])))
def _(t):
    from lateparcel.operators.clean import model_input

    return rounded(profile.describe_all(model_input(t.full_orders)))


@query("a9_describe_numbers", with_base(
    _DESCRIBE_SQL.format("price", "raw_items") + " UNION ALL "
    + _DESCRIBE_SQL.format("shipping_charges", "raw_items")))
def _(t):
    return rounded(profile.describe_numbers(t.items, ["price", "shipping_charges"]))


_ORDER_NAMES = [
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_timestamp", "order_estimated_delivery_date", "delivery_delay",
    "delivery_time", "order_year_month", "order_year", "order_month",
]


@query("a10_missing_values", with_base(" UNION ALL ".join(
    f"""SELECT '{n}' AS "column", count(*) - count({n}) AS missing_values FROM orders_clean"""
    for n in _ORDER_NAMES)))
def _(t):
    return profile.missing_values(t.orders_clean)


@query("a11_missing_percent", with_base(" UNION ALL ".join(
    f"""SELECT '{n}' AS "column", count(*) - count({n}) AS missing_values,
    round_even(100.0 * (count(*) - count({n})) / count(*), 2) AS missing_pct FROM orders_clean"""
    for n in _ORDER_NAMES)))
def _(t):
    return profile.missing_values(t.orders_clean, with_pct=True)


@query("a12_duplicate_rows", """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM (
  SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber, l_returnflag)""")
def _(t):
    return profile.duplicate_rows(
        t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    )


@query("a13_quantile", with_base("""
SELECT 'price' AS "column", round(quantile_cont(price, 0.99), 6) AS value FROM raw_items
UNION ALL
SELECT 'shipping_charges', round(quantile_cont(shipping_charges, 0.99), 6) FROM raw_items"""))
def _(t):
    return rounded(profile.quantile_table(t.items, ["price", "shipping_charges"], 0.99))


@query("a14_medians", with_base("""
SELECT 'delivery_delay' AS "column", median(delivery_delay) AS value FROM orders_clean
UNION ALL SELECT 'delivery_time', median(delivery_time) FROM orders_clean
UNION ALL SELECT 'order_month', median(order_month) FROM orders_clean"""))
def _(t):
    return profile.column_medians(
        t.orders_clean, ["delivery_delay", "delivery_time", "order_month"]
    )


@query("a15_most_frequent", with_base("""
SELECT 'customer_city' AS "column", (array_agg(v ORDER BY n DESC, v))[1] AS most_frequent
FROM (SELECT customer_city AS v, count(*) AS n FROM raw_customers GROUP BY 1)
UNION ALL SELECT 'customer_state', (array_agg(v ORDER BY n DESC, v))[1]
FROM (SELECT customer_state AS v, count(*) AS n FROM raw_customers GROUP BY 1)"""))
def _(t):
    return profile.most_frequent(t.customers, ["customer_city", "customer_state"])


@query("a16_target_moments", with_base("""
SELECT round(avg(delivery_delay), 6) AS mean, round(stddev_pop(delivery_delay), 6) AS std
FROM delays"""))
def _(t):
    return rounded(profile.target_moments(t.delays, "delivery_delay"))


@query("a17_class_distribution", with_base("""
SELECT target, n AS count, round(CAST(min(n) OVER () AS DOUBLE) / max(n) OVER (), 6) AS min_max_ratio,
       row_number() OVER (ORDER BY n DESC, target) = 1 AS is_majority
FROM (SELECT target, count(*) AS n FROM delays GROUP BY target)"""))
def _(t):
    return rounded(profile.class_distribution(t.delays, "target"))


def _histogram_sql(name: str, view: str) -> str:
    return f"""
SELECT CAST(b AS INTEGER) AS bin, round(low + b * width, 6) AS left_edge,
       round(low + (b + 1) * width, 6) AS right_edge, coalesce(n, 0) AS count
FROM range(50) r(b) CROSS JOIN edges LEFT JOIN (
  SELECT CAST(least(floor((CAST({name} AS DOUBLE) - low) / width), 49) AS INTEGER) AS place,
         count(*) AS n
  FROM {view} CROSS JOIN edges WHERE {name} IS NOT NULL GROUP BY 1) ON place = b"""


def _edges_sql(name: str, view: str) -> str:
    return f"""edges AS (SELECT CAST(min({name}) AS DOUBLE) AS low,
  CAST(max({name}) - min({name}) AS DOUBLE) / 50 AS width FROM {view})"""


@query("a18_delay_histogram", with_base(
    _histogram_sql("delivery_delay", "orders_clean"), _edges_sql("delivery_delay", "orders_clean")))
def _(t):
    return rounded(profile.histogram(t.orders_clean, "delivery_delay"))


@query("a18_value_histogram", with_base(
    _histogram_sql("l_extendedprice", "lineitem"), _edges_sql("l_extendedprice", "lineitem")))
def _(t):
    return rounded(profile.histogram(t.raw("lineitem"), "l_extendedprice"))


def _box_sql(name: str, view: str) -> str:
    return f"""
SELECT '{name}' AS "column", round(least(min({name}) FILTER ({name} >= q1 - 1.5 * (q3 - q1)
         AND {name} <= q3 + 1.5 * (q3 - q1)), any_value(q1)), 6) AS whisker_low,
       round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median,
       round(any_value(q3), 6) AS q3,
       round(greatest(max({name}) FILTER ({name} >= q1 - 1.5 * (q3 - q1)
         AND {name} <= q3 + 1.5 * (q3 - q1)), any_value(q3)), 6) AS whisker_high,
       count(*) FILTER ({name} < q1 - 1.5 * (q3 - q1) OR {name} > q3 + 1.5 * (q3 - q1)) AS outliers
FROM {view} CROSS JOIN (SELECT quantile_cont({name}, 0.25) AS q1, quantile_cont({name}, 0.5) AS q2,
  quantile_cont({name}, 0.75) AS q3 FROM {view})"""


@query("a19_box_plot", with_base(
    _box_sql("price", "raw_items") + " UNION ALL " + _box_sql("shipping_charges", "raw_items")))
def _(t):
    return rounded(profile.box_plot(t.items, ["price", "shipping_charges"]))


def _corr_sql(left: str, right: str, view: str) -> str:
    value = f"(SELECT corr({left}, {right}) FROM {view})"
    return f"round(CASE WHEN isnan({value}) THEN NULL ELSE {value} END, 6)"


_PEARSON = ["delivery_delay", "delivery_time", "order_year", "order_month", "order_total_value"]


@query("a20_pearson", with_base(" UNION ALL ".join(
    f"SELECT '{a}' AS feature, " + ", ".join(
        f"{_corr_sql(min(a, b), max(a, b), 'valued')} AS {b}" for b in _PEARSON)
    for a in _PEARSON), _TOTALS_SQL, """valued AS (
  SELECT o.*, order_total_value FROM orders_clean o LEFT JOIN totals s ON o.order_id = s.order_id)"""))
def _(t):
    return rounded(relate.pearson_matrix(with_order_total(t.orders_clean, t.items), _PEARSON))


_SPEARMAN = ["delivery_delay", "delivery_time", "order_year", "order_month", "customer_id"]


def _spearman_sql(left: str, right: str) -> str:
    """Average ranks over the rows where both columns are known."""
    def rank(name: str) -> str:
        return (f"rank() OVER (ORDER BY {name}) + (count(*) OVER (PARTITION BY {name}) - 1) / 2.0")

    value = f"""(SELECT corr(a, b) FROM (SELECT {rank(left)} AS a, {rank(right)} AS b
      FROM full_orders WHERE {left} IS NOT NULL AND {right} IS NOT NULL))"""
    return f"round(CASE WHEN isnan({value}) THEN NULL ELSE {value} END, 6)"


@query("a21_spearman", with_base(" UNION ALL ".join(
    f"SELECT '{a}' AS feature, " + ", ".join(
        f"{_spearman_sql(min(a, b), max(a, b))} AS {b}" for b in _SPEARMAN)
    for a in _SPEARMAN)))
def _(t):
    return rounded(relate.spearman_matrix(t.full_orders, _SPEARMAN))


_VIF3 = ["delivery_time", "order_month", "order_year"]


@query("a22_vif_with_intercept", with_base(" UNION ALL ".join(
    f"""SELECT '{a}' AS feature, round((1 - bc * bc) / (1 - ab * ab - ac * ac - bc * bc
    + 2 * ab * ac * bc), 6) AS VIF FROM (SELECT corr({a}, {b}) AS ab, corr({a}, {c}) AS ac,
    corr({b}, {c}) AS bc FROM filled)"""
    for a, b, c in [
        ("delivery_time", "order_month", "order_year"),
        ("order_month", "delivery_time", "order_year"),
        ("order_year", "delivery_time", "order_month")]), """filled AS (
  SELECT coalesce(CAST(delivery_time AS DOUBLE), (SELECT median(delivery_time) FROM orders_clean))
    AS delivery_time, order_month, order_year FROM orders_clean)"""))
def _(t):
    return rounded(relate.variance_inflation(t.orders_clean, _VIF3))


@query("a23_vif_without_intercept", with_base("""
SELECT unnest(['delivery_time', 'order_month']) AS feature, round(1 / (1 - u * u), 6) AS VIF FROM (
  SELECT sum(CAST(delivery_time AS DOUBLE) * order_month)
         / sqrt(sum(CAST(delivery_time AS DOUBLE) * delivery_time)
                * sum(CAST(order_month AS DOUBLE) * order_month)) AS u
  FROM orders_clean WHERE delivery_time IS NOT NULL AND order_month IS NOT NULL)"""))
def _(t):
    return rounded(
        relate.variance_inflation(
            t.orders_clean, ["delivery_time", "order_month"], with_intercept=False, nulls="drop"
        )
    )


@query("o3_missing_largest_first", with_base("""SELECT * FROM (""" + " UNION ALL ".join(
    f"""SELECT '{n}' AS "column", count(*) - count({n}) AS missing_values FROM orders_clean"""
    for n in _ORDER_NAMES) + """) ORDER BY missing_values DESC, "column\""""))
def _(t):
    return report.largest_first(profile.missing_values(t.orders_clean), "missing_values", "column")


@query("o4_top_customers", with_base("""
SELECT customer_id, count(order_id) AS orders FROM raw_orders WHERE customer_id IS NOT NULL
GROUP BY customer_id ORDER BY orders DESC, customer_id LIMIT 15"""))
def _(t):
    return report.top_rows(orders_per_customer(t.orders), "orders", "customer_id", 15)
