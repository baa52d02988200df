"""Sampling, splits, folds, over-sampling and feature encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from lateparcel.operators import encode, sample, sparse
from lateparcel.operators.join import add_loyalty_target, at_item_grain
from lateparcel.plans.registry import query, rounded, with_base

KEY = ["order_id"]


def hashed_sql(view: str, label: str | None = None, seed: int = 42) -> str:
    """Place of each row in hash order, within its class where there is one."""
    stratum = f"PARTITION BY {label} " if label else ""
    return f"""hashed AS (
  SELECT *, md5('{seed}|' || order_id) AS h,
         row_number() OVER ({stratum}ORDER BY md5('{seed}|' || order_id)) AS place
  FROM {view})"""


def quota_sql(name: str, counts: str, draws: str, label: str) -> str:
    """Largest-remainder shares of ``draws`` (a scalar) over the classes of ``counts``."""
    return f"""{name} AS (
  SELECT {label}, n, CAST(floor(exact) AS BIGINT) + CASE WHEN row_number() OVER (
      ORDER BY exact - floor(exact) DESC, {label}) <= {draws} - sum(floor(exact)) OVER ()
      THEN 1 ELSE 0 END AS quota
  FROM (SELECT {label}, n, CAST({draws} AS BIGINT) * n / CAST(sum(n) OVER () AS DOUBLE) AS exact
        FROM {counts}))"""


_COUNTS = "counts AS (SELECT target, count(*) AS n FROM delays GROUP BY target)"
_N = "(SELECT count(*) FROM delays)"
_TEST = f"ceil({_N} * 0.2)"
_VALIDATION = f"ceil(({_N} - {_TEST}) * 0.2)"


@query("x1_row_cap", with_base("""
SELECT order_id, customer_id FROM hashed WHERE place <= 1000""", hashed_sql("raw_orders")))
def _(t):
    return sample.row_cap(t.orders.select("order_id", "customer_id"), KEY, 1000)


@query("x2_fraction_sample", with_base("""
SELECT order_id, customer_id FROM hashed WHERE substr(h, 1, 8) < '33333333'""",
    hashed_sql("raw_orders")))
def _(t):
    return sample.fraction_sample(t.orders.select("order_id", "customer_id"), KEY, 0.2)


@query("x3_stratified_cap", with_base("""
SELECT order_id, target FROM hashed JOIN quotas USING (target) WHERE place <= quota""",
    hashed_sql("delays", "target"), _COUNTS,
    quota_sql("quotas", "counts", f"least(1000, {_N})", "target")))
def _(t):
    return sample.stratified_cap(t.delays.select("order_id", "target"), KEY, "target", 1000)


@query("x4_train_test", with_base(f"""
SELECT order_id, CASE WHEN place <= {_TEST} THEN 'test' ELSE 'train' END AS split FROM hashed""",
    hashed_sql("delays")))
def _(t):
    return sample.train_test_split(t.delays.select("order_id"), KEY, 0.2)


@query("x5_stratified_train_test", with_base("""
SELECT order_id, target, CASE WHEN place <= quota THEN 'test' ELSE 'train' END AS split
FROM hashed JOIN quotas USING (target)""",
    hashed_sql("delays", "target"), _COUNTS, quota_sql("quotas", "counts", _TEST, "target")))
def _(t):
    return sample.train_test_split(t.delays.select("order_id", "target"), KEY, 0.2, "target")


@query("x6_three_way", with_base(f"""
SELECT order_id, CASE WHEN place <= {_TEST} THEN 'test'
       WHEN place <= {_TEST} + {_VALIDATION} THEN 'validation' ELSE 'train' END AS split
FROM hashed""", hashed_sql("delays")))
def _(t):
    return sample.three_way_split(t.delays.select("order_id"), KEY)


STRATIFIED_SQL = (
    hashed_sql("delays", "target"), _COUNTS, quota_sql("quotas", "counts", _TEST, "target"),
    "rest AS (SELECT target, n - quota AS n FROM quotas)",
    quota_sql("second", "rest", _VALIDATION, "target"),
    """stratified AS (SELECT hashed.*, CASE WHEN place <= quotas.quota THEN 'test'
      WHEN place <= quotas.quota + second.quota THEN 'validation' ELSE 'train' END AS split
      FROM hashed JOIN quotas USING (target) JOIN second USING (target))""",
)


@query("x6_three_way_stratified", with_base(
    "SELECT order_id, target, split FROM stratified", *STRATIFIED_SQL))
def _(t):
    return sample.three_way_split(t.delays.select("order_id", "target"), KEY, label="target")


@query("x7_oversample", with_base("""
SELECT order_id, target, CAST(copy AS INTEGER) AS copy FROM (
  SELECT order_id, target, unnest(range(1, 1 + most // n
         + CASE WHEN place <= most % n THEN 1 ELSE 0 END)) AS copy
  FROM hashed JOIN counts USING (target) CROSS JOIN (SELECT max(n) AS most FROM counts))""",
    hashed_sql("delays", "target"), _COUNTS))
def _(t):
    return sample.oversample(t.delays.select("order_id", "target"), KEY, "target")


@query("x8_shuffle", with_base("""
SELECT order_id, h AS shuffle_key FROM hashed ORDER BY h""", hashed_sql("delays")))
def _(t):
    return sample.shuffle_order(t.delays.select("order_id"), KEY)


@query("x9_folds", with_base("""
SELECT order_id, target, CAST(ntile(3) OVER (PARTITION BY target ORDER BY h) - 1 AS INTEGER) AS fold
FROM hashed""", hashed_sql("delays")))
def _(t):
    return sample.assign_folds(t.delays.select("order_id", "target"), KEY, 3, "target")


# --- features ----------------------------------------------------------------------------

_STATES = [f"NATION_{i}" for i in range(25)]


def _dummies(values) -> str:
    return ", ".join(
        f"CAST(coalesce(customer_state = '{v}', FALSE) AS INTEGER) AS \"customer_state_{v}\""
        for v in values
    )


@query("t1_encode_features", with_base(f"""
SELECT customer_id, customer_zip_code_prefix, {_dummies(sorted(_STATES)[1:])}
FROM raw_customers"""))
def _(t):
    return encode.encode_features(t.customers)


def _scaled_sql(name: str) -> str:
    """Standardised with the train rows only."""
    stats = f"(SELECT avg({name}), stddev_pop({name}) FROM marked WHERE split = 'train')"
    return (
        f"round(({name} - (SELECT avg({name}) FROM marked WHERE split = 'train')) / "
        f"(SELECT CASE WHEN stddev_pop({name}) = 0 THEN 1 ELSE stddev_pop({name}) END"
        f" FROM marked WHERE split = 'train'), 6) AS \"{name}\""
    ) if stats else ""


@query("t2_tabular_encoder", with_base(
    "SELECT order_id, split, " + ", ".join(
        _scaled_sql(n) for n in ["delivery_time", "customer_zip_code_prefix", "order_month",
                                 "order_year", *[f"customer_state_{v}" for v in sorted(_STATES)[1:]]])
    + " FROM marked",
    hashed_sql("delays"), f"""marked AS (
  SELECT order_id, delivery_time, customer_zip_code_prefix, order_month, order_year,
    CASE WHEN place <= {_TEST} THEN 'test' ELSE 'train' END AS split,
    {_dummies(sorted(_STATES)[1:])} FROM hashed)"""))
def _(t):
    marked = sample.train_test_split(t.delays, KEY, 0.2)
    features = [*encode.NUMERIC_FEATURES, *encode.CATEGORICAL_FEATURES]
    encoder = encode.TabularEncoder.fit(marked.where("split = 'train'"), features)
    return rounded(encoder.transform(marked, ["order_id", "split"]))


@query("t3_one_hot", with_base(f"""
SELECT customer_id, {_dummies(sorted(_STATES))} FROM raw_customers"""))
def _(t):
    states = encode.fit_categories(t.customers, ["customer_state"])["customer_state"]
    columns = encode.one_hot_columns("customer_state", states)
    return t.customers.select("customer_id", *[c.alias(n) for n, c in columns.items()])


@query("t4_label_encode", with_base("""
SELECT order_id, order_status, customer_state,
       CAST(dense_rank() OVER (ORDER BY customer_state) - 1 AS INTEGER) AS customer_state_enc,
       CAST(dense_rank() OVER (ORDER BY order_status) - 1 AS INTEGER) AS order_status_enc
FROM full_orders"""))
def _(t):
    chosen = t.full_orders.select("order_id", "order_status", "customer_state")
    return encode.label_encode(chosen, ["customer_state", "order_status"])


@query("t5_standardise", with_base("""
SELECT order_id, product_id, round((price - m) / s, 5) AS price_scaled,
       round((shipping_charges - ms) / ss, 5) AS shipping_charges_scaled
FROM raw_items CROSS JOIN (SELECT avg(price) AS m, stddev_pop(price) AS s,
  avg(shipping_charges) AS ms, stddev_pop(shipping_charges) AS ss FROM raw_items)"""))
def _(t):
    scaler = encode.Scaler.fit(t.items, ["price", "shipping_charges"])
    scaled = scaler.transform(t.items, "_scaled")
    return rounded(
        scaled.select("order_id", "product_id", "price_scaled", "shipping_charges_scaled"), 5
    )


@query("t6_impute", with_base("""
SELECT order_id, coalesce(CAST(delivery_time AS DOUBLE), (SELECT median(delivery_time) FROM orders_clean))
         AS delivery_time,
       coalesce(nullif(order_status, 'shipped'), (SELECT (array_agg(v ORDER BY n DESC, v))[1] FROM (
         SELECT order_status AS v, count(*) AS n FROM orders_clean WHERE order_status <> 'shipped'
         GROUP BY 1))) AS order_status
FROM orders_clean"""))
def _(t):
    gaps = t.orders_clean.select(
        "order_id", "delivery_time",
        F.nullif("order_status", F.lit("shipped")).alias("order_status"),
    )
    return encode.Imputer.fit(gaps, ["delivery_time"], ["order_status"]).transform(gaps)


@query("t7_preprocessor", with_base("""
SELECT order_id, round((delivery_time - (SELECT avg(delivery_time) FROM delays))
         / (SELECT stddev_pop(delivery_time) FROM delays), 6) AS first_entry,
       CAST(29 AS INTEGER) AS entries, 1.0 :: DOUBLE AS hot
FROM delays"""))
def _(t):
    from pyspark.ml.functions import vector_to_array

    fitted = encode.Preprocessor.fit(t.delays)
    entries = vector_to_array("features")
    return fitted.transform(t.delays, ["order_id"]).select(
        "order_id",
        F.round(entries[0], 6).alias("first_entry"),
        F.size(entries).alias("entries"),
        F.aggregate(F.slice(entries, 5, 100), F.lit(0.0), lambda a, b: a + b).alias("hot"),
    )


_CODED = """
coded AS (
  SELECT order_id, product_id, seller_id, price,
         dense_rank() OVER (ORDER BY CAST(product_id AS VARCHAR)) - 1 AS product,
         dense_rank() OVER (ORDER BY CAST(seller_id AS VARCHAR)) - 1 AS seller,
         (SELECT count(DISTINCT product_id) FROM raw_items) AS products,
         (SELECT count(DISTINCT seller_id) FROM raw_items) AS sellers
  FROM raw_items)"""


@query("t7_sparse_preprocessor", with_base("""
SELECT order_id, product_id, seller_id, CAST(1 + products + sellers AS INTEGER) AS entries,
       round((price - avg(price) OVER ()) / stddev_pop(price) OVER (), 5) AS scaled,
       concat_ws(',', 0, 1 + product, 1 + products + seller) AS places
FROM coded""", _CODED))
def _(t):
    fitted = sparse.SparseEncoder.fit(t.items, ["price"], ["product_id", "seller_id"])
    names = ["order_id", "product_id", "seller_id"]
    rows = fitted.transform(t.items, names).withColumn("v", sparse.entries_of("features"))
    return rows.select(
        *names, F.col("v.size").alias("entries"),
        F.round(F.col("v.values")[0], 5).alias("scaled"),
        F.concat_ws(",", F.col("v.indices").cast("array<string>")).alias("places"),
    )


@query("t8_feature_matrix", with_base("""
SELECT coalesce(delivery_delay, 0) AS delivery_delay, coalesce(delivery_time, 0) AS delivery_time,
       order_year, order_month, CAST(order_status = 'delivered' AS INTEGER) AS arrived
FROM full_orders"""))
def _(t):
    flagged = add_loyalty_target(t.full_orders).withColumn(
        "arrived", F.col("order_status") == "delivered"
    )
    return encode.feature_matrix(flagged)


@query("t9_delay_frame", with_base("SELECT * FROM delays"))
def _(t):
    return t.delays


@query("t10_balanced_weights", with_base("""
SELECT order_id, target, round((SELECT count(*) FROM delays) / (2.0 * n), 6) AS weight
FROM delays JOIN counts USING (target)""", _COUNTS))
def _(t):
    return rounded(sample.balanced_weights(t.delays.select("order_id", "target"), "target"))


@query("t4_t5_item_features", with_base("""
SELECT o.order_id, i.product_id,
       CAST(dense_rank() OVER (ORDER BY customer_state) - 1 AS INTEGER) AS customer_state_enc,
       round((price - avg(price) OVER ()) / stddev_pop(price) OVER (), 5) AS price_scaled
FROM full_orders o JOIN raw_items i ON o.order_id = i.order_id"""))
def _(t):
    grain = at_item_grain(t.full_orders, t.items)
    scaled = encode.Scaler.fit(grain, ["price"]).transform(grain, "_scaled")
    coded = encode.label_encode(scaled, ["customer_state"])
    return rounded(
        coded.select("order_id", "product_id", "customer_state_enc", "price_scaled"), 5
    )
