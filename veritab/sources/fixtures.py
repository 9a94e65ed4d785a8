"""Adapters A1-A5: the reference's data model derived from the driver tables.

Each adapter has a Spark builder and a DuckDB SQL twin (a CTE body over the
same parquet views) so every downstream operator can be checked against an
independent engine on the same input. The SQL twins are the oracle side only;
the Spark builders are what the library uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# ---- fixed values of the fixture derivation (FIXTURES.md) -------------------------------
# (returnflag, linestatus) -> interaction type; 'Click' tests lower-casing, 'wishlist' is unknown
INTERACTION_BY_FLAGS = {"AF": "view", "AO": "Click", "NF": "rating", "NO": "purchase", "RF": "like", "RO": "wishlist"}
LOCATIONS = ["CA", "FL", "IL", "NY", "TX", "WA"]
DEVICES = ["desktop", "mobile", "tablet"]
MERCHANT_CATEGORIES = ["electronics", "fashion", "gaming", "grocery", "travel", "utilities"]
PAYMENT_METHODS = ["Electronic check", "Mailed check", "Bank transfer", "Credit card"]
INTERNET_SERVICES = ["DSL", "Fiber optic", "No"]
SERVICE_COLUMNS = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies"]
CHURN_CUTOFF = "2000-08-01"
# interactions of line number 6 name a variant of their item that the catalog lacks (q08 only)
VARIANT_LINE = 6
# file-order tie-break columns of A1 (l_orderkey, l_linenumber) is not unique
INTERACTION_ORDER_COLS = ("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
                          "l_discount", "l_tax")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def _pick(values: list[str], index_col):
    return _case(index_col, {i: v for i, v in enumerate(values)})


def _sql_pick(values: list[str], index_sql: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {index_sql} {whens} END)"


# ---------------------------------------------------------------- A1 interactions
def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        (F.col("o_custkey") + 1).alias("user_id"),
        F.concat(F.lit("i"), F.col("l_partkey").cast("string")).alias("item_id"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double"))
        .otherwise(F.ceil(F.col("l_quantity") / 10).cast("double")).alias("rating"),
        _case(F.concat(F.col("l_returnflag"), F.col("l_linestatus")), INTERACTION_BY_FLAGS).alias("interaction_type"),
        F.col("l_shipdate").alias("timestamp"),
        *INTERACTION_ORDER_COLS,
    )


def _sql_flags_case() -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in INTERACTION_BY_FLAGS.items())
    return f"(CASE l_returnflag || l_linestatus {whens} END)"


SQL_INTERACTIONS = f"""
SELECT o_custkey + 1 AS user_id,
       'i' || CAST(l_partkey AS VARCHAR) AS item_id,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(ceil(l_quantity / 10) AS DOUBLE) END AS rating,
       {_sql_flags_case()} AS interaction_type,
       l_shipdate AS "timestamp",
       {", ".join(INTERACTION_ORDER_COLS)}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rating column alone, without the join that gives the users."""
    rated = F.when(F.col("l_linenumber") != 7, F.ceil(F.col("l_quantity") / 10).cast("double"))
    return table(spark, sf_dir, "lineitem").select(rated.alias("rating"))


def interactions_with_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interactions, some of them with items that the catalog does not know."""
    named = F.when(F.col("l_linenumber") == VARIANT_LINE, F.concat("item_id", F.lit("-v"))).otherwise(F.col("item_id"))
    return interactions(spark, sf_dir).withColumn("item_id", named)


SQL_INTERACTIONS_WITH_VARIANTS = f"""
SELECT * REPLACE (CASE WHEN l_linenumber = {VARIANT_LINE} THEN item_id || '-v' ELSE item_id END AS item_id)
FROM interactions_raw"""


# ---------------------------------------------------------------- A2 items
def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("i"), F.col("p_partkey").cast("string")).alias("item_id"),
        F.col("p_name").alias("title"),
        F.concat(F.col("p_type"), F.lit("|"), F.col("p_brand")).alias("genres"),
        F.col("p_type").alias("category"),
        F.col("p_partkey").alias("catalog_order"),
    )


SQL_ITEMS = """
SELECT 'i' || CAST(p_partkey AS VARCHAR) AS item_id, p_name AS title, p_type || '|' || p_brand AS genres,
       p_type AS category, p_partkey AS catalog_order
FROM part
"""


# ---------------------------------------------------------------- A3 transactions
def trailing_window_stats(df: DataFrame, key: str, ts_col: str, value_col: str, width_seconds: int,
                          count_name: str, avg_name: str) -> DataFrame:
    """Trailing RANGE window (ts - width, inclusive .. ts] count and average per key.

    Rows are bucketed by time (bucket width = window width) and every row is also
    replicated into the next bucket as context, so each window partition is one
    (key, bucket) and a hot key never lands in a single task.
    """
    width_us = width_seconds * 1_000_000
    ts_us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    base = df.withColumn("_ts_us", ts_us).withColumn("_bucket", F.floor(F.col("_ts_us") / F.lit(width_us)))
    expanded = base.withColumn("_ctx", F.explode(F.array(F.lit(False), F.lit(True)))) \
        .withColumn("_bucket", F.col("_bucket") + F.col("_ctx").cast("long"))
    w = Window.partitionBy(key, "_bucket").orderBy("_ts_us").rangeBetween(-width_us, 0)
    out = expanded.withColumn(count_name, F.count(F.lit(1)).over(w)) \
        .withColumn(avg_name, F.avg(value_col).over(w)).where(~F.col("_ctx"))
    return out.drop("_ts_us", "_bucket", "_ctx")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    base = ev.select(
        F.concat(F.lit("tx_"), F.col("event_id").cast("string")).alias("transaction_id"),
        (F.col("user_id") + 1).alias("user_id"),
        F.col("value").alias("transaction_amount"),
        F.col("ts").alias("transaction_time"),
        _pick(LOCATIONS, F.col("user_id") % 6).alias("location"),
        _pick(DEVICES, F.col("event_id") % 3).alias("device"),
        _pick(MERCHANT_CATEGORIES, F.col("event_id") % 6).alias("merchant_category"),
        F.col("event_type").alias("payment_channel"),
        (k % 2).alias("is_international"),
        ((k % 3) > 0).cast("int").alias("card_present"),
        ((F.col("event_type") == "error") & (F.col("value") >= 60)).cast("int").alias("label"),
    )
    day = trailing_window_stats(base.select("transaction_id", "user_id", "transaction_time", "transaction_amount"),
                                "user_id", "transaction_time", "transaction_amount", 24 * 3600, "_n24", "_avg24")
    week = trailing_window_stats(base.select("transaction_id", "user_id", "transaction_time", "transaction_amount"),
                                 "user_id", "transaction_time", "transaction_amount", 7 * 24 * 3600, "_n7", "_avg7")
    feats = day.select("transaction_id", (F.col("_n24") - 1).cast("int").alias("previous_transactions_24h")) \
        .join(week.select("transaction_id", F.coalesce("_avg7", F.lit(0.0)).alias("avg_spend_7d")), "transaction_id")
    out = base.join(feats, "transaction_id")
    return out.select("transaction_id", "user_id", "transaction_amount", "transaction_time", "location", "device",
                      "merchant_category", "payment_channel", "is_international", "card_present",
                      "previous_transactions_24h", "avg_spend_7d", "label")


SQL_TRANSACTIONS = f"""
SELECT 'tx_' || CAST(event_id AS VARCHAR) AS transaction_id,
       user_id + 1 AS user_id,
       value AS transaction_amount,
       ts AS transaction_time,
       {_sql_pick(LOCATIONS, 'user_id % 6')} AS location,
       {_sql_pick(DEVICES, 'event_id % 3')} AS device,
       {_sql_pick(MERCHANT_CATEGORIES, 'event_id % 6')} AS merchant_category,
       event_type AS payment_channel,
       CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 AS is_international,
       CAST((CAST(json_extract_string(props, '$.k') AS INTEGER) % 3) > 0 AS INTEGER) AS card_present,
       CAST(count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) - 1
            AS INTEGER) AS previous_transactions_24h,
       coalesce(avg(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW),
                0.0) AS avg_spend_7d,
       CAST(event_type = 'error' AND value >= 60 AS INTEGER) AS label
FROM events
"""


# ---------------------------------------------------------------- A4 customers
def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    cutoff = F.lit(CHURN_CUTOFF).cast("timestamp_ntz")
    before = F.col("o_orderdate") < cutoff
    agg = o.groupBy("o_custkey").agg(
        F.min(F.when(before, F.col("o_orderdate"))).alias("first_order"),
        F.sum(F.when(before, F.col("o_totalprice"))).alias("total"),
        F.count_if(~before).alias("n_after"),
    )
    # a customer without orders has no tenure, no total and no later order
    j = c.join(agg, c.c_custkey == agg.o_custkey, "left").withColumn("n_after", F.coalesce("n_after", F.lit(0)))
    tenure = F.coalesce(F.floor(F.datediff(cutoff, F.col("first_order")) / 30), F.lit(0)).cast("int")
    internet = _pick(INTERNET_SERVICES, F.col("c_custkey") % 3)
    services = [
        F.when(F.col("c_custkey") % 3 == 2, F.lit("No internet service"))
        .when(F.shiftright(F.col("c_custkey"), j_bit) % 2 == 1, F.lit("Yes")).otherwise(F.lit("No")).alias(name)
        for j_bit, name in enumerate(SERVICE_COLUMNS)
    ]
    total_text = F.when(F.col("total").isNull(), F.lit(" ")).otherwise(F.round("total", 2).cast("string"))
    yes_no = lambda cond: F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))
    return j.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("customerID"),
        tenure.alias("tenure"),
        F.round(F.coalesce(F.col("total"), F.lit(0.0)) / F.greatest(tenure, F.lit(1)), 2).alias("MonthlyCharges"),
        total_text.alias("TotalCharges"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.lit("Month-to-month"))
        .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("One year")).otherwise(F.lit("Two year")).alias("Contract"),
        internet.alias("InternetService"),
        *services,
        _pick(PAYMENT_METHODS, F.col("c_nationkey") % 4).alias("PaymentMethod"),
        (F.col("c_custkey") % 7 == 0).cast("int").alias("SeniorCitizen"),
        yes_no(F.col("c_custkey") % 2 == 0).alias("Partner"),
        yes_no(F.col("c_custkey") % 5 == 0).alias("Dependents"),
        yes_no(F.col("c_custkey") % 3 != 1).alias("PaperlessBilling"),
        yes_no(F.col("n_after") == 0).alias("Churn"),
    )


def _sql_services() -> str:
    parts = []
    for j_bit, name in enumerate(SERVICE_COLUMNS):
        parts.append(f"CASE WHEN c_custkey % 3 = 2 THEN 'No internet service' "
                     f"WHEN (c_custkey >> {j_bit}) % 2 = 1 THEN 'Yes' ELSE 'No' END AS {name}")
    return ",\n       ".join(parts)


SQL_CUSTOMERS = f"""
SELECT 'C' || CAST(c_custkey AS VARCHAR) AS customerID,
       CAST(coalesce(floor(datediff('day', first_order, TIMESTAMP '{CHURN_CUTOFF}') / 30), 0) AS INTEGER) AS tenure,
       round(coalesce(total, 0.0) / greatest(CAST(coalesce(floor(datediff('day', first_order, TIMESTAMP '{CHURN_CUTOFF}') / 30), 0) AS INTEGER), 1), 2) AS MonthlyCharges,
       CASE WHEN total IS NULL THEN ' ' ELSE CAST(round(total, 2) AS VARCHAR) END AS TotalCharges,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Month-to-month'
            WHEN c_mktsegment = 'AUTOMOBILE' THEN 'One year' ELSE 'Two year' END AS Contract,
       {_sql_pick(INTERNET_SERVICES, 'c_custkey % 3')} AS InternetService,
       {_sql_services()},
       {_sql_pick(PAYMENT_METHODS, 'c_nationkey % 4')} AS PaymentMethod,
       CAST(c_custkey % 7 = 0 AS INTEGER) AS SeniorCitizen,
       CASE WHEN c_custkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS Partner,
       CASE WHEN c_custkey % 5 = 0 THEN 'Yes' ELSE 'No' END AS Dependents,
       CASE WHEN c_custkey % 3 <> 1 THEN 'Yes' ELSE 'No' END AS PaperlessBilling,
       CASE WHEN coalesce(n_after, 0) = 0 THEN 'Yes' ELSE 'No' END AS Churn
FROM customer LEFT JOIN (
    SELECT o_custkey,
           min(CASE WHEN o_orderdate < TIMESTAMP '{CHURN_CUTOFF}' THEN o_orderdate END) AS first_order,
           sum(CASE WHEN o_orderdate < TIMESTAMP '{CHURN_CUTOFF}' THEN o_totalprice END) AS total,
           count(*) FILTER (WHERE NOT (o_orderdate < TIMESTAMP '{CHURN_CUTOFF}')) AS n_after
    FROM orders GROUP BY o_custkey) a ON c_custkey = a.o_custkey
"""


# ---------------------------------------------------------------- A6 scored transactions
# fixed formula score used to test the evaluators without a model fit:
# z = -4 + 0.03 amount + 2 [channel = error] + 0.5 international - 0.3 card_present, score = round(sigmoid(z), 6)
def scored_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = transactions(spark, sf_dir)
    z = (((F.lit(-4.0) + F.lit(0.03) * F.col("transaction_amount"))
          + F.lit(2.0) * (F.col("payment_channel") == "error").cast("double"))
         + F.lit(0.5) * F.col("is_international").cast("double")) - F.lit(0.3) * F.col("card_present").cast("double")
    return t.select("transaction_id", "label", F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 6).alias("score"))


SQL_SCORED_TRANSACTIONS = """
SELECT transaction_id, label,
       round(1.0 / (1.0 + exp(-((((CAST(-4.0 AS DOUBLE) + CAST(0.03 AS DOUBLE) * transaction_amount)
             + CAST(2.0 AS DOUBLE) * CAST(payment_channel = 'error' AS DOUBLE))
             + CAST(0.5 AS DOUBLE) * CAST(is_international AS DOUBLE)) - CAST(0.3 AS DOUBLE) * CAST(card_present AS DOUBLE)))), 6)
       AS score
FROM transactions
"""
