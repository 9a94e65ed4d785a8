"""Registered queries: data quality, features, dedup/splits and profiling (B1)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.config import FRAUD_REQUIRED
from veritab.functions import features as ft
from veritab.operators import dedup, profile, quality, splits
from veritab.operators.recsys import signals as rs
from veritab.plans.oracle_sql import r6, with_ctes
from veritab.plans.registry import (catalog, interaction_matrix, prepared_interactions, register, requested_items,
                                    rounded)
from veritab.sources import fixtures as fx

TX_NUMERIC = ["user_id", "transaction_amount", "is_international", "card_present", "previous_transactions_24h",
              "avg_spend_7d", "label"]
TX_STRINGS = ["location", "device", "merchant_category", "payment_channel"]
CUSTOMER_COLUMNS = ["customerID", "tenure", "MonthlyCharges", "TotalCharges", "Contract", "InternetService",
                    *fx.SERVICE_COLUMNS, "PaymentMethod", "SeniorCitizen", "Partner", "Dependents", "PaperlessBilling",
                    "Churn"]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------------ quality
@register("q03_quality_report", with_ctes(_union([
    "SELECT 'row_count' AS check_name, CAST(count(*) AS BIGINT) AS bad_rows, "
    "CASE WHEN count(*) = 0 THEN 'error' ELSE 'info' END AS severity FROM transactions",
    "SELECT 'null_keys', CAST(count(*) FILTER (WHERE transaction_id IS NULL OR user_id IS NULL) AS BIGINT), 'error' "
    "FROM transactions",
    "SELECT 'non_binary_label', CAST(count(*) FILTER (WHERE NOT coalesce(TRY_CAST(label AS DOUBLE) IN (0.0, 1.0), false))"
    " AS BIGINT), 'error' FROM transactions",
    "SELECT 'duplicate_ids', CAST(count(transaction_id) - count(DISTINCT transaction_id) AS BIGINT), 'warn' "
    "FROM transactions",
    "SELECT 'invalid_timestamp', CAST(count(*) FILTER (WHERE transaction_time IS NULL) AS BIGINT), 'error' "
    "FROM transactions",
])))
def q03_quality_report(spark, sf_dir):
    tx = fx.transactions(spark, sf_dir)
    quality.require_columns(tx, FRAUD_REQUIRED)
    return quality.quality_report(tx, key_cols=["transaction_id", "user_id"], label_col="label",
                                  id_col="transaction_id", time_col="transaction_time")


@register("q08_unknown_items", with_ctes("""
SELECT 'unknown_item_id' AS check_name, CAST(count(DISTINCT item_id) AS BIGINT) AS bad_rows, 'warn' AS severity
FROM interactions_variants WHERE item_id IS NOT NULL AND item_id NOT IN (SELECT item_id FROM items_raw)"""))
def q08_unknown_items(spark, sf_dir):
    return quality.unknown_references(fx.interactions_with_variants(spark, sf_dir), fx.items(spark, sf_dir), "item_id")


def _rules_sql() -> str:
    rules = [
        ("transaction_id_nonempty", "length(CAST(transaction_id AS VARCHAR)) >= 1"),
        ("user_id_positive", "user_id >= 1"),
        ("amount_positive", "transaction_amount > 0"),
        ("time_text", "length(CAST(transaction_time AS VARCHAR)) >= 4"),
    ]
    rules += [(f"{c}_nonempty", f"length({c}) >= 1") for c in ("location", "device", "merchant_category",
                                                                 "payment_channel")]
    rules += [(f"{c}_binary", f"{c} BETWEEN 0 AND 1") for c in ("is_international", "card_present")]
    rules += [("previous_transactions_24h_nonneg", "previous_transactions_24h >= 0"),
              ("avg_spend_7d_nonneg", "avg_spend_7d >= 0")]
    items = ", ".join(f"CASE WHEN coalesce({p}, false) THEN NULL ELSE '{n}' END" for n, p in rules)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


@register("q09_record_constraints", with_ctes(f"""
SELECT transaction_id, array_to_string(f, ',') AS failed_rules, len(f) = 0 AS is_valid
FROM (SELECT transaction_id, {_rules_sql()} AS f FROM transactions)"""))
def q09_record_constraints(spark, sf_dir):
    v = quality.validate_records(fx.transactions(spark, sf_dir))
    return v.select("transaction_id", F.array_join("failed_rules", ",").alias("failed_rules"), "is_valid")


def _requests(spark, sf_dir):
    """Recommend requests derived from the customer table (some ids and sizes out of range)."""
    c = fx.table(spark, sf_dir, "customer")
    return c.select((F.col("c_custkey") - 3).alias("user_id"),
                    F.when(F.col("c_custkey") % 11 == 0, F.lit(None)).otherwise(F.col("c_custkey") % 60 - 5)
                    .cast("int").alias("top_n"))


SQL_REQUESTS = """SELECT c_custkey - 3 AS user_id,
       CAST(CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey % 60 - 5 END AS INTEGER) AS top_n FROM customer"""


@register("q10_request_constraints", with_ctes("""
SELECT user_id, top_n, coalesce(user_id BETWEEN 1 AND 10000000000 AND top_n BETWEEN 1 AND 50, false) AS is_valid,
       greatest(1, least(top_n, 50)) AS effective_top_n
FROM (SELECT user_id, CAST(coalesce(top_n, 10) AS INTEGER) AS top_n FROM sent_requests)""", {"sent_requests": SQL_REQUESTS}))
def q10_request_constraints(spark, sf_dir):
    return quality.validate_requests(_requests(spark, sf_dir))


ALIGN_SCHEMA = T.StructType([T.StructField("customerID", T.StringType()), T.StructField("gender", T.StringType()),
                             T.StructField("tenure", T.LongType()), T.StructField("Contract", T.StringType()),
                             T.StructField("MonthlyCharges", T.DoubleType())])


@register("q12_schema_alignment", with_ctes(f"""
SELECT customerID, CAST(NULL AS VARCHAR) AS gender, CAST(tenure AS BIGINT) AS tenure, Contract,
       {r6('MonthlyCharges')} AS MonthlyCharges FROM customers"""))
def q12_schema_alignment(spark, sf_dir):
    return rounded(quality.align_schema(fx.customers(spark, sf_dir), ALIGN_SCHEMA))


@register("q14_fill_absent_fields", with_ctes("""
SELECT customerID, OnlineSecurity, TechSupport, 'No' AS StreamingTV, 'No' AS PaperlessBilling, 0 AS SeniorCitizen,
       Partner FROM customers"""))
def q14_fill_absent_fields(spark, sf_dir):
    c = fx.customers(spark, sf_dir).select("customerID", "OnlineSecurity", "TechSupport", "Partner")
    out = quality.fill_absent(c)
    return out.select("customerID", "OnlineSecurity", "TechSupport", "StreamingTV", "PaperlessBilling",
                      "SeniorCitizen", "Partner")


# ------------------------------------------------------------------ features
def _sql_flag(cond: str) -> str:
    return f"CAST(coalesce({cond}, false) AS INTEGER)"


def _sql_tenure_group(t: str) -> str:
    return (f"CASE WHEN {t} > -1 AND {t} <= 6 THEN '0_6' WHEN {t} > 6 AND {t} <= 12 THEN '7_12' "
            f"WHEN {t} > 12 AND {t} <= 24 THEN '13_24' WHEN {t} > 24 AND {t} <= 48 THEN '25_48' "
            f"WHEN {t} > 48 THEN '49_plus' END")


@register("p01_churn_features", with_ctes(f"""
SELECT customerID, {r6('TRY_CAST(TotalCharges AS DOUBLE)')} AS TotalCharges,
       {r6('TRY_CAST(tenure AS DOUBLE)')} AS tenure,
       {r6('CASE WHEN TRY_CAST(tenure AS DOUBLE) + 1.0 = 0 THEN NULL ELSE TRY_CAST(TotalCharges AS DOUBLE) / (TRY_CAST(tenure AS DOUBLE) + 1.0) END')} AS avg_monthly_spend,
       {_sql_tenure_group('TRY_CAST(tenure AS DOUBLE)')} AS tenure_group,
       {_sql_flag("Contract = 'Month-to-month'")} AS is_month_to_month,
       {" + ".join(_sql_flag(f"{c} = 'Yes'") for c in fx.SERVICE_COLUMNS)} AS active_services_count
FROM customers"""))
def p01_churn_features(spark, sf_dir):
    f = ft.churn_features(fx.customers(spark, sf_dir))
    return rounded(f.select("customerID", "TotalCharges", "tenure", "avg_monthly_spend", "tenure_group",
                            "is_month_to_month", "active_services_count"))


@register("p06_target_normalisation", with_ctes("""
SELECT customerID, CASE WHEN lower(trim(Churn)) IN ('yes', '1') THEN 1 WHEN lower(trim(Churn)) IN ('no', '0') THEN 0
       END AS target FROM customers"""))
def p06_target_normalisation(spark, sf_dir):
    c = fx.customers(spark, sf_dir)
    return c.select("customerID", ft.normalise_target("Churn").alias("target"))


def _targets(spark, sf_dir):
    """Target texts of customers, some of them written differently, some unknown, some absent."""
    c = fx.table(spark, sf_dir, "customer")
    told = F.array(*[F.lit(x) for x in (" Yes", "NO", "1", "0 ", "maybe", None, "no", "")])
    return c.select("c_custkey", F.get(told, (F.col("c_custkey") % 8).cast("int")).alias("target_text"))


@register("p06_unmapped_targets", """
SELECT [' Yes', 'NO', '1', '0 ', 'maybe', NULL, 'no', ''][c_custkey % 8 + 1] AS target_text, count(*) AS n_rows
FROM customer WHERE c_custkey % 8 IN (4, 5, 7) GROUP BY 1""")
def p06_unmapped_targets(spark, sf_dir):
    """Target texts that stand for no class, counted; a strict normalisation fails on them."""
    return quality.unmapped_targets(_targets(spark, sf_dir), "target_text")


@register("p07_fraud_features", with_ctes(f"""
SELECT user_id, {r6('CAST(transaction_amount AS DOUBLE)')} AS transaction_amount,
       CAST(hour(transaction_time) AS INTEGER) AS transaction_hour,
       CAST(isodow(transaction_time) - 1 AS INTEGER) AS transaction_dayofweek,
       {r6('CAST(previous_transactions_24h AS DOUBLE)')} AS previous_transactions_24h,
       {r6('transaction_amount / (avg_spend_7d + 1.0)')} AS amount_to_avg_ratio,
       {_sql_flag('previous_transactions_24h >= 8')} AS high_velocity_flag,
       {_sql_flag('hour(transaction_time) IN (0, 1, 2, 3, 4, 23)')} AS night_transaction,
       {_sql_flag('is_international = 1 AND card_present = 0')} AS intl_card_absent,
       payment_channel, label
FROM transactions"""))
def p07_fraud_features(spark, sf_dir):
    f = ft.fraud_features(fx.transactions(spark, sf_dir))
    return rounded(f.select("user_id", "transaction_amount", "transaction_hour", "transaction_dayofweek",
                            "previous_transactions_24h", "amount_to_avg_ratio", "high_velocity_flag",
                            "night_transaction", "intl_card_absent", "payment_channel", "label"))


@register("p17_category_codes", with_ctes("""
SELECT item_id, category, CAST(coalesce(code, -1) AS INTEGER) AS category_code
FROM catalog LEFT JOIN (SELECT category AS cat, dense_rank() OVER (ORDER BY category) - 1 AS code
                        FROM (SELECT DISTINCT category FROM catalog WHERE category IS NOT NULL)) ON category = cat"""))
def p17_category_codes(spark, sf_dir):
    return rs.category_codes(catalog(spark, sf_dir), "category", "category_code") \
        .select("item_id", "category", "category_code")


# ------------------------------------------------------------------ dedup / splits / samples
def _replayed_transactions(spark, sf_dir):
    tx = fx.transactions(spark, sf_dir)
    replay = tx.withColumn("transaction_amount", F.col("transaction_amount") * 2)
    return tx.withColumn("feed_order", F.lit(0)).unionByName(replay.withColumn("feed_order", F.lit(1)))


@register("d01_dedup_transactions", with_ctes(f"""
SELECT transaction_id, {r6('transaction_amount')} AS transaction_amount, feed_order FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY feed_order) AS rn FROM (
    SELECT transaction_id, transaction_amount, 0 AS feed_order FROM transactions
    UNION ALL SELECT transaction_id, transaction_amount * 2, 1 FROM transactions)) WHERE rn = 1"""))
def d01_dedup_transactions(spark, sf_dir):
    d = dedup.dedup_transactions(_replayed_transactions(spark, sf_dir), order_cols=["feed_order"])
    return rounded(d.select("transaction_id", "transaction_amount", "feed_order"))


@register("d03_dedup_items", with_ctes("""
SELECT item_id, title, catalog_order FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY catalog_order) AS rn FROM (
    SELECT item_id, title, catalog_order FROM items_raw
    UNION ALL SELECT item_id, upper(title), catalog_order + 1000000000 FROM items_raw)) WHERE rn = 1"""))
def d03_dedup_items(spark, sf_dir):
    it = fx.items(spark, sf_dir)
    twice = it.unionByName(it.withColumn("title", F.upper("title"))
                           .withColumn("catalog_order", F.col("catalog_order") + 1_000_000_000))
    return dedup.dedup_items(twice, order_cols=["catalog_order"]).select("item_id", "title", "catalog_order")


_HASH_TX = "md5('42|' || transaction_id)"


@register("d04_stratified_split", with_ctes(f"""
SELECT transaction_id, label, CASE WHEN rk < floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split
FROM (SELECT transaction_id, label, row_number() OVER (PARTITION BY label ORDER BY {_HASH_TX}) - 1 AS rk,
             count(*) OVER (PARTITION BY label) AS n FROM transactions)"""))
def d04_stratified_split(spark, sf_dir):
    s = splits.stratified_split(fx.transactions(spark, sf_dir), "label", ["transaction_id"], 0.2, 42)
    return s.select("transaction_id", "label", "split")


@register("d06_stratified_folds", with_ctes(f"""
SELECT transaction_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {_HASH_TX}) - 1) % 4 AS INTEGER)
       AS fold FROM transactions"""))
def d06_stratified_folds(spark, sf_dir):
    s = splits.stratified_folds(fx.transactions(spark, sf_dir), "label", ["transaction_id"], k=4, seed=42)
    return s.select("transaction_id", "label", "fold")


@register("d11_seeded_sample", with_ctes("""
SELECT customerID, tenure, Contract, Churn FROM customers ORDER BY md5('42|' || customerID) LIMIT 3"""))
def d11_seeded_sample(spark, sf_dir):
    return splits.seeded_sample(fx.customers(spark, sf_dir), ["customerID"], 3, 42) \
        .select("customerID", "tenure", "Contract", "Churn")


@register("d12_distinct_users", with_ctes("""
SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS n_distinct_user_id FROM prepared"""))
def d12_distinct_users(spark, sf_dir):
    return dedup.distinct_count(prepared_interactions(spark, sf_dir), "user_id")


# ------------------------------------------------------------------ profiling
def _describe_sql(cols: list[str], src: str) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS column_name, CAST(count({x}) AS BIGINT) AS count, {r6(f'avg({x})')} AS mean, "
                     f"{r6(f'stddev_samp({x})')} AS std, {r6(f'min({x})')} AS min, "
                     f"{r6(f'quantile_cont({x}, 0.25)')} AS p25, {r6(f'quantile_cont({x}, 0.5)')} AS p50, "
                     f"{r6(f'quantile_cont({x}, 0.75)')} AS p75, {r6(f'max({x})')} AS max FROM {src}")
    return _union(parts)


@register("x01_describe_numeric", with_ctes(_describe_sql(TX_NUMERIC, "transactions")))
def x01_describe_numeric(spark, sf_dir):
    d = profile.describe_numeric(fx.transactions(spark, sf_dir), TX_NUMERIC)
    return rounded(d.withColumnRenamed("column", "column_name"))


def _describe_cat_sql(cols: list[str], src: str) -> str:
    parts = [f"""SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS count,
       CAST(count(DISTINCT {c}) AS BIGINT) AS "unique",
       (SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
       (SELECT CAST(count(*) AS BIGINT) FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1)
       AS freq FROM {src}""" for c in cols]
    return _union(parts)


@register("x01_describe_categorical", with_ctes(_describe_cat_sql(TX_STRINGS, "transactions")))
def x01_describe_categorical(spark, sf_dir):
    return profile.describe_categorical(fx.transactions(spark, sf_dir), TX_STRINGS) \
        .withColumnRenamed("column", "column_name")


@register("x02_class_distribution", with_ctes(f"""
SELECT label, CAST(count(*) AS BIGINT) AS count, {r6('round(count(*) / (SELECT count(*) FROM transactions), 4)')} AS ratio
FROM transactions GROUP BY label"""))
def x02_class_distribution(spark, sf_dir):
    return rounded(profile.class_distribution(fx.transactions(spark, sf_dir), "label"))


def _missing_sql(cols: list[str], src: str) -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing, "
             f"{r6(f'CASE WHEN count(*) = 0 THEN 0.0 ELSE count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) END')}"
             f" AS missing_pct FROM {src}" for c in cols]
    return _union(parts)


CHURN_FEATURE_COLUMNS = CUSTOMER_COLUMNS + ["avg_monthly_spend", "tenure_group", "is_month_to_month",
                                            "active_services_count"]
SQL_CHURN_FEATURES = f"""
SELECT * REPLACE (TRY_CAST(TotalCharges AS DOUBLE) AS TotalCharges),
       TRY_CAST(TotalCharges AS DOUBLE) / (tenure + 1.0) AS avg_monthly_spend,
       {_sql_tenure_group('tenure')} AS tenure_group,
       {_sql_flag("Contract = 'Month-to-month'")} AS is_month_to_month,
       {" + ".join(_sql_flag(f"{c} = 'Yes'") for c in fx.SERVICE_COLUMNS)} AS active_services_count
FROM customers"""


@register("x03_missing_profile", with_ctes(_missing_sql(CHURN_FEATURE_COLUMNS, "churn_features"),
                                           {"churn_features": SQL_CHURN_FEATURES}))
def x03_missing_profile(spark, sf_dir):
    f = ft.churn_features(fx.customers(spark, sf_dir))
    return rounded(profile.missing_profile(f).withColumnRenamed("column", "column_name"))


X4_COLUMNS = ["user_id", "item_id", "rating", "interaction_type", "timestamp", *fx.INTERACTION_ORDER_COLS,
              "title", "genres", "category", "catalog_order"]


@register("x04_missing_profile_union", with_ctes(
    _missing_sql([f'"{c}"' if c == "timestamp" else c for c in X4_COLUMNS], "stacked").replace("'\"timestamp\"'",
                                                                                             "'timestamp'"),
    {"stacked": "SELECT * FROM interactions_raw UNION ALL BY NAME SELECT * FROM items_raw"}))
def x04_missing_profile_union(spark, sf_dir):
    p = profile.missing_profile_union(fx.interactions(spark, sf_dir), fx.items(spark, sf_dir))
    return rounded(p.withColumnRenamed("column", "column_name"))


@register("x05_pairwise_correlation", with_ctes(_union([
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r6(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS corr "
    f"FROM transactions" for i, a in enumerate(TX_NUMERIC) for b in TX_NUMERIC[i + 1:]])))
def x05_pairwise_correlation(spark, sf_dir):
    return rounded(profile.pairwise_correlation(fx.transactions(spark, sf_dir), TX_NUMERIC))


def _hist_sql(src: str, x: str, label: str | None, bins: int) -> str:
    keys = f"{label}, " if label else ""
    part = f"PARTITION BY {label}" if label else ""
    return f"""
SELECT {keys}bin, {r6(f'mn + (bin - 1) * ((mx - mn) / {bins})')} AS bin_lo, CAST(count(*) AS BIGINT) AS count,
       {r6(f"count(*) / (max(n) * CASE WHEN mx = mn THEN 1.0 ELSE (mx - mn) / {bins} END)")} AS density
FROM (SELECT {keys}CAST(CASE WHEN mx = mn THEN 1 ELSE least(floor((x - mn) / (mx - mn) * {bins}) + 1, {bins}) END
             AS INTEGER) AS bin, mn, mx, n
      FROM (SELECT {keys}CAST({x} AS DOUBLE) AS x, count(*) OVER ({part}) AS n,
                   (SELECT min(CAST({x} AS DOUBLE)) FROM {src}) AS mn, (SELECT max(CAST({x} AS DOUBLE)) FROM {src}) AS mx
            FROM {src} WHERE {x} IS NOT NULL))
GROUP BY {keys}bin, mn, mx"""


@register("x06_class_histogram", with_ctes(_hist_sql("transactions", "transaction_amount", "label", 30)))
def x06_class_histogram(spark, sf_dir):
    return rounded(profile.class_histogram(fx.transactions(spark, sf_dir), "transaction_amount", "label", 30))


@register("x07_kde_curve", with_ctes(f"""
WITH base AS (SELECT label, CAST(transaction_amount AS DOUBLE) AS x FROM transactions WHERE transaction_amount IS NOT NULL),
stats AS (SELECT label, count(*) AS n, stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), -0.2) AS bw,
                 min(x) AS lo, max(x) AS hi FROM base GROUP BY label),
grid AS (SELECT label, n, bw, lo - 3.0 * bw AS g0, ((hi + 3.0 * bw) - (lo - 3.0 * bw)) / 199 AS step FROM stats),
w AS (SELECT label, x, count(*) AS w FROM base GROUP BY label, x)
SELECT grid.label, CAST(g.g AS INTEGER) AS g, {r6('g0 + g.g * step')} AS x,
       {r6('sum(w * exp(-0.5 * ((g0 + g.g * step - w.x) / bw) * ((g0 + g.g * step - w.x) / bw)) / (n * bw * sqrt(2 * pi())))')} AS density
FROM w JOIN grid ON w.label = grid.label, range(0, 200) g(g)
GROUP BY grid.label, g.g, g0, step"""))
def x07_kde_curve(spark, sf_dir):
    return rounded(profile.kde_curve(fx.transactions(spark, sf_dir), "transaction_amount", "label", 200))


@register("x08_interactions_per_user_histogram", with_ctes(
    _hist_sql("per_user", "n_interactions", None, 25),
    {"per_user": "SELECT user_id, count(*) AS n_interactions FROM prepared GROUP BY user_id"}))
def x08_interactions_per_user_histogram(spark, sf_dir):
    per_user = profile.interactions_per_user(prepared_interactions(spark, sf_dir))
    return rounded(profile.class_histogram(per_user, "n_interactions", None, 25))


@register("x09_top_items_by_volume", with_ctes("""
SELECT item_id, CAST(count(*) AS BIGINT) AS count FROM prepared GROUP BY item_id ORDER BY count DESC, item_id LIMIT 12"""))
def x09_top_items_by_volume(spark, sf_dir):
    return profile.top_items_by_volume(prepared_interactions(spark, sf_dir), 12)


@register("x10_popular_items_with_titles", with_ctes(f"""
SELECT t.item_id, count, {r6('avg_rating')} AS avg_rating, title, genres FROM (
  SELECT item_id, CAST(count(*) AS BIGINT) AS count, avg(rating) AS avg_rating FROM interactions_raw GROUP BY item_id
  ORDER BY count DESC, item_id LIMIT 10) t LEFT JOIN items_raw i ON t.item_id = i.item_id"""))
def x10_popular_items_with_titles(spark, sf_dir):
    return rounded(profile.popular_items_with_titles(fx.interactions(spark, sf_dir), fx.items(spark, sf_dir), 10))


@register("x11_item_pearson", with_ctes(f"""
WITH m AS (SELECT user_id, item_id, avg(signal) AS r FROM train GROUP BY user_id, item_id),
nu AS (SELECT CAST(count(DISTINCT user_id) AS DOUBLE) AS n FROM m),
s AS (SELECT item_id, sum(r) AS sx, sum(r * r) AS sxx FROM m GROUP BY item_id),
p AS (SELECT a.item_id AS a, b.item_id AS b, sum(a.r * b.r) AS sxy FROM m a JOIN m b ON a.user_id = b.user_id
      AND a.item_id <> b.item_id WHERE a.item_id IN (SELECT item_id FROM asked_items) GROUP BY 1, 2)
SELECT p.a, p.b, {r6('CASE WHEN den > 0 THEN num / den END')} AS corr FROM (
  SELECT p.a, p.b, n * sxy - sa.sx * sb.sx AS num,
         sqrt((n * sa.sxx - sa.sx * sa.sx) * (n * sb.sxx - sb.sx * sb.sx)) AS den
  FROM p JOIN s sa ON p.a = sa.item_id JOIN s sb ON p.b = sb.item_id, nu) p"""))
def x11_item_pearson(spark, sf_dir):
    return rounded(profile.item_pearson(requested_items(spark, sf_dir), interaction_matrix(spark, sf_dir)))


@register("x12_catalog_coverage", with_ctes(f"""
SELECT CAST(u AS BIGINT) AS items_interacted, CAST(t AS BIGINT) AS catalog_items,
       {r6('CASE WHEN t = 0 THEN 0.0 ELSE u / t END')} AS coverage
FROM (SELECT count(DISTINCT item_id) AS u FROM interactions_raw), (SELECT count(DISTINCT item_id) AS t FROM items_raw)"""))
def x12_catalog_coverage(spark, sf_dir):
    return rounded(profile.catalog_coverage(fx.interactions(spark, sf_dir), fx.items(spark, sf_dir)))


@register("x13_head_share", with_ctes(f"""
WITH c AS (SELECT item_id, count(*) AS cnt FROM interactions_raw GROUP BY item_id),
r AS (SELECT cnt, row_number() OVER (ORDER BY cnt DESC, item_id) AS rk FROM c)
SELECT CAST(sum(CASE WHEN rk <= greatest(1, floor((SELECT count(*) FROM c) * 0.2)) THEN cnt ELSE 0 END) AS BIGINT)
       AS head_interactions, CAST(sum(cnt) AS BIGINT) AS total_interactions,
       {r6('sum(CASE WHEN rk <= greatest(1, floor((SELECT count(*) FROM c) * 0.2)) THEN cnt ELSE 0 END) / sum(cnt)')}
       AS head_share FROM r"""))
def x13_head_share(spark, sf_dir):
    return rounded(profile.head_share(fx.interactions(spark, sf_dir)))


@register("x14_popularity_curve", with_ctes("""
SELECT item_id, CAST(count(*) AS BIGINT) AS count,
       CAST(row_number() OVER (ORDER BY count(*) DESC, item_id) AS BIGINT) AS rank
FROM interactions_raw GROUP BY item_id"""))
def x14_popularity_curve(spark, sf_dir):
    return profile.popularity_curve(fx.interactions(spark, sf_dir))
