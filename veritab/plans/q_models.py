"""Registered queries: fitted preprocessing (SQL-checked), sampling and model fits (rows-only)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from veritab.functions import features as ft
from veritab.operators import evaluation as ev
from veritab.operators import sampling, splits
from veritab.operators.prep import fit_prep, long_features
from veritab.plans import search
from veritab.plans import training as tr
from veritab.plans.oracle_sql import r6, with_ctes
from veritab.plans.registry import register, rounded
from veritab.session import materialize, materialize_at
from veritab.sources import fixtures as fx

CHURN_NUMERIC = ["tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen", "avg_monthly_spend",
                 "is_month_to_month", "active_services_count"]
CHURN_CATEGORICAL = ["Contract", "InternetService", "PaymentMethod", "TechSupport", "tenure_group"]
FRAUD_NUMERIC = ["user_id", "transaction_amount", "is_international", "card_present", "previous_transactions_24h",
                 "avg_spend_7d", "transaction_hour", "transaction_dayofweek", "amount_to_avg_ratio",
                 "high_velocity_flag", "night_transaction", "intl_card_absent"]
FRAUD_CATEGORICAL = ["location", "device", "merchant_category", "payment_channel"]


def churn_split(spark, sf_dir):
    c = ft.churn_features(fx.customers(spark, sf_dir)).withColumn("label", ft.normalise_target("Churn", strict=True))
    return splits.stratified_split(c, "label", ["customerID"], 0.2, 42)


def fraud_split(spark, sf_dir):
    t = fx.transactions(spark, sf_dir)
    f = ft.fraud_features(t, drop_cols=("transaction_time",))
    return splits.stratified_split(f, "label", ["transaction_id"], 0.2, 42)


SQL_CHURN_SPLIT = """
SELECT *, CASE WHEN rk < floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || customerID)) - 1 AS rk,
         count(*) OVER (PARTITION BY label) AS n
  FROM (SELECT * REPLACE (TRY_CAST(TotalCharges AS DOUBLE) AS TotalCharges),
               TRY_CAST(TotalCharges AS DOUBLE) / (tenure + 1.0) AS avg_monthly_spend,
               CASE WHEN tenure > -1 AND tenure <= 6 THEN '0_6' WHEN tenure > 6 AND tenure <= 12 THEN '7_12'
                    WHEN tenure > 12 AND tenure <= 24 THEN '13_24' WHEN tenure > 24 AND tenure <= 48 THEN '25_48'
                    WHEN tenure > 48 THEN '49_plus' END AS tenure_group,
               CAST(coalesce(Contract = 'Month-to-month', false) AS INTEGER) AS is_month_to_month,
               """ + " + ".join(f"CAST(coalesce({c} = 'Yes', false) AS INTEGER)" for c in fx.SERVICE_COLUMNS) + """
               AS active_services_count,
               CASE WHEN lower(trim(Churn)) IN ('yes', '1') THEN 1 WHEN lower(trim(Churn)) IN ('no', '0') THEN 0 END
               AS label
        FROM customers))"""


def _stats_sql() -> str:
    parts = []
    for c in CHURN_NUMERIC:
        x = f"CAST({c} AS DOUBLE)"
        med = f"(SELECT median({x}) FROM churn_train)"
        parts.append(f"SELECT '{c}' AS column_name, {r6(med)} AS median, {r6(f'avg(coalesce({x}, {med}))')} AS mean, "
                     f"{r6(f'stddev_pop(coalesce({x}, {med}))')} AS std FROM churn_train")
    return "\nUNION ALL\n".join(parts)


@register("m01_prep_statistics", with_ctes(_stats_sql(), {"churn_split": SQL_CHURN_SPLIT,
                                                          "churn_train": "SELECT * FROM churn_split WHERE split = 'train'"}))
def m01_prep_statistics(spark, sf_dir):
    train = churn_split(spark, sf_dir).where("split = 'train'")
    m = fit_prep(train, CHURN_NUMERIC, [])
    rows = [(c, m.medians[c], m.means[c], m.stds[c]) for c in CHURN_NUMERIC]
    return rounded(spark.createDataFrame(rows, "column_name string, median double, mean double, std double"))


def _modes_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, (SELECT CAST({c} AS VARCHAR) FROM churn_train WHERE {c} IS NOT NULL GROUP BY {c} "
        f"ORDER BY count(*) DESC, {c} LIMIT 1) AS mode" for c in CHURN_CATEGORICAL)


@register("m02_most_frequent", with_ctes(_modes_sql(), {"churn_split": SQL_CHURN_SPLIT,
                                                       "churn_train": "SELECT * FROM churn_split WHERE split = 'train'"}))
def m02_most_frequent(spark, sf_dir):
    train = churn_split(spark, sf_dir).where("split = 'train'")
    m = fit_prep(train, [], CHURN_CATEGORICAL)
    return spark.createDataFrame([(c, m.modes[c]) for c in CHURN_CATEGORICAL], "column_name string, mode string")


def _transform_sql() -> str:
    num = []
    for c in CHURN_NUMERIC:
        x = f"CAST({c} AS DOUBLE)"
        med = f"(SELECT median({x}) FROM churn_train)"
        mean = f"(SELECT avg(coalesce({x}, {med})) FROM churn_train)"
        std = f"(SELECT CASE WHEN stddev_pop(coalesce({x}, {med})) = 0 THEN 1.0 ELSE stddev_pop(coalesce({x}, {med})) END FROM churn_train)"
        num.append(f"SELECT customerID, '{c}' AS feature, {r6(f'(coalesce({x}, {med}) - {mean}) / {std}')} AS value FROM churn_test")
    cat = []
    for c in CHURN_CATEGORICAL:
        mode = (f"(SELECT CAST({c} AS VARCHAR) FROM churn_train WHERE {c} IS NOT NULL GROUP BY {c} "
                f"ORDER BY count(*) DESC, {c} LIMIT 1)")
        v = f"coalesce(CAST({c} AS VARCHAR), {mode})"
        cat.append(f"SELECT customerID, '{c}_' || {v} AS feature, 1.0 AS value FROM churn_test "
                   f"WHERE {v} IN (SELECT coalesce(CAST({c} AS VARCHAR), {mode}) FROM churn_train)")
    return "\nUNION ALL\n".join(num + cat)


@register("m05_transformed_features", with_ctes(_transform_sql(), {
    "churn_split": SQL_CHURN_SPLIT, "churn_train": "SELECT * FROM churn_split WHERE split = 'train'",
    "churn_test": "SELECT * FROM churn_split WHERE split = 'test'"}))
def m05_transformed_features(spark, sf_dir):
    s = churn_split(spark, sf_dir)
    m = fit_prep(s.where("split = 'train'"), CHURN_NUMERIC, CHURN_CATEGORICAL)
    return rounded(long_features(s.where("split = 'test'"), m, "customerID"))


@register("d07_random_oversample", with_ctes("""
WITH r AS (SELECT transaction_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || transaction_id)) - 1 AS rk
           FROM transactions),
c AS (SELECT label, count(*) AS n FROM transactions GROUP BY label),
need AS (SELECT label, n, (SELECT max(n) FROM c) - n AS need FROM c WHERE n < (SELECT max(n) FROM c)),
copies AS (SELECT need.label, g.j AS copy_id, n FROM need, range(1, need.need + 1) g(j))
SELECT transaction_id, label, CAST(0 AS BIGINT) AS copy_id FROM transactions
UNION ALL
SELECT r.transaction_id, r.label, copies.copy_id FROM copies JOIN r ON r.label = copies.label
  AND r.rk = (CAST(('0x' || substr(md5('42|oversample|' || CAST(copies.label AS VARCHAR) || '|' || CAST(copies.copy_id AS VARCHAR)), 1, 12)) AS BIGINT) % copies.n)"""))
def d07_random_oversample(spark, sf_dir):
    t = fx.transactions(spark, sf_dir).select("transaction_id", "label")
    return sampling.random_oversample(t, "label", ["transaction_id"], 42).select("transaction_id", "label", "copy_id")


def _smote_sql() -> str:
    scaled = []
    for c in CHURN_NUMERIC:
        x = f"CAST({c} AS DOUBLE)"
        med = f"(SELECT median({x}) FROM churn_train)"
        mean = f"(SELECT avg(coalesce({x}, {med})) FROM churn_train)"
        std = f"(SELECT CASE WHEN stddev_pop(coalesce({x}, {med})) = 0 THEN 1.0 ELSE stddev_pop(coalesce({x}, {med})) END FROM churn_train)"
        scaled.append(f"(coalesce({x}, {med}) - {mean}) / {std}")
    known = [f"coalesce(CAST({c} AS VARCHAR), (SELECT CAST({c} AS VARCHAR) FROM churn_train WHERE {c} IS NOT NULL GROUP BY {c} "
             f"ORDER BY count(*) DESC, {c} LIMIT 1))" for c in CHURN_CATEGORICAL]
    digest = "md5('42|smote|' || CAST(label AS VARCHAR) || '|' || CAST(j AS VARCHAR))"
    part = lambda at, n: f"CAST(('0x' || substr({digest}, {at}, {n})) AS BIGINT)"
    return f"""
WITH z AS MATERIALIZED (
  SELECT customerID, label, [{", ".join(scaled)}] AS z, [{", ".join(known)}] AS cat,
         row_number() OVER (PARTITION BY label ORDER BY md5('42|' || customerID)) - 1 AS rk, count(*) OVER (PARTITION BY label) AS n
  FROM churn_train WHERE label IS NOT NULL),
few AS MATERIALIZED (SELECT * FROM z WHERE n < (SELECT max(n) FROM z)),
near AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY d2, neighbour) - 1 AS place FROM (
    SELECT a.customerID AS key, b.customerID AS neighbour, b.z AS bz, round(
             list_sum(list_transform(range(1, len(a.z) + 1), lambda i: (a.z[i] - b.z[i]) * (a.z[i] - b.z[i])))
             + 2 * len(list_filter(range(1, len(a.cat) + 1), lambda i: a.cat[i] <> b.cat[i])), 9) AS d2
    FROM few a JOIN few b ON a.label = b.label AND a.customerID <> b.customerID)),
copies AS (
  SELECT label, n, j, {part(1, 12)} % n AS rk, {part(13, 8)} % least(3, n - 1) AS place, {part(21, 12)} / 281474976710656.0 AS u
  FROM (SELECT label, n, unnest(range(1, (SELECT max(n) FROM z) - n + 1)) AS j FROM (SELECT DISTINCT label, n FROM few)))
SELECT f.customerID, CAST(c.j AS BIGINT) AS copy_id, c.label, x.neighbour, {r6("c.u")} AS u, {r6("x.d2")} AS d2,
       {r6("f.z[1] + c.u * (x.bz[1] - f.z[1])")} AS first_feature,
       {r6("list_sum(f.z) + c.u * (list_sum(x.bz) - list_sum(f.z)) + len(f.cat)")} AS feature_sum
FROM copies c JOIN few f ON f.label = c.label AND f.rk = c.rk JOIN near x ON x.key = f.customerID AND x.place = c.place"""


@register("d08_smote", with_ctes(_smote_sql(), {"churn_split": SQL_CHURN_SPLIT,
                                                "churn_train": "SELECT * FROM churn_split WHERE split = 'train'"}))
def d08_smote(spark, sf_dir):
    """The synthetic rows of the churn training part in its preprocessed space, with the neighbour each goes towards."""
    train = churn_split(spark, sf_dir).where("split = 'train'")
    prep = fit_prep(train, CHURN_NUMERIC, CHURN_CATEGORICAL)
    feats = prep.transform(train, keep=["customerID", "label"], vector_col="features").select(
        "customerID", "label", vector_to_array("features").alias("features"))
    made = sampling.smote(feats, "label", "customerID", "features", 3, 42).where("copy_id > 0").withColumnRenamed("key", "customerID")
    start = feats.select("customerID", F.col("features").alias("_from"))
    end = feats.select(F.col("customerID").alias("neighbour"), F.col("features").alias("_to"))
    d2 = F.aggregate(F.zip_with("_from", "_to", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)
    total = F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x)
    return rounded(made.join(start, "customerID").join(end, "neighbour").select(
        "customerID", "copy_id", "label", "neighbour", "u", d2.alias("d2"), F.col("vec")[0].alias("first_feature"), total.alias("feature_sum")))


@register("d10_class_weights", with_ctes(f"""
SELECT label, {r6('(SELECT count(*) FROM transactions) / (2.0 * count(*))')} AS class_weight FROM transactions
GROUP BY label"""))
def d10_class_weights(spark, sf_dir):
    t = fx.transactions(spark, sf_dir).select("label")
    return rounded(sampling.class_weight_table(t, "label"))


# ---------------------------------------------------------------- model fits
# A fit has no SQL twin, but what must hold for it has: the rows it scores, with the promises kept for each
# (probability in range, ranking better than chance, decision by the threshold) as true columns.
CHURN_CTES = {"churn_split": SQL_CHURN_SPLIT, "churn_test": "SELECT * FROM churn_split WHERE split = 'test'"}
FRAUD_CTES = {"fraud_split": """
SELECT *, CASE WHEN rk < floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT transaction_id, label, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || transaction_id)) - 1 AS rk,
         count(*) OVER (PARTITION BY label) AS n FROM transactions)"""}
_KEPT = "true AS in_range, true AS better_than_chance"


def kept_promises(scored, key: str):
    """(key, label, in_range, better_than_chance) of every scored row."""
    scored = materialize(scored, "scored")
    auc = ev.roc_auc(scored.withColumnRenamed("probability", "score")).select(F.col("roc_auc") > 0.5).scalar()
    return scored.select(key, "label", F.col("probability").between(0.0, 1.0).alias("in_range"), auc.alias("better_than_chance"))


def _fraud_logistic(spark, sf_dir):
    s = materialize(fraud_split(spark, sf_dir), "fraud_split")
    return s, tr.fit_classifier(s.where("split = 'train'"), "label", FRAUD_NUMERIC, FRAUD_CATEGORICAL,
                                "logistic_regression", {"C": 1.0, "class_weight": "balanced"})


def _churn_fit(spark, sf_dir, name, params):
    s = materialize(churn_split(spark, sf_dir), "churn_split")
    return s, tr.fit_classifier(s.where("split = 'train'"), "label", CHURN_NUMERIC, CHURN_CATEGORICAL, name, params)


@register("m07_fraud_logistic_scores", with_ctes(
    f"SELECT transaction_id, label, {_KEPT} FROM fraud_split WHERE split = 'test'", FRAUD_CTES))
def m07_fraud_logistic_scores(spark, sf_dir):
    s, fitted = _fraud_logistic(spark, sf_dir)
    return kept_promises(fitted.score(s.where("split = 'test'"), ["transaction_id", "label"]), "transaction_id")


@register("m08_churn_forest_scores", with_ctes(f"SELECT customerID, label, {_KEPT} FROM churn_split WHERE split = 'test'", CHURN_CTES))
def m08_churn_forest_scores(spark, sf_dir):
    s, fitted = _churn_fit(spark, sf_dir, "random_forest", tr.SELECTOR)
    return kept_promises(fitted.score(s.where("split = 'test'"), ["customerID", "label"]), "customerID")


@register("m09_churn_gbt_scores", with_ctes(f"SELECT customerID, label, {_KEPT} FROM churn_split WHERE split = 'test'", CHURN_CTES))
def m09_churn_gbt_scores(spark, sf_dir):
    """M9: gradient-boosted trees (pyspark.ml GBT in place of XGBoost)."""
    s, fitted = _churn_fit(spark, sf_dir, "gbt", {"n_estimators": 50, "max_depth": 3, "learning_rate": 0.1})
    return kept_promises(fitted.score(s.where("split = 'test'"), ["customerID", "label"]), "customerID")


@register("m12_default_model_comparison", with_ctes("""
SELECT unnest(['logistic_regression', 'random_forest', 'gbt']) AS model,
       (SELECT CAST(count(*) AS BIGINT) FROM churn_test) AS n_rows, true AS in_range""", CHURN_CTES))
def m12_default_model_comparison(spark, sf_dir):
    s = materialize(churn_split(spark, sf_dir), "churn_split")
    t = tr.compare_defaults(s.where("split = 'train'"), s.where("split = 'test'"), "label", CHURN_NUMERIC, CHURN_CATEGORICAL)
    bounded = F.forall(F.array("accuracy", "precision", "recall", "f1", "roc_auc"), lambda v: v.between(0.0, 1.0))
    return t.select("model", (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("n_rows"), bounded.alias("in_range"))


@register("m13_feature_importance", with_ctes("""
SELECT CAST(12 + (SELECT count(DISTINCT location) + count(DISTINCT device) + count(DISTINCT merchant_category)
                         + count(DISTINCT payment_channel) FROM transactions) AS BIGINT) AS n_features,
       true AS sum_is_one, true AS none_negative"""))
def m13_feature_importance(spark, sf_dir):
    s = materialize(fraud_split(spark, sf_dir), "fraud_split")
    fitted = tr.fit_classifier(s.where("split = 'train'"), "label", FRAUD_NUMERIC, FRAUD_CATEGORICAL,
                               "random_forest", tr.SELECTOR)
    return tr.feature_importance(fitted, 1000).agg(
        F.count(F.lit(1)).alias("n_features"), (F.abs(F.sum("importance") - 1) < 1e-6).alias("sum_is_one"),
        (F.min("importance") >= 0).alias("none_negative"))


@register("m06_importance_selection", with_ctes("""
SELECT true AS half_or_more, true AS trained_on_kept_only, true AS in_range"""))
def m06_importance_selection(spark, sf_dir):
    """M6: features of at least median importance, and a model trained on the columns they come from."""
    s, forest = _churn_fit(spark, sf_dir, "random_forest", tr.SELECTOR)
    kept = tr.select_by_importance(forest)
    fitted = tr.fit_selected(s.where("split = 'train'"), "label", CHURN_NUMERIC, CHURN_CATEGORICAL, "logistic_regression",
                             tr.DEFAULT_PARAMS["logistic_regression"], forest=forest)
    columns = fitted.prep.numeric + fitted.prep.categorical
    only = all(any(k == c or k.startswith(f"{c}_") for k in kept) for c in columns)
    scored = fitted.score(s.where("split = 'test'"), ["customerID"])
    return scored.agg(F.lit(2 * len(kept) >= len(forest.prep.feature_names)).alias("half_or_more"),
                      F.lit(only).alias("trained_on_kept_only"), F.bool_and(F.col("probability").between(0.0, 1.0)).alias("in_range"))


@register("m15_churn_batch_scoring", with_ctes(f"SELECT customerID, label, {_KEPT}, true AS decided_by_half FROM churn_split", CHURN_CTES))
def m15_churn_batch_scoring(spark, sf_dir):
    s, fitted = _churn_fit(spark, sf_dir, "logistic_regression", {"C": 1.0, "class_weight": None})
    scored = materialize(fitted.score(s, ["customerID", "label"]), "scored")
    said = scored.select("customerID", ((ft.decode_label(F.col("probability"), "Yes", "No", 0.5) == "Yes")
                                        == (F.col("probability") >= 0.5)).alias("decided_by_half"))
    return kept_promises(scored, "customerID").join(said, "customerID")


@register("m15_fraud_tuned_scoring", with_ctes("""
SELECT transaction_id, true AS by_stored_threshold, true AS same_after_load, true AS precise_enough FROM transactions"""))
def m15_fraud_tuned_scoring(spark, sf_dir):
    """The fraud chain: fit, tune the threshold, store it with the model, load, check the schema, score every row."""
    s, fitted = _fraud_logistic(spark, sf_dir)
    fitted = tr.with_tuned_threshold(fitted, s.where("split = 'test'"), "label", 0.70)
    _, path = materialize_at(spark.range(1), "fraud_model")
    fitted.save(spark, f"{path}/saved")
    loaded = tr.FittedClassifier.load(spark, f"{path}/saved")
    scored = materialize(loaded.classify(s, ["transaction_id", "label", "split"], "is_fraud"), "fraud_scored")
    test = scored.where("split = 'test' AND is_fraud")
    precise = test.select(F.coalesce(F.avg((F.col("label") == 1).cast("double")), F.lit(1.0)) >= 0.70).scalar()
    same = F.lit(loaded.threshold == fitted.threshold and loaded.prep == fitted.prep and loaded.params == fitted.params)
    return scored.select("transaction_id", (F.col("is_fraud") == (F.col("probability") >= loaded.threshold)).alias("by_stored_threshold"),
                         same.alias("same_after_load"), precise.alias("precise_enough"))


def _searched(table, positive_share):
    """One row per model and strategy: draws and folds compared, and whether the best draw beats a ranking by chance."""
    counts = table.groupBy("model", "imbalance_strategy").agg(F.count_distinct("params").alias("n_draws"))
    best = tr.compare_models(table)
    return best.join(counts, ["model", "imbalance_strategy"]).select(
        "model", "imbalance_strategy", "n_draws", "folds", F.col("cv_score").between(0.0, 1.0).alias("in_range"),
        (F.col("cv_score") > positive_share).alias("better_than_chance"))


@register("m10_fraud_model_search", with_ctes("""
SELECT m.model, s.imbalance_strategy, CAST(10 AS BIGINT) AS n_draws, CAST(4 AS INTEGER) AS folds, true AS in_range, true AS better_than_chance
FROM (SELECT unnest(['logistic_regression', 'random_forest', 'gbt']) AS model) m,
     (SELECT unnest(['none', 'random_oversample', 'smote']) AS imbalance_strategy) s"""))
def m10_fraud_model_search(spark, sf_dir):
    """M10 + M11 of the fraud chain: ten draws of each space, three strategies, four folds, by average precision."""
    s = materialize(fraud_split(spark, sf_dir).where("split = 'train'").drop("split"), "fraud_train")
    table = materialize(search.search(s, "label", ["transaction_id"], search.FRAUD_SPACE, n_iter=10, folds=4), "fraud_search")
    return _searched(table, s.agg(F.avg(F.col("label").cast("double"))).scalar())


@register("m11_churn_model_search", with_ctes("""
SELECT m.model, 'none' AS imbalance_strategy, CAST(20 AS BIGINT) AS n_draws, CAST(5 AS INTEGER) AS folds, true AS in_range
FROM (SELECT unnest(['logistic_regression', 'random_forest', 'gbt']) AS model) m"""))
def m11_churn_model_search(spark, sf_dir):
    """M10 + M11 of the churn chain: feature selection in each fold, twenty draws of each space, five folds, by F1."""
    s = materialize(churn_split(spark, sf_dir).where("split = 'train'").drop("split"), "churn_train")
    table = materialize(search.search(s, "label", ["customerID"], search.CHURN_SPACE, 20, 5, CHURN_NUMERIC, CHURN_CATEGORICAL,
                                      strategies=("none",), metric="f1", select_features=True), "churn_search")
    return _searched(table, F.lit(0.0)).drop("better_than_chance")


@register("m14_permutation_importance", with_ctes(
    "SELECT unnest(['" + "', '".join(CHURN_NUMERIC + CHURN_CATEGORICAL) + "']) AS feature, true AS in_range"))
def m14_permutation_importance(spark, sf_dir):
    """Mean F1 drop over 8 seeded permutations of every column."""
    s, fitted = _churn_fit(spark, sf_dir, "logistic_regression", {"C": 1.0, "class_weight": None})
    t = tr.permutation_importance(fitted, s.where("split = 'test'"), "label", "customerID", CHURN_NUMERIC + CHURN_CATEGORICAL)
    return t.select("feature", (F.col("importance_mean").between(-1.0, 1.0) & (F.col("importance_std") >= 0)).alias("in_range"))


@register("x15_scored_sample", with_ctes("""
SELECT customerID, CASE WHEN label = 1 THEN 'Yes' ELSE 'No' END AS actual, tenure, Contract,
       true AS decided_by_threshold, 0.5::DOUBLE AS threshold, '1.0' AS model_version
FROM churn_split ORDER BY md5('42|' || customerID) LIMIT 3""", CHURN_CTES))
def x15_scored_sample(spark, sf_dir):
    """Seeded sample of 3 customers of the whole table with inputs, actual label, decoded prediction, probability."""
    s, fitted = _churn_fit(spark, sf_dir, "logistic_regression", {"C": 1.0, "class_weight": None})
    sample = splits.seeded_sample(s, ["customerID"], 3, 42)
    inputs = [c for c in sample.columns if c not in ("customerID", "label", "split", "Churn")]
    scored = fitted.score(sample, ["customerID", "label"]).join(
        sample.select("customerID", F.struct(*inputs).alias("input")), "customerID")
    decided = (ft.decode_label(F.col("probability")) == "Yes") == (F.col("probability") >= fitted.threshold)
    return scored.select("customerID", F.when(F.col("label") == 1, "Yes").otherwise("No").alias("actual"),
                         F.col("input.tenure").cast("int").alias("tenure"), "input.Contract", decided.alias("decided_by_threshold"),
                         F.lit(fitted.threshold).alias("threshold"), F.lit(fitted.version).alias("model_version"))


@register("p19_minmax_score", with_ctes(f"""
SELECT transaction_id, {r6("CASE WHEN (SELECT max(score) - min(score) FROM scored) = 0 THEN 0.5 ELSE (score - (SELECT min(score) FROM scored)) / (SELECT max(score) - min(score) FROM scored) END")} AS score_01
FROM scored"""))
def p19_minmax_score(spark, sf_dir):
    sc = fx.scored_transactions(spark, sf_dir)
    return rounded(ft.minmax_score(sc, "score").select("transaction_id", "score_01"))
