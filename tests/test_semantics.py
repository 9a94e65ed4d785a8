"""Hand goldens for the pandas/sklearn vs Spark semantic decisions (S-table of the design notes)."""

import math

from pyspark.sql import functions as F

from veritab.functions import features as ft
from veritab.operators import dedup, evaluation as ev, prep, splits
from veritab.operators.recsys import signals as rs


def test_s1_s2_s3_coercion_division_flags(spark):
    df = spark.createDataFrame([("12.5", "0", "Month-to-month"), (" ", "-1", None), ("abc", "3", "One year")],
                               "TotalCharges string, tenure string, Contract string")
    out = ft.churn_features(df).collect()
    assert out[0]["TotalCharges"] == 12.5 and out[1]["TotalCharges"] is None and out[2]["TotalCharges"] is None
    assert out[0]["avg_monthly_spend"] == 12.5
    assert out[1]["avg_monthly_spend"] is None          # tenure -1 -> division by zero -> NULL
    assert [r["is_month_to_month"] for r in out] == [1, 0, 0]   # NULL comparison -> 0


def test_s4_weekday_monday_zero(spark):
    df = spark.createDataFrame([("tx1", "2024-01-31 21:32:00"), ("tx2", "2024-02-04 23:00:00"), ("tx3", "bad")],
                               "transaction_id string, transaction_time string")
    df = df.withColumns({c: F.lit(1) for c in ("transaction_amount", "avg_spend_7d", "previous_transactions_24h",
                                               "is_international", "card_present")})
    out = ft.fraud_features(df).orderBy("transaction_amount").collect()
    days = sorted((r["transaction_dayofweek"], r["transaction_hour"], r["night_transaction"]) for r in out
                  if r["transaction_dayofweek"] is not None)
    assert days == [(2, 21, 0), (6, 23, 1)]
    assert sum(1 for r in out if r["transaction_hour"] is None) == 1


def test_s5_tenure_bins_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in [-1.0, 0.0, 6.0, 6.5, 12.0, 48.0, 48.1]], "tenure double")
    out = [r[0] for r in df.select(ft.tenure_group(F.col("tenure"))).collect()]
    assert out == [None, "0_6", "0_6", "7_12", "7_12", "25_48", "49_plus"]


def test_s6_s7_s8_s9_prep(spark):
    df = spark.createDataFrame([(1.0, "b"), (3.0, "a"), (None, "b"), (10.0, "a"), (2.0, None)], "x double, c string")
    m = prep.fit_prep(df, ["x"], ["c"])
    assert m.medians["x"] == 2.5                      # mean of the two middle values
    assert m.modes["c"] == "a"                        # tie -> smallest value
    imputed = [1.0, 3.0, 2.5, 10.0, 2.0]
    mean = sum(imputed) / 5
    std = math.sqrt(sum((v - mean) ** 2 for v in imputed) / 5)   # population std
    assert abs(m.means["x"] - mean) < 1e-12 and abs(m.stds["x"] - std) < 1e-12
    new = spark.createDataFrame([(None, "z")], "x double, c string")
    row = m.transform(new).collect()[0]
    assert abs(row["x"] - (2.5 - mean) / std) < 1e-12
    assert row["c_a"] == 0.0 and row["c_b"] == 0.0    # unseen category -> all zeros
    const = prep.fit_prep(spark.createDataFrame([(5.0,), (5.0,)], "x double"), ["x"], [])
    assert const.transform(spark.createDataFrame([(5.0,)], "x double")).collect()[0]["x"] == 0.0


def test_s10_keep_first_is_deterministic(spark):
    rows = [("t1", 2, 10.0), ("t1", 1, 20.0), ("t2", 5, 1.0), ("t1", 3, 30.0)]
    df = spark.createDataFrame(rows, "id string, pos int, amount double")
    for d in (df, df.repartition(3), df.orderBy(F.desc("pos"))):
        out = {r["id"]: r["amount"] for r in dedup.keep_first(d, ["id"], ["pos"]).collect()}
        assert out == {"t1": 20.0, "t2": 1.0}


def test_s12_split_exact_and_stratified(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 10 == 0).cast("int")
                                  .alias("label"))
    a = splits.stratified_split(df, "label", ["k"], 0.2, 42)
    b = splits.stratified_split(df.repartition(7), "label", ["k"], 0.2, 42)
    counts = {(r["label"], r["split"]): r["count"] for r in a.groupBy("label", "split").count().collect()}
    assert counts[(1, "test")] == 20 and counts[(0, "test")] == 180
    assert sorted(r.k for r in a.where("split = 'test'").collect()) == \
        sorted(r.k for r in b.where("split = 'test'").collect())


def test_s13_average_precision_is_stepwise(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.6), (1, 0.5), (0, 0.4)], "label int, score double")
    ap = ev.average_precision(df).collect()[0][0]
    assert abs(ap - (1.0 + 2 / 3 + 3 / 5) / 3) < 1e-12      # 0.7556, not the trapezoid
    auc = ev.roc_auc(df).collect()[0][0]
    assert abs(auc - 6 / 9) < 1e-12


def test_s17_null_type_weighs_one(spark):
    df = spark.createDataFrame([(1, "i1", None, None, "2024-01-01 00:00:00"), (1, "i2", None, "Click", None)],
                               "user_id long, item_id string, rating double, interaction_type string, timestamp string")
    out = {r["item_id"]: r["signal"] for r in rs.add_signal(df).collect()}
    assert out == {"i1": 1.0, "i2": 2.5}
