"""Plan checks: no cartesian products / nested-loop joins / Python UDFs in the scale-critical queries,
and stream = batch parity for the streaming operators."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SMALL

CRITICAL = ["r19_hybrid_top10", "r23_evaluate", "r24_tune_weights", "r29_recommend_requests", "e04_roc_curve",
            "e06_pr_curve", "e09_f1_threshold_grid", "d04_stratified_split", "d07_random_oversample",
            "x07_kde_curve", "x14_popularity_curve", "r10_cf_recommend"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CRITICAL)
def test_no_cartesian_or_python(spark, name):
    plan = _plan(entry.queries()[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


def test_global_ranks_have_no_unpartitioned_window_over_rows(spark):
    # the ROC curve's running sums partition by the range of the score
    plan = _plan(entry.queries()["e04_roc_curve"](spark, SMALL))
    assert "Window" in plan and "_range" in plan


def test_stream_dedup_keeps_every_id_of_an_unordered_feed(spark):
    from veritab.session import materialize_at
    from veritab.sources import fixtures as fx
    from veritab.streaming import scoring as st

    tx = fx.transactions(spark, SMALL).select("transaction_id", "user_id", "transaction_time", "transaction_amount")
    feed, folder = materialize_at(tx.unionByName(tx).orderBy(F.desc("transaction_time")).repartition(5, "transaction_amount"), "test_replay")
    got = st.run_dedup(st.read_parquet_stream(spark, folder, feed.schema))
    assert sorted(r[0] for r in got.select("transaction_id").collect()) == sorted(r[0] for r in tx.select("transaction_id").collect())
    assert got.exceptAll(tx).count() == 0


def test_stream_scoring_equals_batch(spark):
    from veritab.plans import training as tr
    from veritab.plans.q_models import FRAUD_CATEGORICAL, FRAUD_NUMERIC, fraud_split
    from veritab.session import materialize
    from veritab.sources import fixtures as fx
    from veritab.streaming import scoring as st

    s = fraud_split(spark, SMALL)
    fitted = tr.fit_classifier(s.where("split = 'train'"), "label", FRAUD_NUMERIC, FRAUD_CATEGORICAL,
                               "logistic_regression", {"C": 1.0, "class_weight": None})
    feed = materialize(fx.transactions(spark, SMALL).repartition(3), "test_feed")
    folder = feed.inputFiles()[0].rsplit("/", 1)[0]
    out = st.run_scoring(st.read_parquet_stream(spark, folder, feed.schema), fitted)
    streamed = spark.read.parquet(f"{out}/valid").select("transaction_id", F.round("probability", 9).alias("p"))
    batch = st.score_transactions(feed, fitted).select("transaction_id", F.round("probability", 9).alias("p"))
    assert sorted(tuple(r) for r in streamed.collect()) == sorted(tuple(r) for r in batch.collect())
    assert streamed.count() == feed.count()
