"""Steps whose size at scale was mended: what they deal, and that rows stay the same in odd cases."""

import pytest
from pyspark.sql import functions as F

from veritab.config import RecColumns
from veritab.operators import profile, sampling, splits
from veritab.operators.recsys import cf as cfm
from veritab.operators.recsys import content as cb
from veritab.operators.recsys import hybrid as hy
from veritab.operators.recsys import matrix as rm
from veritab.operators.recsys import signals as rs
from veritab.operators.recsys import similarity as sim

COLS = RecColumns(order_cols=("row_no",))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df) -> int:
    return _plan(df).count("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(1, "a", 4.0, "view", "2024-01-01", 0), (1, "a", 5.0, "view", "2024-01-01", 1), (1, "b", 2.0, "like", None, 2),
            (1, "b", 3.0, "like", None, 3), (2, "a", 1.0, "view", "2024-01-03", 4), (None, "a", 1.0, "view", "2024-01-03", 5),
            (None, "a", 2.0, "view", "2024-01-03", 6), (None, "b", 2.0, "view", "2024-01-04", 7), (3, None, 2.0, "view", "2024-01-05", 8),
            (3, "c", 2.0, "view", "2024-01-04", 9), (4, "c", 2.0, "click", "2024-01-04", 10), (4, "d", 2.0, "click", "2024-01-05", 11)]
    return spark.createDataFrame(rows, "user_id long, item_id string, rating double, interaction_type string, timestamp string, row_no int")


def test_split_deals_its_rows_once(raw):
    out = rs.leave_last_out(rs.prepare_interactions(raw, COLS, by_owner=True), COLS)
    assert _exchanges(out) == 1
    got = {(r["user_id"], r["item_id"], r["row_no"], r["split"]) for r in out.collect()}
    plain = rs.leave_last_out(rs.prepare_interactions(raw, COLS), COLS)
    assert got == {(r["user_id"], r["item_id"], r["row_no"], r["split"]) for r in plain.collect()}
    assert got == {(1, "a", 0, "train"), (1, "b", 2, "test"), (2, "a", 4, "train"), (None, "a", 5, "train"), (None, "b", 7, "train"),
                   (3, None, 8, "train"), (3, "c", 9, "train"), (4, "c", 10, "train"), (4, "d", 11, "test")}


def test_sparsity_does_not_expand_the_matrix(spark):
    m = spark.createDataFrame([(1, "a", 1.0), (1, "b", 0.0), (2, "a", 2.0), (None, "a", 3.0)], "user_id long, item_id string, r double")
    out = rm.sparsity(m)
    assert "Expand" not in _plan(out)
    assert tuple(out.first()) == (1 - 3 / 4, 2, 2, 3)


def test_pairs_are_dealt_once(spark):
    m = spark.createDataFrame([(u, f"i{(u * 7 + k * k) % 13}", 1.0 + (u + k) % 4) for u in range(20) for k in range(5)],
                              "user_id long, item_id string, r double").groupBy("user_id", "item_id").agg(F.avg("r").alias("r"))
    asked = m.select("user_id").distinct().limit(3)
    sims = sim.user_cosine(asked, m)
    assert _plan(sims).count("hashpartitioning(a#") == 1
    rows = m.collect()
    vec = {u: {r["item_id"]: r["r"] for r in rows if r["user_id"] == u} for u in range(20)}
    norm = {u: sum(x * x for x in v.values()) ** 0.5 for u, v in vec.items()}
    for r in sims.collect():
        dot = sum(x * vec[r["b"]].get(i, 0.0) for i, x in vec[r["a"]].items())
        assert abs(r["sim"] - dot / norm[r["a"]] / norm[r["b"]]) < 1e-12
    items = m.select("item_id").distinct().limit(3)
    assert _plan(profile.item_pearson(items, m)).count("hashpartitioning(a#") == 1


def _ratings(spark, sign=1.0):
    rows = [(u, None if (u + k) % 11 == 0 else f"i{(u * 7 + k * k) % 13}", sign if (u + k) % 4 == 0 else 1.0 + (u + k) % 4)
            for u in range(12) for k in range(4)]
    return spark.createDataFrame(rows, "user_id long, item_id string, r double").groupBy("user_id", "item_id").agg(F.avg("r").alias("r"))


def test_scores_by_lists_are_those_by_similarities(spark, monkeypatch):
    m = _ratings(spark)
    asked = spark.createDataFrame([(1,), (5,)], "user_id long")
    monkeypatch.setattr(cfm, "LIST_ROWS", 2)  # lists cut in two
    got = [{(r[0], r[1]): r[2] for r in f(asked, m).collect()} for f in (cfm.item_based_scores, cfm.cf_scores)]
    monkeypatch.setattr(cfm, "_has_negative", lambda matrix: True)
    for new, f in zip(got, (cfm.item_based_scores, cfm.cf_scores)):
        old = {(r[0], r[1]): r[2] for r in f(asked, m).collect()}
        assert old.keys() == new.keys() and all(abs(old[k] - new[k]) < 1e-12 for k in old)


def test_negative_ratings_take_the_long_way(spark):
    assert cfm._has_negative(_ratings(spark, -2.0)) and not cfm._has_negative(_ratings(spark))


def test_rare_and_common_terms_weigh_the_same_way(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "red bolt red"), (2, "red ring"), (2, "blue ring"), (None, "red"), (4, None)], "item_id int, content_text string")
    common = {(r[0], r[1]): r[2] for r in cb.tfidf(docs).collect()}
    monkeypatch.setattr(cb, "COMMON", 1)  # only terms of all documents are common
    rare = {(r[0], r[1]): r[2] for r in cb.tfidf(docs).collect()}
    assert common.keys() == rare.keys() and (None, "red") in rare and all(abs(common[k] - rare[k]) < 1e-12 for k in rare)


def test_content_predictions_sum_no_collaborative_scores(spark, monkeypatch):
    train = spark.createDataFrame([(1, "a", 4.0), (2, "b", 3.0)], "user_id long, item_id string, signal double")
    items = spark.createDataFrame([("a", "red bolt"), ("b", "red ring")], "item_id string, content_text string")
    parts = hy.fit(train, items)
    assert not hasattr(parts, "profiles")
    monkeypatch.setattr(hy, "cf_of_pairs", None)
    pairs = spark.createDataFrame([(1, "b"), (2, "a"), (9, "a")], "user_id long, item_id string")
    assert hy.predict(parts, pairs, (0.0, 1.0, 0.0)).count() == 3


def test_class_counts_do_not_deal_the_rows(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(20)], "id int, label int")
    for out in (splits.stratified_split(df, "label", ["id"]), sampling.balanced_class_weights(df, "label")):
        assert "ResolvedHint (strategy=broadcast)" in out._jdf.queryExecution().analyzed().toString()


def test_items_of_one_text_are_not_all_candidates(spark):
    texts = ["red bolt", "red ring", "blue ring", "old nail"]
    items = spark.createDataFrame([(f"i{k:03d}", texts[k % 4]) for k in range(240)], "item_id string, content_text string")
    train = spark.createDataFrame([(u, f"i{(u * 37 + j * 11 + j * j) % 240:03d}", 1.0 + (u + j) % 5) for u in range(8) for j in range(4)],
                                  "user_id long, item_id string, signal double").dropDuplicates(["user_id", "item_id"])
    parts = hy.fit(train, items)
    asked = spark.createDataFrame([(1,), (5,)], "user_id long")
    weights, n = [(0.6, 0.3, 0.1), (0.0, 1.0, 0.0), (0.2, 0.8, 0.0), (0.0, 0.5, 0.5)], 5
    got = {(r["grid"], r["user_id"], r["rank"]): (r["item_id"], round(r["score"], 9)) for r in hy.top_n(parts, weights, n, asked).collect()}
    assert hy.candidates(parts, asked, n, weights[:1]).groupBy("user_id").count().agg(F.max("count")).first()[0] < 120
    # every pair of an asked user and an item, scored
    pairs = asked.crossJoin(parts.codes.select(F.col("item_id").alias("i"))).withColumnRenamed("i", "item_id")
    whole = hy.scores_of_pairs(parts, pairs).join(parts.seen, ["user_id", "item_id"], "left_anti").join(
        parts.catalog.select("item_id", "pop_i"), "item_id").join(parts.users.select("user_id", "has_profile"), "user_id")
    for g, w in enumerate(weights):
        rows = parts.decode(whole.withColumn("score", F.round(hy.score_column(*[F.lit(x) for x in hy.normalise_weights(*w)]), 9))).collect()
        for u in (1, 5):
            best = sorted(((r["item_id"], r["score"]) for r in rows if r["user_id"] == u), key=lambda x: (-x[1], x[0]))[:n]
            assert [got[g, u, k + 1][0] for k in range(n)] == [i for i, _ in best]
            assert all(abs(got[g, u, k + 1][1] - s) < 1e-8 for k, (_, s) in enumerate(best))
