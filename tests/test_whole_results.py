"""Results that must not lose rows: PR curve, null labels, uneven scores, unknown users, whole fixtures; saved models."""

import random

import pytest
from pyspark.sql import functions as F

from veritab.operators import evaluation as ev, prep, profile, quality, sampling, splits
from veritab.operators.prefix import global_running_sums
from veritab.operators.recsys import hybrid as hy
from veritab.operators.recsys.similarity import blocked_join
from veritab.plans import registry, search
from veritab.plans import training as tr
from veritab.sources import fixtures as fx, tables

from conftest import SMALL


def test_pr_curve_has_every_threshold(spark):
    rows = [(i % 7 == 0, (i * 37 % 500) / 1e8) for i in range(400)]  # all scores below 1e-5
    df = spark.createDataFrame([(int(a), b) for a, b in rows], "label int, score double")
    assert ev.pr_curve(df).count() == len({b for _, b in rows}) + 1
    pairs = sum((a > b) + 0.5 * (a == b) for x, a in rows if x for y, b in rows if not y)
    auc = ev.roc_auc(df).first()[0]
    assert abs(auc - pairs / (sum(x for x, _ in rows) * sum(not x for x, _ in rows))) < 1e-9


def test_running_sums_use_several_ranges(spark):
    df = spark.createDataFrame([(f"same-prefix-{i:05d}", i) for i in range(3000)], "id string, v int").repartition(4)
    out = global_running_sums(df, [F.col("id").asc()], {"upto": F.col("v"), "n": F.lit(1)}, keep_range=True).collect()
    assert all(r["upto"] == r["v"] * (r["v"] + 1) // 2 and r["n"] == r["v"] + 1 for r in out)
    assert len({r["_range"] for r in out}) > 3


def test_rows_without_label_stay(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else i % 2) for i in range(100)], "id int, label int")
    assert splits.stratified_split(df, "label", ["id"]).count() == 100
    assert splits.stratified_folds(df, "label", ["id"], 4).count() == 100
    assert sampling.random_oversample(df, "label", ["id"]).where("copy_id = 0").count() == 100
    assert sampling.balanced_class_weights(df, "label").count() == 100


def test_exact_quantiles_and_modes(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, rnd.randint(0, 30)]), rnd.choice(["a", "b", "c", None])) for _ in range(501)]
    df = spark.createDataFrame(rows, "x int, s string")
    values = sorted(x for x, _ in rows if x is not None)
    got = {r["p"]: r["value"] for r in profile.exact_quantiles(df, ["x"], (0.0, 0.25, 0.5, 0.9, 1.0)).collect()}
    for p, v in got.items():
        h = p * (len(values) - 1)
        low, high = values[int(h)], values[min(int(h) + 1, len(values) - 1)]
        assert abs(v - (low + (high - low) * (h - int(h)))) < 1e-9
    texts = [s for _, s in rows if s]
    assert profile.most_frequent(df, ["s"]).first()["value"] == min(set(texts), key=lambda s: (-texts.count(s), s))


def test_too_many_categories_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(prep, "MAX_CATEGORIES", 3)
    df = spark.createDataFrame([(str(i),) for i in range(5)], "c string")
    with pytest.raises(ValueError, match="categories"):
        prep.fit_prep(df, [], ["c"])


def test_blocked_join_meets_every_row(spark):
    many = spark.createDataFrame([(i % 3, i) for i in range(100)], "k int, v int")
    few = spark.createDataFrame([(0, "a"), (1, "b"), (7, "c")], "k int, w string")
    got = {(r["k"], r["v"], r["w"]) for r in blocked_join(few, many, "k", "v", block_rows=5).collect()}
    assert got == {(i % 3, i, "ab"[i % 3]) for i in range(100) if i % 3 < 2}


def test_fixtures_are_whole(spark):
    for fixture, table in ((fx.items, "part"), (fx.customers, "customer")):
        assert fixture(spark, SMALL).count() == fx.table(spark, SMALL, table).count()
    assert quality.unknown_references(fx.interactions_with_variants(spark, SMALL), fx.items(spark, SMALL), "item_id").first()["bad_rows"] > 0


def test_unknown_users_get_the_popular_items(spark):
    parts = registry.hybrid_parts(spark, SMALL)
    known = parts.users.select("user_id").limit(1).first()[0]
    asked = spark.createDataFrame([(known, 3), (10 ** 8, 4)], "user_id long, effective_top_n int")
    got = [(r["user_id"], r["rank"]) for r in hy.recommend_requests(parts, asked, (0.55, 0.30, 0.15)).collect()]
    assert sorted(got) == [(known, 1), (known, 2), (known, 3), *[(10 ** 8, r) for r in (1, 2, 3, 4)]]
    cf = hy.cf_top_n(parts, asked, 4).where(F.col("user_id") == 10 ** 8).orderBy("rank").collect()
    assert [r["item_id"] for r in cf] == [r["item_id"] for r in hy.popular_list(parts, 4).orderBy("rank").collect()]


def test_requests_stand_below_the_join_of_raters(spark):
    parts = registry.hybrid_parts(spark, SMALL)
    plan = hy.co_raters(parts, parts.users.limit(2))._jdf.queryExecution().optimizedPlan().toString()
    inner = plan[plan.index("Join Inner"):]
    assert "LeftSemi" in inner


def test_recommender_saved_and_loaded(spark, tmp_path):
    parts = registry.hybrid_parts(spark, SMALL)
    parts.save(f"file://{tmp_path}/rec")
    loaded = hy.HybridParts.load(spark, f"file://{tmp_path}/rec")
    users = parts.users.select("user_id").orderBy("user_id").limit(3)
    a, b = (sorted(map(tuple, hy.top_n(p, [(0.5, 0.3, 0.2)], 5, users).collect())) for p in (parts, loaded))
    assert [x[:4] for x in a] == [x[:4] for x in b] and len(a) == 15


def test_classifier_chain(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(f"t{i}", rnd.gauss(0, 1), rnd.choice("ab"), i % 5 == 0) for i in range(300)]
    df = spark.createDataFrame([(k, x + 3 * y, c, int(y)) for k, x, c, y in rows], "id string, x double, c string, label int")
    table = tr.compare_models(search.search(df, "label", ["id"], {"logistic_regression": search.FRAUD_SPACE["logistic_regression"]}, 2, 2))
    assert table.count() == 3 and table.where("cv_score > 0.5").count() == 3
    fitted = search.refit(df, "label", ["id"], ["x"], ["c"], table.first())
    fitted = tr.with_tuned_threshold(fitted, df, "label", 0.8)
    fitted.save(spark, f"file://{tmp_path}/clf")
    loaded = tr.FittedClassifier.load(spark, f"file://{tmp_path}/clf")
    assert (loaded.threshold, loaded.params, loaded.prep) == (fitted.threshold, fitted.params, fitted.prep)
    scored = loaded.classify(df.withColumn("extra", F.lit(1)), ["id", "label"], "flag")
    hits = scored.where("flag").agg(F.avg("label")).first()[0]
    assert hits >= 0.8 and scored.count() == 300
    with pytest.raises(ValueError, match="Missing required features"):
        loaded.classify(df.drop("x"), ["id"])


def test_csv_null_tokens_before_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,amount,name\n1,NA,x\n2,2.5,N/A\n3,4,y\n")
    df = tables.read_table(spark, f"file://{tmp_path}/t.csv")
    assert dict(df.dtypes) == {"id": "bigint", "amount": "double", "name": "string"}
    assert [r["amount"] for r in df.orderBy("id").collect()] == [None, 2.5, 4.0]


def test_permutations_are_independent_and_whole(spark):
    df = spark.createDataFrame([(f"k{i}", float(i % 2), float(i % 7), i % 2) for i in range(120)], "id string, x double, z double, label int")
    fitted = tr.fit_classifier(df, "label", ["x", "z"], [], "logistic_regression", tr.DEFAULT_PARAMS["logistic_regression"])
    got = {r["feature"]: (r["importance_mean"], r["importance_std"]) for r in tr.permutation_importance(fitted, df, "label", "id", ["x", "z"], 6).collect()}
    assert got["x"][0] > 0.3 and got["x"][1] > 0 and abs(got["z"][0]) < 0.1
