"""Registered queries: the recommender."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritab.operators import quality
from veritab.operators.recsys import cf as cfm
from veritab.operators.recsys import content as cb
from veritab.operators.recsys import hybrid as hy
from veritab.operators.recsys import ranking_eval as re_
from veritab.operators.recsys import similarity as sim
from veritab.operators.recsys.signals import probability_like
from veritab.plans import oracle_sql as osql
from veritab.plans.oracle_sql import r6, with_ctes
from veritab.plans.registry import (catalog, hybrid_parts, interaction_matrix, register, requested_items, requested_users,
                                    rounded, test_interactions, train_interactions)
from veritab.sources import fixtures as fx

U, I = "user_id", "item_id"
DEFAULT_W = (0.55, 0.30, 0.15)


SQL_REQ = """SELECT user_id, effective_top_n FROM (
  SELECT user_id, greatest(1, least(CAST(coalesce(top_n, 10) AS INTEGER), 50)) AS effective_top_n,
         coalesce(user_id BETWEEN 1 AND 10000000000 AND CAST(coalesce(top_n, 10) AS INTEGER) BETWEEN 1 AND 50, false) AS ok
  FROM (SELECT c_custkey * 7 % 2000 + 1 AS user_id, CAST(c_custkey % 13 + 1 AS INTEGER) AS top_n FROM customer)) WHERE ok"""


def _matrix(spark, sf_dir):
    return interaction_matrix(spark, sf_dir)


def _parts(spark, sf_dir):
    return hybrid_parts(spark, sf_dir)


@register("r04_item_cosine", with_ctes(f"SELECT a, b, {r6('sim')} AS sim FROM isim WHERE a IN (SELECT item_id FROM asked_items)"))
def r04_item_cosine(spark, sf_dir):
    return rounded(sim.item_cosine(requested_items(spark, sf_dir), _matrix(spark, sf_dir)))


@register("r05_user_cosine", with_ctes(f"SELECT a, b, {r6('sim')} AS sim FROM usim WHERE a IN (SELECT user_id FROM requests)"))
def r05_user_cosine(spark, sf_dir):
    return rounded(sim.user_cosine(requested_users(spark, sf_dir), _matrix(spark, sf_dir)))


@register("r06_item_based_scores", with_ctes(f"SELECT user_id, item_id, {r6('item_score')} AS item_score FROM ib WHERE user_id IN (SELECT user_id FROM requests)"))
def r06_item_based_scores(spark, sf_dir):
    m = _matrix(spark, sf_dir)
    return rounded(cfm.item_based_scores(requested_users(spark, sf_dir), m))


@register("r07_neighbours", with_ctes(f"""
SELECT user_id, v, {r6('sim')} AS sim FROM nbrs WHERE user_id IN (SELECT user_id FROM requests)"""))
def r07_neighbours(spark, sf_dir):
    m = _matrix(spark, sf_dir)
    return rounded(cfm.neighbours(sim.user_cosine(requested_users(spark, sf_dir), m), 20))


@register("r07_user_based_scores", with_ctes(f"SELECT user_id, item_id, {r6('user_score')} AS user_score FROM ub WHERE user_id IN (SELECT user_id FROM requests)"))
def r07_user_based_scores(spark, sf_dir):
    m = _matrix(spark, sf_dir)
    return rounded(cfm.user_based_scores(m, cfm.neighbours(sim.user_cosine(requested_users(spark, sf_dir), m), 20)))


@register("r08_cf_scores", with_ctes(f"SELECT user_id, item_id, {r6('cf')} AS cf FROM cf WHERE user_id IN (SELECT user_id FROM requests)"))
def r08_cf_scores(spark, sf_dir):
    m = _matrix(spark, sf_dir)
    return rounded(cfm.cf_scores(requested_users(spark, sf_dir), m))


@register("r09_cf_predict", with_ctes(f"""
SELECT t.user_id, t.item_id, {r6(f"CASE WHEN coalesce(cf.cf, 0.0) > 0 THEN {osql.clip('cf.cf')} ELSE coalesce({osql.clip('p.avg_signal')}, {osql.clip('(SELECT mavg FROM meanavg)')}, 3.0) END")} AS prediction
FROM test t LEFT JOIN cf ON cf.user_id = t.user_id AND cf.item_id = t.item_id
LEFT JOIN popularity p ON p.item_id = t.item_id"""))
def r09_cf_predict(spark, sf_dir):
    pairs = test_interactions(spark, sf_dir).select(U, I)
    return rounded(hy.cf_predict_pairs(_parts(spark, sf_dir), pairs).select(U, I, "prediction"))


@register("r10_cf_recommend", with_ctes(f"""
WITH req AS ({SQL_REQ})
SELECT user_id, rank, item_id, {r6(osql.clip('score'))} AS score FROM (
  SELECT u.user_id, i.item_id, coalesce(cf.cf, 0.0) AS score,
         row_number() OVER (PARTITION BY u.user_id ORDER BY round(coalesce(cf.cf, 0.0), 9) DESC, i.item_id) AS rank
  FROM (SELECT DISTINCT user_id FROM train WHERE user_id IN (SELECT user_id FROM req)) u CROSS JOIN (SELECT DISTINCT item_id FROM train) i
  LEFT JOIN cf ON cf.user_id = u.user_id AND cf.item_id = i.item_id
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.user_id AND s.item_id = i.item_id))
WHERE rank <= 10
UNION ALL
SELECT q.user_id, p.pos, p.item_id, {r6('p.avg_signal')} FROM (SELECT DISTINCT user_id FROM req) q JOIN pop_ranked p ON p.pos <= 10
WHERE q.user_id NOT IN (SELECT user_id FROM kusers)"""))
def r10_cf_recommend(spark, sf_dir):
    return rounded(hy.cf_top_n(_parts(spark, sf_dir), _requests(spark, sf_dir), 10))


@register("r11_tfidf", with_ctes(f"SELECT item_id, term, {r6('weight')} AS weight FROM vec"))
def r11_tfidf(spark, sf_dir):
    return rounded(cb.tfidf(catalog(spark, sf_dir).select(I, "content_text")))


SQL_DOC_VEC = f"""
WITH dt AS (SELECT doc_id, list_filter(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
                                   lambda t: NOT list_contains({osql._stop_list()}, t)) AS t FROM documents),
dterms AS (SELECT doc_id, unnest(t || CASE WHEN len(t) >= 2 THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])
                                 ELSE CAST([] AS VARCHAR[]) END) AS term FROM dt),
dtf AS (SELECT doc_id, term, count(*) AS tf FROM dterms GROUP BY doc_id, term),
ddf AS (SELECT term, count(*) AS df FROM dtf GROUP BY term),
dw AS (SELECT doc_id, term, tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0) AS w
       FROM dtf JOIN ddf USING (term))
SELECT doc_id, term, {r6('w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))')} AS weight FROM dw"""


@register("r11_tfidf_documents", SQL_DOC_VEC)
def r11_tfidf_documents(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    return rounded(cb.tfidf(docs, "doc_id", "text"))


@register("r12_content_similarity_top10", with_ctes(f"""
SELECT a, b, {r6('sim')} AS sim, rank FROM (
  SELECT a, b, sim, row_number() OVER (PARTITION BY a ORDER BY round(sim, 9) DESC, b) AS rank FROM (
    SELECT x.item_id AS a, y.item_id AS b, sum(x.weight * y.weight) AS sim FROM vec x JOIN vec y ON x.term = y.term
    WHERE x.item_id <> y.item_id AND x.item_id IN (SELECT item_id FROM asked_items) GROUP BY x.item_id, y.item_id))
WHERE rank <= 10"""))
def r12_content_similarity_top10(spark, sf_dir):
    vec = cb.tfidf(catalog(spark, sf_dir).select(I, "content_text"))
    return rounded(cb.content_top(requested_items(spark, sf_dir), vec, 10).select("a", "b", "sim", "rank"))


@register("r13_user_profiles", with_ctes(f"SELECT user_id, term, {r6('weight')} AS weight FROM prof"))
def r13_user_profiles(spark, sf_dir):
    vec = cb.tfidf(catalog(spark, sf_dir).select(I, "content_text"))
    return rounded(cb.user_profiles(train_interactions(spark, sf_dir), vec))


@register("r14_content_scores", with_ctes(f"""
SELECT user_id, item_id, {r6('1.0 + 4.0 * dot')} AS content_score FROM dots WHERE user_id IN (SELECT user_id FROM requests)"""))
def r14_content_scores(spark, sf_dir):
    vec = cb.tfidf(catalog(spark, sf_dir).select(I, "content_text"))
    prof = cb.user_profiles(train_interactions(spark, sf_dir).join(requested_users(spark, sf_dir), U, "left_semi"), vec)
    return rounded(cb.content_scores(cb.profile_dots(prof, vec)).select(U, I, "content_score"))


@register("r15_content_predict", with_ctes(f"""
SELECT t.user_id, t.item_id,
       {r6(f"CASE WHEN u.user_id IS NOT NULL AND ct.item_id IS NOT NULL THEN {osql.clip('1.0 + 4.0 * coalesce(d.dot, 0.0)')} ELSE coalesce({osql.clip('p.avg_signal')}, {osql.clip('(SELECT mavg FROM meanavg)')}, 3.0) END")} AS prediction
FROM test t LEFT JOIN dots d ON d.user_id = t.user_id AND d.item_id = t.item_id
LEFT JOIN (SELECT DISTINCT user_id FROM prof) u ON u.user_id = t.user_id
LEFT JOIN (SELECT DISTINCT item_id FROM catalog) ct ON ct.item_id = t.item_id
LEFT JOIN popularity p ON p.item_id = t.item_id"""))
def r15_content_predict(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    pairs = test_interactions(spark, sf_dir).select(U, I)
    # content-only model: the hybrid predictor with weights (0, 1, 0) has the same fallback chain
    return rounded(hy.predict(parts, pairs, (0.0, 1.0, 0.0)).select(U, I, "prediction"))


@register("r19_hybrid_top10", with_ctes(f"""
SELECT user_id, rank, item_id, {r6('score')} AS score FROM ({osql.hybrid_top_sql([DEFAULT_W], 10, 'requests')})"""))
def r19_hybrid_top10(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    return rounded(hy.top_n(parts, [DEFAULT_W], 10, requested_users(spark, sf_dir)).drop("grid"))


@register("r18_hybrid_predict", with_ctes(f"""
SELECT user_id, item_id, {r6('prediction')} AS prediction FROM ({osql.predict_sql('SELECT user_id, item_id FROM test', DEFAULT_W)})"""))
def r18_hybrid_predict(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    return rounded(hy.predict(parts, test_interactions(spark, sf_dir).select(U, I), DEFAULT_W))


def _eval_sql(grid, k: int = 10, names=None, floor_recall: bool = False) -> str:
    rel = "(SELECT user_id, count(DISTINCT item_id) AS n_rel FROM test GROUP BY user_id)"
    rec_den = "greatest(r.n_rel, 1)" if floor_recall else "r.n_rel"
    return f"""
WITH recs AS ({osql.hybrid_top_sql(grid, k)}),
hits AS (SELECT grid, user_id, count(*) AS hits FROM (SELECT DISTINCT grid, user_id, item_id FROM recs) x
         WHERE EXISTS (SELECT 1 FROM test t WHERE t.user_id = x.user_id AND t.item_id = x.item_id) GROUP BY grid, user_id),
gu AS (SELECT g.grid, r.user_id, r.n_rel FROM {rel} r, (SELECT DISTINCT grid FROM recs) g),
um AS (SELECT gu.grid, gu.user_id, coalesce(h.hits, 0) / {float(k)} AS p,
              CASE WHEN gu.n_rel > 0 THEN coalesce(h.hits, 0) / {rec_den.replace('r.', 'gu.')} ELSE 0.0 END AS rc
       FROM gu LEFT JOIN hits h ON h.grid = gu.grid AND h.user_id = gu.user_id)
SELECT grid, avg(p) AS precision_at_k, avg(rc) AS recall_at_k FROM um GROUP BY grid"""


@register("r23_evaluate", with_ctes(f"""
WITH e AS ({_eval_sql([DEFAULT_W])}),
pr AS ({osql.predict_sql('SELECT user_id, item_id, signal FROM test', DEFAULT_W)})
SELECT {r6('precision_at_k')} AS precision_at_k, {r6('recall_at_k')} AS recall_at_k,
       {r6('(SELECT coalesce(sqrt(avg((signal - prediction) * (signal - prediction))), 0.0) FROM pr)')} AS rmse FROM e"""))
def r23_evaluate(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    return rounded(re_.evaluate(parts, test_interactions(spark, sf_dir), DEFAULT_W, 10))


@register("r24_tune_weights", with_ctes(f"""
WITH e AS ({_eval_sql(re_.TUNING_GRID)}),
best AS (SELECT grid FROM e ORDER BY round(precision_at_k, 12) DESC, grid LIMIT 1)
SELECT e.grid, {r6('precision_at_k')} AS precision_at_k, w.cf_weight, w.cb_weight, w.popularity_weight,
       CAST(NULL AS VARCHAR) AS strategy, e.grid = (SELECT grid FROM best) AS is_best
FROM e JOIN (VALUES {", ".join(f"({g}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE), CAST({c} AS DOUBLE))" for g, (a, b, c) in enumerate(re_.TUNING_GRID))})
  w(grid, cf_weight, cb_weight, popularity_weight) ON w.grid = e.grid"""))
def r24_tune_weights(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    return rounded(re_.tune_weights(parts, test_interactions(spark, sf_dir)))


def _presets_values() -> str:
    return ", ".join(f"({g}, '{n}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE), CAST({c} AS DOUBLE))"
                     for g, (n, a, b, c) in enumerate(re_.PRESETS))


@register("r25_compare_presets", with_ctes(f"""
WITH e AS ({_eval_sql([(a, b, c) for _, a, b, c in re_.PRESETS], floor_recall=True)}),
w AS (SELECT * FROM (VALUES {_presets_values()}) v(grid, strategy, cf_weight, cb_weight, popularity_weight))
SELECT e.grid, w.strategy, {r6('precision_at_k')} AS precision_at_k, {r6('recall_at_k')} AS recall_at_k,
       {r6('r.rmse')} AS rmse, w.cf_weight, w.cb_weight, w.popularity_weight,
       row_number() OVER (ORDER BY round(precision_at_k, 12) DESC, e.grid)::INT AS place,
       row_number() OVER (ORDER BY round(precision_at_k, 12) DESC, e.grid) = 1 AS is_best
FROM e JOIN w ON w.grid = e.grid JOIN (
  {" UNION ALL ".join(f"SELECT {g} AS grid, coalesce(sqrt(avg((signal - prediction) * (signal - prediction))), 0.0) AS rmse FROM ({osql.predict_sql('SELECT user_id, item_id, signal FROM test', (a, b, c))})" for g, (_, a, b, c) in enumerate(re_.PRESETS))}
) r ON r.grid = e.grid"""))
def r25_compare_presets(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    return rounded(re_.compare_presets(parts, test_interactions(spark, sf_dir)))


@register("r26_binary_relevance", with_ctes(f"""
SELECT user_id, item_id, CAST(signal >= 4.0 AS INTEGER) AS label, {r6(osql.clip('prediction / 5.0', '0.0', '1.0'))} AS score
FROM ({osql.predict_sql('SELECT user_id, item_id, signal FROM test', DEFAULT_W)})"""))
def r26_binary_relevance(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    return rounded(re_.binary_relevance(parts, test_interactions(spark, sf_dir), DEFAULT_W))


@register("r26_binary_relevance_auc", with_ctes(f"""
WITH b AS (SELECT CAST(signal >= 4.0 AS INTEGER) AS label, {osql.clip('prediction / 5.0', '0.0', '1.0')} AS score
           FROM ({osql.predict_sql('SELECT user_id, item_id, signal FROM test', DEFAULT_W)})),
c AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM b GROUP BY score),
w AS (SELECT *, sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fps,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM c)
SELECT {r6('(max(P) * max(N) - sum(pos * fps) + sum(pos * neg * 0.5)) / (max(P) * max(N))')} AS roc_auc FROM w"""))
def r26_binary_relevance_auc(spark, sf_dir):
    from veritab.operators import evaluation as ev

    parts = _parts(spark, sf_dir)
    return rounded(ev.roc_auc(re_.binary_relevance(parts, test_interactions(spark, sf_dir), DEFAULT_W)))


@register("r27_scored_recommendations", with_ctes(f"""
SELECT user_id, rank, item_id, {r6('round(prediction, 4)')} AS predicted_signal,
       {r6(f"round({osql.clip('prediction / 5.0', '0.0', '1.0')}, 4)")} AS probability_like
FROM (SELECT t.*, CASE WHEN score > 0 THEN {osql.clip('score')}
             ELSE coalesce({osql.clip('p.avg_signal')}, {osql.clip('(SELECT mavg FROM meanavg)')}, 3.0) END AS prediction
      FROM ({osql.hybrid_top_sql([DEFAULT_W], 5, 'requests')}) t LEFT JOIN popularity p ON p.item_id = t.item_id)"""))
def r27_scored_recommendations(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    recs = hy.top_n(parts, [DEFAULT_W], 5, requested_users(spark, sf_dir)).drop("grid")
    pred = hy.ranked_predictions(parts, recs)
    return rounded(pred.select(U, "rank", I, F.round("prediction", 4).alias("predicted_signal"),
                               probability_like(F.col("prediction")).alias("probability_like")))


def _requests(spark, sf_dir):
    c = fx.table(spark, sf_dir, "customer")
    req = c.select((F.col("c_custkey") * 7 % 2000 + 1).alias("user_id"), (F.col("c_custkey") % 13 + 1).cast("int")
                   .alias("top_n"))
    return quality.validate_requests(req).where("is_valid").select(U, "effective_top_n")


@register("r29_recommend_requests", with_ctes(f"""
WITH req AS ({SQL_REQ}),
recs AS ({osql.hybrid_top_sql([DEFAULT_W], 50, 'req')})
SELECT q.user_id, r.rank, r.item_id, {r6('r.score')} AS score FROM req q JOIN recs r ON r.user_id = q.user_id
WHERE r.rank <= q.effective_top_n
UNION ALL
SELECT q.user_id, p.pos, p.item_id, {r6('p.avg_signal')} FROM req q JOIN pop_ranked p ON p.pos <= q.effective_top_n
WHERE q.user_id NOT IN (SELECT user_id FROM kusers)"""))
def r29_recommend_requests(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    return rounded(hy.recommend_requests(parts, _requests(spark, sf_dir), DEFAULT_W, 50))


@register("r30_seen_items", with_ctes("SELECT DISTINCT user_id, item_id FROM train"))
def r30_seen_items(spark, sf_dir):
    return cfm.seen_pairs(train_interactions(spark, sf_dir))
