"""Registered queries: evaluation operators on the fixed-formula score (B2)."""

from __future__ import annotations

from veritab.operators import evaluation as ev
from veritab.plans.oracle_sql import r6, with_ctes
from veritab.plans.registry import register, rounded
from veritab.sources import fixtures as fx


def _scored(spark, sf_dir):
    return fx.scored_transactions(spark, sf_dir)


@register("e01_confusion_metrics", with_ctes(f"""
WITH m AS (SELECT count(*) FILTER (WHERE score < 0.5 AND label <> 1) AS tn,
                  count(*) FILTER (WHERE score >= 0.5 AND label <> 1) AS fp,
                  count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn,
                  count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp FROM scored),
auc AS (SELECT (max(P) * max(N) - sum(pos * fps) + sum(pos * neg * 0.5)) / (max(P) * max(N)) AS roc_auc FROM score_cum)
SELECT {r6('CASE WHEN tn + fp + fn + tp > 0 THEN (tp + tn) / (tn + fp + fn + tp) ELSE 0.0 END')} AS accuracy,
       {r6('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END')} AS precision,
       {r6('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END')} AS recall,
       {r6('CASE WHEN tp = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END')} AS f1,
       CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp,
       {r6('fn / greatest(fn + tp, 1)')} AS fnr, {r6('fp / greatest(fp + tn, 1)')} AS fpr,
       {r6('roc_auc')} AS roc_auc
FROM m, auc"""))
def e01_confusion_metrics(spark, sf_dir):
    return rounded(ev.confusion_metrics(_scored(spark, sf_dir)))


@register("e04_roc_curve", with_ctes(f"""
WITH n AS (SELECT *, lag(tps) OVER (ORDER BY score DESC) AS tp_prev, lead(tps) OVER (ORDER BY score DESC) AS tp_next,
                  lag(fps) OVER (ORDER BY score DESC) AS fp_prev, lead(fps) OVER (ORDER BY score DESC) AS fp_next
           FROM score_cum)
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr, CAST(0 AS BIGINT) AS point
UNION ALL
SELECT {r6('score')}, {r6('fps / N')}, {r6('tps / P')}, CAST(rk AS BIGINT) FROM n
WHERE tp_prev IS NULL OR tp_next IS NULL OR fp_prev - 2 * fps + fp_next <> 0 OR tp_prev - 2 * tps + tp_next <> 0"""))
def e04_roc_curve(spark, sf_dir):
    return rounded(ev.roc_curve(_scored(spark, sf_dir)))


@register("e05_roc_auc", with_ctes(f"""
SELECT {r6('(max(P) * max(N) - sum(pos * fps) + sum(pos * neg * 0.5)) / (max(P) * max(N))')} AS roc_auc
FROM score_cum"""))
def e05_roc_auc(spark, sf_dir):
    return rounded(ev.roc_auc(_scored(spark, sf_dir)))


@register("e06_pr_curve", with_ctes(f"""
SELECT {r6('threshold')} AS threshold, {r6('precision')} AS precision, {r6('recall')} AS recall FROM pr_points
UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0, 0.0"""))
def e06_pr_curve(spark, sf_dir):
    return rounded(ev.pr_curve(_scored(spark, sf_dir)))


@register("e07_average_precision", with_ctes(f"""
SELECT {r6('sum(pos * precision) / sum(pos)')} AS average_precision FROM pr_points"""))
def e07_average_precision(spark, sf_dir):
    return rounded(ev.average_precision(_scored(spark, sf_dir)))


@register("e08_tune_threshold", with_ctes(f"""
WITH v AS (SELECT bool_or(precision >= 0.7) AS any_valid FROM pr_points),
c AS (SELECT threshold, round(CASE WHEN any_valid THEN recall + 0.001 * f1 ELSE f1 END, 12) AS obj
      FROM pr_points, v WHERE precision >= 0.7 OR NOT any_valid)
SELECT {r6('coalesce((SELECT threshold FROM c ORDER BY obj DESC, threshold ASC LIMIT 1), 0.5)')} AS threshold"""))
def e08_tune_threshold(spark, sf_dir):
    return rounded(ev.tune_threshold(_scored(spark, sf_dir), min_precision=0.70))


@register("e09_f1_threshold_grid", with_ctes(f"""
WITH g AS (SELECT i, CAST(0.3 AS DOUBLE) + i * CAST(0.05 AS DOUBLE) AS t FROM range(0, 11) r(i)),
a AS (SELECT i, t, sum(CASE WHEN score >= t THEN pos ELSE 0 END) AS tp, sum(CASE WHEN score >= t THEN neg ELSE 0 END) AS fp,
             sum(pos) AS n_pos FROM score_counts, g GROUP BY i, t),
m AS (SELECT i, t, tp / greatest(tp + fp, 1) AS precision, tp / greatest(n_pos, 1) AS recall FROM a),
f AS (SELECT *, 2 * precision * recall / greatest(precision + recall, 1e-9) AS f1 FROM m)
SELECT {r6('t')} AS threshold, {r6('precision')} AS precision, {r6('recall')} AS recall, {r6('f1')} AS f1,
       i = (SELECT i FROM f ORDER BY round(f1, 12) DESC, i LIMIT 1) AS is_best FROM f"""))
def e09_f1_threshold_grid(spark, sf_dir):
    return rounded(ev.f1_threshold_grid(_scored(spark, sf_dir)))
