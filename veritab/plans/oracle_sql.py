"""DuckDB SQL twins of the operators: the independent side of the correctness check.

These strings are written from the operator *specifications* (window
``row_number``, plain joins, cross joins on tiny grids) rather than from the
Spark plans, so an error in one form is unlikely to repeat in the other.
Doubles are rounded to 6 digits at the output in both engines.
"""

from __future__ import annotations

from veritab.operators.recsys.signals import INTERACTION_WEIGHTS
from veritab.sources import fixtures as fx

ORDER = ", ".join(fx.INTERACTION_ORDER_COLS)


def _weight_case(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in INTERACTION_WEIGHTS.items())
    return f"(CASE {col} {whens} ELSE CAST(1.0 AS DOUBLE) END)"


def clip(x: str, lo="1.0", hi="5.0") -> str:
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE least(greatest({x}, CAST({lo} AS DOUBLE)), CAST({hi} AS DOUBLE)) END)"


def r6(x: str) -> str:
    # the 1e-9 nudge moves exact half-way values (common for means of small counts) off the
    # rounding boundary, so last-bit differences between engines cannot flip the 6th digit
    return f"(round(({x}) + 1e-9, 6) + 0.0)"


# base CTEs, in dependency order
CTES: dict[str, str] = {}
CTES["interactions_raw"] = fx.SQL_INTERACTIONS
CTES["interactions_variants"] = fx.SQL_INTERACTIONS_WITH_VARIANTS
CTES["typed"] = f"""
SELECT user_id, item_id, {clip('CAST(rating AS DOUBLE)')} AS rating_c, lower(interaction_type) AS interaction_type,
       "timestamp", {ORDER}
FROM interactions_raw"""
CTES["signalled"] = f"""
SELECT user_id, item_id, interaction_type, "timestamp", {ORDER},
       CASE WHEN (SELECT coalesce(bool_or(rating_c IS NOT NULL), false) FROM typed)
            THEN {clip(f"CAST(0.7 AS DOUBLE) * coalesce(rating_c, CAST(3.0 AS DOUBLE)) + CAST(0.3 AS DOUBLE) * {_weight_case('interaction_type')}")}
            ELSE {clip(_weight_case('interaction_type'))} END AS signal
FROM typed"""
CTES["prepared"] = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, item_id, "timestamp" ORDER BY {ORDER}) AS rn FROM signalled)
WHERE rn = 1"""
CTES["split"] = f"""
SELECT * EXCLUDE (rn_desc, n_user),
       CASE WHEN n_user >= 2 AND rn_desc = 1 THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" DESC NULLS FIRST,
             {", ".join(c + " DESC" for c in fx.INTERACTION_ORDER_COLS)}) AS rn_desc,
             count(*) OVER (PARTITION BY user_id) AS n_user
      FROM prepared)"""
CTES["requests"] = """
SELECT DISTINCT o_custkey + 1 AS user_id FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL 7 DAY"""
CTES["train"] = "SELECT * FROM split WHERE split = 'train'"
CTES["test"] = "SELECT * FROM split WHERE split = 'test'"
CTES["asked_items"] = "SELECT DISTINCT item_id FROM test WHERE user_id IN (SELECT user_id FROM requests)"
CTES["items_raw"] = fx.SQL_ITEMS
CTES["catalog"] = """
SELECT item_id, title, genres, category, catalog_order,
       trim(regexp_replace(concat_ws(' ', title, genres, category), '\\s+', ' ', 'g')) AS content_text
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY catalog_order, title, genres, category) AS rn
      FROM items_raw) WHERE rn = 1"""
CTES["popularity"] = """
SELECT item_id, avg(signal) AS avg_signal, count(*) AS interaction_count FROM train GROUP BY item_id"""
CTES["transactions"] = fx.SQL_TRANSACTIONS
CTES["customers"] = fx.SQL_CUSTOMERS
CTES["scored"] = fx.SQL_SCORED_TRANSACTIONS
CTES["score_counts"] = """
SELECT score, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
       CAST(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM scored GROUP BY score"""
CTES["score_cum"] = """
SELECT score, pos, neg, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps, row_number() OVER w AS rk,
       sum(pos) OVER () AS P, sum(neg) OVER () AS N
FROM score_counts WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
CTES["pr_points"] = """
SELECT score AS threshold, tps / (tps + fps) AS precision, tps / P AS recall, pos,
       2 * (tps / (tps + fps)) * (tps / P) / greatest(tps / (tps + fps) + tps / P, 1e-12) AS f1
FROM score_cum"""


def needed(sql: str) -> list[str]:
    """CTE names referenced (transitively) by ``sql``, in definition order."""
    import re

    names = list(CTES)
    want: set[str] = set()
    frontier = [sql]
    while frontier:
        text = frontier.pop()
        for n in names:
            if n not in want and re.search(rf"\b{n}\b", text):
                want.add(n)
                frontier.append(CTES[n])
    return [n for n in names if n in want]


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    ctes = dict(extra or {})
    if clash := set(ctes) & set(CTES):
        raise ValueError(f"names of shared CTEs: {sorted(clash)}")
    probe = body + " ".join(ctes.values())
    order = needed(probe)
    parts = [f"{n} AS ({CTES[n]})" for n in order] + [f"{n} AS ({s})" for n, s in ctes.items()]
    stripped = body.lstrip()
    if parts and stripped[:4].upper() == "WITH":
        # body has its own WITH list: merge it after the shared CTEs
        return "WITH " + ",\n".join(parts) + ",\n" + stripped[4:]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


# ---- recommender (dense SQL form: users x catalog cross join, affordable at the check scale) ----
def _stop_list() -> str:
    from veritab.functions.text import sql_stop_list

    return sql_stop_list()


CTES["rmat"] = "SELECT user_id, item_id, avg(signal) AS r FROM train GROUP BY user_id, item_id"
CTES["inorm"] = "SELECT item_id, sqrt(sum(r * r)) AS n FROM rmat GROUP BY item_id"
CTES["unorm"] = "SELECT user_id, sqrt(sum(r * r)) AS n FROM rmat GROUP BY user_id"
CTES["isim"] = """
SELECT x.item_id AS a, y.item_id AS b, sum(x.r * y.r) / (max(na.n) * max(nb.n)) AS sim
FROM rmat x JOIN rmat y ON x.user_id = y.user_id JOIN inorm na ON na.item_id = x.item_id JOIN inorm nb ON nb.item_id = y.item_id
GROUP BY x.item_id, y.item_id"""
CTES["usim"] = """
SELECT x.user_id AS a, y.user_id AS b, sum(x.r * y.r) / (max(na.n) * max(nb.n)) AS sim
FROM rmat x JOIN rmat y ON x.item_id = y.item_id JOIN unorm na ON na.user_id = x.user_id JOIN unorm nb ON nb.user_id = y.user_id
GROUP BY x.user_id, y.user_id"""
CTES["ib"] = """
SELECT rmat.user_id, s.b AS item_id,
       CASE WHEN sum(abs(s.sim)) <> 0 THEN sum(s.sim * rmat.r) / sum(abs(s.sim)) ELSE 0.0 END AS item_score
FROM rmat JOIN isim s ON s.a = rmat.item_id GROUP BY rmat.user_id, s.b"""
CTES["nbrs"] = """
SELECT a AS user_id, b AS v, sim FROM (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(sim, 9) DESC, b) AS rk FROM usim WHERE a <> b AND sim > 0)
WHERE rk <= 20"""
CTES["ub"] = """
SELECT n.user_id, rmat.item_id, sum(n.sim * rmat.r) / max(d.den) AS user_score
FROM nbrs n JOIN rmat ON rmat.user_id = n.v JOIN (SELECT user_id, sum(abs(sim)) AS den FROM nbrs GROUP BY user_id) d
  ON d.user_id = n.user_id
GROUP BY n.user_id, rmat.item_id"""
CTES["cf"] = """
SELECT coalesce(ib.user_id, ub.user_id) AS user_id, coalesce(ib.item_id, ub.item_id) AS item_id,
       CASE WHEN coalesce(ib.user_id, ub.user_id) IN (SELECT user_id FROM nbrs)
            THEN 0.65 * coalesce(item_score, 0.0) + 0.35 * coalesce(user_score, 0.0)
            ELSE coalesce(item_score, 0.0) END AS cf
FROM ib FULL OUTER JOIN ub ON ib.user_id = ub.user_id AND ib.item_id = ub.item_id"""
CTES["toks"] = f"""
SELECT item_id, list_filter(regexp_extract_all(lower(coalesce(content_text, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
                            lambda t: NOT list_contains({_stop_list()}, t)) AS t
FROM catalog"""
CTES["terms"] = """
SELECT item_id, unnest(t || CASE WHEN len(t) >= 2 THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])
                               ELSE CAST([] AS VARCHAR[]) END) AS term FROM toks"""
CTES["tf"] = "SELECT item_id, term, count(*) AS tf FROM terms GROUP BY item_id, term"
CTES["dfq"] = "SELECT term, count(*) AS df FROM tf GROUP BY term"
CTES["vec"] = """
SELECT item_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS weight
FROM (SELECT item_id, term, tf * (ln((1.0 + (SELECT count(*) FROM catalog)) / (1.0 + df)) + 1.0) AS w
      FROM tf JOIN dfq USING (term))"""
CTES["prow"] = "SELECT user_id, item_id, signal FROM train WHERE item_id IN (SELECT item_id FROM vec)"
CTES["pu"] = "SELECT user_id, sum(signal) AS ss, count(*) AS n FROM prow GROUP BY user_id"
CTES["prof"] = """
SELECT p.user_id, v.term,
       sum(CASE WHEN pu.ss <= 0 THEN 1.0 ELSE p.signal END * v.weight / CASE WHEN pu.ss <= 0 THEN pu.n ELSE pu.ss END)
       AS weight
FROM prow p JOIN pu ON pu.user_id = p.user_id JOIN vec v ON v.item_id = p.item_id GROUP BY p.user_id, v.term"""
CTES["dots"] = """
SELECT p.user_id, v.item_id, sum(p.weight * v.weight) AS dot FROM prof p JOIN vec v ON v.term = p.term
GROUP BY p.user_id, v.item_id"""
CTES["meanavg"] = "SELECT avg(avg_signal) AS mavg FROM popularity"
CTES["cat"] = """
SELECT c.item_id, coalesce(p.avg_signal, (SELECT mavg FROM meanavg), 3.0) AS pop_i
FROM (SELECT DISTINCT item_id FROM catalog) c LEFT JOIN popularity p ON p.item_id = c.item_id"""
CTES["kusers"] = """
SELECT user_id, user_id IN (SELECT user_id FROM prof) AS has_profile FROM (SELECT DISTINCT user_id FROM train)"""
CTES["seen"] = "SELECT DISTINCT user_id, item_id FROM train"
CTES["pop_ranked"] = """
SELECT *, row_number() OVER (ORDER BY round(avg_signal, 9) DESC, interaction_count DESC, item_id) AS pos FROM popularity"""


def hybrid_scores_sql(grid: list[tuple[float, float, float]], asked: str | None = None) -> str:
    """Dense scores of every known user (of the CTE ``asked``) x catalog item x weight vector, seen items removed."""
    who = f"(SELECT * FROM kusers WHERE user_id IN (SELECT user_id FROM {asked}))" if asked else "kusers"
    rows = ", ".join(f"({g}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE), CAST({c} AS DOUBLE))"
                     for g, (a, b, c) in enumerate(grid))
    return f"""
SELECT g.grid, u.user_id, c.item_id,
       g.wc * coalesce(cf.cf, 0.0) + g.wb * CASE WHEN u.has_profile THEN 1.0 + 4.0 * coalesce(d.dot, 0.0) ELSE 0.0 END
       + g.wp * c.pop_i AS score
FROM {who} u CROSS JOIN cat c CROSS JOIN (VALUES {rows}) g(grid, wc, wb, wp)
LEFT JOIN cf ON cf.user_id = u.user_id AND cf.item_id = c.item_id
LEFT JOIN dots d ON d.user_id = u.user_id AND d.item_id = c.item_id
WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = u.user_id AND s.item_id = c.item_id)"""


def hybrid_top_sql(grid, n: int, asked: str | None = None) -> str:
    return f"""
SELECT grid, user_id, rank, item_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY grid, user_id ORDER BY round(score, 9) DESC, item_id) AS rank
  FROM ({hybrid_scores_sql(grid, asked)})) WHERE rank <= {n}"""


def predict_sql(pairs: str, w: tuple[float, float, float]) -> str:
    a, b, c = w
    h = (f"(CAST({a} AS DOUBLE) * coalesce(cf.cf, 0.0) + CAST({b} AS DOUBLE) * CASE WHEN coalesce(u.has_profile, false) "
         f"THEN 1.0 + 4.0 * coalesce(d.dot, 0.0) ELSE 0.0 END + CAST({c} AS DOUBLE) * ct.pop_i)")
    return f"""
SELECT t.*, CASE WHEN ct.pop_i IS NOT NULL AND {h} > 0 THEN {clip(h)}
                 ELSE coalesce({clip('p.avg_signal')}, {clip('(SELECT mavg FROM meanavg)')}, 3.0) END AS prediction
FROM ({pairs}) t LEFT JOIN cf ON cf.user_id = t.user_id AND cf.item_id = t.item_id
LEFT JOIN dots d ON d.user_id = t.user_id AND d.item_id = t.item_id
LEFT JOIN cat ct ON ct.item_id = t.item_id LEFT JOIN kusers u ON u.user_id = t.user_id
LEFT JOIN popularity p ON p.item_id = t.item_id"""
