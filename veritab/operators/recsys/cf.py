"""Collaborative filtering scores, blend, prediction and top-N for asked users.

Scores exist only for (user, item) pairs that share a co-occurrence; every
other train item scores 0. Top-N therefore ranks the touched items together
with the first ``n + |seen|`` train items in tie-break order (item id), which
contains every untouched item that could reach the list - no user x item
cross join is ever formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.operators.prefix import global_running_sums
from veritab.operators.recsys.signals import clip
from veritab.operators.recsys.similarity import blocked_join, item_cosine, top_k_per_key, user_cosine

U, I = "user_id", "item_id"


#: ratings of one user that travel as one row, and asked users whose sums are made in one task, about
LIST_ROWS, USERS_PER_TASK = 1_000, 50


def with_norms(matrix: DataFrame) -> DataFrame:
    """(user, item, r, nj, nu): the ratings with the norms of their item and user."""
    inorm = matrix.groupBy(I).agg(F.sqrt(F.sum(F.col("r") * F.col("r"))).alias("nj"))
    unorm = matrix.groupBy(U).agg(F.sqrt(F.sum(F.col("r") * F.col("r"))).alias("nu"))
    return matrix.join(inorm, I).join(unorm, U).select(U, I, "r", "nj", "nu")


def rating_lists(matrix: DataFrame) -> DataFrame:
    """(v, items, rs): the ratings of every user as lists; those of a user with very many are cut into several."""
    m = matrix.select(F.col(U).alias("v"), I, "r")
    heavy = F.broadcast(m.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / LIST_ROWS).cast("long").alias("_lists")).where("_lists > 1"))
    cut = m.join(heavy, "v", "left").withColumn("_list", F.pmod(F.xxhash64(I), F.coalesce("_lists", F.lit(1).cast("long"))))
    return cut.groupBy("v", "_list").agg(F.collect_list(F.struct(I, "r")).alias("_l")) \
        .select("v", F.col(f"_l.{I}").alias("items"), F.col("_l.r").alias("rs"))


def sums_of_ratings(pairs: DataFrame, matrix: DataFrame, sums: list[Column]) -> DataFrame:
    """``sums`` per (user, item) over the ratings (item, r) of every v of ``pairs`` (user, v, ...).

    Lists travel to the users that ask and are opened there, so what is dealt is a row per pair and not one per
    pair and rating.
    """
    asked = pairs.select(U).distinct().count()
    tasks = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(10_000, asked // USERS_PER_TASK))
    met = pairs.join(rating_lists(matrix), "v").drop("v").repartition(tasks, U)
    opened = met.select("*", F.explode(F.arrays_zip("items", "rs")).alias("_e")).drop("items", "rs")
    return opened.withColumns({I: F.col("_e.items"), "r": F.col("_e.rs")}).drop("_e").groupBy(U, I).agg(*sums)


def co_raters(asked: DataFrame, normed: DataFrame, k: int | None = None) -> DataFrame:
    """(user, v, A, B, nb_sim, uden) for every asked user and every user v sharing an item with them.

    One join of the asked users' ratings with all ratings of the same items gives, for every such pair:
      dot(u,v) = sum_j r(u,j) r(v,j)            -> user cosine (R5) and the top-k neighbours (R7)
      A(u,v)   = sum_j r(u,j) r(v,j) / |j|      -> item-based numerator (R6)
      B(u,v)   = sum_j r(v,j) / |j|             -> item-based denominator (R6)
    because sum_j sim(i,j) r(u,j) = (1/|i|) sum_v r(v,i) A(u,v) and sum_j |sim(i,j)| = (1/|i|) sum_v r(v,i) B(u,v)
    (no value is negative); the 1/|i| cancels in the ratio. ``nb_sim`` is set for the top-k neighbours; without ``k``
    nobody is ranked.
    """
    share = F.when(F.col("nj") > 0, F.lit(1.0) / F.col("nj")).otherwise(0.0)
    left = normed.join(asked.select(U).distinct(), U, "left_semi").select(U, I, F.col("r").alias("ru"), "nu")
    right = normed.select(F.col(U).alias("v"), I, F.col("r").alias("rv"), share.alias("_per"), F.col("nu").alias("nv"))
    sums = [F.sum(F.col("ru") * F.col("rv") * F.col("_per")).alias("A"), F.sum(F.col("rv") * F.col("_per")).alias("B")]
    met = blocked_join(left, right, I, "v")
    if k is None:
        return met.groupBy(U, "v").agg(*sums)
    pairs = met.groupBy(U, "v").agg((F.sum(F.col("ru") * F.col("rv")) / (F.first("nu") * F.first("nv"))).alias("sim"), *sums)
    near = Window.partitionBy(U).orderBy((F.col("v") == F.col(U)).asc(), F.round("sim", 9).desc(), F.col("v").asc())
    ranked = pairs.withColumn("_n", F.row_number().over(near))
    is_near = (F.col("_n") <= k) & (F.col("v") != F.col(U)) & (F.col("sim") > 0)
    ranked = ranked.withColumn("nb_sim", F.when(is_near, F.col("sim")))
    return ranked.withColumn("uden", F.sum(F.abs("nb_sim")).over(Window.partitionBy(U))).select(U, "v", "A", "B", "nb_sim", "uden")


def cf_sums() -> list[Column]:
    return [F.sum(F.col("r") * F.col("A")).alias("inum"), F.sum(F.col("r") * F.col("B")).alias("iden"),
            F.sum(F.col("r") * F.col("nb_sim")).alias("unum"), F.first("uden").alias("uden")]


def blended(item_blend: float, user_blend: float) -> Column:
    """R8 from the summed contributions of a pair."""
    item_score = F.when(F.col("iden") != 0, F.col("inum") / F.col("iden")).otherwise(0.0)
    user_score = F.coalesce(F.col("unum") / F.col("uden"), F.lit(0.0))
    return F.when(F.col("uden").isNotNull(), F.lit(item_blend) * F.coalesce(item_score, F.lit(0.0))
                  + F.lit(user_blend) * user_score).otherwise(F.coalesce(item_score, F.lit(0.0)))


def _has_negative(matrix: DataFrame) -> bool:
    return not matrix.where(F.col("r") < 0).isEmpty()


def item_based_scores(asked: DataFrame, matrix: DataFrame) -> DataFrame:
    """R6 for the asked users: sum_j sim(i,j) r(u,j) / sum_j |sim(i,j)| over the user's items j; 0/0 -> 0.

    Without negative ratings both sums follow from the co-raters, and no similarity of two items is written down.
    """
    if _has_negative(matrix):
        m = matrix.join(asked.select(U).distinct(), U, "left_semi").select(U, F.col(I).alias("j"), "r")
        s = item_cosine(m.select(F.col("j").alias(I)), matrix).select(F.col("a").alias("j"), F.col("b").alias(I), "sim")
        agg = m.join(s, "j").groupBy(U, I).agg(F.sum(F.col("sim") * F.col("r")).alias("inum"), F.sum(F.abs("sim")).alias("iden"))
    else:
        # a rating without an item is similar to nothing
        agg = sums_of_ratings(co_raters(asked, with_norms(matrix)), matrix.where(F.col(I).isNotNull()), cf_sums()[:2])
    return agg.select(U, I, F.when(F.col("iden") != 0, F.col("inum") / F.col("iden")).otherwise(0.0).alias("item_score"))


def neighbours(user_sim: DataFrame, k: int = 20) -> DataFrame:
    """Top-k other users with positive similarity (sim desc, user asc)."""
    pos = user_sim.where((F.col("a") != F.col("b")) & (F.col("sim") > 0))
    return top_k_per_key(pos, k).select(F.col("a").alias(U), F.col("b").alias("v"), "sim")


def user_based_scores(matrix: DataFrame, nbrs: DataFrame) -> DataFrame:
    """sum_v sim(u,v) r(v,i) / sum_v |sim(u,v)| over the neighbours (missing r counts 0)."""
    den = nbrs.groupBy(U).agg(F.sum(F.abs("sim")).alias("_den"))
    m = matrix.select(F.col(U).alias("v"), I, "r")
    num = nbrs.join(m, "v").groupBy(U, I).agg(F.sum(F.col("sim") * F.col("r")).alias("_num"))
    return num.join(den, U).select(U, I, (F.col("_num") / F.col("_den")).alias("user_score"))


def cf_scores(asked: DataFrame, matrix: DataFrame, k: int = 20, item_blend: float = 0.65,
              user_blend: float = 0.35) -> DataFrame:
    """R8 for the asked users: 0.65 item + 0.35 user, or the item score alone without neighbours; column ``cf``."""
    if not _has_negative(matrix):
        sums = sums_of_ratings(co_raters(asked, with_norms(matrix), k), matrix, cf_sums())
        # a rating without an item is similar to nothing: only neighbours speak for it
        sums = sums.where(F.col(I).isNotNull() | F.col("unum").isNotNull()).withColumn("iden", F.when(F.col(I).isNotNull(), F.col("iden")))
        return sums.select(U, I, blended(item_blend, user_blend).alias("cf"))
    nbrs = neighbours(user_cosine(asked, matrix), k)
    ib = item_based_scores(asked, matrix)
    ub = user_based_scores(matrix, nbrs)
    has_nb = nbrs.select(U).distinct().withColumn("_has_nb", F.lit(True))
    j = ib.join(ub, [U, I], "full_outer").join(has_nb, U, "left")
    score = F.when(F.col("_has_nb"), F.lit(item_blend) * F.coalesce("item_score", F.lit(0.0))
                   + F.lit(user_blend) * F.coalesce("user_score", F.lit(0.0))) \
        .otherwise(F.coalesce("item_score", F.lit(0.0)))
    return j.select(U, I, score.alias("cf"))


def fallback_chain(score, avg_signal, mean_avg):
    """Score > 0 -> clip(score); else item avg_signal; else mean avg_signal; else 3.0 (all clipped)."""
    return F.when(score > 0, clip(score)).otherwise(
        F.coalesce(clip(avg_signal), clip(mean_avg), F.lit(3.0)))


def cf_predict(pairs: DataFrame, cf: DataFrame, pop: DataFrame) -> DataFrame:
    """Prediction for asked (user, item) pairs from their CF scores (see ``hybrid.scores_of_pairs``)."""
    mean_avg = pop.select(F.avg("avg_signal")).scalar()
    j = pairs.join(cf, [U, I], "left").join(pop.select(I, "avg_signal"), I, "left")
    return j.withColumn("prediction", fallback_chain(F.coalesce("cf", F.lit(0.0)), F.col("avg_signal"), mean_avg))


def ranked_items(items: DataFrame, order) -> DataFrame:
    """Global 1-based rank of an item table in ``order``."""
    return global_running_sums(items, order, {"pos": F.lit(1)}).withColumn("pos", F.col("pos").cast("long"))


#: users that meet one rank of a list in one task, about
USERS_PER_RANK = 50_000


def first_k_per_user(users: DataFrame, ranked: DataFrame, k_col: str) -> DataFrame:
    """(user, item) for the first ``k_col`` items of a ranked table, per user, via explode + equi-join on rank.

    Every user holds the first ranks, so these are dealt by user into blocks.
    """
    wanted = users.select(U, F.explode(F.sequence(F.lit(1).cast("long"), F.col(k_col).cast("long"))).alias("pos"))
    return blocked_join(ranked.select("pos", I), wanted, "pos", U, USERS_PER_RANK).select(U, I)


def seen_pairs(train: DataFrame) -> DataFrame:
    """Distinct (user, item) history."""
    return train.select(U, I).distinct()


def cf_recommend(users: DataFrame, train: DataFrame, cf: DataFrame, pop_ranked: DataFrame, n: int = 10) -> DataFrame:
    """Per asked known user, unseen train items by CF score desc (ties item asc), clipped; (user, rank, item, score)."""
    seen = seen_pairs(train).join(users.select(U).distinct(), U, "left_semi")
    per_user = seen.groupBy(U).agg(F.count(F.lit(1)).alias("_nseen")).withColumn("_k", F.col("_nseen") + n)
    by_id = ranked_items(train.select(I).distinct(), [F.col(I).asc()])
    padded = first_k_per_user(per_user, by_id, "_k").withColumn("cf", F.lit(None).cast("double"))
    cands = cf.unionByName(padded).groupBy(U, I).agg(F.max("cf").alias("cf"))
    cands = cands.withColumn("cf", F.coalesce("cf", F.lit(0.0))).join(seen, [U, I], "left_anti")
    top = top_k_per_key(cands.withColumnRenamed(U, "a").withColumnRenamed(I, "b").withColumnRenamed("cf", "sim"), n)
    recs = top.select(F.col("a").alias(U), "rank", F.col("b").alias(I), clip(F.col("sim")).alias("score"))
    # users whose every train item is seen fall back to popularity minus seen
    empty = per_user.join(recs.select(U).distinct(), U, "left_anti")
    fb = popular_minus_seen(empty, seen, pop_ranked, n)
    return recs.unionByName(fb)


def popular_minus_seen(users: DataFrame, seen: DataFrame, pop_ranked: DataFrame, n: int) -> DataFrame:
    """Fallback: the popularity ranking without the user's seen items; score = avg_signal."""
    k = users.join(seen.groupBy(U).agg(F.count(F.lit(1)).alias("_ns")), U, "left") \
        .withColumn("_k", F.coalesce("_ns", F.lit(0)) + n)
    cand = first_k_per_user(k, pop_ranked, "_k").join(seen, [U, I], "left_anti") \
        .join(pop_ranked.select(I, "pos", "avg_signal"), I)
    from pyspark.sql import Window

    w = Window.partitionBy(U).orderBy("pos")
    return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n) \
        .select(U, "rank", I, F.col("avg_signal").alias("score"))
