"""TF-IDF item vectors, user profiles and content scores in long form.

Vectors are rows ``(item_id, term, weight)``; only non-zero entries exist.
idf is the smoothed ``ln((1 + n) / (1 + df)) + 1`` and rows are L2-normalised.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.functions.text import STOP_WORDS_EN, terms_frame
from veritab.operators.recsys.similarity import blocked_join, top_k_per_key
from veritab.session import materialize, own_partitions, tell_workers

#: terms in at least one of so many documents are looked up in a broadcast table, which so has at most this many times
#: the distinct terms of an average document, however many documents there are
COMMON = 1_000
#: users whose profiles are summed in one task, about
USERS_PER_TASK = 500
#: ids of the left and of the right side whose products one task makes; ids, terms and rows that it holds at a time
LEFT_ROWS, RIGHT_ROWS, LEFT_AT_ONCE, TERMS_AT_ONCE, ROWS_AT_ONCE = 2_000, 8_000, 128, 512, 65_536


def tfidf(docs: DataFrame, id_col: str = "item_id", text_col: str = "content_text", stop_words=STOP_WORDS_EN,
          ngram_max: int = 2) -> DataFrame:
    """``(id, term, weight)``."""
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    # the texts are dealt by document before they are opened, so their terms are counted where they lie
    exploded = terms_frame(docs.select(id_col, text_col).repartition(id_col), id_col, text_col, stop_words, ngram_max)
    tf = materialize(exploded.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")), "tf")
    dfreq = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    often = F.col("df") * COMMON >= n_docs
    met = tf.join(F.broadcast(dfreq.where(often)), "term", "left").select(id_col, "term", "tf", "df")
    rare = met.where("df IS NULL").drop("df").join(dfreq.where(~often).hint("merge"), "term")
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    weighted = met.where("df IS NOT NULL").unionByName(rare).select(id_col, "term", (F.col("tf") * idf).alias("w"))
    norms = materialize(weighted.groupBy(F.col(id_col).alias("_id")).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm")), "norms")
    return weighted.join(norms, F.col(id_col).eqNullSafe(F.col("_id"))).select(id_col, "term", (F.col("w") / F.col("_norm")).alias("weight"))


def content_top(asked: DataFrame, vectors: DataFrame, k: int, id_col: str = "item_id") -> DataFrame:
    """R12 cut to the ``k`` nearest others of each asked item: (a, b, sim, rank)."""
    vectors = vectors.where(F.col(id_col).isNotNull())
    own = vectors.join(asked.select(id_col).distinct(), id_col, "left_semi").withColumnRenamed(id_col, "a")
    return top_k_per_key(products(own, vectors.withColumnRenamed(id_col, "b"), "a", "b", "sim", k), k)


def content_similarity(asked: DataFrame, vectors: DataFrame, id_col: str = "item_id") -> DataFrame:
    """Dot products of the asked items with every other item sharing a term; (a, b, sim)."""
    a = vectors.join(asked.select(id_col).distinct(), id_col, "left_semi") \
        .select(F.col(id_col).alias("a"), "term", F.col("weight").alias("wa"))
    b = vectors.select(F.col(id_col).alias("b"), "term", F.col("weight").alias("wb"))
    return blocked_join(a, b, "term", "b").where(F.col("a") != F.col("b")).groupBy("a", "b") \
        .agg(F.sum(F.col("wa") * F.col("wb")).alias("sim"))


def user_profiles(train: DataFrame, vectors: DataFrame, user: str = "user_id", item: str = "item_id",
                  signal: str = "signal") -> DataFrame:
    """``(user, term, weight)`` = sum(signal * vec) / sum(signal) over the user's rows with a catalog item.

    Every train row counts (a repeated item counts again); when the signal sum is
    not positive all weights are 1. Users without catalog items get no profile.
    """
    lists = vectors.groupBy(item).agg(F.collect_list(F.struct("term", "weight")).alias("_l")) \
        .select(item, F.col("_l.term").alias("_terms"), F.col("_l.weight").alias("_weights"))
    # repeated items are summed per user before they meet the vectors, which travel to the user as lists
    rows = train.where(F.col(user).isNotNull()).select(user, item, F.col(signal).cast("double").alias("_s"))
    per_item = rows.groupBy(user, item).agg(F.sum("_s").alias("_s"), F.count(F.lit(1)).alias("_c"))
    met = per_item.join(lists.hint("merge"), item).drop(item).repartition(_tasks(rows, user), user)
    opened = _with_shares(met, user).select(user, "share", F.explode(F.arrays_zip("_terms", "_weights")).alias("_e"))
    return opened.select(user, F.col("_e._terms").alias("term"), (F.col("share") * F.col("_e._weights")).alias("w")) \
        .groupBy(user, "term").agg(F.sum("w").alias("weight"))


def _tasks(rows: DataFrame, user: str) -> int:
    users = rows.select(user).distinct().count()
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(10_000, users // USERS_PER_TASK))


def _with_shares(met: DataFrame, user: str) -> DataFrame:
    """``met`` (user, _s, _c, ...) with the ``share`` of each row in its user's profile."""
    own = Window.partitionBy(user)
    met = met.withColumns({"_ssum": F.sum("_s").over(own), "_n": F.sum("_c").over(own)})
    use_ones = F.col("_ssum") <= 0
    return met.withColumn("share", F.when(use_ones, F.col("_c").cast("double")).otherwise(F.col("_s"))
                          / F.when(use_ones, F.col("_n").cast("double")).otherwise(F.col("_ssum")))


def profile_shares(train: DataFrame, vectors: DataFrame, user: str = "user_id", item: str = "item_id",
                   signal: str = "signal") -> DataFrame:
    """R13 without the terms: ``(user, item, share)`` of the items with a vector; a profile is the sum of share * vec."""
    rows = train.where(F.col(user).isNotNull()).select(user, item, F.col(signal).cast("double").alias("_s"))
    rows = rows.join(vectors.select(item).distinct(), item, "left_semi")
    per_item = rows.repartition(_tasks(rows, user), user).groupBy(user, item).agg(F.sum("_s").alias("_s"), F.count(F.lit(1)).alias("_c"))
    return _with_shares(per_item, user).select(user, item, "share")


def profile_dots(profiles: DataFrame, vectors: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """R14 core: ``(user, item, dot)`` for item vectors sharing at least one term with the profile."""
    return products(profiles, vectors, user, item, "dot")


def products(left: DataFrame, right: DataFrame, a: str, b: str, value: str, k: int | None = None) -> DataFrame:
    """``(a, b, value)``: inner products of all ``left`` (a, term, weight) and ``right`` (b, term, weight) that share a term;
    rows are unique by id and term. With ``k`` at least the first ``k`` of each a by value (to 1e-9) desc, b asc, and no b that is a.

    Blocks of both sides meet in one task each, which adds up their products: nothing is dealt per pair or per pair and term.
    """
    spark = left.sparkSession
    tell_workers(spark)
    sides = []
    for df, name, most in ((left, a, LEFT_ROWS), (right, b, RIGHT_ROWS)):
        df = materialize(df.select(F.col(name).alias("id"), "term", F.col("weight").cast("double").alias("w")).dropna(subset=["term", "w"]), "factors")
        sides.append((df, max(1, -(-df.select("id").distinct().count() // most))))
    (x, n_x), (y, n_y) = sides
    none = lambda df: F.lit(None).cast(df.schema["id"].dataType)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    rows = x.select(F.lit(True).alias("left"), F.col("id").alias("a"), none(y).alias("b"), "term", "w", block(n_x).alias("_x"), every(n_y).alias("_y")) \
        .unionByName(y.select(F.lit(False).alias("left"), none(x).alias("a"), F.col("id").alias("b"), "term", "w", block(n_y).alias("_y"), every(n_x).alias("_x")))
    slots = F.array(*[F.lit(s) for s in own_partitions(spark, n_x * n_y)])
    dealt = rows.withColumn("slot", F.get(slots, F.col("_x") * n_y + F.col("_y"))).drop("_x", "_y").repartition(n_x * n_y, "slot")
    schema = T.StructType([T.StructField(a, x.schema["id"].dataType), T.StructField(b, y.schema["id"].dataType), T.StructField(value, T.DoubleType())])
    return dealt.mapInArrow(lambda batches: _products(batches, (a, b, value), k), schema)


def _by(of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of ``of``, and where each of its ``n`` numbers starts."""
    return np.argsort(of, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))])


def _products(batches: Iterator[pa.RecordBatch], names: tuple[str, str, str], k: int | None) -> Iterator[pa.RecordBatch]:
    batches = list(batches)
    if not batches:
        return
    table = pa.Table.from_batches(batches)
    term = table["term"].combine_chunks().dictionary_encode()
    term, n_terms, w, left = term.indices.to_numpy(), len(term.dictionary), table["w"].to_numpy(), table["left"].to_numpy().astype(bool)
    def ids(column: str, of: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        coded = table[column].filter(pa.array(of)).combine_chunks().dictionary_encode(null_encoding="encode")
        return coded.dictionary, coded.indices.to_numpy()
    (x_ids, x), (y_ids, y) = ids("a", left), ids("b", ~left)
    if not len(x) or not len(y):
        return
    n, (x_term, x_w), (y_term, y_w) = len(y_ids), (term[left], w[left]), (term[~left], w[~left])
    order, starts = _by(y_term, n_terms)
    y, y_w = y[order], y_w[order]
    # terms that many of the right side have are multiplied whole, the others one by one
    common = np.flatnonzero(np.diff(starts) * 16 > n)
    rank = np.full(n_terms, -1)
    dense = []
    for a in range(0, len(common), TERMS_AT_ONCE):
        some = common[a:a + TERMS_AT_ONCE]
        rank[some] = np.arange(a, a + len(some))
        weights, has = np.zeros((len(some), n)), np.zeros((len(some), n), np.float32)
        for i, t in enumerate(some):
            weights[i, y[starts[t]:starts[t + 1]]] = y_w[starts[t]:starts[t + 1]]
            has[i, y[starts[t]:starts[t + 1]]] = 1
        dense.append((weights, has))
    order, own = _by(x, len(x_ids))
    x, x_term, x_w = x[order], x_term[order], x_w[order]
    if k:
        place = np.empty(n, np.int64)
        place[pc.sort_indices(y_ids).to_numpy()] = np.arange(n)
        same = pc.index_in(x_ids, y_ids).fill_null(-1).to_numpy() if x_ids.type == y_ids.type else np.full(len(x_ids), -1)
    for a in range(0, len(x_ids), LEFT_AT_ONCE):
        b = min(len(x_ids), a + LEFT_AT_ONCE)
        rows, terms, weights = x[own[a]:own[b]] - a, x_term[own[a]:own[b]], x_w[own[a]:own[b]]
        dot, met = np.zeros((b - a, n)), np.zeros((b - a, n), bool)
        for i, (many, has) in enumerate(dense):
            here = (rank[terms] // TERMS_AT_ONCE == i) & (rank[terms] >= 0)
            part, mask = np.zeros((b - a, len(many))), np.zeros((b - a, len(many)), np.float32)
            part[rows[here], rank[terms[here]] % TERMS_AT_ONCE] = weights[here]
            mask[rows[here], rank[terms[here]] % TERMS_AT_ONCE] = 1
            dot += part @ many
            met |= mask @ has > 0
        rare = np.flatnonzero(rank[terms] < 0)
        rare = rare[np.argsort(terms[rare], kind="stable")]
        for some in np.split(rare, np.flatnonzero(np.diff(terms[rare])) + 1) if len(rare) else ():
            t = terms[some[0]]
            at, theirs = y[starts[t]:starts[t + 1]], y_w[starts[t]:starts[t + 1]]
            if len(at):
                cells = np.ix_(rows[some], at)
                dot[cells] += weights[some][:, None] * theirs
                met[cells] = True
        if k:
            held = np.flatnonzero(same[a:b] >= 0)
            met[held, same[a:b][held]] = False
        i, j = np.nonzero(met)
        if k:
            order = np.lexsort((place[j], -np.round(dot[i, j], 9), i))
            i, j = i[order], j[order]
            i, j = (v[np.arange(len(i)) - np.searchsorted(i, i) < k] for v in (i, j))
        for c in range(0, len(i), ROWS_AT_ONCE):
            u, v = i[c:c + ROWS_AT_ONCE], j[c:c + ROWS_AT_ONCE]
            yield pa.RecordBatch.from_arrays([x_ids.take(pa.array(a + u)), y_ids.take(pa.array(v)), pa.array(dot[u, v])], names=list(names))


def content_scores(dots: DataFrame) -> DataFrame:
    """score = 1 + 4 * dot (items without a shared term score 1 for a user with a profile)."""
    return dots.withColumn("content_score", F.lit(1.0) + F.lit(4.0) * F.col("dot"))
