"""Cosine similarities of asked entities over the long matrix, by join on the shared key.

Only the asked entities stand on the left of the join, so the work is theirs
and not that of all pairs. A key that very many entities share (a popular item,
a common term) is cut into blocks, so that no task holds all its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: rows of one key that are joined in one task, about
BLOCK_ROWS = 20_000


def blocked_join(few: DataFrame, many: DataFrame, key: str, spread: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Equi-join on ``key``; a key with more than ``block_rows`` rows of ``many`` is dealt by ``spread`` into blocks, each
    met by all of ``few``.

    The table of such keys has at most a ``block_rows``-th of the rows of ``many``; all other keys are joined as they are.
    """
    rows = F.count(F.lit(1))
    heavy = F.broadcast(many.groupBy(key).agg(F.ceil(rows / block_rows).cast("long").alias("_blocks")).where("_blocks > 1"))
    blocks = F.coalesce("_blocks", F.lit(1).cast("long"))
    many = many.join(heavy, key, "left").withColumn("_block", F.pmod(F.xxhash64(spread), blocks)).drop("_blocks")
    few = few.join(heavy, key, "left").withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return few.drop("_blocks").join(many, [key, "_block"]).drop("_block")


def cosine_of(asked: DataFrame, long: DataFrame, key: str, entity: str, value: str) -> DataFrame:
    """cos(a, b) = sum_k x(k,a) x(k,b) / (|a| |b|) of every asked entity a and every b sharing a ``key``; (a, b, sim).

    ``asked`` has a column ``entity``; every neighbour of an asked entity is
    returned, itself included with similarity 1. The entries are divided by
    their entity's norm before they meet, so the pairs are dealt once.
    """
    x = long.select(F.col(key).alias("_k"), F.col(entity).alias("_e"), F.col(value).cast("double").alias("_x"))
    norms = x.groupBy("_e").agg(F.sqrt(F.sum(F.col("_x") * F.col("_x"))).alias("_norm"))
    x = x.join(norms, "_e").select("_k", "_e", F.when(F.col("_norm") > 0, F.col("_x") / F.col("_norm")).otherwise(0.0).alias("_x"))
    wanted = asked.select(F.col(entity).alias("_e")).distinct()
    a = x.join(wanted, "_e", "left_semi").select("_k", F.col("_e").alias("a"), F.col("_x").alias("xa"))
    b = x.select("_k", F.col("_e").alias("b"), F.col("_x").alias("xb"))
    return blocked_join(a, b, "_k", "b").groupBy("a", "b").agg(F.sum(F.col("xa") * F.col("xb")).alias("sim"))


def item_cosine(asked: DataFrame, matrix: DataFrame, user: str = "user_id", item: str = "item_id",
                value: str = "r") -> DataFrame:
    """Cosine of the asked items with the items that share a user."""
    return cosine_of(asked, matrix, user, item, value)


def user_cosine(asked: DataFrame, matrix: DataFrame, user: str = "user_id", item: str = "item_id",
                value: str = "r") -> DataFrame:
    """Cosine of the asked users with the users that share an item."""
    return cosine_of(asked, matrix, item, user, value)


def top_k_per_key(pairs: DataFrame, k: int, key: str = "a", other: str = "b", score: str = "sim") -> DataFrame:
    """Top ``k`` partners per key by score desc, partner asc (window per key; a key's group is its partners)."""
    w = Window.partitionBy(key).orderBy(F.round(score, 9).desc(), F.col(other).asc())
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
