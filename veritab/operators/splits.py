"""Exact, seeded, engine-independent splits and samples.

Randomness comes from ``md5(seed|key)``: the same text hash in every engine,
so a split is reproducible and checkable. Ranks inside a class use the
two-level rank of ``veritab.operators.prefix`` (no single-task window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.operators.prefix import hash_key, null_safe_join, rank_within


def class_counts(df: DataFrame, label_col: str) -> DataFrame:
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_class_n"))


def ranked_by_class(df: DataFrame, label_col: str, key_cols: list[str], seed: int = 42,
                    digits: int = 3) -> DataFrame:
    """Add ``_h`` (md5 hex) and ``_rank`` (0-based position inside the class by ``_h``)."""
    hashed = df.withColumn("_h", hash_key(seed, *key_cols))
    return rank_within(hashed, [label_col], "_h", "_rank", digits)


def stratified_split(df: DataFrame, label_col: str, key_cols: list[str], test_size: float = 0.2, seed: int = 42,
                     digits: int = 3) -> DataFrame:
    """Per class, the first ``round(n_c * test_size)`` rows by hash are ``test``; column ``split``.

    Rows without a label are a class of their own, so no row is lost.
    """
    ranked = ranked_by_class(df, label_col, key_cols, seed, digits)
    counts = class_counts(df, label_col).withColumn("_n_test", F.floor(F.col("_class_n") * test_size + 0.5))
    out = null_safe_join(ranked, F.broadcast(counts), [label_col])  # a row per class
    out = out.withColumn("split", F.when(F.col("_rank") < F.col("_n_test"), F.lit("test")).otherwise(F.lit("train")))
    return out.drop("_h", "_rank", "_class_n", "_n_test")


def stratified_folds(df: DataFrame, label_col: str, key_cols: list[str], k: int = 5, seed: int = 42,
                     digits: int = 3, fold_col: str = "fold") -> DataFrame:
    """fold = (rank inside the class) mod k -> class-balanced, disjoint folds."""
    ranked = ranked_by_class(df, label_col, key_cols, seed, digits)
    return ranked.withColumn(fold_col, (F.col("_rank") % k).cast("int")).drop("_h", "_rank")


def seeded_sample(df: DataFrame, key_cols: list[str], n: int = 3, seed: int = 42) -> DataFrame:
    """N rows ordered by md5(seed|key) (top-k per partition, then merged)."""
    return df.withColumn("_h", hash_key(seed, *key_cols)).orderBy("_h").limit(n).drop("_h")
