"""The long user-item matrix, its sparsity and item popularity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.config import RecColumns


def user_item_matrix(train: DataFrame, cols: RecColumns = RecColumns()) -> DataFrame:
    """Mean signal per (user, item); absent pairs are implicit zeros (never pivoted)."""
    return train.groupBy(cols.user, cols.item).agg(F.avg(cols.target).alias("r"))


def sparsity(matrix: DataFrame, cols: RecColumns = RecColumns()) -> DataFrame:
    """R2: 1 - nonzero / (users * items); an empty matrix is fully sparse.

    Users and items are counted by a grouping each: distinct counts of two columns in one aggregate would write every
    row three times.
    """
    nonzero = matrix.agg(F.count_if(F.col("r") != 0)).scalar()
    n_users, n_items = (matrix.select(c).distinct().agg(F.count(c)).scalar() for c in (cols.user, cols.item))
    total = F.col("n_users").cast("double") * F.col("n_items")
    counts = matrix.sparkSession.range(1).select(nonzero.alias("nonzero"), n_users.alias("n_users"), n_items.alias("n_items"))
    return counts.select(F.when(total == 0, F.lit(1.0)).otherwise(F.lit(1.0) - F.col("nonzero") / total).alias("sparsity"),
                         "n_users", "n_items", "nonzero")


def popularity(train: DataFrame, cols: RecColumns = RecColumns()) -> DataFrame:
    """Average signal and interaction count per item."""
    return train.groupBy(cols.item).agg(F.avg(cols.target).alias("avg_signal"),
                                        F.count(F.lit(1)).alias("interaction_count"))


def popularity_order(cols: RecColumns = RecColumns()):
    """Ranking of R3: avg desc, count desc, item asc (avg compared at 1e-9 so engines agree on ties)."""
    return [F.round("avg_signal", 9).desc(), F.col("interaction_count").desc(), F.col(cols.item).asc()]


def top_popular(pop: DataFrame, n: int, cols: RecColumns = RecColumns()) -> DataFrame:
    return pop.orderBy(*popularity_order(cols)).limit(n)
