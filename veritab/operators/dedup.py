"""Deterministic deduplication and distinct counts.

``keep_first`` is the Spark form of pandas ``drop_duplicates(keep='first')``:
the first row of each key in an explicit order. It is an aggregate
(``min`` of a struct led by the order columns), so copies collapse in the
map-side partial aggregation and a key holding a third of all rows never
becomes one sorted window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order_cols: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """First row per ``keys`` ordered by ``order_cols`` then every remaining column."""
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in (order_cols or []) if c not in keys]
    payload = order + [c for c in rest if c not in order]
    if not payload:
        return df.select(*keys).distinct()
    first = F.min(F.struct(*[F.col(c) for c in payload])).alias("_first")
    out = df.groupBy(*keys).agg(first)
    return out.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def dedup_transactions(df: DataFrame, id_col: str = "transaction_id", order_cols=None) -> DataFrame:
    """One row per transaction id, first in file order."""
    return keep_first(df, [id_col], order_cols)


def dedup_items(df: DataFrame, item_col: str = "item_id", order_cols=None) -> DataFrame:
    """D3: one row per item id, first in catalog order."""
    return keep_first(df, [item_col], order_cols)


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    """Exact number of distinct values."""
    return df.agg(F.count_distinct(col).alias(f"n_distinct_{col}"))
