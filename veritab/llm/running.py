"""Ranks and running sums over whole groups without one task per group.

Rows carry a position in [0, 1). A group of n rows is cut into about sqrt(n) buckets of its positions; each bucket
is summed by a map-side aggregate, the bucket sums are accumulated over a table of about sqrt(n) rows, and only the
rows of one bucket are ever sorted together. A group that holds a third of all rows is therefore spread over
sqrt(n) tasks of sqrt(n) rows each, at any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.staging import staged

#: a table of so many group sizes at most is broadcast
FEW_GROUPS = 100_000


def running(df: DataFrame, group: str, position: str, ties: list, value: str | None = None) -> DataFrame:
    """Add ``n_group``, ``rank`` (from 0) and, given ``value``, ``before`` (its sum over earlier rows of the group).

    ``df`` must be a written table (see ``staged``): it is read once for the sizes, once for the bucket sums and
    once for the rows. ``group`` must not hold nulls. Rows equal in position and ties are interchangeable.
    """
    sizes = staged(df.groupBy(group).agg(F.count(F.lit(1)).alias("n_group")), "group-sizes")
    few = sizes.count() <= FEW_GROUPS
    cut = df.join(F.broadcast(sizes) if few else sizes, group).withColumn(
        "_bucket", F.floor(F.col(position) * F.ceil(F.sqrt(F.col("n_group")))).cast("long"))
    if not few:  # rows dealt by group for the join must be dealt by bucket, else a hot group stays in one task
        cut = cut.repartition(group, "_bucket")
    sums = [F.count(F.lit(1)).alias("_rows")] + ([F.sum(value).alias("_sum")] if value else [])
    earlier = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy(group, "_bucket").agg(*sums)
    offsets = offsets.select(group, "_bucket", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rank0"),
                             *([F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum0")] if value else []))
    inside = Window.partitionBy(group, "_bucket").orderBy(position, *ties)
    out = cut.join(offsets, [group, "_bucket"])
    out = out.withColumn("rank", F.col("_rank0") + F.row_number().over(inside) - 1)
    if value:
        before = F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1))
        out = out.withColumn("before", F.col("_sum0") + F.coalesce(before, F.lit(0)))
    return out.drop("_bucket", "_rank0", "_sum0")
