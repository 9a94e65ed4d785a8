"""Global running sums and ranks without an un-partitioned window.

A window with ``orderBy`` but no ``partitionBy`` moves every row to one task.
Instead the rows are cut into ranges of their order by sampled boundaries and
written once with the number of their range; running sums are computed inside
each range, and a range's offset is the sum over the ranges before it - a
table with one row per range, whatever the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.session import materialize


def global_running_sums(df: DataFrame, order: list[Column], values: dict[str, Column], keep_range: bool = False) -> DataFrame:
    """Add inclusive running sums of ``values`` (name -> column) in ``order``.

    The ranges are written before they are used: their boundaries come from a
    sample, and totals and rows must agree on them. ``keep_range`` leaves the
    range number in ``_range``.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    vkeys = {name: f"_v_{name}" for name in values}
    cut = df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id())
    cut = materialize(cut.withColumns({vkeys[n]: c for n, c in values.items()}), "ranges")
    totals = cut.groupBy("_range").agg(*[F.sum(vkeys[n]).alias(vkeys[n]) for n in values])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", *[F.coalesce(F.sum(vkeys[n]).over(before), F.lit(0)).alias(f"_off_{n}")
                                        for n in values])
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumns({f"_in_{n}": F.sum(vkeys[n]).over(within) for n in values})
    out = local.join(F.broadcast(offsets), "_range").withColumns(
        {n: F.col(f"_off_{n}") + F.col(f"_in_{n}") for n in values})
    drop = list(vkeys.values()) + [f"_off_{n}" for n in values] + [f"_in_{n}" for n in values]
    return out.drop(*drop, *([] if keep_range else ["_range"]))


def null_safe_join(left: DataFrame, right: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet; the key columns of ``left`` stay."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in cols})
    cond = None
    for c in cols:
        own = left[c].eqNullSafe(renamed[f"_r_{c}"])
        cond = own if cond is None else cond & own
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in cols])


def hash_key(seed: int, *cols: str | Column) -> Column:
    """Text md5 of ``seed|k1|k2...``; identical in Spark and DuckDB for integer/string keys."""
    parts = [F.lit(str(seed))] + [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def rank_within(df: DataFrame, part_cols: list[str], hash_col: str, out_col: str = "_rank",
                digits: int = 3) -> DataFrame:
    """0-based position of each row inside ``part_cols`` ordered by an md5 hex column.

    Two-level: rows are split by the first ``digits`` hex characters of the hash
    (16**digits buckets per group), ranked inside their bucket, and shifted by
    the counts of the preceding buckets. NULL is a group (and a hash) of its own.
    """
    bucket = F.substring(F.col(hash_col), 1, digits)
    b = df.withColumn("_hb", bucket)
    counts = b.groupBy(*part_cols, "_hb").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*part_cols).orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*part_cols, "_hb", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy(*part_cols, "_hb").orderBy(hash_col)
    local = b.withColumn("_rn", F.row_number().over(within))
    out = null_safe_join(local, offsets, [*part_cols, "_hb"])
    return out.withColumn(out_col, (F.col("_off") + F.col("_rn") - 1).cast("long")).drop("_hb", "_rn", "_off")
