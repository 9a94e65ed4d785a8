"""Profiling tables (the data behind the reference's EDA charts).

Each profile is a fixed number of aggregate passes over the input; results
are long tables (one row per column, pair, bin or item).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.operators.prefix import global_running_sums

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def value_counts(df: DataFrame, cols: list[str], dtype: str) -> DataFrame:
    """(column, value, n) of the non-null values of every column, in one pass with map-side counts."""
    kv = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(dtype).alias("value")) for c in cols])
    return df.select(F.explode(kv).alias("kv")).select("kv.*").where(F.col("value").isNotNull()) \
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(df: DataFrame, cols: list[str], probs: tuple[float, ...]) -> DataFrame:
    """(column, p, value): quantiles with linear interpolation, from value counts and running counts.

    The value at position h = p (n - 1) lies between the values at floor(h) and
    ceil(h); a value holds the positions from its running count before to the
    one after. No column is ever sorted or held in one task.
    """
    counts = value_counts(df, cols, "double")
    ran = global_running_sums(counts, [F.col("column").asc(), F.col("value").asc()], {"upto": F.col("n")})
    totals = ran.groupBy("column").agg(F.sum("n").alias("rows"), F.min(F.col("upto") - F.col("n")).alias("start"))
    placed = ran.join(F.broadcast(totals), "column") \
        .withColumns({"hi": F.col("upto") - F.col("start"), "lo": F.col("upto") - F.col("start") - F.col("n")}) \
        .withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs]))) \
        .withColumn("h", F.col("p") * (F.col("rows") - 1))
    has = lambda at: (at >= F.col("lo")) & (at < F.col("hi"))
    low, high = F.floor("h"), F.ceil("h")
    ends = placed.where(has(low) | has(high)).groupBy("column", "p").agg(
        F.first("h").alias("h"), F.max(F.when(has(low), F.col("value"))).alias("a"),
        F.max(F.when(has(high), F.col("value"))).alias("b"))
    return ends.select("column", "p", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("h") - F.floor("h"))).alias("value"))


def most_frequent(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value): the most frequent non-null value as text; ties -> smallest."""
    counts = value_counts(df, cols, "string")
    return counts.groupBy("column").agg(F.min_by("value", F.struct(F.negative(F.col("n")), F.col("value"))).alias("value"))


def describe_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """X1 (numeric part): count, mean, sample std, min, quartiles (linear interpolation), max per column."""
    cols = cols or numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
                 F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
    stack = ", ".join(f"'{c}', n{i}, mean{i}, std{i}, min{i}, max{i}" for i, c in enumerate(cols))
    stats = df.agg(*aggs).selectExpr(f"stack({len(cols)}, {stack}) AS (column, count, mean, std, min, max)")
    at = lambda p, name: F.max(F.when(F.col("p") == p, F.col("value"))).alias(name)
    quartiles = exact_quantiles(df, cols, (0.25, 0.5, 0.75)).groupBy("column").agg(
        at(0.25, "p25"), at(0.5, "p50"), at(0.75, "p75"))
    return stats.join(quartiles, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_categorical(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """X1 (object part): count, unique, top (most frequent; tie -> smallest), freq per column."""
    cols = cols or string_columns(df)
    parts = []
    for c in cols:
        counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("freq"))
        parts.append(counts.agg(
            F.sum("freq").alias("count"), F.count(F.lit(1)).alias("unique"),
            F.min_by("value", F.struct(F.negative(F.col("freq")), F.col("value"))).alias("top"),
            F.max("freq").alias("freq"),
        ).select(F.lit(c).alias("column"), "count", "unique", "top", "freq"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def class_distribution(df: DataFrame, label_col: str) -> DataFrame:
    """Count and ratio (rounded to 4) per class; the total is a scalar subquery."""
    total = df.select(F.count(F.lit(1))).scalar()
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count")) \
        .withColumn("ratio", F.round(F.col("count") / total, 4))


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing count and percent per column, one aggregate pass; sorted by count desc, name."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"m{i}")
                                                     for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', m{i}" for i, c in enumerate(cols))
    long = row.selectExpr("_rows", f"stack({len(cols)}, {stack}) AS (column, missing)")
    return long.select("column", F.col("missing").cast("long").alias("missing"),
                       F.when(F.col("_rows") == 0, F.lit(0.0))
                       .otherwise(F.col("missing") * 100.0 / F.col("_rows")).alias("missing_pct"))


def missing_profile_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """Missing profile of two tables stacked (columns absent in one side count as missing)."""
    return missing_profile(a.unionByName(b, allowMissingColumns=True))


def pairwise_correlation(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every numeric pair, pairwise-complete, in one aggregate pass."""
    cols = cols or numeric_columns(df)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
                   for i, (a, b) in enumerate(pairs)])
    stack = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    return row.selectExpr(f"stack({len(pairs)}, {stack}) AS (col_a, col_b, corr)")


def class_histogram(df: DataFrame, value_col: str, label_col: str | None, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max] (max falls in the last bin); density normalised per class.

    Two passes: the range, then one grouped count; class sizes are sums of the counts.
    """
    x = F.col(value_col).cast("double")
    stats = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx")).select(F.struct("mn", "mx")).scalar()
    mn, mx = stats.getField("mn"), stats.getField("mx")
    width = (mx - mn) / bins
    b = F.least(F.floor((x - mn) / (mx - mn) * bins) + 1, F.lit(bins))
    b = F.when(mx == mn, F.lit(1)).otherwise(b).cast("int")
    keys = [label_col] if label_col else []
    counted = df.where(x.isNotNull()).groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    # one row per class and bin
    counted = counted.withColumn("_n", F.sum("count").over(Window.partitionBy(*keys)))
    w = F.when(width == 0, F.lit(1.0)).otherwise(width)
    return counted.select(*keys, "bin", (mn + (F.col("bin") - 1) * width).alias("bin_lo"), "count",
                          (F.col("count") / (F.col("_n") * w)).alias("density"))


def kde_curve(df: DataFrame, value_col: str, label_col: str | None = None, grid: int = 200,
              cut: float = 3.0) -> DataFrame:
    """Gaussian KDE per class on a ``grid``-point line, Scott bandwidth std * n^(-1/5).

    Rows are first collapsed to (class, value, weight); every distinct value then
    emits its kernel at the grid points (an ``explode`` of a fixed-size array,
    not a join) and a grouped sum adds them up.
    """
    keys = [label_col] if label_col else []
    x = F.col(value_col).cast("double")
    base = df.where(x.isNotNull()).select(*keys, x.alias("x"))
    stats = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"),
                                    F.min("x").alias("lo"), F.max("x").alias("hi"))
    stats = stats.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))) \
        .withColumn("g0", F.col("lo") - cut * F.col("bw")) \
        .withColumn("step", ((F.col("hi") + cut * F.col("bw")) - F.col("g0")) / (grid - 1))
    weighted = base.groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("w"))
    if not keys:  # one class: join on a constant key (the stats table has one row)
        weighted, stats, keys = weighted.withColumn("_all", F.lit(0)), stats.withColumn("_all", F.lit(0)), ["_all"]
    j = weighted.join(F.broadcast(stats), keys)
    pts = j.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    gx = F.col("g0") + F.col("g") * F.col("step")
    z = (gx - F.col("x")) / F.col("bw")
    k = F.col("w") * F.exp(-0.5 * z * z) / (F.col("n") * F.col("bw") * F.lit(math.sqrt(2 * math.pi)))
    out = pts.groupBy(*keys, "g").agg(F.first(gx).alias("x"), F.sum(k).alias("density"))
    return out.drop("_all") if "_all" in keys else out


def interactions_per_user(interactions: DataFrame, user_col: str = "user_id") -> DataFrame:
    return interactions.groupBy(user_col).agg(F.count(F.lit(1)).alias("n_interactions"))


def top_items_by_volume(interactions: DataFrame, n: int = 12, item_col: str = "item_id") -> DataFrame:
    """The n most frequent items (count desc, item asc)."""
    return interactions.groupBy(item_col).agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.col("count").desc(), F.col(item_col)).limit(n)


def popular_items_with_titles(interactions: DataFrame, items: DataFrame, n: int = 10, item_col: str = "item_id",
                              rating_col: str = "rating") -> DataFrame:
    """Top n items by count with average rating, left-joined to title / genres."""
    top = interactions.groupBy(item_col).agg(F.count(F.lit(1)).alias("count"), F.avg(rating_col).alias("avg_rating")) \
        .orderBy(F.col("count").desc(), F.col(item_col)).limit(n)
    return top.join(items.select(item_col, "title", "genres"), item_col, "left")


def item_pearson(asked: DataFrame, matrix: DataFrame, user_col: str = "user_id", item_col: str = "item_id",
                 value_col: str = "r") -> DataFrame:
    """X11: Pearson over zero-filled user columns of every asked item a and every other item b sharing a user.

    With n = number of users, Sx = sum, Sxx = sum of squares per item and Sxy
    over common users, r = (n Sxy - Sx Sy) / sqrt((n Sxx - Sx^2)(n Syy - Sy^2));
    the zero entries never need to exist.
    """
    from veritab.operators.recsys.similarity import blocked_join

    n_users = matrix.select(user_col).distinct().agg(F.count(user_col)).scalar()
    stats = matrix.groupBy(item_col).agg(F.sum(value_col).alias("_s"), F.sum(F.col(value_col) ** 2).alias("_q"))
    # an item's sums travel with its entries, so the pairs are dealt once
    rows = matrix.join(stats, item_col)
    a = rows.join(asked.select(item_col).distinct(), item_col, "left_semi").select(
        F.col(user_col), F.col(item_col).alias("a"), F.col(value_col).alias("xa"), F.col("_s").alias("sa"), F.col("_q").alias("saa"))
    b = rows.select(F.col(user_col), F.col(item_col).alias("b"), F.col(value_col).alias("xb"), F.col("_s").alias("sb"),
                    F.col("_q").alias("sbb"))
    j = blocked_join(a, b, user_col, "b").where(F.col("a") != F.col("b")).groupBy("a", "b").agg(
        F.sum(F.col("xa") * F.col("xb")).alias("sxy"), *[F.first(c).alias(c) for c in ("sa", "saa", "sb", "sbb")])
    num = n_users * F.col("sxy") - F.col("sa") * F.col("sb")
    den = F.sqrt((n_users * F.col("saa") - F.col("sa") ** 2) * (n_users * F.col("sbb") - F.col("sb") ** 2))
    return j.select("a", "b", F.when(den > 0, num / den).alias("corr"))


def catalog_coverage(interactions: DataFrame, items: DataFrame, item_col: str = "item_id") -> DataFrame:
    """Distinct interacted items / catalog items."""
    used = interactions.select(F.count_distinct(item_col)).scalar()
    total = items.select(F.count_distinct(item_col)).scalar()
    return interactions.sparkSession.range(1).select(
        used.alias("items_interacted"), total.alias("catalog_items"),
        F.when(total == 0, F.lit(0.0)).otherwise(used / total).alias("coverage"))


def popularity_curve(interactions: DataFrame, item_col: str = "item_id") -> DataFrame:
    """(rank, count) with rank 1 = most interacted item (count desc, item asc).

    The global rank is a running count (no single-task window).
    """
    counts = interactions.groupBy(item_col).agg(F.count(F.lit(1)).alias("count"))
    ranked = global_running_sums(counts, [F.col("count").desc(), F.col(item_col).asc()], {"rank": F.lit(1)})
    return ranked.select(item_col, "count", F.col("rank").cast("long").alias("rank"))


def head_share(interactions: DataFrame, item_col: str = "item_id", head_fraction: float = 0.2) -> DataFrame:
    """Share of all interactions taken by the top max(1, int(0.2 n)) items."""
    curve = popularity_curve(interactions, item_col)
    n_items = curve.select(F.count(F.lit(1))).scalar()
    head_n = F.greatest(F.lit(1), F.floor(n_items * F.lit(head_fraction)))
    return curve.agg(F.sum(F.when(F.col("rank") <= head_n, F.col("count")).otherwise(0)).alias("head_interactions"),
                     F.sum("count").alias("total_interactions")) \
        .withColumn("head_share", F.col("head_interactions") / F.col("total_interactions"))
