"""Class-imbalance handling on DataFrames.

Random oversampling draws, for every missing copy ``j`` of a class, the row
whose in-class rank is ``md5(seed|class|j) mod n_c``: sampling with
replacement, generated by ``spark.range`` and an equi-join on rank, never a
driver-side list. Synthetic rows carry ``copy_id > 0``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.operators.prefix import null_safe_join
from veritab.operators.splits import class_counts, ranked_by_class
from veritab.session import materialize


def _hex_to_long(hex_col, n_chars: int = 12):
    return F.conv(F.substring(hex_col, 1, n_chars), 16, 10).cast("long")


def random_oversample(df: DataFrame, label_col: str, key_cols: list[str], seed: int = 42,
                      digits: int = 3) -> DataFrame:
    """Grow every class to the majority count by seeded draws with replacement."""
    spark = df.sparkSession
    ranked = ranked_by_class(df, label_col, key_cols, seed, digits).drop("_h")
    # per-class scalars only (one row per label value) reach the driver
    counts = [(r[label_col], r["_class_n"]) for r in class_counts(df, label_col).collect()]
    target = max((n for _, n in counts), default=0)
    needs = [(label, n, target - n) for label, n in counts if n < target]
    if not needs:
        return ranked.drop("_rank").withColumn("copy_id", F.lit(0).cast("long"))
    copies = None
    for label, n_c, n_need in needs:
        part = spark.range(1, n_need + 1).withColumnRenamed("id", "copy_id").select(
            F.lit(label).cast(df.schema[label_col].dataType).alias(label_col), "copy_id",
            F.lit(n_c).alias("_class_n"))
        copies = part if copies is None else copies.unionByName(part)
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("oversample"), F.coalesce(F.col(label_col).cast("string"), F.lit("")),
                             F.col("copy_id").cast("string")))
    copies = copies.withColumn("_rank", F.pmod(_hex_to_long(draw), F.col("_class_n"))) \
        .select(label_col, "_rank", "copy_id")
    synthetic = null_safe_join(copies, ranked, [label_col, "_rank"]).drop("_rank")
    originals = ranked.drop("_rank").withColumn("copy_id", F.lit(0).cast("long"))
    return originals.unionByName(synthetic.select(*originals.columns))


def class_weight_table(df: DataFrame, label_col: str, weight_col: str = "class_weight") -> DataFrame:
    """One row per class with its ``balanced`` weight n / (n_classes * n_c)."""
    counts = class_counts(df, label_col)
    whole = counts.agg(F.struct(F.sum("_class_n").alias("t"), F.count(F.lit(1)).alias("k")).alias("w")).scalar()
    return counts.withColumn(weight_col, whole.getField("t") / (whole.getField("k") * F.col("_class_n").cast("double"))) \
        .drop("_class_n")


def balanced_class_weights(df: DataFrame, label_col: str, weight_col: str = "class_weight") -> DataFrame:
    """``df`` with the weight of each row's class; rows without a label are a class."""
    return null_safe_join(df, F.broadcast(class_weight_table(df, label_col, weight_col)), [label_col])


def positive_weight(df: DataFrame, label_col: str, scale_pos_weight: float, weight_col: str = "class_weight"):
    """D10 (boosting form): positives weigh ``scale_pos_weight``."""
    return df.withColumn(weight_col, F.when(F.col(label_col) == 1, F.lit(float(scale_pos_weight))).otherwise(1.0))


def smote(df: DataFrame, label_col: str, key_col: str, vec_col: str, k: int = 3, seed: int = 42) -> DataFrame:
    """(key, copy_id, neighbour, u, label, vec) of every row and of the synthetic rows that fill each class up.

    Copy j of a class starts from the row whose in-class rank is ``md5(seed|smote|class|j) mod n_c``, goes towards one of
    its k nearest rows of the class and stops at a share u of the way, both by further digits of the same hash. The
    neighbours are exact (``operators.neighbours``). Rows of the input have ``copy_id`` 0. A class of one row has no
    neighbours; its copies are the row itself.
    """
    from veritab.operators.neighbours import nearest

    spark = df.sparkSession
    base = materialize(df.select(F.col(key_col).alias("key"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec")), "smote_base")
    counts = [(r["label"], r["_class_n"]) for r in class_counts(base, "label").where("label IS NOT NULL").collect()]
    most = max((n for _, n in counts), default=0)
    nothing = {"copy_id": F.lit(0).cast("long"), "neighbour": F.lit(None).cast(base.schema["key"].dataType),
               "u": F.lit(None).cast("double")}
    out = base.withColumns(nothing).select("key", "copy_id", "neighbour", "u", "label", "vec")
    for label, n in counts:
        if n == most:
            continue
        minority = ranked_by_class(base.where(F.col("label") == F.lit(label)), "label", ["key"], seed).drop("_h")
        minority = materialize(minority, "smote_minority")
        draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit("smote"), F.lit(str(label)), F.col("copy_id").cast("string")))
        width = max(1, min(k, n - 1))
        copies = spark.range(1, most - n + 1).withColumnRenamed("id", "copy_id").select(
            "copy_id", F.pmod(_hex_to_long(draw), F.lit(n)).alias("_rank"),
            F.pmod(F.conv(F.substring(draw, 13, 8), 16, 10).cast("long"), F.lit(width)).cast("int").alias("place"),
            (F.conv(F.substring(draw, 21, 12), 16, 10).cast("long") / F.lit(float(1 << 48))).alias("u"))
        near = nearest(minority, k, "key", "vec", seed).join(minority.select(F.col("key").alias("neighbour"), F.col("vec").alias("_to")), "neighbour")
        drawn = copies.join(minority, "_rank").join(near.drop("d2"), ["key", "place"], "left")
        moved = F.when(F.col("_to").isNull(), F.col("vec")).otherwise(
            F.zip_with("vec", "_to", lambda a, b: a + F.col("u") * (b - a)))
        out = out.unionByName(drawn.select("key", "copy_id", "neighbour", "u", "label", moved.alias("vec")))
    return out
