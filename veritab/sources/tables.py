"""IO1-IO4: table, metrics and model persistence.

Parquet is the default format (column pruning and filter pushdown reach the
scan); CSV is supported with an explicit schema. Metrics are written as
one-row JSON tables so they travel through the same writer as data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.session import materialize

# pandas' read_csv turns these into NaN by default (S18); CSV readers normalise them to NULL
NULL_TOKENS = ("", "NA", "N/A", "NULL", "null", "NaN", "nan", "n/a", "#N/A", "None")


def read_table(spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | str | None = None,
               header: bool = True) -> DataFrame:
    """IO1: read parquet (default) or CSV with header; CSV null tokens become NULL."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        return normalise_null_tokens(reader.schema(schema).csv(path))
    return inferred(normalise_null_tokens(reader.csv(path)))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """IO1: (rows, broken): a CSV by an explicit schema; lines that do not fit it are set aside as text, never half-read.

    ``broken`` has the column ``line``. Null tokens of text columns become NULL, in others they make a line broken
    unless they are empty.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = T.StructField("_corrupt_line", T.StringType())
    read = spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", raw.name) \
        .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True) \
        .schema(T.StructType([*schema.fields, raw])).csv(path)
    parsed = materialize(read, "csv")  # parsed once, all columns of it: a line is judged by the columns that are read
    whole = F.col(raw.name).isNull()
    return normalise_null_tokens(parsed.where(whole).drop(raw.name)), parsed.where(~whole).select(F.col(raw.name).alias("line"))


def inferred(df: DataFrame) -> DataFrame:
    """Text columns whose every value is a number become long or double; null tokens have gone before, so they do not
    keep a column textual."""
    counts = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(df.columns)],
                    *[F.count(F.col(c).try_cast("long")).alias(f"l{i}") for i, c in enumerate(df.columns)],
                    *[F.count(F.col(c).try_cast("double")).alias(f"d{i}") for i, c in enumerate(df.columns)]).first()
    kinds = {c: next((k for k, x in (("long", "l"), ("double", "d")) if counts[f"n{i}"] and counts[f"{x}{i}"] == counts[f"n{i}"]), None)
             for i, c in enumerate(df.columns)}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if kinds[c] else F.col(c) for c in df.columns])


def normalise_null_tokens(df: DataFrame, tokens=NULL_TOKENS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.when(F.trim(c).isin(*tokens), F.lit(None).cast("string")).otherwise(c).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite", only_partitions: bool = False) -> None:
    """IO2: overwrite-write a table; parents are created by the file system committer.

    With ``only_partitions`` an overwrite replaces just the partitions that ``df`` has rows of.
    """
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if only_partitions else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_metrics(spark: SparkSession, metrics: dict, path: str) -> None:
    """IO3: a dict of scalars as a one-row JSON table."""
    row = {k: (float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v) for k, v in metrics.items()}
    spark.createDataFrame([row]).coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> dict:
    rows = spark.read.json(path).take(1)
    return rows[0].asDict() if rows else {}


def save_model(model, path: str) -> None:
    """IO4: pyspark.ml models through their own writer (no pickle)."""
    model.write().overwrite().save(path)


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
