"""Tables written between the passes of one operator.

An operator that needs a derived table more than once writes it as parquet to the folder the cluster
shares and reads it back: the plan stays short, a lost executor costs only the tasks it ran, and values
that later steps must agree on (row counts, ranks) cannot change between two evaluations.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.session import bound_arrow_batches, shuffles_freed


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a session without one uses its warehouse folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; the files go when the application ends."""
    spark = df.sparkSession
    bound_arrow_batches(spark)
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    with shuffles_freed(spark):
        df.write.parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def unstage(*tables: DataFrame) -> None:
    """Delete the files of ``staged`` tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def unit_interval(*parts: Column) -> Column:
    """A keyed position in [0, 1): the first 52 bits of the md5 of the parts (null parts read as '~')."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def row_key(doc_id: Column, text: Column) -> Column:
    """Joins what was decided about a row back to the row: its id and a digest of its text."""
    return F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("~")),
                       F.when(text.isNull(), "~").otherwise(F.xxhash64(text).cast("string")))
