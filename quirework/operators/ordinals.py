"""Running numbers within keys of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.session import cut_lineage


def running_number(df: DataFrame, keys: list[str], bucket: Column, order: list[str | Column], name: str) -> DataFrame:
    """``df`` with the position, from 1, of every row among those with the same keys.

    ``bucket`` must not decrease along ``order``. Rows are numbered within keys and bucket, and the counts of the
    earlier buckets are added, so that no task has to sort all rows of one key; only the counts, a row per key and
    bucket, are summed up by key.
    """
    marked = df.withColumn("_bucket", bucket)
    counts = marked.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy(F.col("_bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    numbered = marked.withColumn("_within", F.row_number().over(within))
    right = offsets.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_b"), "_offset")
    same = F.col("_bucket").eqNullSafe(F.col("_b"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = numbered.join(right, same, "left")
    return joined.withColumn(name, (F.col("_within") + F.col("_offset")).cast("bigint")).drop("_bucket", "_b", "_within", "_offset", *[f"_k{i}" for i in range(len(keys))])


def global_number(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with the position, from 1, of every row among all rows.

    Rows are split into ranges of ``order`` and numbered within each; only the ranges' counts, one row per partition,
    are summed up in one place. The split is materialized, since another evaluation might draw the ranges elsewhere.
    """
    ranged = cut_lineage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_range").orderBy(*order)
    return ranged.withColumn("_within", F.row_number().over(within)).join(F.broadcast(offsets), "_range").withColumn(name, (F.col("_within") + F.col("_offset")).cast("bigint")).drop("_range", "_within", "_offset")
