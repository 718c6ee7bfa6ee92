"""Running totals and positions over data of any size.

A window over one large group would sort it in one task.  Here the rows are
range-partitioned by group and order and stored with their partition number;
totals run inside each partition, and the totals of the partitions before it
(one row per group and partition) are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.session import fresh_folder


def running_total(df: DataFrame, group: Sequence[str], order: Sequence[Column], amount: str,
                  name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``amount`` up to and including the row
    in its group.  ``order`` must tell the rows of a group apart."""
    spark, path = df.sparkSession, fresh_folder(df.sparkSession, "numbering")
    keys = [F.col(g) for g in group] + list(order)
    df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    stored = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType())])
    rows = spark.read.schema(stored).parquet(path)
    sums = rows.groupBy(*group, "_part").agg(F.sum(amount).alias("_sum"))
    # One row per group and partition: bounded by the number of partitions.
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_part").alias("_at"),
                       F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    same = F.col("_part") == F.col("_at")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    inside = Window.partitionBy(*group, "_part").orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_local", F.sum(amount).over(inside))
    return local.join(sums, same).select(*df.columns, (F.col("_before") + F.col("_local")).alias(name))
