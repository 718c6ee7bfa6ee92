"""Intermediate tables and files in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierline.session import fresh_folder
from tierline.tables.files import remove_folder


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts lineage with files every executor reaches, so a lost executor never
    makes an iterative job start over.
    """
    path = fresh_folder(df.sparkSession, "llm", name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def removed(*tables: DataFrame) -> None:
    """Remove the folders of tables made by :func:`saved` that no later step
    reads; what reads them must have been written itself."""
    for t in tables:
        remove_folder(t.sparkSession, t.stored_at)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def width(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the number of parallel pieces."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
