"""File sources: typed CSV, raw CSV, positional CSV, parquet, text, tables.

Bronze is read with an explicit schema that includes the partition columns,
so partition discovery types them from the schema (ids stay strings) and the
CSV field names in the header do not matter: fields bind by position, which
is how ``pos``/``pts`` become ``position``/``points``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.sinks.files import CSV_OPTIONS, NULL_TOKEN
from tierline.tables.files import folders

# Folder name of a NULL (or empty) partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType,
                   header: bool = True, null_token: str = NULL_TOKEN,
                   mode: str = "FAILFAST", filename: str | None = None,
                   recursive: bool = False) -> DataFrame:
    """CSV with an explicit schema; a malformed field fails the read
    (``FAILFAST``) instead of becoming NULL silently.  ``recursive`` reads
    the files of all folders below ``path``, without partition columns."""
    df = (spark.read.schema(schema)
          .options(**{**CSV_OPTIONS, "nullValue": null_token})
          .option("header", header).option("mode", mode)
          .option("enforceSchema", True)
          .option("recursiveFileLookup", recursive)
          .csv(path))
    return with_filename(df, filename) if filename else df


def read_csv_by_folder(spark: SparkSession, path: str, schema: T.StructType,
                       keys: Sequence[str], filename: str | None = None) -> DataFrame:
    """``read_csv_typed`` for layouts of very many folders, with a ``key=value``
    level for each of ``keys``.

    Spark's partition discovery takes time in the square of the folders, and
    lists in one job per folder that holds many.  Here files are only listed, in
    one job below the folders of the outer keys, and a row takes its keys from
    the path of its file.  The columns come in schema order."""
    if not any(f.startswith(f"{keys[0]}=") for f in folders(spark, path)):
        # A landing of no rows has no folders.
        return read_csv_typed(spark, path, schema, filename=filename)
    rows = T.StructType([f for f in schema.fields if f.name not in keys])
    below = "/".join([path, *(f"{k}=*" for k in keys[:-1])])
    at = F.col("_metadata.file_path")
    return read_csv_typed(spark, below, rows, recursive=True).select(
        *[folder_value(at, f.name).cast(f.dataType).alias(f.name) if f.name in keys
          else F.col(f.name) for f in schema.fields],
        *([at.alias(filename)] if filename else []))


def read_csv_positional(spark: SparkSession, path: str, schema: T.StructType,
                        null_token: str = NULL_TOKEN) -> DataFrame:
    """Headerless CSV, fields named by their position in ``schema``."""
    return read_csv_typed(spark, path, schema, header=False, null_token=null_token)


def read_csv_raw(spark: SparkSession, path: str, filename: str | None = None) -> DataFrame:
    """CSV with a header and every column (partition columns too) a string,
    NULL tokens left as text: the raw bronze view."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        df = (spark.read.option("header", True).option("quote", '"')
              .option("escape", '"').csv(path))
    finally:
        spark.conf.set(key, old)
    return with_filename(df, filename) if filename else df


def with_filename(df: DataFrame, name: str = "filename") -> DataFrame:
    """Add the source file of each row (hidden ``_metadata`` column)."""
    return df.select("*", F.col("_metadata.file_path").alias(name))


def partition_value(path: Column, key: str) -> Column:
    """The value of ``key=...`` in a Hive-style file path."""
    return F.regexp_extract(path, f"/{key}=([^/]+)/", 1)


def folder_value(path: Column, key: str) -> Column:
    """The value of ``key`` as partition discovery reads it from a file path:
    NULL for the folder of NULLs, else unescaped twice, as the path is a URI and
    the folder's name escapes characters of the value.  A plus is none."""
    def unescaped(c: Column) -> Column:
        return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    name = F.regexp_extract(path, f".*/{key}=([^/]+)/", 1)
    return F.when(name != NULL_FOLDER, unescaped(unescaped(name)))


def scan_parquet(spark: SparkSession, path: str,
                 columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def create_namespace(spark: SparkSession, name: str, near: str) -> None:
    """The database of a table name, if it has one; its own folder lies beside
    ``near``, in the shared folder, not in the default warehouse."""
    if "." in name:
        db = name.split(".")[0]
        where = f"{near.rstrip('/').rsplit('/', 1)[0]}/_namespaces/{db}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{where}'")


def register_external(spark: SparkSession, name: str, path: str,
                      fmt: str = "parquet") -> DataFrame:
    """Catalog table over files at ``path`` (namespace created if absent)."""
    create_namespace(spark, name, path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        # Partitions of a Hive-style layout are registered from the folders.
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def read_payloads(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Landed raw payloads: the request keys (typed as strings from the
    folder names) and the payload text ``body``."""
    schema = T.StructType([T.StructField("value", T.StringType())] +
                          [T.StructField(k, T.StringType()) for k in keys])
    return spark.read.schema(schema).text(path).select(*keys, F.col("value").alias("body"))
