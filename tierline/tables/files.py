"""Small files of the shared folder, through Hadoop's file system API.

Pointers and markers are one line of text.  A line is written beside its
place and renamed over it, so a reader sees the old line or the new one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def read_line(spark: SparkSession, path: str) -> str | None:
    """The line stored at ``path``; None if there is no such file."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8").rstrip("\n")
    finally:
        stream.close()


def write_line(spark: SparkSession, path: str, line: str) -> None:
    """Replace the line at ``path`` in one rename."""
    fs, p = _at(spark, path)
    tmp = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray((line + "\n").encode("utf-8")))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(tmp), fs.makeQualified(p), options)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder, if there is one; the parent of ``to`` is made."""
    fs, p = _at(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    if fs.exists(p):
        fs.mkdirs(target.getParent())
        fs.rename(p, target)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
