"""Descendants in a hierarchy of any depth, given as parent-child edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.session import fresh_folder


def descendants(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, node, depth): every node that a root reaches, itself at depth 0.

    ``edges``: (parent, child); ``roots``: (root).  One join per level: the
    nodes found last are joined with the edges, and those that their root has
    not reached before are the next level, so a node is reported once per root
    with its smallest depth, and cycles end.  Levels are stored, which cuts
    lineage; edges with a null end, repeated edges and repeated roots add
    nothing.
    """
    spark, path = edges.sparkSession, fresh_folder(edges.sparkSession, "hierarchy")
    links = edges.select("parent", "child").filter("parent IS NOT NULL AND child IS NOT NULL").distinct()
    links.write.parquet(f"{path}/edges")
    links = spark.read.schema(links.schema).parquet(f"{path}/edges")
    kind = roots.schema["root"].dataType
    level = roots.select("root", F.col("root").cast(links.schema["child"].dataType).alias("node")) \
        .filter("root IS NOT NULL").distinct()
    schema = f"root {kind.simpleString()}, node {links.schema['child'].dataType.simpleString()}"
    depth = 0
    while True:
        level.write.parquet(f"{path}/found/depth={depth}")
        last = spark.read.schema(schema).parquet(f"{path}/found/depth={depth}")
        if last.isEmpty():
            break
        seen = spark.read.schema(f"{schema}, depth int").parquet(f"{path}/found")
        step = last.join(links, last["node"] == links["parent"]).select("root", F.col("child").alias("node")).distinct()
        level = step.join(seen.select("root", "node"), ["root", "node"], "left_anti")
        depth += 1
    return spark.read.schema(f"{schema}, depth int").parquet(f"{path}/found")
