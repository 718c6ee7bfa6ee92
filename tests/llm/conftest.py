import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


@pytest.fixture()
def docs_of(spark):
    """documents rows from (doc_id, text[, source]) tuples, stored as Parquet
    with the columns of the driver's table and some clashing ones."""
    from tierline.session import fresh_folder

    def make(rows, clash=()):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC)
        for c in clash:
            from pyspark.sql import functions as F
            df = df.withColumn(c, F.lit("extra"))
        path = fresh_folder(spark, "tests", "docs")
        df.repartition(3).write.parquet(path)
        return spark.read.parquet(path)
    return make

