"""Per-application state of the registered queries.

The lake every query reads (bronze landed from a full crawl, silver loaded
from it) is built once per Spark application and ``sf_dir`` under the
shared folder, then reused.  Queries that test a write land into a fresh
folder of their own.
"""

from __future__ import annotations

import hashlib
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions import logs as L
from tierline.operators.crawl import Crawl, crawl, request_log
from tierline.operators.runlog import failed_keys, failed_sets, parse_log
from tierline.plans.lake import Lake, load_silver
from tierline.plans.medallion import land_classifications, land_crawl
from tierline.sinks.files import TEXT_OPTIONS
from tierline.session import apply_runtime_conf, fresh_folder, run_folder
from tierline.sources.entities import EntitySource
from tierline.sources.fixture import derive_entities, with_gaps

_ENVS: dict[tuple[str, str], "Env"] = {}


class Env:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.tag = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:10]

    @cached_property
    def src(self) -> EntitySource:
        return derive_entities(self.spark, self.sf_dir)

    @cached_property
    def crawl(self) -> Crawl:
        s = self.src
        return crawl(s.seasons, s.events, s.categories, s.sessions)

    def scratch(self, name: str) -> str:
        return fresh_folder(self.spark, "suite", self.tag, "scratch", name)

    @cached_property
    def gaps(self) -> Crawl:
        """The crawl of the source with childless parents at every level."""
        g = with_gaps(self.src)
        return crawl(g.seasons, g.events, g.categories, g.sessions)

    @cached_property
    def lake(self) -> Lake:
        lake = Lake(run_folder(self.spark, "suite", self.tag, "lake"))
        c = land_crawl(self.spark, lake, self.src.seasons, self.src)
        land_classifications(lake, c.tasks, self.src.classifications, replace=True)
        load_silver(self.spark, lake)
        return lake

    @cached_property
    def log_path(self) -> str:
        """The process log of a full run over the source with gaps, written
        once."""
        path = run_folder(self.spark, "suite", self.tag, "process_log")
        request_log(self.gaps, self.src.classifications).write.mode("overwrite") \
            .options(**TEXT_OPTIONS).text(path)
        return path

    @cached_property
    def failed(self) -> dict[str, DataFrame]:
        """Key sets of the failed requests of that log, stored once."""
        path = run_folder(self.spark, "suite", self.tag, "failed")
        failed_keys(parse_log(self.spark.read.text(self.log_path))).write.mode("overwrite").parquet(path)
        return failed_sets(self.spark.read.parquet(path))

    def log(self) -> DataFrame:
        """Parsed process log: level and message (time dropped)."""
        v = self.spark.read.text(self.log_path).select("value")
        return v.select(L.line_level(F.col("value")).alias("level"),
                        L.line_message(F.col("value")).alias("message"))


def env(spark: SparkSession, sf_dir: str) -> Env:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _ENVS:
        apply_runtime_conf(spark)
        _ENVS[key] = Env(spark, sf_dir)
    return _ENVS[key]
