"""Declared sources: name -> (location, format, schema, options).

A source declared once is read by name anywhere; each read also registers
a temporary view ``<prefix>_<name>`` so SQL text can refer to it.  One
source may override the shared location template or options (as the
classification source does with its null token).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierline.sinks.files import CSV_OPTIONS


@dataclass
class SourceSpec:
    name: str
    location: str
    fmt: str = "csv"
    schema: T.StructType | None = None
    options: dict[str, str] = field(default_factory=dict)


class SourceRegistry:
    def __init__(self, spark: SparkSession, location_template: str,
                 fmt: str = "csv", options: dict[str, str] | None = None,
                 view_prefix: str = "bronze"):
        self.spark = spark
        self.template = location_template
        self.fmt = fmt
        self.options = {"header": "true", **CSV_OPTIONS, **(options or {})}
        self.view_prefix = view_prefix
        self.specs: dict[str, SourceSpec] = {}

    def declare(self, name: str, schema: T.StructType | None = None,
                location: str | None = None, fmt: str | None = None,
                **options: str) -> "SourceRegistry":
        loc = location or self.template.format(name=name)
        self.specs[name] = SourceSpec(name, loc, fmt or self.fmt, schema,
                                      {**self.options, **options})
        return self

    def read(self, name: str) -> DataFrame:
        spec = self.specs[name]
        r = self.spark.read.format(spec.fmt).options(**spec.options)
        if spec.schema is not None:
            r = r.schema(spec.schema)
        df = r.load(spec.location)
        if spec.schema is not None:
            df = df.select(*spec.schema.names)
        df.createOrReplaceTempView(f"{self.view_prefix}_{name}")
        return df

    def names(self) -> list[str]:
        return list(self.specs)
