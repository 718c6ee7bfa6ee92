"""JSON payloads whose fields drift: variants and a quarantine.

A payload line is read as a VARIANT, so whatever its objects hold is kept as
sent: fields that no schema knows, fields that are missing, values of another
type.  Lines that are no JSON array, and elements that are no objects, are set
apart with their text and a reason; nothing fails and nothing is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Why a line or an element is in quarantine.
UNREADABLE, NO_ARRAY, NO_OBJECT = "unreadable", "no array", "no object"


def split_payloads(payloads: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(elements, quarantine) of payload lines.

    ``elements``: keep..., element (VARIANT), one row per object of an array;
    ``[]``, ``null`` and NULL give none.  ``quarantine``: keep..., text,
    reason.  Both are lazy over the same lines.
    """
    read = payloads.select(*keep, F.col(body).alias("_text"), F.try_parse_json(F.col(body)).alias("_v")) \
        .filter(F.col("_text").isNotNull())
    read = read.withColumn("_items", F.try_variant_get("_v", "$", "array<variant>")) \
        .withColumn("_none", F.coalesce(F.is_variant_null("_v"), F.lit(False)))
    reason = F.when(F.col("_v").isNull(), UNREADABLE).when(F.col("_items").isNull() & ~F.col("_none"), NO_ARRAY)
    bad_lines = read.select(*keep, F.col("_text").alias("text"), reason.alias("reason")).filter("reason IS NOT NULL")
    items = read.select(*keep, F.explode("_items").alias("element"))
    is_object = F.schema_of_variant("element").startswith("OBJECT")
    bad_items = items.filter(~is_object).select(*keep, F.to_json("element").alias("text"),
                                                F.lit(NO_OBJECT).alias("reason"))
    return items.filter(is_object), bad_lines.unionByName(bad_items)


def typed(elements: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """keep..., the fields of ``schema``, more.

    A missing field is NULL.  ``more`` holds as JSON what the columns do not:
    unknown fields, and known ones whose value is not of the column's type.
    """
    cols = [F.try_variant_get("element", f"$['{f.name}']", f.dataType.simpleString()).alias(f.name)
            for f in schema.fields]
    rows = elements.select(*keep, F.try_variant_get("element", "$", "map<string,variant>").alias("_m"), *cols)

    def held_back(key: Column, value: Column) -> Column:
        lost = ~key.isin(schema.names)
        for f in schema.names:
            lost = lost | ((key == f) & F.col(f).isNull() & ~F.is_variant_null(value))
        return lost
    return rows.select(*keep, *schema.names, F.to_json(F.map_filter("_m", held_back)).alias("more"))
