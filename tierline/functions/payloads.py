"""JSON payload expressions: rows to JSON arrays and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# to_json keeps null fields, as the API does for null number / position.
JSON_OPTS = {"ignoreNullFields": "false"}


def row_json(cols: Sequence[str]) -> Column:
    """One JSON object per row (``jq -c`` form), null fields kept."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]), JSON_OPTS)


def parse_array(payload: Column, element: T.StructType) -> Column:
    """``from_json`` of a JSON array of objects; ``null`` and ``[]`` both give
    an empty or NULL array, so ``explode`` yields no row for them."""
    return F.from_json(payload, T.ArrayType(element))
