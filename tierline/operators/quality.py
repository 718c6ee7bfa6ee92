"""Data-quality checks: each returns the failing rows or a small summary.

Checks are set-based and shuffle at most a partial aggregate: counts per
file or per key are combined map-side before the exchange.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tierline.operators.joins import duplicate_keys_staged

# Documented range of a season year (upper bound: this year).
YEAR_MIN = 1949


class AuditError(Exception):
    """A blocking check failed; carries the dimension and its NULL count."""

    def __init__(self, dimension: str, count: int):
        super().__init__(f"found {count} NULL values in column {dimension}")
        self.dimension = dimension
        self.count = count


def null_count_by_file(df: DataFrame, measure: str = "position",
                       file_col: str = "filename",
                       count_name: str = "NULL_POSITION_COUNT") -> DataFrame:
    """Rows whose ``measure`` is NULL, counted per source file."""
    return (df.filter(F.col(measure).isNull())
              .groupBy(file_col).agg(F.count(F.lit(1)).alias(count_name)))


def file_partials(df: DataFrame, measures: Sequence[str], file_col: str = "filename") -> DataFrame:
    """Rows and NULLs of each measure per source file: counts that add up, so
    files can be counted at different times and combined."""
    return df.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(m).isNull()).alias(f"null_{m}") for m in measures])


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows that fail a not-null test."""
    return df.filter(F.col(column).isNull())


def failing_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that fail a unique test, with their counts ``n``; keys
    without a second row like them are not moved."""
    return duplicate_keys_staged(df, keys)


def failing_year_range(df: DataFrame, column: str = "year", lo: int = YEAR_MIN,
                       hi: int | None = None) -> DataFrame:
    """Rows outside ``lo .. hi`` (``hi`` defaults to the current year)."""
    hi = _dt.date.today().year if hi is None else hi
    return df.filter(~F.col(column).between(lo, hi) | F.col(column).isNull())


def null_counts(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """NULL count of every dimension in one pass: rows (dim, nulls)."""
    agg = df.agg(*[F.count_if(F.col(d).isNull()).alias(d) for d in dims])
    stack = ", ".join(f"'{d}', `{d}`" for d in dims)
    return agg.selectExpr(f"stack({len(dims)}, {stack}) AS (dim, nulls)")


def _raise_on_nulls(counts, dims: Sequence[str]) -> None:
    for d in dims:
        if counts[d]:
            raise AuditError(d, int(counts[d]))


def audit_nulls(df: DataFrame, dims: Sequence[str]) -> None:
    """Blocking audit: raise :class:`AuditError` for the first dimension
    with NULLs.  One scan for all dimensions; the result is one row."""
    _raise_on_nulls(df.agg(*[F.count_if(F.col(d).isNull()).alias(d) for d in dims]).first(), dims)


class WriteAudit:
    """The same audit inside the job that writes the rows.

    ``watch(df)`` adds the NULL counts of the dimensions, and the row count,
    as observed metrics; after one action over it ``check()`` raises as
    :func:`audit_nulls` does, without reading anything again.  A task that is
    run twice may be counted twice: counts that block are never lost, and no
    NULL is reported where there is none.
    """

    def __init__(self, dims: Sequence[str]):
        self.dims, self._seen = list(dims), Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, F.count(F.lit(1)).alias("_rows"),
                          *[F.count_if(F.col(d).isNull()).alias(d) for d in self.dims])

    @property
    def counts(self) -> dict[str, int]:
        return self._seen.get

    def check(self) -> int:
        """Raise for the first dimension with NULLs; the number of rows."""
        counts = self.counts
        _raise_on_nulls(counts, self.dims)
        return int(counts["_rows"])


def missing_children(parents: DataFrame, children: DataFrame,
                     on: Sequence[tuple[str, str]], level: str,
                     parent_id: str = "id") -> DataFrame:
    """Parents with no child: rows (level, parent_id).

    ``on`` pairs parent columns with child columns; the anti join ships
    only the child key columns.
    """
    kids = children.select(*[F.col(c).alias(p) for p, c in on])
    return (parents.join(kids, [p for p, _ in on], "left_anti")
                   .select(F.lit(level).alias("level"),
                           F.col(parent_id).alias("parent_id")))

