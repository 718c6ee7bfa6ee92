"""Numbers that rise with a key, and their place between given edges."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of a string that fit a positive long.
_BYTES = 7


def common_bytes(low: str, high: str) -> int:
    """Leading bytes that all strings between ``low`` and ``high`` share."""
    return len(os.path.commonprefix([low.encode(), high.encode()]))


def key_number(column: str, skip: int = 0) -> Column:
    """The seven bytes after the first ``skip`` as a number: of two strings
    that share these, the smaller one never has the larger number."""
    part = F.hex(F.substring(F.col(column).cast("binary"), skip + 1, _BYTES))
    return F.conv(F.rpad(part, 2 * _BYTES, "0"), 16, 10).cast("long")


def bucket_of(number: Column, edges: Sequence[int]) -> Column:
    """How many of the rising ``edges`` are at most ``number`` (binary search)."""
    if not edges:
        return F.lit(0)
    held = F.array(*[F.lit(int(e)).cast("long") for e in edges])
    steps = [1 << i for i in range(len(edges).bit_length() - 1, -1, -1)]

    def go(at: Column, step: Column) -> Column:
        inside = at + step <= len(edges)
        return F.when(inside & (F.get(held, at + step - 1) <= number), at + step).otherwise(at)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), go)
