"""Write-audit-publish on a published table.

stage    -- write the new rows to a new folder; readers see nothing new
audit    -- NULL counts of every audited dimension; any NULL raises and
            nothing is published.  They are observed by the job that stages
            the rows, so nothing is read again; :func:`audit` counts the rows
            of a folder that was staged without
publish  -- point the table at the folder (no data is copied); refused if the
            table was published by somebody else since
cleanup  -- remove folders that nothing points to
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tierline.operators.quality import WriteAudit, audit_nulls
from tierline.tables.published import PublishedTable, Staged


def audit(table: PublishedTable, staged: Staged, dims: Sequence[str]) -> None:
    audit_nulls(table.read(staged.folder), dims)


def write_audit_publish(table: PublishedTable, df: DataFrame, dims: Sequence[str]) -> str:
    """Stage and audit in one job, then publish; the published folder.  On a
    failed audit the table is unchanged; the staged folder stays for
    inspection until ``remove_unused`` takes it."""
    seen = WriteAudit(dims)
    staged = table.stage(seen.watch(df))
    seen.check()
    return table.publish(staged)
