"""Tables that are replaced as a whole: new folder, then publish.

A write goes to a new, uniquely named folder, so a writer that dies leaves
nothing in the way of the next one.  Publishing moves the catalog table to
that folder (``ALTER TABLE ... SET LOCATION``) and stores the folder's name in
a one-line pointer file, from which the table is registered again where the
catalog does not outlive the session.  A reader keeps the folder it resolved;
folders that nothing points to can be removed at any time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierline.sinks.files import write_parquet
from tierline.sources.files import create_namespace
from tierline.tables import files

class PublishConflict(RuntimeError):
    """The table was published by somebody else since the rows were staged."""


@dataclass(frozen=True)
class Staged:
    """A written, unpublished folder, and the published one at that time."""

    folder: str
    base: str | None


class PublishedTable:
    def __init__(self, spark: SparkSession, location: str, name: str | None = None,
                 schema: T.StructType | None = None):
        self.spark = spark
        self.location = location.rstrip("/")
        self.name = name
        self.schema = schema

    @property
    def _pointer(self) -> str:
        return f"{self.location}/_current"

    def path(self, folder: str) -> str:
        return f"{self.location}/data/{folder}"

    def current(self) -> str | None:
        """The published folder."""
        return files.read_line(self.spark, self._pointer)

    def stage(self, df: DataFrame) -> Staged:
        base, folder = self.current(), uuid.uuid4().hex
        write_parquet(df, self.path(folder), mode="errorifexists")
        return Staged(folder, base)

    def publish(self, staged: Staged) -> str:
        """Make the staged folder the table; its name.  Refused if the table
        was published since the rows were staged."""
        if self.current() != staged.base:
            raise PublishConflict(f"{self.location} was published meanwhile")
        files.write_line(self.spark, self._pointer, staged.folder)
        if self.name:
            self._register(staged.folder)
        return staged.folder

    def replace(self, df: DataFrame) -> str:
        return self.publish(self.stage(df))

    def _register(self, folder: str) -> None:
        if self.spark.catalog.tableExists(self.name):
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{self.path(folder)}'")
            self.spark.sql(f"REFRESH TABLE {self.name}")
            return
        create_namespace(self.spark, self.name, self.location)
        self.spark.sql(f"CREATE TABLE {self.name} USING parquet LOCATION '{self.path(folder)}'")

    def read(self, folder: str | None = None) -> DataFrame:
        """The published rows, or those of a staged or earlier folder."""
        if folder is None:
            folder = self.current()
            if folder is None:
                raise KeyError(f"{self.location} has not been published")
            if self.name:
                if not self.spark.catalog.tableExists(self.name):
                    self._register(folder)
                return self.spark.table(self.name)
        reader = self.spark.read
        return (reader.schema(self.schema) if self.schema else reader).parquet(self.path(folder))

    def remove_unused(self) -> list[str]:
        """Remove folders that nothing points to; the folders left."""
        used = self.current()
        for f in files.folders(self.spark, f"{self.location}/data"):
            if f != used:
                files.remove_folder(self.spark, self.path(f))
        return files.folders(self.spark, f"{self.location}/data")
