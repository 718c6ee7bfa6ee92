"""Named models over declared sources, referenced by name.

A model is a function of the graph returning a DataFrame; inside it,
``g.ref(name)`` gives another model and ``g.source(name)`` a declared
source.  The dependency order is simply the order in which references are
resolved (Spark's lazy plans carry the rest).  A model with a location is
materialised there as parquet and read back, so dependants read the written
files (lineage is cut at each materialised model).  Source tests run the
first time a source is read, before any model that uses it.

With ``changed_only`` a materialised model is built only if something it was
made of differs from what it notes beside its files: the model's own code, the
files of the sources it read (path, size, time), or a model it referred to.
Others are read as they are, so a second build writes nothing and a changed
source rebuilds its dependants.
"""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.quality import failing_not_null, failing_unique
from tierline.sinks.files import write_parquet
from tierline.sources.registry import SourceRegistry
from tierline.tables import files


class DataTestError(AssertionError):
    pass


class ModelGraph:
    def __init__(self, spark: SparkSession, sources: SourceRegistry,
                 location_template: str | None = None, changed_only: bool = False):
        self.spark = spark
        self.sources = sources
        self.template = location_template
        self._models: dict[str, tuple[Callable[["ModelGraph"], DataFrame], bool]] = {}
        self._built: dict[str, DataFrame] = {}
        self._tests: dict[str, list[tuple[str, str]]] = {}
        self._read: dict[str, DataFrame] = {}
        self.changed_only = changed_only
        self.rebuilt: list[str] = []
        self._prints: dict[tuple[str, str], str] = {}
        self._using: list[dict[str, dict[str, str]]] = []  # of the models being built

    def model(self, name: str, external: bool = True):
        def deco(fn: Callable[["ModelGraph"], DataFrame]):
            self._models[name] = (fn, external)
            return fn
        return deco

    def test(self, source: str, kind: str, column: str) -> "ModelGraph":
        """Declare a data test (``not_null`` or ``unique``) on a source column."""
        self._tests.setdefault(source, []).append((kind, column))
        return self

    def source(self, name: str) -> DataFrame:
        if self._using:
            self._using[-1]["sources"][name] = self._source_print(name)
        if name not in self._read:
            df = self.sources.read(name)
            for kind, column in self._tests.get(name, []):
                failing = (failing_not_null(df, column) if kind == "not_null"
                           else failing_unique(df, [column]))
                if failing.limit(1).count():
                    raise DataTestError(f"{kind} test failed on {name}.{column}")
            self._read[name] = df
        return self._read[name]

    def location(self, name: str) -> str | None:
        return self.template.format(name=name) if self.template else None

    def ref(self, name: str) -> DataFrame:
        if name not in self._built:
            df = self._kept(name)
            if df is None:
                df = self._make(name)
            df.createOrReplaceTempView(name)
            self._built[name] = df
        if self._using:
            self._using[-1]["models"][name] = self._prints.get(("model", name), "")
        return self._built[name]

    def _make(self, name: str) -> DataFrame:
        fn, external = self._models[name]
        self._using.append({"sources": {}, "models": {}})
        try:
            df = fn(self)
        finally:
            made_of = self._using.pop()
        loc = self.location(name)
        if external and loc:
            write_parquet(df, loc)
            df = self.spark.read.parquet(loc)
        self.rebuilt.append(name)
        if self.changed_only:
            note = json.dumps({"code": _code_print(fn), **made_of}, sort_keys=True)
            self._prints["model", name] = hashlib.sha256(note.encode()).hexdigest()
            if external and loc:  # last, so a build that died is no build
                files.write_line(self.spark, f"{loc}/_made_of", note)
        return df

    def _kept(self, name: str) -> DataFrame | None:
        """The model as it was built, if all it is made of is as it was."""
        fn, external = self._models[name]
        loc = self.location(name)
        if not (self.changed_only and external and loc):
            return None
        note = files.read_line(self.spark, f"{loc}/_made_of")
        if note is None:
            return None
        was = json.loads(note)
        same = was["code"] == _code_print(fn) \
            and all(s in self.sources.specs and self._source_print(s) == p for s, p in was["sources"].items())
        for m, p in was["models"].items():
            if same and m in self._models:
                self.ref(m)
            same = same and m in self._models and self._prints.get(("model", m), "") == p
        if not same:
            return None
        self._prints["model", name] = hashlib.sha256(note.encode()).hexdigest()
        return self.spark.read.parquet(loc)

    def _source_print(self, name: str) -> str:
        """Fingerprint of a source's declaration and files, without their
        contents: one aggregate over the listing."""
        if not self.changed_only:
            return ""
        if ("source", name) not in self._prints:
            spec = self.sources.specs[name]
            meta = F.struct(*[f"_metadata.file_{a}" for a in ("path", "size", "modification_time")])
            listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(spec.location)
            seen = listed.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(meta)).alias("x")).first()
            text = f"{spec.fmt}|{spec.schema}|{sorted(spec.options.items())}|{seen['n']}|{seen['x']}"
            self._prints["source", name] = hashlib.sha256(text.encode()).hexdigest()
        return self._prints["source", name]

    def register_upstream(self, names: list[str]) -> list[str]:
        """Register a view for every named model whose output already exists
        at its location (no rebuild); returns the names registered."""
        done = []
        for name in names:
            loc = self.location(name)
            if loc is None:
                continue
            try:
                df = self.spark.read.parquet(loc)
            except Exception as exc:  # noqa: BLE001  (not materialised yet)
                if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
                    continue
                raise
            df.createOrReplaceTempView(name)
            self._built[name] = df
            done.append(name)
        return done

    def build(self) -> dict[str, DataFrame]:
        return {name: self.ref(name) for name in self._models}


def _code_print(fn: Callable) -> str:
    """Fingerprint of a model's source text and of the values it encloses."""
    held = [c.cell_contents for c in fn.__closure__ or ()]
    text = inspect.getsource(fn) + repr([h for h in held if isinstance(h, (str, int, float, dict, list, tuple))])
    return hashlib.sha256(text.encode()).hexdigest()


def passthrough(source_name: str) -> Callable[[ModelGraph], DataFrame]:
    """A staging model that selects every column of a source."""
    return lambda g: g.source(source_name).select("*")


def renamed(source_name: str, renames: dict[str, str]) -> Callable[[ModelGraph], DataFrame]:
    """A staging model that renames some columns of a source."""
    def fn(g: ModelGraph) -> DataFrame:
        df = g.source(source_name)
        return df.select(*[F.col(c).alias(renames.get(c, c)) for c in df.columns])
    return fn
