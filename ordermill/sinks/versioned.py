"""Tables that change all at once.

Under the table's folder, ``data/_load=<id>`` holds the rows of one load, written once and never touched again, and
``manifest/<number>.json`` says which load holds each partition value. A change writes a new load and then a new manifest, under
a name that only one writer can take. A reader takes the manifest with the highest number, so it sees the table before or
after a change, never between. A partition value is no folder: a load has few files, however many values it has.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from py4j.protocol import Py4JJavaError

from ..operators.joins import match
from ..operators.lines import deduplicate
from ..workspace import remove, staged, staging

_LOAD = "_load"
_Value = str | None


class ChangedMeanwhile(RuntimeError):
    """Another writer has changed the table since it was read."""


@dataclass(frozen=True)
class Manifest:
    """``live``: the load that holds each partition value; ``held``: all values that each of these loads has."""

    number: int
    schema: T.StructType
    live: dict[_Value, str]
    held: dict[str, list[_Value]]
    note: dict = field(default_factory=dict)

    def dumped(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "live": list(self.live.items()), "held": self.held, "note": self.note})

    @staticmethod
    def loaded(number: int, text: str) -> Manifest:
        stored = json.loads(text)
        return Manifest(number, T.StructType.fromJson(stored["schema"]), dict(map(tuple, stored["live"])), stored["held"], stored["note"])


class VersionedTable:
    """A table of Parquet files, by the values of the column ``by`` (dates, whole numbers or text), or as a whole."""

    def __init__(self, spark: SparkSession, path: str, by: str | None = None):
        self.spark, self.path, self.by = spark, path.rstrip("/"), by

    # Files

    def _at(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        at, system = self._at(f"{self.path}/manifest")
        names = [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []
        return sorted(int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit())

    def version(self) -> int | None:
        return max(self.versions(), default=None)

    def manifest(self, version: int | None = None) -> Manifest | None:
        """That of ``version``, by default the latest; None if there is no table yet."""
        version = self.version() if version is None else version
        if version is None:
            return None
        at, system = self._at(f"{self.path}/manifest/{version}.json")
        stream = system.open(at)
        try:
            return Manifest.loaded(version, self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, manifest: Manifest) -> None:
        """The one step that makes a change visible. The manifest is complete before it gets its name."""
        jvm, folder = self.spark._jvm, f"{self.path}/manifest"
        draft, system = self._at(f"{folder}/.{uuid.uuid4().hex}")
        stream = system.create(draft)
        stream.write(bytearray(manifest.dumped().encode()))
        stream.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        plain = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # that is, never overwrite
        try:
            files.rename(draft, self._at(f"{folder}/{manifest.number}.json")[0], plain)
        except (Py4JJavaError, CapturedException) as error:
            system.delete(draft, False)
            if "FileAlreadyExists" in str(error):
                raise ChangedMeanwhile(f"{self.path} has a version {manifest.number} already") from error
            raise

    # Reading

    def read(self, version: int | None = None, values: Collection[_Value] | None = None) -> DataFrame:
        """The rows of a version, by default the latest; with ``values`` only those of these partition values, if there are any."""
        manifest = self._known(self.manifest(version))
        return self._rows(manifest, manifest.live if values is None else [value for value in values if value in manifest.live])

    def _known(self, manifest: Manifest | None) -> Manifest:
        if manifest is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return manifest

    def _rows(self, manifest: Manifest, values: Collection[_Value]) -> DataFrame:
        """The rows with these partition values. Where a load has others too, a broadcast list of values, of which there is one
        per partition, leaves them out; where it has none, this is a plain scan."""
        loads: dict[str, list[_Value]] = {}
        for value in values:
            loads.setdefault(manifest.live[value], []).append(value)
        if not loads:
            return self.spark.createDataFrame([], manifest.schema)
        schema = T.StructType([*manifest.schema, T.StructField(_LOAD, T.StringType())])
        paths = [f"{self.path}/data/{_LOAD}={load}" for load in sorted(loads)]
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths)
        unwanted = [(load, value) for load, own in loads.items() for value in set(manifest.held[load]) - set(own)]
        if unwanted:
            wanted = [(load, value) for load, own in loads.items() for value in own]
            few, how = (unwanted, "left_anti") if len(unwanted) < len(wanted) else (wanted, "left_semi")
            listed = F.broadcast(self.spark.createDataFrame(few, "_of string, _value string"))
            rows = rows.join(listed, (F.col(_LOAD) == F.col("_of")) & F.col(self.by).cast("string").eqNullSafe(F.col("_value")), how)
        return rows.select(*manifest.schema.names)

    def changes(self, since: int, until: int | None = None) -> tuple[DataFrame, DataFrame]:
        """The rows that went and those that came between two versions, by partition value: of a value that was replaced, all
        rows are in both. Values that were not replaced are not read."""
        old, new = self._known(self.manifest(since)), self._known(self.manifest(until))
        went = [value for value, load in old.live.items() if new.live.get(value) != load]
        came = [value for value, load in new.live.items() if old.live.get(value) != load]
        return self._rows(old, went), self._rows(new, came)

    # Writing

    def replace(self, df: DataFrame, values: Iterable | None = None, note: dict | None = None, sort_by: Sequence[str] = (), gather: bool = True) -> int:
        """Put ``df`` in the place of the partition ``values`` and of those it has rows for, or, without ``values``, of the whole
        table; returns the new version. Values without rows are gone then. ``note`` is kept with the version. Without ``gather`` the
        rows are not shuffled by value first: every task writes those it has."""
        old = self.manifest()
        if old is not None and values is not None and set(df.columns) != set(old.schema.names):
            raise ValueError(f"columns {df.columns}, but the table has {old.schema.names}")
        load = f"v{uuid.uuid4().hex}"
        folder = f"{self.path}/data/{_LOAD}={load}"
        kept = df if old is None or values is None else df.select(*old.schema.names)
        gathered = kept.hint("rebalance", *([self.by] if self.by else [])) if gather else kept
        order = [*([self.by] if self.by else []), *sort_by]
        (gathered.sortWithinPartitions(*order) if order else gathered).write.option("compression", "zstd").parquet(folder)
        stored = self.spark.read.schema(kept.schema).parquet(folder)
        held = self._values(stored)
        gone = {None if v is None else str(v) for v in values} | set(held) if values is not None else None
        live = {} if old is None or gone is None else {value: of for value, of in old.live.items() if value not in gone}
        live |= dict.fromkeys(held, load)
        helds = {} if old is None else {of: own for of, own in old.held.items() if of in set(live.values())}
        number = 1 if old is None else old.number + 1
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in (kept.schema if old is None or values is None else old.schema)])
        self._commit(Manifest(number, nullable, live, helds | ({load: held} if held else {}), note or {}))
        return number

    def _values(self, df: DataFrame) -> list[_Value]:
        """The partition values of ``df``, one per partition; without ``by`` the one value None, if there are rows."""
        if self.by is None:
            return [] if df.isEmpty() else [None]
        return [row[0] for row in df.select(F.col(self.by).cast("string")).distinct().collect()]

    def merge(self, updates: DataFrame, keys: Sequence[str], order_by: Sequence[Column], delete: Column | None = None) -> int:
        """Replace, add or (where ``delete`` holds) remove the rows of ``updates`` by ``keys``; returns the version.

        Of updates with one key the first by ``order_by`` counts. Only partitions that hold an updated key, or get one, are
        read in full and written again. Null keys are keys. Applying the same updates again changes no row.
        """
        manifest = self._known(self.manifest())
        gone = F.lit(False) if delete is None else F.coalesce(delete, F.lit(False))
        with staging(self.spark) as folder:
            latest = staged(deduplicate(updates.withColumn("_gone", gone), keys, order_by=order_by), f"{folder}/latest")
            added = latest.where(~F.col("_gone")).select(*manifest.schema.names)
            outdated = match(self._rows(manifest, manifest.live).select(*dict.fromkeys([*keys, *([self.by] if self.by else [])])), latest, keys, "left_semi", null_safe=True)
            values = set(self._values(outdated)) | set(self._values(added))
            if not values:
                return manifest.number
            affected = self._rows(manifest, [value for value in values if value in manifest.live])
            merged = match(affected, latest, keys, "left_anti", null_safe=True).unionByName(added)
            return self.replace(merged, values, note=manifest.note)

    def vacuum(self, keep: int = 2) -> None:
        """Remove all but the last ``keep`` versions, and the loads that no kept version uses. No writer may be at work."""
        versions = self.versions()
        used = {load for version in versions[-keep:] for load in self.manifest(version).live.values()}
        for version in versions[:-keep]:
            remove(self.spark, f"{self.path}/manifest/{version}.json")
        at, system = self._at(f"{self.path}/data")
        for status in system.listStatus(at) if system.exists(at) else []:
            if status.getPath().getName().removeprefix(f"{_LOAD}=") not in used:
                system.delete(status.getPath(), True)
