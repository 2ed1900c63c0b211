"""One commit for all tables of a build: a log of snapshots.

A build writes its tables aside, each into a folder of its own that is never written
again, and then adds one file to the log, which names the folders of every table. Adding
fails if a file of that number is there already, so of two builds that began with one
snapshot the second is refused. Whoever breaks off before that leaves the old whole set.
Readers hold a snapshot, and with it all its tables, until they take another one. Folders
that no kept snapshot names are removed later.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.canonical import drop_sensitive
from .files import hadoop

LOG = "_snapshots"


class ConcurrentBuild(Exception):
    """Another build was committed since this one began."""


@dataclass(frozen=True)
class Snapshot:
    """number (0: none yet); tables: layer/name to its folders (path below the root, and what tells one apart: bucket, generation); meta: what builds need to know."""

    spark: SparkSession
    root: str
    number: int = 0
    tables: dict[str, list[dict]] = field(default_factory=dict)
    schemas: dict[str, dict] = field(default_factory=dict)
    meta: dict = field(default_factory=dict)

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def read(self, name: str, empty: str | None = None, buckets: list[int] | None = None, generations: list[str] | None = None) -> DataFrame:
        """The table, or those of its folders; without it an empty one of the schema `empty`."""
        if name not in self.tables:
            if empty is None:
                raise KeyError(name)
            return self.spark.createDataFrame([], empty)
        schema = StructType.fromJson(self.schemas[name])
        chosen = [p["path"] for p in self.tables[name] if (buckets is None or p.get("bucket") in buckets) and (generations is None or p.get("generation") in generations)]
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p}" for p in chosen]) if chosen else self.spark.createDataFrame([], schema)


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def numbers(self) -> list[int]:
        fs, at = hadoop(self.spark, f"{self.root}/{LOG}")
        names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def at(self, number: int) -> Snapshot:
        doc = json.loads("\n".join(r.value for r in self.spark.read.text(self._file(number)).collect()))
        return Snapshot(self.spark, self.root, number, doc["tables"], doc["schemas"], doc["meta"])

    def latest(self) -> Snapshot:
        numbers = self.numbers()
        return self.at(numbers[-1]) if numbers else Snapshot(self.spark, self.root)

    def begin(self) -> Transaction:
        return Transaction(self, self.latest())

    def _file(self, number: int) -> str:
        return f"{self.root}/{LOG}/{number:020d}.json"

    def add(self, snapshot: Snapshot) -> None:
        """The log's next file; it appears whole or not at all."""
        jvm = self.spark._jvm
        fs, log = hadoop(self.spark, f"{self.root}/{LOG}")
        fs.mkdirs(log)
        aside = f"{self.root}/{LOG}/{uuid.uuid4().hex}.aside"
        out = fs.create(jvm.org.apache.hadoop.fs.Path(aside))
        out.write(bytearray(json.dumps({"tables": snapshot.tables, "schemas": snapshot.schemas, "meta": snapshot.meta}).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(log.toUri(), self.spark._jsparkSession.sessionState().newHadoopConf())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(fs.makeQualified(jvm.org.apache.hadoop.fs.Path(aside)), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(self._file(snapshot.number))), options)
        except Exception as error:
            fs.delete(jvm.org.apache.hadoop.fs.Path(aside), False)
            if "FileAlreadyExists" in str(error):
                raise ConcurrentBuild(f"snapshot {snapshot.number} is there already") from error
            raise

    def clean(self, keep: int = 2, grace: float = 3600) -> None:
        """Remove all but the last snapshots, and folders that no remaining one names and that are older than `grace` seconds, as a build under way has such too."""
        fs, _ = hadoop(self.spark, self.root)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        numbers = self.numbers()
        for n in numbers[:-keep]:
            fs.delete(path(self._file(n)), False)
        used = {"/".join(p["path"].split("/")[:3]) for n in numbers[-keep:] for parts in self.at(n).tables.values() for p in parts}
        for layer in fs.listStatus(path(self.root)):
            if not layer.isDirectory() or layer.getPath().getName().startswith(("_", ".")):
                continue
            for table in fs.listStatus(layer.getPath()):
                for version in fs.listStatus(table.getPath()) if table.isDirectory() else ():
                    place = "/".join((layer.getPath().getName(), table.getPath().getName(), version.getPath().getName()))
                    if version.getPath().getName().startswith("v-") and place not in used and version.getModificationTime() / 1000 <= time.time() - grace:
                        fs.delete(version.getPath(), True)


class Transaction:
    """The tables of the next snapshot: those of the last one but where this writes, appends or drops."""

    def __init__(self, store: Snapshots, base: Snapshot):
        self.store, self.base, self.id = store, base, uuid.uuid4().hex
        self.tables, self.schemas, self.meta = {k: list(v) for k, v in base.tables.items()}, dict(base.schemas), dict(base.meta)

    @property
    def now(self) -> Snapshot:
        """What is there so far."""
        return Snapshot(self.store.spark, self.store.root, self.base.number + 1, self.tables, self.schemas, self.meta)

    def _put(self, name: str, df: DataFrame, buckets: bool = False) -> list[dict]:
        df = drop_sensitive(df)
        # Each write has a folder of its own, so a table may be written twice in a build.
        place = f"{name}/v-{self.id}-{uuid.uuid4().hex[:8]}"
        at = f"{self.store.root}/{place}"
        (df.write.partitionBy("bucket") if buckets else df.write).parquet(at)
        self.schemas[name] = json.loads((df.drop("bucket") if buckets else df).schema.json())
        if not buckets:
            return [{"path": place}]
        fs, path = hadoop(self.store.spark, at)
        names = sorted(f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory())
        return [{"path": f"{place}/{n}", "bucket": int(n.split("=")[1])} for n in names]

    def write(self, name: str, df: DataFrame) -> DataFrame:
        self.tables[name] = self._put(name, df)
        return self.now.read(name)

    def write_unless_empty(self, name: str, df: DataFrame) -> None:
        self.write(name, df)
        if self.now.read(name).isEmpty():
            self.drop(name)

    def write_buckets(self, name: str, df: DataFrame, buckets: list[int]) -> DataFrame:
        """df (with a column bucket) in place of what the table has in these buckets; other buckets' folders stay."""
        new = self._put(name, df, True)
        self.tables[name] = [p for p in self.tables.get(name, []) if p["bucket"] not in buckets] + new
        return self.now.read(name)

    def append(self, name: str, df: DataFrame, generation: str | None = None, buckets: bool = False) -> DataFrame:
        """One more folder (of one generation); returns what is appended."""
        new = [p | ({"generation": generation} if generation else {}) for p in self._put(name, df, buckets)]
        self.tables[name] = self.tables.get(name, []) + new
        return self.store.spark.read.schema(StructType.fromJson(self.schemas[name])).parquet(*[f"{self.store.root}/{p['path']}" for p in new]) if new else self.now.read(name, buckets=[])

    def keep_generations(self, used: set[str]) -> None:
        for name, parts in self.tables.items():
            self.tables[name] = [p for p in parts if p.get("generation") is None or p["generation"] in used]

    def drop(self, *names: str) -> None:
        for name in names:
            self.tables.pop(name, None)

    def commit(self) -> Snapshot:
        self.store.add(self.now)
        return self.now
