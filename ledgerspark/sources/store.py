"""Versioned tables on a shared file system: several tables change together or not at all.

Each publish writes its data to fresh directories and then one manifest, ``_manifests/<n>.json``, by a rename
that fails when another job has published the same version. A reader resolves one manifest and keeps seeing
that version while newer ones appear. Appends add a directory and leave the rest of a table untouched.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


class ConcurrentPublish(RuntimeError):
    """Another job has published this version first; nothing of this publish is visible."""


@dataclass(frozen=True)
class Manifest:
    version: int
    tables: dict[str, dict] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)


class VersionedStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        base = self._path(f"{self.root}/_manifests")
        conf = spark._jsc.hadoopConfiguration()
        self._fs = base.getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        self._fs.mkdirs(base)

    # ---- manifests

    def versions(self) -> list[int]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/_manifests"))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        if version is None:
            known = self.versions()
            if not known:
                return Manifest(0)
            version = known[-1]
        stream = self._fs.open(self._path(self._file(version)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(**json.loads(text))

    def _file(self, version: int) -> str:
        return f"{self.root}/_manifests/{version:012d}.json"

    def _commit(self, manifest: Manifest) -> None:
        draft = self._path(f"{self.root}/_manifests/draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(json.dumps(manifest.__dict__).encode())
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            self._context.rename(draft, self._path(self._file(manifest.version)), options)
        except Exception as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in str(error) or "already exists" in str(error):
                raise ConcurrentPublish(f"version {manifest.version} exists") from error
            raise

    # ---- reading and writing

    def read(self, table: str, version: int | None = None) -> DataFrame:
        entry = self.manifest(version).tables[table]
        return self.spark.read.schema(entry["schema"]).parquet(*[f"{self.root}/{p}" for p in entry["paths"]])

    def publish(
        self,
        replace: dict[str, DataFrame] | None = None,
        append: dict[str, DataFrame] | None = None,
        notes: dict[str, str] | None = None,
        base: Manifest | None = None,
    ) -> int:
        """Write all given tables, then make them visible together as the next version.

        ``base`` is the manifest the data was computed from; if another version has appeared since,
        ``ConcurrentPublish`` is raised and the job has to start from that one.
        """
        base = base or self.manifest()
        tables = dict(base.tables)
        for name, df in (replace or {}).items():
            tables[name] = {"schema": _ddl(df), "paths": [self._write(name, base.version + 1, df)]}
        for name, df in (append or {}).items():
            known = tables.get(name, {"schema": _ddl(df), "paths": []})
            if known["schema"] != _ddl(df):
                raise ValueError(f"{name} has the columns {known['schema']}, not {_ddl(df)}")
            tables[name] = {**known, "paths": [*known["paths"], self._write(name, base.version + 1, df)]}
        self._commit(Manifest(base.version + 1, tables, {**base.notes, **(notes or {})}))
        return base.version + 1

    def attach(self, table: str, schema: str, paths: list[str], base: Manifest | None = None) -> int:
        """Make directories that a job has already written under the root the content of a table."""
        base = base or self.manifest()
        tables = {**base.tables, table: {"schema": schema, "paths": paths}}
        self._commit(Manifest(base.version + 1, tables, base.notes))
        return base.version + 1

    def _write(self, name: str, version: int, df: DataFrame) -> str:
        path = f"{name}/v={version}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{path}")
        return path


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def create_table_as(store: VersionedStore, name: str, df: DataFrame) -> DataFrame:
    """Write a query result as a new table and return the table."""
    if name in store.manifest().tables:
        raise ValueError(f"table {name} exists")
    store.publish(replace={name: df})
    return store.read(name)


def insert_select(store: VersionedStore, name: str, df: DataFrame) -> DataFrame:
    store.publish(append={name: df})
    return store.read(name)


def truncate_reload(store: VersionedStore, name: str, df: DataFrame) -> DataFrame:
    store.publish(replace={name: df})
    return store.read(name)
