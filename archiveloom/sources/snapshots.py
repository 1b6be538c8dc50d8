"""Tables under one folder that change all at once.

A version is a manifest, a small JSON file that names the folders each table consists of. Data
is written to folders of its own first and becomes visible only with the manifest, which is created
in one step and never overwritten; so a writer that is killed leaves the last version as it was,
and trying again writes other folders. Whoever commits says which version the work started from:
if another version came in between, the commit fails and nothing changes. A table may
consist of several folders, so that adding to it does not rewrite it.

Manifests that a killed writer left half written are passed over. Folders that no kept version
names are removed by :meth:`Snapshots.clean`.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

NOTHING = 0  # the version before the first


class Conflict(RuntimeError):
    """Another version was committed in the meantime."""


@dataclass(frozen=True)
class Snapshot:
    """One version: the folders and the schema of each table, and free information."""

    version: int
    parent: int
    folders: Mapping[str, list[str]]
    schemas: Mapping[str, dict]
    info: Mapping[str, object] = field(default_factory=dict)


class Snapshots:
    """The versions under a folder of any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *parts: object):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *map(str, parts)]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, folder: str) -> list:
        files, path = self._files(), self._path(folder)
        return list(files.listStatus(path)) if files.exists(path) else []

    def _numbers(self) -> list[int]:
        return sorted(int(s.getPath().getName().removesuffix(".json")) for s in self._listed("_versions"))

    def _manifest(self, number: int) -> Snapshot | None:
        stream = self._files().open(self._path("_versions", f"{number:010d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            return Snapshot(**json.loads(text))
        except ValueError:  # half written
            return None
        finally:
            stream.close()

    def history(self) -> list[Snapshot]:
        """All versions in order, each based on the one before it."""
        found: list[Snapshot] = []
        for number in self._numbers():
            one = self._manifest(number)
            if one and one.parent == (found[-1].version if found else NOTHING):
                found.append(one)
        return found

    def latest(self) -> Snapshot | None:
        versions = self.history()
        return versions[-1] if versions else None

    def at(self, version: int | None = None) -> Snapshot:
        versions = {s.version: s for s in self.history()}
        wanted = max(versions, default=None) if version is None else version
        if wanted not in versions:
            raise LookupError(f"{self.root}: no version {'at all' if version is None else version}")
        return versions[wanted]

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table as of a version, the latest one if none is given."""
        one = self.at(version)
        schema = StructType.fromJson(one.schemas[table])
        folders = [f"{self.root}/{f}" for f in one.folders[table]]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def draft(self) -> "Draft":
        return Draft(self, self.latest())

    def commit(self, based_on: int, folders: Mapping[str, list[str]], schemas: Mapping[str, dict], info: Mapping[str, object]) -> Snapshot:
        last = self.latest()
        if (last.version if last else NOTHING) != based_on:
            raise Conflict(f"{self.root}: version {last.version if last else NOTHING} is not {based_on}")
        number = max(self._numbers(), default=NOTHING) + 1
        one = Snapshot(number, based_on, dict(folders), dict(schemas), dict(info))
        text = json.dumps(one.__dict__).encode()
        try:
            stream = self._files().create(self._path("_versions", f"{number:010d}.json"), False)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                raise Conflict(f"{self.root}: version {number} was taken") from e
            raise
        stream.write(text, 0, len(text))
        stream.close()
        if self.latest().version != number:  # another writer's manifest was finished after this began
            raise Conflict(f"{self.root}: version {number} lost to another one")
        return one

    def rollback(self, version: int) -> Snapshot:
        """A new version with the tables of an old one."""
        old, last = self.at(version), self.latest()
        return self.commit(last.version, old.folders, old.schemas, {**old.info, "rollback_to": version})

    def clean(self, keep: int = 2, older_than: float = 86_400.0) -> list[str]:
        """Remove data folders that the last ``keep`` versions do not name, and that are no one's draft.

        A folder younger than ``older_than`` seconds may belong to a writer at work and stays.
        """
        named = {f.split("/")[1] for s in self.history()[-keep:] for folders in s.folders.values() for f in folders}
        gone = []
        for status in self._listed("data"):
            name, age = status.getPath().getName(), time.time() - status.getModificationTime() / 1000
            if name not in named and age >= older_than:
                self._files().delete(status.getPath(), True)
                gone.append(name)
        return gone


def _schema(df: DataFrame) -> dict:
    """Schema of what is written: files do not keep which values cannot be NULL."""

    def nullable(part):
        if isinstance(part, dict):
            return {k: True if k in ("nullable", "containsNull", "valueContainsNull") else nullable(v) for k, v in part.items()}
        return [nullable(p) for p in part] if isinstance(part, list) else part

    return nullable(df.schema.jsonValue())


class Draft:
    """The next version in the making."""

    def __init__(self, snapshots: Snapshots, base: Snapshot | None):
        self.snapshots, self.base = snapshots, base
        self.name = f"data/{uuid.uuid4().hex}"
        self.folders: dict[str, list[str]] = {t: list(f) for t, f in base.folders.items()} if base else {}
        self.schemas: dict[str, dict] = dict(base.schemas) if base else {}
        self.info: dict[str, object] = dict(base.info) if base else {}

    def write(self, table: str, df: DataFrame, add: bool = False) -> DataFrame:
        """Write a table, or with ``add`` more rows of it; returns what was written."""
        folder = f"{self.name}/{table}"
        schema = _schema(df)
        if add and self.schemas.get(table) not in (None, schema):
            raise ValueError(f"{table}: the rows to add have another schema")
        df.write.mode("errorifexists").parquet(f"{self.snapshots.root}/{folder}")
        self.folders[table] = [*(self.folders.get(table, []) if add else []), folder]
        self.schemas[table] = schema
        return self.snapshots.spark.read.schema(StructType.fromJson(schema)).parquet(f"{self.snapshots.root}/{folder}")

    def commit(self, **info: object) -> Snapshot:
        """Make the draft the latest version; :class:`Conflict` if another one came first."""
        base = self.base.version if self.base else NOTHING
        return self.snapshots.commit(base, self.folders, self.schemas, {**self.info, **info})
