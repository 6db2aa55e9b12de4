"""A table of ids kept as immutable snapshots: commits that either take effect whole or not at all.

Each commit writes its new rows to a folder of their own, then publishes a manifest named after the
next version by a rename that fails if the name is taken. Readers open the latest manifest and see
whole commits only; of two writers that started from one version the second gets a conflict.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another commit was published since the version this one started from."""


@dataclass(frozen=True)
class Snapshot:
    version: int
    folders: tuple[str, ...]


class SnapshotTable:
    """Rows in ``folders`` of Parquet below ``path``, listed by numbered manifests."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        hadoop = spark._jvm.org.apache.hadoop
        self._hadoop = hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = hadoop.fs.Path(self.path).getFileSystem(self._conf)

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    def latest(self) -> Snapshot:
        """The last published version; version 0 is the empty table."""
        folder = self._at("manifests")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        versions = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")]
        return self.at(max(versions)) if versions else Snapshot(0, ())

    def at(self, version: int) -> Snapshot:
        """A published version; earlier ones stay readable."""
        stream = self._fs.open(self._at(f"manifests/{version:020d}.json"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return Snapshot(version, tuple(json.loads(text)["folders"]))

    def read(self, snapshot: Snapshot | None = None) -> DataFrame:
        snapshot = snapshot or self.latest()
        if not snapshot.folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in snapshot.folders])

    def write(self, rows: DataFrame) -> str:
        """The rows as a folder that no manifest names yet."""
        name = f"data/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{name}")
        return name

    def publish(self, base: Snapshot, folder: str) -> Snapshot:
        """Make a written folder part of the table; ``Conflict`` if ``base`` is no longer the latest."""
        new = Snapshot(base.version + 1, (*base.folders, folder))
        target, draft = self._at(f"manifests/{new.version:020d}.json"), self._at(f"manifests/.{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps({"folders": new.folders}).encode()))
        stream.close()
        if self._fs.exists(target):
            self._fs.delete(draft, False)
            raise Conflict(f"version {new.version} of {self.path} is taken")
        files = self._hadoop.FileContext.getFileContext(self._fs.getUri(), self._conf)
        options = self.spark._sc._gateway.new_array(self._hadoop.Options.Rename, 1)
        options[0] = self._hadoop.Options.Rename.NONE
        try:
            files.rename(draft, target, options)
        except Exception as error:
            if self._fs.exists(target):
                raise Conflict(f"version {new.version} of {self.path} is taken") from error
            raise
        return new


def mark(table: SnapshotTable, ids: DataFrame, attempts: int = 5) -> int:
    """Add ids that the table lacks, once each; returns the number added.

    After a conflict the ids are compared with the new version and the commit is tried again. Null
    ids are left out; without a new id nothing is committed.
    """
    for attempt in range(attempts):
        base = table.latest()
        new = ids.select("id").where("id IS NOT NULL").distinct().join(table.read(base), "id", "left_anti")
        folder = table.write(new)
        added = table.spark.read.schema(table.schema).parquet(f"{table.path}/{folder}").count()
        if not added:
            return 0
        try:
            table.publish(base, folder)
            return added
        except Conflict:
            if attempt == attempts - 1:
                raise
    return 0
