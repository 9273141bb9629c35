"""Versioned keyed tables: immutable data files, delete files, and one manifest per version.

Below the table's folder:

- ``data/<id>``: the rows one commit adds, a parquet folder with the column ``_file`` set to ``<id>``.
- ``deletes/<id>``: (``_file``, keys) of rows of earlier data files that the commit supersedes, a delete vector by key.
- ``_log/<version>.json``: the manifest, listing the data and delete files of that version, the table's keys, and a
  ledger of what each writer has committed (stream name -> last batch id and its source files).

Readers resolve a version's manifest once and read only its files, merged on read by an anti join of data against
deletes; files are never changed, so a reader keeps its version while writers commit later ones. A commit is the
creation of the next manifest with create-if-absent: all files are written before, so a writer that dies earlier
leaves files that no manifest names, and the table is unchanged. Of two writers racing for one version, one fails.

A change writes only the rows of the keys it touches and their delete vector, however large the table is.
``compact`` rewrites the merged rows into files of a target size and commits a version without deletes.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.operators.mutate import latest_by_key, upsert
from marquee.session import materialize

FILE = "_file"
#: Size of a compacted data file, and the number of data files beyond which ``needs_compaction`` says yes.
TARGET_BYTES, MAX_DELTAS = 128 << 20, 32


class CommitConflict(RuntimeError):
    """Another writer committed the version first."""


class DeltaTable:
    """A keyed table at ``path``; every change is a new version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # Manifests.

    def _log(self, version: int) -> str:
        return f"{self.path}/_log/{version:020d}.json"

    def versions(self) -> list[int]:
        log = self._Path(f"{self.path}/_log")
        if not self._fs.exists(log):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(log)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self) -> int:
        """The latest committed version, -1 if none."""
        found = self.versions()
        return found[-1] if found else -1

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version < 0:
            raise FileNotFoundError(f"no version of {self.path}")
        stream = self._fs.open(self._Path(self._log(version)))
        try:
            reader = self.spark._jvm.java.io.BufferedReader(self.spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            text = "\n".join(iter(reader.readLine, None))
        finally:
            stream.close()
        return json.loads(text)

    def _commit(self, manifest: dict) -> int:
        version = manifest["version"]
        out = self._fs.create(self._Path(self._log(version)), False)  # fails if the version exists
        try:
            out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        finally:
            out.close()
        return version

    # Reading.

    def _rows(self, manifest: dict, with_file: bool = False) -> DataFrame:
        schema = manifest["schema"]
        data = [f"{self.path}/data/{d}" for d in manifest["data"]]
        rows = self.spark.read.schema(f"{schema}, {FILE} string").parquet(*data) if data else self.spark.createDataFrame([], f"{schema}, {FILE} string")
        if manifest["deletes"]:
            keys = manifest["keys"]
            gone = self.spark.read.parquet(*[f"{self.path}/deletes/{d}" for d in manifest["deletes"]]).select(FILE, *keys)
            rows = rows.join(gone, [FILE, *keys], "left_anti")
        return rows if with_file else rows.drop(FILE)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (default: the latest), as of when this is called."""
        return self._rows(self.manifest(version))

    def ledger(self, version: int | None = None) -> dict:
        return self.manifest(version).get("ledger", {}) if self.version() >= 0 else {}

    # Writing.

    def _file(self, kind: str, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/{kind}/{name}")
        return name

    def create(self, df: DataFrame, keys: Sequence[str]) -> int:
        """Version 0 with the rows of ``df``."""
        if self.version() >= 0:
            raise FileExistsError(self.path)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        name = uuid.uuid4().hex
        df.withColumn(FILE, F.lit(name)).write.parquet(f"{self.path}/data/{name}")
        return self._commit({"version": 0, "schema": schema, "columns": df.columns, "keys": list(keys), "data": [name], "deletes": [], "ledger": {}})

    def change(self, rows: DataFrame, superseded: DataFrame, ledger: Mapping[str, Any] | None = None,
               before_commit: Callable[[], None] | None = None, base: dict | None = None) -> int:
        """Commit ``rows`` as new and the (``_file``, keys) rows of ``superseded`` as deleted, on top of ``base``."""
        base = base or self.manifest()
        name = uuid.uuid4().hex
        # The file id is part of every row, so a delete names the rows of exactly one file.
        rows.select(*base["columns"]).withColumn(FILE, F.lit(name)).write.parquet(f"{self.path}/data/{name}")
        gone = superseded.select(FILE, *base["keys"])
        deleted = self._file("deletes", gone)
        if before_commit:
            before_commit()
        manifest = {**base, "version": base["version"] + 1, "data": [*base["data"], name], "deletes": [*base["deletes"], deleted],
                    "ledger": {**base.get("ledger", {}), **(ledger or {})}}
        try:
            return self._commit(manifest)
        except Exception as e:  # the version exists: another writer was first
            raise CommitConflict(f"version {manifest['version']} of {self.path} exists") from e

    def upsert(self, incoming: DataFrame, mode: str = "replace", defaults: Mapping[str, Any] | None = None, order: Sequence[str] = (),
               ledger: Mapping[str, Any] | None = None, before_commit: Callable[[], None] | None = None) -> int:
        """Insert or change rows by key (``mutate.upsert`` semantics); writes only the touched keys' rows."""
        base = self.manifest()
        keys = base["keys"]
        batch = materialize(incoming, "delta-batch")
        current = self._rows(base, with_file=True)
        touched = materialize(current.join(batch.select(*keys).distinct(), list(keys), "left_semi"), "delta-touched")
        merged = upsert(touched.drop(FILE), batch, keys, mode, defaults, order)
        return self.change(merged, touched, ledger, before_commit, base)

    def merge_newest(self, incoming: DataFrame, stamp: str, ledger: Mapping[str, Any] | None = None,
                     before_commit: Callable[[], None] | None = None) -> int | None:
        """Keep per key the row with the latest ``stamp`` among stored and incoming rows; equal stamps: the larger
        row by its other columns, so the result does not depend on the order of arrival. None if nothing changed."""
        base = self.manifest()
        keys, columns = base["keys"], base["columns"]
        batch = materialize(latest_by_key(incoming.select(*columns), keys, [stamp]), "delta-batch")
        current = self._rows(base, with_file=True)
        touched = materialize(current.join(batch.select(*keys), list(keys), "left_semi"), "delta-touched")
        winners = latest_by_key(touched.drop(FILE).unionByName(batch), keys, [stamp])
        stored = touched.select(*[F.col(c).alias(f"__s_{c}") for c in columns])
        same = F.lit(True)
        for c in columns:
            same = same & F.col(c).eqNullSafe(F.col(f"__s_{c}"))
        changed = materialize(winners.join(stored, same, "left_anti"), "delta-changed")
        if not changed.limit(1).count() and not ledger:
            return None
        superseded = touched.join(changed.select(*keys), list(keys), "left_semi")
        return self.change(changed, superseded, ledger, before_commit, base)

    # Upkeep.

    def needs_compaction(self, max_deltas: int = MAX_DELTAS) -> bool:
        return len(self.manifest()["data"]) > max_deltas

    def compact(self, target_bytes: int = TARGET_BYTES) -> int:
        """Rewrite the latest version's rows into files of about ``target_bytes``; the result has no deletes."""
        base = self.manifest()
        size = sum(self._fs.getContentSummary(self._Path(f"{self.path}/data/{d}")).getLength() for d in base["data"])
        name = uuid.uuid4().hex
        rows = self._rows(base).repartition(max(1, math.ceil(size / target_bytes)), *base["keys"])
        rows.withColumn(FILE, F.lit(name)).write.parquet(f"{self.path}/data/{name}")
        return self._commit({**base, "version": base["version"] + 1, "data": [name], "deletes": []})

    def vacuum(self, keep_from: int) -> int:
        """Delete files that no version from ``keep_from`` on names; returns how many folders went."""
        named = {("data", d) for v in self.versions() if v >= keep_from for d in self.manifest(v)["data"]}
        named |= {("deletes", d) for v in self.versions() if v >= keep_from for d in self.manifest(v)["deletes"]}
        gone = 0
        for kind in ("data", "deletes"):
            folder = self._Path(f"{self.path}/{kind}")
            if not self._fs.exists(folder):
                continue
            for status in self._fs.listStatus(folder):
                if (kind, status.getPath().getName()) not in named:
                    self._fs.delete(status.getPath(), True)
                    gone += 1
        return gone
