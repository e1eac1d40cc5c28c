"""Staged CSV files that later jobs reuse.

A store is a shared folder of batches. A batch is the Parquet form of the
source files that some job found new, with the file of every row, and a
manifest: each file's path, size and time, how it was read, and the hash of all that,
which is the batch's name. A job lists its source, takes every file whose path,
size and time a committed batch has, and stages the others as one batch more;
files that changed or went are filtered out of older batches. A manifest is
renamed into place last, so a batch without one does not count.

A job holds a lease on the batches it reads; :meth:`StageStore.clean` removes batches
on which there is none that still runs.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.session import remove_path
from crashlens.sources.csv_load import header_groups
from crashlens.sources.schemas import REQUIRED_COLUMNS, TABLE_TYPES

MANIFEST, BATCHES, LEASES = "manifest.json", "batches", "leases"
SOURCE_FILE = "_source_file"
LEASE_SECONDS = 24 * 3600


@dataclass(frozen=True)
class Staged:
    """Rows of a source, read from batches; how many files were reused and which were staged; the lease held."""

    rows: DataFrame
    reused: int
    new: tuple[str, ...]
    lease: str


class StageStore:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._hadoop, self._conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
        self._fs = self._path().getFileSystem(self._conf)

    def _path(self, *parts: str):
        return self._hadoop.fs.Path("/".join((self.folder, *parts)))

    def _list(self, folder: str) -> list[str]:
        where = self._path(folder)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def _read(self, *parts: str) -> dict | None:
        where = self._path(*parts)
        if not self._fs.exists(where):
            return None
        stream = self._fs.open(where)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def _write(self, value: dict, folder: str, name: str) -> None:
        part = self._path(folder, f".{uuid.uuid4().hex}")
        stream = self._fs.create(part, True)
        stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        stream.close()
        self._fs.delete(self._path(folder, name), False)
        if not self._fs.rename(part, self._path(folder, name)):
            raise OSError(f"could not write {folder}/{name} in {self.folder}")

    def _stamp(self, file: str) -> list:
        where = self._hadoop.fs.Path(file)
        status = where.getFileSystem(self._conf).getFileStatus(where)
        return [int(status.getLen()), int(status.getModificationTime())]

    def manifests(self) -> dict[str, dict]:
        """The committed batches by name."""
        found = {name: self._read(BATCHES, name, MANIFEST) for name in self._list(BATCHES)}
        return {name: m for name, m in found.items() if m}

    def load(self, path: str, types: dict[str, T.DataType] | None = None, sep: str = ",", seconds: float = LEASE_SECONDS) -> Staged:
        """The rows of the CSV files at ``path`` (headers may differ), typed as ``read_csv_typed`` does; only new files are parsed.

        Columns are those of all files, NULL where a file lacks one. Files that are read
        in another way (``types``, ``sep``) are other content. ``release`` the lease when the
        rows are not needed any more; it ends by itself after ``seconds``.
        """
        types = types or {}
        how = json.dumps([sep, {c: t.simpleString() for c, t in sorted(types.items())}])
        groups = header_groups(self.spark, path, sep)
        if not groups:
            raise ValueError(f"no CSV files at {path}")
        stamps = {f: self._stamp(f) for g in groups for f in g.files}
        lease = uuid.uuid4().hex
        # The lease comes first, and names no batch yet: it keeps all, so none that is about to be reused is removed meanwhile.
        self._write({"until": time.time() + seconds, "batches": None}, LEASES, lease)
        taken: dict[str, list[str]] = {}
        left = dict(stamps)
        for name, manifest in self.manifests().items():
            if manifest["how"] == how:
                same = [f for f, stamp in manifest["files"].items() if left.get(f) == stamp]
                if same:
                    taken[name] = same
                    left = {f: s for f, s in left.items() if f not in same}
        if left:
            name = hashlib.sha256(json.dumps([how, sorted(left.items())]).encode()).hexdigest()[:32]
            self._stage(name, [(g.columns, [f for f in g.files if f in left]) for g in groups], left, how, types, sep)
            taken[name] = sorted(left)
        self._write({"until": time.time() + seconds, "batches": sorted(taken)}, LEASES, lease)
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [self._rows(name, files) for name, files in sorted(taken.items())])
        order = list(dict.fromkeys(c for g in groups for c in g.columns))
        return Staged(rows.select(*[F.col(f"`{c}`") for c in order]), len(stamps) - len(left), tuple(sorted(left)), lease)

    def _stage(self, name: str, groups: list, files: dict, how: str, types: dict, sep: str) -> None:
        def parse(columns: tuple[str, ...], own: list[str]) -> DataFrame:
            schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
            raw = self.spark.read.schema(schema).options(header=True, sep=sep, mode="PERMISSIVE", enforceSchema=False).csv(own)
            cast = [F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in columns]
            return raw.select(*cast, F.col("_metadata.file_path").alias(SOURCE_FILE))

        parsed = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [parse(c, own) for c, own in groups if own])
        rows = f"rows-{uuid.uuid4().hex[:12]}"  # two jobs that stage the same files do not touch each other's
        parsed.write.option("compression", "zstd").parquet(str(self._path(BATCHES, name, rows)))
        self._write({"how": how, "files": files, "schema": parsed.schema.json(), "rows": rows}, f"{BATCHES}/{name}", MANIFEST)

    def _rows(self, name: str, files: list[str]) -> DataFrame:
        manifest = self._read(BATCHES, name, MANIFEST)
        rows = self.spark.read.schema(T.StructType.fromJson(json.loads(manifest["schema"]))).parquet(str(self._path(BATCHES, name, manifest["rows"])))
        gone = sorted(set(manifest["files"]) - set(files))
        if gone:
            spelled = F.regexp_replace(SOURCE_FILE, "^file:/+", "file:/")
            rows = rows.where(~spelled.isin([g.replace("file:///", "file:/") for g in gone]))
        return rows.drop(SOURCE_FILE)

    def release(self, staged: Staged) -> None:
        self._fs.delete(self._path(LEASES, staged.lease), False)

    def clean(self, now: float | None = None) -> list[str]:
        """Removes ended leases, and batches that no lease names (all stay while some job has not chosen yet); returns the batches' names."""
        now = time.time() if now is None else now
        held: set[str] = set()
        for lease in self._list(LEASES):
            known = None if lease.startswith(".") else self._read(LEASES, lease)
            if not known or known["until"] <= now:
                self._fs.delete(self._path(LEASES, lease), False)
            elif known["batches"] is None:
                return []
            else:
                held |= set(known["batches"])
        free = [name for name in self._list(BATCHES) if name not in held]
        for name in free:
            remove_path(self.spark, str(self._path(BATCHES, name)))
        return free


def load_tables(store: StageStore, paths: dict[str, str]):
    """The crash tables of CSV folders through the store; returns them and what was staged, by table."""
    from crashlens.sources.catalog import CrashTables

    loads = {name: store.load(paths[name], TABLE_TYPES.get(name)) for name in ("person", "units", "damages")}
    for name, load in loads.items():
        missing = [c for c in REQUIRED_COLUMNS[name] if c not in load.rows.columns]
        if missing:
            raise ValueError(f"table {name!r} at {paths[name]} lacks columns {missing}")
    return CrashTables(**{name: load.rows for name, load in loads.items()}), loads
