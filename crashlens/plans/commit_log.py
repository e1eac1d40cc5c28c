"""What a batch job has finished, kept beside its output so that a restarted job goes on from there.

Each step writes its result to a folder of its own below ``_attempts``, which
is then renamed to its place; last, a small file below ``_commits`` names the
run and holds the step's status row. Only the commit counts: a result without
one is what a killed job left, and the next job removes it. A commit appears
whole (it is written beside its place and renamed), through Spark's own
file system interface, so the log lies wherever the output does.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from crashlens.session import remove_path

COMMITS, ATTEMPTS, STAGED = "_commits", "_attempts", "_staged"


class CommitLog:
    """The log of one output folder, for one run (``run_id`` names the input and its version)."""

    def __init__(self, spark: SparkSession, folder: str, run_id: str):
        self.spark, self.folder, self.run_id = spark, folder.rstrip("/"), run_id
        self._jvm = spark._jvm
        self._fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))

    def _names(self, folder: str) -> list[str]:
        where = self._path(self.folder, folder)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def _read(self, folder: str, name: str) -> dict:
        stream = self._fs.open(self._path(self.folder, folder, name))
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def _write(self, folder: str, name: str, value: dict) -> None:
        """One whole file: written under a hidden name, then renamed."""
        part, final = (self._path(self.folder, folder, x) for x in (f".{name}-{uuid.uuid4().hex[:8]}", name))
        stream = self._fs.create(part, True)
        stream.write(bytearray(json.dumps(value).encode()))
        stream.close()
        self._fs.delete(final, False)
        self._rename(part, final)

    def _rename(self, source, target) -> None:
        if not self._fs.rename(source, target):
            raise OSError(f"could not rename {source} to {target}")

    def committed(self) -> dict[str, dict]:
        """Status of each step that this run has finished."""
        found = {n.removesuffix(".json"): self._read(COMMITS, n) for n in self._names(COMMITS) if n.endswith(".json") and not n.startswith(".")}
        return {step: c["status"] for step, c in found.items() if c["run_id"] == self.run_id}

    def recover(self, outputs: dict[str, str]) -> dict[str, dict]:
        """Removes what killed jobs and other runs left; returns the steps that are finished.

        ``outputs`` are the folders of all steps that write one. Attempts,
        tables that an earlier job staged, commits of other runs, and outputs
        without a commit of this run are removed.
        """
        done = self.committed()
        for name in self._names(COMMITS):
            if name.removesuffix(".json") not in done:
                self._fs.delete(self._path(self.folder, COMMITS, name), True)
        for step, path in outputs.items():
            if step not in done:
                self._fs.delete(self._path(path), True)
        self._fs.delete(self._path(self.folder, ATTEMPTS), True)
        for name in self._names(STAGED):
            if not name.startswith("."):
                remove_path(self.spark, self._read(STAGED, name)["path"])
            self._fs.delete(self._path(self.folder, STAGED, name), True)
        return done

    def staging(self, path: str) -> None:
        """Notes, before it is written, a folder that must go with this job."""
        self._write(STAGED, f"{uuid.uuid4().hex[:12]}.json", {"path": path})

    def write(self, step: str, path: str, write: Callable[[str], int]) -> int:
        """``write(folder)`` to a folder of this attempt, which is then put at ``path``; returns what ``write`` does."""
        attempt = f"{self.folder}/{ATTEMPTS}/{step}-{uuid.uuid4().hex[:8]}"
        result = write(attempt)
        self._fs.delete(self._path(path), True)
        self._fs.mkdirs(self._path(path).getParent())
        self._rename(self._path(attempt), self._path(path))
        return result

    def commit(self, step: str, status: dict) -> None:
        self._write(COMMITS, f"{step}.json", {"run_id": self.run_id, "status": status})

    def finish(self) -> None:
        """After the last step: what was staged is gone, so its notes go too."""
        for folder in (ATTEMPTS, STAGED):
            self._fs.delete(self._path(self.folder, folder), True)
