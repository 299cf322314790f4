"""Runs of a job with several outputs: steps that finish for good, outputs that appear together.

A run writes into a folder of its own, ``<root>/runs/<run id>``.  A step leaves
a marker when it is done, with what later steps need to know; a run that is
started again under the same id skips the steps that have one.  When all steps
are done the run is published: one small manifest, put in place by a rename,
names its outputs.  Readers go through the newest manifest, so they see the old
results until then and the new ones after, never some of both.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

_MANIFESTS = "_manifests"


class _Files:
    """The few file operations a run needs, on whatever store the path names."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))] if self.exists(path) else []

    def read(self, path: str) -> dict:
        return json.loads(self.spark.read.text(path, wholetext=True).first()[0])

    def write(self, path: str, content: dict) -> bool:
        """Write a small file so that it is there whole or not at all; False if there is one already."""
        folder, name = path.rsplit("/", 1)
        draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(draft), False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        if not self.exists(path) and self._fs.rename(self._path(draft), self._path(path)):
            return True
        self._fs.delete(self._path(draft), False)
        return False

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


class Run:
    """One run of a job under ``root``; give the ``run_id`` of a run that stopped to go on with it."""

    def __init__(self, spark: SparkSession, root: str, run_id: str | None = None):
        self.root, self.id = root.rstrip("/"), run_id or uuid.uuid4().hex[:12]
        if "/" in self.id or self.id.startswith("."):
            raise ValueError(f"{self.id!r} is no name for a folder")
        self.folder = f"{self.root}/runs/{self.id}"
        self._files = _Files(spark, self.root)

    def step(self, name: str, work: Callable[[], dict | None]) -> dict:
        """What ``work`` returned, from its marker if the step is done; otherwise the step is done (again) from its start."""
        marker = f"{self.folder}/_steps/{name}.json"
        if self._files.exists(marker):
            return self._files.read(marker)
        found = work() or {}
        self._files.write(marker, found)
        return found

    def publish(self, outputs: dict[str, str]) -> None:
        """Make ``outputs`` (name → path within the run's folder) the published ones, all at once; once for a run."""
        folder = f"{self.root}/{_MANIFESTS}"

        def work() -> None:
            content = {"run": self.id, "outputs": outputs}
            while not self._files.write(f"{folder}/{_next(self._files.names(folder)):08d}.json", content):
                pass  # another run was published meanwhile

        self.step("published", work)


def _numbers(names: list[str]) -> list[int]:
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _next(names: list[str]) -> int:
    return max(_numbers(names), default=0) + 1


def published(spark: SparkSession, root: str) -> dict[str, str]:
    """Output name → path of the newest published run under ``root``; raises if there is none."""
    root = root.rstrip("/")
    files = _Files(spark, root)
    numbers = _numbers(files.names(f"{root}/{_MANIFESTS}"))
    if not numbers:
        raise FileNotFoundError(f"nothing is published under {root}")
    manifest = files.read(f"{root}/{_MANIFESTS}/{numbers[-1]:08d}.json")
    return {name: f"{root}/runs/{manifest['run']}/{path}" for name, path in manifest["outputs"].items()}


def drop_old_runs(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete the runs published before the newest ``keep``, with their manifests; returns their ids.

    Runs that were never published are left alone: they may be under way.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    root = root.rstrip("/")
    files = _Files(spark, root)
    numbers = _numbers(files.names(f"{root}/{_MANIFESTS}"))
    paths = [f"{root}/{_MANIFESTS}/{n:08d}.json" for n in numbers]
    runs = [files.read(p)["run"] for p in paths]
    old = [(p, r) for p, r in zip(paths[:-keep], runs[:-keep]) if r not in runs[-keep:]]
    for path, run in old:
        files.delete(path)  # first the name, then the data
        files.delete(f"{root}/runs/{run}")
    return [r for _, r in old]
