"""Session helpers: a local session for tests and benches, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cohortlens", extra_conf: dict | None = None
) -> SparkSession:
    """Local session for tests, benches and examples (UI off, AQE on, UTC)."""
    builder = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder
        .master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def in_one_process(master: str) -> bool:
    """Whether executors are threads of the driver, so that they share its files and import path."""
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (as the context resolved it).

    On a cluster this must be set by whoever runs the job (a folder every
    executor can reach).  Only a local-mode session without it gets a fresh
    folder of its own, as in tests.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if configured:
            sc.setCheckpointDir(configured)
        elif in_one_process(sc.master):
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="cohortlens-ckpt-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before writing intermediate tables")
    return sc.getCheckpointDir().rstrip("/")


_scratch: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder for an intermediate table."""
    path = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete all intermediate tables this session has made so far; returns how many there were.

    Results are lazy and read them: call this when what they were made for has
    been written.  Tables of other sessions in the same folder stay.
    """
    sc = spark.sparkContext
    paths = _scratch.pop(sc.applicationId, [])
    dropped = 0
    for path in paths:
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        dropped += where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
    return dropped


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers.

    In local mode nothing is to do where the repository is on PYTHONPATH or is
    the working folder.  Otherwise its sources go to the executors through
    ``addPyFile``, once a session: on a cluster the driver's import path and
    working folder say nothing about theirs.
    """
    sc = spark.sparkContext
    on_path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    here = _ROOT in on_path or os.path.abspath(os.getcwd()) == _ROOT
    app = sc.applicationId
    if in_one_process(sc.master) and here or app in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="cohortlens-src-"), "cohortlens_src.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(os.path.join(_ROOT, "cohortlens")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, _ROOT))
    sc.addPyFile(archive)
    _shipped.add(app)
