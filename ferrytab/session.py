"""Session helpers: a session for local runs, and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

#: Tasks per core that a stage of :func:`even_tasks` is cut into, as far as its bytes allow.
TASKS_PER_CORE = 4
# The least tasks of a scan, and of a stage after a shuffle that may be joined from smaller parts.
_LEAST_TASKS = ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionNum")

#: Paths that the innermost open scope owns; ``None`` outside of all scopes.
_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def local_session(cores: int | str = 8, app: str = "ferrytab") -> SparkSession:
    """A session for tests and local benchmarks; on a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ferrytab-warehouse-"))
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without that setting; a temporary folder is set for it then.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ferrytab-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below :func:`scratch_dir`; nothing is created. The innermost open :func:`scratch_scope` owns it."""
    path = os.path.join(scratch_dir(spark), f"{label}-{uuid.uuid4().hex}")
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are removed when the block ends, however it ends.

    Frames made inside must be written or collected inside: they read these tables. Until then the tables stay, so a
    lost executor costs a read. Without a scope they stay until their folder is emptied. An inner scope removes its own.
    """
    mark = _OWNED.set([])
    try:
        yield
    finally:
        owned = _OWNED.get() or []
        _OWNED.reset(mark)
        for path in owned:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def even_tasks(spark: SparkSession) -> Iterator[None]:
    """Stages that run inside have several tasks per core, so that their cores end at about the same time.

    Spark aims at one task per core and often makes one or two more, which the other cores then wait for. Files are not cut
    below Spark's cost of opening one, nor shuffled parts below its least size, so small tables have as few tasks as
    before. Settings that the session has already stay, and all are as before when the block ends.
    """
    least = str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    ours = [name for name in _LEAST_TASKS if spark.conf.get(name, None) is None]
    for name in ours:
        spark.conf.set(name, least)
    try:
        yield
    finally:
        for name in ours:
            spark.conf.unset(name)
