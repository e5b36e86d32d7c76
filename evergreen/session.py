"""Session set-up and the one way this package cuts lineage: a table on shared storage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str, app: str = "evergreen", partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution on; cluster deployments bring their own instead."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Unset is only acceptable in local mode (tests), where a temporary folder is
    as good as shared; on a cluster a machine-local folder would lose data with
    the machine, so that is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="evergreen-checkpoint-"))
    return sc.getCheckpointDir()


_run: ContextVar[str | None] = ContextVar("run", default=None)


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Keep the intermediate tables written inside the block in one folder, and remove it at the end.

    Results read those tables, so write them inside the block.  Without such a block
    the tables stay until the checkpoint folder is cleaned.
    """
    path = os.path.join(checkpoint_root(spark), f"evergreen-run-{uuid.uuid4().hex}")
    outer = _run.set(path)
    try:
        yield path
    finally:
        _run.reset(outer)
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on shared storage."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written inside the block leaves no shuffle files behind.

    Otherwise they stay until the driver happens to collect its garbage, so that the
    shuffles of a whole run may lie on disk at once.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def write_aside(df: DataFrame, name: str, keep: bool = False) -> tuple[DataFrame, str]:
    """``materialize``, with the folder of the table, for those that ``remove`` it when nothing reads it any more."""
    spark = df.sparkSession
    root = checkpoint_root(spark) if keep or not _run.get() else _run.get()
    path = os.path.join(root, f"evergreen-{name}-{uuid.uuid4().hex}")
    with freed_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` under the checkpoint folder and read it back; ``keep`` writes it outside any run folder.

    Downstream plans start from the files, so losing an executor never replays
    the history, later stages read only the columns they need, and the planner
    knows the table's real size when it picks join strategies.
    """
    return write_aside(df, name, keep)[0]
