"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

DEFAULTS = {
    # Results must not depend on where the driver runs.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Let the engine coalesce small and split skewed shuffle partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Old (coast, year) partitions survive when only some are rewritten.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


_HANDED_OUT: list[str] = []


def build_session(app_name: str = "brinemark", master: str | None = None, **conf) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder. On a cluster the
    setting is required: executors would not see each other's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master is {master})")
    root = tempfile.mkdtemp(prefix="brinemark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder (not created); ``clear_work`` deletes it."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    _HANDED_OUT.append(path)
    return path


def work_mark() -> int:
    """A mark in the work folders handed out so far, for ``clear_work``."""
    return len(_HANDED_OUT)


def clear_work(spark: SparkSession, since: int = 0, keep: Sequence = ()) -> None:
    """Delete the work folders handed out after ``since``, but for those that the data frames of ``keep`` read.

    What was read from the deleted ones must not be used again.
    """
    kept = [f.split(":", 1)[-1] for df in keep for f in df.inputFiles()]
    for path in _HANDED_OUT[since:]:
        if not any(f"/{path.rstrip('/').rsplit('/', 1)[-1]}/" in f for f in kept):
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
            _HANDED_OUT.remove(path)


def stored(df, label: str):
    """``df`` written once to the shared folder and read back.

    Survives lost executors and gives the optimizer the true size in bytes, so that
    it broadcasts the table only where that is small.
    """
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df):
    """Materialise ``df`` once in the shared folder; survives executor loss."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def spread(df):
    """``df`` over at least as many partitions as there are cores; for narrow rows that are gone over many times."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
