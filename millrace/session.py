"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings a job needs for right results or for a plan that survives skew; sizes
# (executors, memory, shuffle partitions) belong to whoever submits the job.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app_name: str = "millrace", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return sc.getCheckpointDir()


_owner: ContextVar[str | None] = ContextVar("millrace_scratch", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder, or in the folder of the scratch() around it."""
    return os.path.join(_owner.get() or shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


@contextmanager
def scratch(spark: SparkSession):
    """A folder for what the job inside writes by stable() and scratch_path(); it is deleted at the end.

    Frames made inside read those tables, so write or collect them before the end.
    """
    path = scratch_path(spark, "job")
    token = _owner.set(path)
    try:
        yield path
    finally:
        _owner.reset(token)
        drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path in whatever store holds it; a missing one is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def side_by_side(spark: SparkSession, jobs: dict[str, Callable], most: int = 4) -> dict:
    """What each function returns, by name; up to ``most`` of them submit their Spark jobs at the same time.

    For jobs that do not need each other: the tasks of one fill the cores that the last
    tasks, the planning and the commit of another leave idle.
    """
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(most) as pool:
        running = {name: pool.submit(copy_context().run, inherit(job)) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


def stable(df, path: str | None = None):
    """Materialise ``df`` so that later stages never recompute it differently.

    A table written to the shared folder (or to ``path``): it survives the loss of
    executors, is computed once (a checkpoint computes twice), and its size is known to
    the optimizer from then on.
    """
    path = path or scratch_path(df.sparkSession, "stable")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
