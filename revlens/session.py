"""Session conventions: UTC clock, shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_JOB_ROOT: ContextVar[str | None] = ContextVar("job_root", default=None)
_ENDING: set[str] = set()


def build_session(app: str = "revlens", **conf: str) -> SparkSession:
    """Session for jobs started outside a cluster launcher.

    Only settings whose value changes results or plan adaptivity are set here; sizes (memory,
    shuffle partitions) belong to the submitter.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Hours and weekdays are read off the session clock, so every job runs on UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: the one named by ``spark.checkpoint.dir``.

    Without that setting a cluster is an error, since other hosts cannot read this host's disk; a
    local master, whose only host is this one, takes a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{tempfile.gettempdir()}/revlens-{os.getpid()}"


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop_folder(spark: SparkSession, path: str) -> None:
    found, system = _hadoop_path(spark, path)
    system.delete(found, True)


def folder_names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names below a folder that begin so; none if there is no such folder."""
    found, system = _hadoop_path(spark, path)
    if not system.exists(found):
        return []
    names = [status.getPath().getName() for status in system.listStatus(found)]
    return [n for n in names if n.startswith(prefix)]


def commit_mark(spark: SparkSession, path: str) -> None:
    """An empty file, made in one step; an error if it is there already."""
    found, system = _hadoop_path(spark, path)
    system.create(found, False).close()


def mark_exists(spark: SparkSession, path: str) -> bool:
    found, system = _hadoop_path(spark, path)
    return system.exists(found)


@contextmanager
def job_scratch(spark: SparkSession, work_dir: str) -> Iterator[str]:
    """Scratch tables of a job lie under its own folder and go when it ends, also if it fails."""
    root = f"{work_dir.rstrip('/')}/_scratch-{uuid.uuid4().hex}"
    token = _JOB_ROOT.set(root)
    try:
        yield root
    finally:
        _JOB_ROOT.reset(token)
        drop_folder(spark, root)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path no earlier run has used: under the running job's folder, else under the application's.

    The application's folder is deleted when its JVM ends.
    """
    root = _JOB_ROOT.get()
    if root is None:
        root = f"{shared_root(spark)}/revlens-{spark.sparkContext.applicationId}"
        if root not in _ENDING:
            found, system = _hadoop_path(spark, root)
            system.mkdirs(found)
            system.deleteOnExit(found)
            _ENDING.add(root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Used where several actions consume the same derived rows: the written table survives executor
    loss and cuts the lineage, which a cached block does not.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
