"""Session settings, and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; the cluster's own settings win elsewhere."""
    builder = SparkSession.builder.appName("filingpanel")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application.

    Workers import operator code by name, and a driver started from another folder has the package
    only on its own path. Spark's file server hands the archive to every executor, later ones too.
    """
    context = spark.sparkContext
    if getattr(context, "_filingpanel_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="filingpanel-"), "filingpanel.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as target:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._filingpanel_shipped = True


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the cluster's shared checkpoint folder.

    Only a session inside one process (``local``, ``local[n]``) that lacks the setting falls back to
    the machine's own temporary folder: on a cluster, ``local-cluster`` included, such a folder would
    not be visible to every executor.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        root = tempfile.gettempdir()
    return os.path.join(root, f"filingpanel-{name}-{uuid.uuid4().hex}")


def staged(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, so several results can start from an expensive decode without repeating
    it, and a lost executor costs a re-read instead of a re-decode.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    if (kept := _RECORDED.get()) is not None:
        kept.append(folder)
    df.write.partitionBy(*partition_by).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


_RECORDED: ContextVar[list[str] | None] = ContextVar("staged folders", default=None)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders of everything staged meanwhile, for ``remove``."""
    folders: list[str] = []
    token = _RECORDED.set(folders)
    try:
        yield folders
    finally:
        _RECORDED.reset(token)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete files or folders, with the session's own file systems."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
