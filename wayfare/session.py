"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Partition counts and join strategies stay with AQE: it coalesces small
# shuffle partitions, splits skewed ones and turns a sort-merge join into a
# broadcast join only when the measured side is under the threshold.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # profile aggregates keep this many guests in a hash map before they sort
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "20000",
}


def session(app: str = "wayfare", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``, or set on the context.

    Executors must all see it. Only a local session that names none (as in tests)
    gets a temporary one, which is then remembered; elsewhere that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("wayfare.scratch", None)
    if not root:
        folder = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = folder.get() if folder.isDefined() else None
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="wayfare-")
        spark.conf.set("wayfare.scratch", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder name; nothing is ever overwritten or deleted."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, path: str):
    """A path and its file system: Hadoop's, so folders and object stores look alike."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place)


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    place, files = _place(spark, path)
    if not files.rename(place, _place(spark, to)[0]):
        raise OSError(f"cannot rename {path} to {to}")


def remove_path(spark: SparkSession, path: str) -> None:
    place, files = _place(spark, path)
    files.delete(place, True)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of a folder's files."""
    place, files = _place(spark, path)
    return files.getContentSummary(place).getLength()


FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Each execution started inside gives the disk of its shuffles back when it ends.

    Otherwise they stay until the driver happens to collect garbage, so that all steps of a
    job lie on disk together. Not for frames that are executed again by the same reference.
    """
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(FILE_CLEANUP) if before is None else spark.conf.set(FILE_CLEANUP, before)


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which Spark broadcasts a side of a join; negative: never."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip()
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit.lstrip("-"))
    return -size if limit.startswith("-") else size
