"""Session defaults and the shared working folder."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Whole runs sort what a task reads; compressed files of 128 MB would be more rows than a task's memory sorts without spilling.
SPLIT_BYTES = 32 << 20
SPLITS = "spark.sql.files.maxPartitionBytes"
FORCED_SPLIT = "spark.sql.adaptive.forceOptimizeSkewedJoin"


def build_session(app: str = "marketlane", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution, UTC clock and dynamic partition overwrite.

    Shuffle partitions are left to the caller: adaptive execution coalesces
    small ones and splits skewed ones from the cluster-sized initial number.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def split_bytes(spark: SparkSession) -> int:
    """Size of the splits that files are read in."""
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(SPLITS))


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Inside, files are read in splits of at most ``SPLIT_BYTES``."""
    before = spark.conf.get(SPLITS)
    spark.conf.set(SPLITS, str(min(split_bytes(spark), SPLIT_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(SPLITS, before)


@contextmanager
def hot_keys_split(spark: SparkSession) -> Iterator[None]:
    """Inside, a hot key of a join is split also where the joined rows are grouped next, at the price of a shuffle there."""
    before = spark.conf.get(FORCED_SPLIT)
    spark.conf.set(FORCED_SPLIT, "true")
    try:
        yield
    finally:
        spark.conf.set(FORCED_SPLIT, before)


def in_small_splits(fn):
    """The same function of a session, run in ``small_splits``."""

    @functools.wraps(fn)
    def run(spark: SparkSession, *args, **kwargs):
        with small_splits(spark):
            return fn(spark, *args, **kwargs)

    return run


def ship(spark: SparkSession) -> str:
    """Send this package to the Python workers of the session, for clusters where it is not installed; returns the archive.

    Not needed where the workers' ``PYTHONPATH`` holds it or it came by ``--py-files``.
    """
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="marketlane-"), "marketlane")
    archive = shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)
    return archive


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets one made for it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", "")
    unset = ("", None, "<undefined>")  # how an optional setting without a value reads
    root = context.getCheckpointDir() if named in unset else named
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="marketlane-"))
        root = context.getCheckpointDir()
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    """Unused folder name below the shared folder."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")
