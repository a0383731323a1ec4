"""Session settings every job and query relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# A day is a UTC day; loads replace only the partitions they write; the repository
# list (15 names) is longer than Parquet's default limit for an exact IN filter; raw
# payloads are text, which zstd packs far better than the default codec.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.pushdown.inFilterThreshold": "64",
    "spark.sql.parquet.compression.codec": "zstd",
    # A damaged or vanished file stops a load instead of shortening it.
    "spark.sql.files.ignoreCorruptFiles": "false",
    "spark.sql.files.ignoreMissingFiles": "false",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for the jobs started inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def sized_shuffles(
    spark: SparkSession, input_bytes: int, partition_bytes: int = 256 << 20, most: int = 50_000
) -> Iterator[int]:
    """Inside the block, start shuffles with enough partitions for an input of this size.

    Adaptive execution merges partitions that turn out small but cannot add any, so
    the number is only ever raised. Above `most` the partitions get larger and spill.
    """
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(floor, min(most, -(-input_bytes // partition_bytes)))
    with settings(spark, {INITIAL_PARTITIONS: str(wanted)}):
        yield wanted


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for intermediate tables, in the folder the cluster shares.

    That is `spark.checkpoint.dir`; only where it is unset and Spark runs in this
    process is a local temporary folder used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.conf.get("spark.master", "local").split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="forgepulse-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession, label: str) -> str:
    """A fresh database whose tables live under `scratch_path`."""
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name
