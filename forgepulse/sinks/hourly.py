"""Writes the landing zone: one gzipped NDJSON file per hour that has events."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse.functions.columns import hourly_file_name

TIMES = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_FILE = "_hour_file"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and a function from text to a path of it."""
    jvm = spark._jvm
    to_path = jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark._jsc.hadoopConfiguration()), to_path


def land_hours(events: DataFrame, landing_dir: str) -> list[str]:
    """Write events to `YYYY-MM-DD-H.json.gz` by the hour of `created_at`; returns the names.

    An hour is one file, so its events go to one task; hours are spread over all tasks. Files
    are written in a folder of their own and then take their names, replacing an earlier
    delivery of the same hour, so a write that fails leaves the landing zone as it was. The
    driver handles names only. Events without a time have no file and are an error.
    """
    spark = events.sparkSession
    name = hourly_file_name(F.to_date("created_at"), F.hour("created_at"))
    unknown = F.raise_error(F.lit("an event has no time"))
    named = events.withColumn(_FILE, F.when(F.col("created_at").isNull(), unknown).otherwise(name))
    made = f"{landing_dir.rstrip('/')}/_landing-{uuid.uuid4().hex}"
    (
        named.repartition(_FILE)
        .write.partitionBy(_FILE)
        .option("compression", "gzip")
        .option("timestampFormat", TIMES)
        .option("maxRecordsPerFile", 0)
        .json(made)
    )
    system, to_path = file_system(spark, landing_dir)
    landed = []
    for status in system.listStatus(to_path(made)):
        folder = status.getPath()
        if not folder.getName().startswith(f"{_FILE}="):
            continue
        (part,) = [s.getPath() for s in system.listStatus(folder) if s.getPath().getName().startswith("part-")]
        target = to_path(f"{landing_dir.rstrip('/')}/{folder.getName().split('=', 1)[1]}")
        system.delete(target, False)
        if not system.rename(part, target):
            raise OSError(f"{part} could not be renamed to {target}")
        landed.append(target.getName())
    system.delete(to_path(made), True)
    return sorted(landed)
