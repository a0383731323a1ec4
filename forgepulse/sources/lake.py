"""The Parquet lake, one directory per day: year=2026/month=03/day=01."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse.config import DayRange
from forgepulse.functions.columns import lake_day_path


def lake_day_dir(day: date) -> str:
    return f"year={day.year}/month={day.month:02d}/day={day.day:02d}"


def lake_day_paths(days: DataFrame, root: str) -> DataFrame:
    """The lake directory of every day, as rows (day, path)."""
    return days.select("day", lake_day_path(root, F.col("day")).alias("path"))


def joined_paths(paths: DataFrame, column: str = "path") -> DataFrame:
    """All paths in one text, in order, each quoted and separated by a comma.

    For the days of a calendar only: the text has one entry per row.
    """
    quoted = F.concat(F.lit("'"), F.col(column), F.lit("/part-*'"))
    ordered = F.array_sort(F.collect_list(quoted))
    return paths.agg(F.array_join(ordered, ", ").alias("uri_list"))


def scan_days(spark: SparkSession, root: str, days: Sequence[date]) -> DataFrame:
    """Raw events exported for the given days, with year, month and day columns.

    Only the directories of those days are listed, however long the lake's history;
    days without a directory are skipped, and it is an error when none exists. Columns
    that only some of the days have are null for the others.
    """
    dirs = ",".join(map(lake_day_dir, days))
    reader = spark.read.option("basePath", root).option("mergeSchema", "true")
    return reader.parquet(f"{root.rstrip('/')}/{{{dirs}}}")


def scan_lake_days(spark: SparkSession, root: str, start: date, end: date) -> DataFrame:
    """Raw events exported for a closed range of days."""
    day = F.make_date("year", "month", "day")
    return (
        scan_days(spark, root, DayRange(start, end).days)
        .where(day.between(F.lit(start), F.lit(end)))
        .drop("year", "month", "day")
    )


def scan_source_day(spark: SparkSession, prefix: str, day: date) -> DataFrame:
    """One day of a source kept as one table per day, named by prefix and date."""
    return spark.table(f"{prefix}{day:%Y%m%d}")
