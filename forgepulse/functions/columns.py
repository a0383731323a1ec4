"""Column expressions: days, labels and file names."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LABEL_FORMAT = "MMM dd"


def event_day(df: DataFrame) -> Column:
    """The UTC day of each event; tables partitioned by day have it as a column."""
    return F.col("event_date") if "event_date" in df.columns else F.to_date("created_at")


def day_part(text: Column) -> Column:
    """The day of an ISO day or timestamp given as text."""
    return F.to_date(F.split_part(text, F.lit("T"), F.lit(1)))


def each_day(start: Column | date, end: Column | date) -> Column:
    """One row per day of a closed range; none when it is reversed or unknown."""
    first = F.lit(start) if isinstance(start, date) else start
    last = F.lit(end) if isinstance(end, date) else end
    return F.explode(F.when(first <= last, F.sequence(first, last)))


def calendar(spark: SparkSession, start: date, end: date, name: str = "day") -> DataFrame:
    """One row per day of a closed range."""
    return spark.range(0, 1, 1, 1).select(each_day(start, end).alias(name))


def day_label(day: Column) -> Column:
    return F.date_format(day, LABEL_FORMAT)


def short_name(name: Column) -> Column:
    """What follows the first slash; the whole name when there is none."""
    slash = F.instr(name, "/")
    return F.when(slash > 0, F.substring(name, slash + 1, F.length(name))).otherwise(name)


def hourly_file_name(day: Column, hour: Column) -> Column:
    """Name of an hourly event file; the hour is not padded."""
    return F.format_string("%s-%d.json.gz", day.cast("string"), hour)


def file_day(path: Column) -> Column:
    """The day in an hourly file's name, null for other names."""
    text = F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})-\d{1,2}\.json\.gz$", 1)
    return F.to_date(F.nullif(text, F.lit("")))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def lake_day_path(root: str, day: Column) -> Column:
    """Directory of one day in the lake."""
    return F.format_string(
        f"{root.rstrip('/').replace('%', '%%')}/year=%d/month=%02d/day=%02d",
        F.year(day), F.month(day), F.dayofmonth(day),
    )
