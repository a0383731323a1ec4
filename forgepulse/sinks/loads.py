"""Ways to load a table: rebuild, create, replace days, upsert days, export, expire.

The built-in catalog has no MERGE or DELETE, so days are replaced as partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgepulse.session import settings
from forgepulse.sources.lake import lake_day_dir

DAY = "event_date"
CLUSTER_BUCKETS = 1024
DAYS_PER_LOAD = 31

# Shuffled bytes per task that writes, at most and at least; sorted columns make a file
# of about half that. In between, work is spread over all cores.
WRITE_BYTES = "128m"
SMALLEST_WRITE_BYTES = "24m"


def _sized() -> dict[str, str]:
    return {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": WRITE_BYTES,
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": SMALLEST_WRITE_BYTES,
    }


def _dynamic() -> dict[str, str]:
    return {**_sized(), "spark.sql.sources.partitionOverwriteMode": "dynamic"}


def _in_place() -> dict[str, str]:
    """For rows written where they are: a task that meets a few days keeps one file open
    for each, which saves sorting wide rows by day."""
    return {**_dynamic(), "spark.sql.maxConcurrentOutputFileWriters": "8"}


class EmptyDay(RuntimeError):
    """Days to be replaced have no new rows; `loaded` are the days that had."""

    def __init__(self, message: str, loaded: Sequence[date] = ()):
        super().__init__(message)
        self.loaded = list(loaded)


class UnknownColumns(ValueError):
    """Rows have columns that the table has not."""


def spread(df: DataFrame, cluster_by: Sequence[str], partition_by: str = DAY) -> DataFrame:
    """Rows in tasks of even size, each with few days and values of the cluster column.

    Rows are spread by day and by a bucket of the first cluster column, and adaptive
    execution splits what is too big for a file (a day or repository with a third of
    all rows) and merges what is too small.
    """
    if not cluster_by:
        return df.hint("rebalance", partition_by)
    bucket = F.pmod(F.xxhash64(cluster_by[0]), F.lit(CLUSTER_BUCKETS)).cast("int")
    return (
        df.withColumn("_bucket", bucket)
        .hint("rebalance", partition_by, "_bucket")
        .drop("_bucket")
    )


def clustered(df: DataFrame, cluster_by: Sequence[str], partition_by: str = DAY) -> DataFrame:
    """Spread rows, sorted so that a filter on the cluster columns skips most pages."""
    return spread(df, cluster_by, partition_by).sortWithinPartitions(partition_by, *cluster_by)


def full_rebuild(
    df: DataFrame,
    table: str,
    partition_by: str | None = None,
    cluster_by: Sequence[str] | None = (),
) -> None:
    """Replace the whole table with the rows of `df`; if that fails the old rows stay.

    A table in one piece is written beside the old one and then takes its name. Of a
    table with partitions the written ones are swapped in by the commit of the write,
    and those without new rows are dropped after it.

    `cluster_by=None` writes rows where they are, without a shuffle or a sort.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    sized = _in_place() if cluster_by is None else _dynamic()
    if not partition_by:
        _swapped(df, table, exists, sized)
        return
    laid_out = df if cluster_by is None else spread(df, cluster_by, partition_by)
    seen, old = Observation(), []
    if exists and set(spark.table(table).columns) == set(df.columns):
        old = partition_days(spark, table)
        laid_out = laid_out.observe(seen, *_days_with_rows(old, partition_by))
    elif exists:
        # Other columns: all rows are made beside the old ones before these go.
        beside = f"{table}__new_{uuid.uuid4().hex[:8]}"
        _swapped(df, beside, False, sized)
        laid_out, exists = spark.table(beside), False
        if cluster_by is not None:
            laid_out = spread(laid_out, cluster_by, partition_by)
    else:
        beside = None
    if cluster_by is not None:
        laid_out = laid_out.sortWithinPartitions(partition_by, *cluster_by)
    with settings(spark, sized):
        if exists:
            _overwrite_days(laid_out, table)
            for day in _without_rows(seen, old):
                drop_day(spark, table, day, partition_by)
            return
        laid_out.write.mode("overwrite").format("parquet").partitionBy(partition_by).saveAsTable(table)
    if beside:
        spark.sql(f"DROP TABLE {beside}")


def _swapped(df: DataFrame, table: str, exists: bool, sized: dict[str, str]) -> None:
    """Write a table without partitions under another name, then rename it."""
    spark = df.sparkSession
    mark = uuid.uuid4().hex[:8]
    fresh, former = f"{table}__fresh_{mark}", f"{table}__former_{mark}"
    try:
        with settings(spark, sized):
            df.write.format("parquet").saveAsTable(fresh)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    if exists:
        spark.sql(f"ALTER TABLE {table} RENAME TO {former}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    if exists:
        spark.sql(f"DROP TABLE {former}")


DAYS_PER_METRIC = 62


def _days_with_rows(days: Sequence[date | None], day_column: str) -> list[Column]:
    """Metrics that tell which of the days have rows: a bit for each."""
    none = F.count(F.when(F.col(day_column).isNull(), 1)).alias("none")
    metrics = [none]
    for k, first in enumerate(_blocks(days)):
        offset = F.datediff(F.col(day_column), F.lit(first))
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), offset)
        inside = offset.between(0, DAYS_PER_METRIC - 1)
        metrics.append(F.bit_or(F.when(inside, bit).otherwise(0)).alias(f"block{k}"))
    return metrics


def _blocks(days: Sequence[date | None]) -> list[date]:
    firsts: list[date] = []
    for day in sorted(d for d in days if d is not None):
        if not firsts or (day - firsts[-1]).days >= DAYS_PER_METRIC:
            firsts.append(day)
    return firsts


def _without_rows(seen: Observation, days: Sequence[date | None]) -> list[date | None]:
    metrics = seen.get
    blocks = _blocks(days)
    gone = [] if metrics.get("none") or None not in days else [None]
    for day in (d for d in days if d is not None):
        k = max(i for i, first in enumerate(blocks) if first <= day)
        if not (metrics.get(f"block{k}") or 0) >> (day - blocks[k]).days & 1:
            gone.append(day)
    return gone


def create_if_absent(
    spark: SparkSession, table: str, columns: str, partition_by: str = DAY
) -> None:
    """Create an empty table partitioned by day unless it exists; `columns` is DDL."""
    given = T.StructType.fromDDL(columns).names
    day = "" if partition_by in given else f", {partition_by} DATE"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}{day}) "
        f"USING parquet PARTITIONED BY ({partition_by})"
    )


def create_like(df: DataFrame, table: str, partition_by: str = DAY) -> None:
    """Create an empty table with the columns of `df` unless it exists."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        empty = df.where(F.lit(False))
        empty.write.format("parquet").partitionBy(partition_by).saveAsTable(table)


def drop_day(
    spark: SparkSession, table: str, day: date | None, partition_by: str = DAY
) -> None:
    value = "NULL" if day is None else f"DATE '{day}'"
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition_by} = {value})")


def _which_days(days: Sequence[date], day_column: str = DAY) -> Column:
    """One bit per day of a load that has rows, gathered while they are written."""
    offset = F.datediff(F.col(day_column), F.lit(days[0]))
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), offset))


def add_columns(df: DataFrame, table: str) -> None:
    """Give a table the columns of `df` that it lacks; its old rows have nulls there."""
    known = {c.lower() for c in df.sparkSession.table(table).columns}
    for field in df.schema:
        if field.name.lower() not in known:
            kind = field.dataType.simpleString()
            df.sparkSession.sql(f"ALTER TABLE {table} ADD COLUMNS (`{field.name}` {kind})")


def _overwrite_days(df: DataFrame, table: str) -> None:
    """Columns go by name; one the rows lack is null, one the table lacks is an error."""
    fields = df.sparkSession.table(table).schema
    given = {c.lower() for c in df.columns}
    unknown = given - {f.name.lower() for f in fields}
    if unknown:
        raise UnknownColumns(f"{table} has no column {', '.join(sorted(unknown))}")
    columns = [
        F.col(f.name) if f.name.lower() in given else F.lit(None).cast(f.dataType).alias(f.name)
        for f in fields
    ]
    df.select(*columns).write.insertInto(table, overwrite=True)


def month_parts(days: Sequence[date]) -> Iterator[list[date]]:
    """Days in order, split so that no load spans more than a month."""
    wanted = sorted(set(days))
    while wanted:
        part = [d for d in wanted if (d - wanted[0]).days < DAYS_PER_LOAD]
        yield part
        wanted = wanted[len(part):]


def _seen_days(seen: Observation, part: Sequence[date]) -> list[date]:
    bits = seen.get["days"] or 0
    return [d for d in part if bits >> (d - part[0]).days & 1]


def replace_days(
    df: DataFrame,
    table: str,
    days: Sequence[date],
    cluster_by: Sequence[str] | None = (),
    allow_empty: bool = False,
    partition_by: str = DAY,
    grow: bool = False,
) -> list[date]:
    """Make the given days of a table equal to those days of `df`; other days stay.

    Days are replaced in one job per month's worth. A day without new rows is an
    error after the others are written, and its old rows stay; with `allow_empty` its
    partition is dropped instead. Returns the days that had rows.

    `cluster_by=None` writes rows where they are, without a shuffle or a sort. With
    `grow`, columns that the table lacks are added to it; otherwise they are an error.
    """
    spark = df.sparkSession
    if grow:
        add_columns(df, table)
    loaded: list[date] = []
    for part in month_parts(days):
        seen = Observation()
        rows = df.where(F.col(partition_by).isin(part))
        if cluster_by is not None:
            rows = spread(rows, cluster_by, partition_by)
        # After the shuffle, where adaptive execution keeps it even if there is no row.
        rows = rows.observe(seen, _which_days(part, partition_by).alias("days"))
        if cluster_by is not None:
            rows = rows.sortWithinPartitions(partition_by, *cluster_by)
        with settings(spark, _in_place() if cluster_by is None else _dynamic()):
            _overwrite_days(rows, table)
        loaded += _seen_days(seen, part)
    empty = sorted(set(days) - set(loaded))
    if empty and not allow_empty:
        raise EmptyDay(f"{table}: no rows for {', '.join(map(str, empty))}", loaded)
    for day in empty:
        drop_day(spark, table, day, partition_by)
    return loaded


def merged(
    old: DataFrame, new: DataFrame, keys: Sequence[str], nulls_match: bool = True
) -> DataFrame:
    """Old rows, with those whose keys occur in `new` replaced by the new ones.

    Both sides are shuffled by key once, and each is computed once: of every key the
    rows of the newer side stay. With `nulls_match=False` a null key equals nothing,
    so such rows are kept from both sides.
    """
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    newest = F.max("_side").over(Window.partitionBy(*keys))
    keep = F.col("_side") == F.col("_newest")
    if not nulls_match:
        keep = keep | reduce(Column.__or__, (F.col(k).isNull() for k in keys))
    return both.withColumn("_newest", newest).where(keep).drop("_side", "_newest")


def upsert_days(
    new: DataFrame,
    table: str,
    keys: Sequence[str],
    days: Sequence[date],
    cluster_by: Sequence[str] = (),
    nulls_match: bool = True,
) -> None:
    """Update rows whose keys match and insert the others; rows not in `new` stay.

    Only the partitions of the given days are read and written.
    """
    spark = new.sparkSession
    touched = F.col(DAY).isin(list(days))
    old = spark.table(table).where(touched)
    rows = merged(old, new.where(touched), keys, nulls_match)
    with settings(spark, _dynamic()):
        _overwrite_days(clustered(rows, cluster_by), table)


def export_days(df: DataFrame, root: str, days: Sequence[date], day: Column | None = None) -> None:
    """Write raw events to the lake, replacing the directories of the given days.

    `day` tells the rows' day when there are several. A day without rows leaves a
    directory that holds no row.
    """
    spark = df.sparkSession
    if len(set(days)) > 1 and day is None:
        raise ValueError("several days need a day column")
    dated = df.withColumn(DAY, F.lit(days[0]) if day is None else day)
    names = {"year": "yyyy", "month": "MM", "day": "dd"}
    for part in month_parts(days):
        seen = Observation()
        rows = dated.where(F.col(DAY).isin(part)).observe(seen, _which_days(part).alias("days"))
        laid_out = rows.select(
            *df.columns, *(F.date_format(DAY, form).alias(name) for name, form in names.items())
        )
        with settings(spark, _in_place()):
            laid_out.write.mode("overwrite").partitionBy(*names).parquet(root)
        for empty in sorted(set(part) - set(_seen_days(seen, part))):
            df.where(F.lit(False)).write.mode("overwrite").parquet(
                f"{root.rstrip('/')}/{lake_day_dir(empty)}"
            )


def partition_days(spark: SparkSession, table: str) -> list[date | None]:
    """The days a table has partitions for: metadata only, one row per day."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    values = [row[0].split("=", 1)[1] for row in rows]
    return [None if v.startswith("__HIVE") or v == "null" else date.fromisoformat(v) for v in values]


def retain_days(
    spark: SparkSession, table: str, start: date, end: date, partition_by: str = DAY
) -> list[date]:
    """Drop the partitions of all days outside the closed range; returns those days."""
    stale = sorted(
        d for d in partition_days(spark, table) if d is not None and not start <= d <= end
    )
    for day in stale:
        drop_day(spark, table, day, partition_by)
    return stale
