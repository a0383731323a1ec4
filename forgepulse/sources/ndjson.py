"""Scan of hourly, gzipped, newline-delimited JSON event files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgepulse import schemas
from forgepulse.config import HOURS_PER_DAY
from forgepulse.functions.columns import file_day
from forgepulse.session import settings

FILES = "*.json.gz"
CORRUPT = "_corrupt_record"


def files_of(days: Sequence[date] | None) -> str:
    """Pattern for the hourly files of some days, or for every file.

    Of given days only the names of their 24 hours match: whatever else lies beside
    them has not been audited and is not read.
    """
    if days is None:
        return FILES
    hours = ",".join(map(str, range(HOURS_PER_DAY)))
    return "{" + ",".join(d.isoformat() for d in days) + "}-{" + hours + "}.json.gz"


def _reader(spark: SparkSession, days: Sequence[date] | None, malformed: str):
    return (
        spark.read.option("pathGlobFilter", files_of(days))
        .option("mode", malformed)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def _file_columns() -> list[Column]:
    """The file a row came from, its day, and what tells one delivery of it from another."""
    path = F.col("_metadata.file_path")
    return [
        path.alias("filename"),
        F.col("_metadata.file_size").alias("file_bytes"),
        F.col("_metadata.file_modification_time").alias("file_time"),
        file_day(path).alias("file_date"),
    ]


def _with_file(df: DataFrame) -> DataFrame:
    return df.select("*", *_file_columns())


def scan_ndjson(
    spark: SparkSession,
    landing_dir: str,
    days: Sequence[date] | None = None,
    malformed: str = "FAILFAST",
) -> DataFrame:
    """Raw events with the file each came from and that file's day, for the files of the
    given days or for all.

    The schema is fixed, so nothing is read twice, a field missing from a file is null
    and fields of any shape inside `payload` are kept as text. A malformed line stops
    the read, or lands in `_corrupt_record` with `malformed="PERMISSIVE"`.
    """
    schema = schemas.RAW
    if malformed == "PERMISSIVE":
        schema += f", {CORRUPT} STRING"
    return _with_file(_reader(spark, days, malformed).schema(schema).json(landing_dir))


def scan_ndjson_variant(
    spark: SparkSession, landing_dir: str, days: Sequence[date] | None = None
) -> DataFrame:
    """As `scan_ndjson`, with the whole line kept as a VARIANT in `body`.

    No field is lost, whatever the files hold, and the raw columns are read out of it.
    """
    lines = _reader(spark, days, "FAILFAST").option("singleVariantColumn", "body").json(
        landing_dir
    )
    fields = T.StructType.fromDDL(schemas.RAW)
    columns = [
        F.variant_get("body", f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
        if f.name != "payload"
        else F.to_json(F.variant_get("body", "$.payload", "variant")).alias("payload")
        for f in fields
    ]
    return lines.select(*columns, "body", *_file_columns())


def scan_ndjson_inferred(
    spark: SparkSession, landing_dir: str, days: Sequence[date] | None = None
) -> DataFrame:
    """As `scan_ndjson`, with the schema found by reading every line first.

    Costs a second read of the files. Payload keys may differ only in case, which tables
    cannot hold: they are told apart while reading, and the payload becomes text again.
    Raw columns no file has are added as nulls.
    """
    with settings(spark, {"spark.sql.caseSensitive": "true"}):
        events = (
            _reader(spark, days, "FAILFAST")
            .option("samplingRatio", 1.0)
            .option("inferTimestamp", "true")
            .json(landing_dir)
        )
        found = {f.name: f.dataType for f in events.schema}
        columns = [
            F.to_json(name).alias(name)
            if name == "payload" and isinstance(kind, T.StructType)
            else F.col(name)
            for name, kind in found.items()
        ]
        absent = [f for f in T.StructType.fromDDL(schemas.RAW) if f.name not in found]
        return events.select(
            *columns,
            *(F.lit(None).cast(f.dataType).alias(f.name) for f in absent),
            *_file_columns(),
        )


def columns_of(scan: str) -> set[str] | None:
    """The columns of a scan whose schema does not depend on the files."""
    if scan == "inferred":
        return None
    known = {*T.StructType.fromDDL(schemas.RAW).names, "filename", "file_bytes", "file_time", "file_date"}
    return known | {"body"} if scan == "variant" else known


SCANS = {"fixed": scan_ndjson, "variant": scan_ndjson_variant, "inferred": scan_ndjson_inferred}
