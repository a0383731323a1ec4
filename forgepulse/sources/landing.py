"""Audit of the landing directory: which hourly files are there, and are they sound."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgepulse.config import HOURS_PER_DAY, MIN_FILE_BYTES
from forgepulse.functions.columns import base_name, calendar, file_day, hourly_file_name
from forgepulse.session import settings
from forgepulse.sources.ndjson import FILES, files_of

WARN, ERROR = "warn", "error"


class LandingError(RuntimeError):
    """The landed files cannot be loaded as they are."""


def expected_files(spark: SparkSession, start: date, end: date) -> DataFrame:
    """(file_date, hour, filename) for every hour of the range."""
    hours = F.explode(F.sequence(F.lit(0), F.lit(HOURS_PER_DAY - 1)))
    days = calendar(spark, start, end, "file_date")
    return days.select("file_date", hours.alias("hour")).withColumn(
        "filename", hourly_file_name(F.col("file_date"), F.col("hour"))
    )


def landed_files(
    spark: SparkSession, landing_dir: str, days: Sequence[date] | None = None
) -> DataFrame:
    """(filename, length, time, path) of the files present; contents are not read.

    A scan leaves files without a byte out, so their names come from the scan's own list of
    files, which the driver holds in any case; their time is unknown.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", files_of(days))
        .load(landing_dir)
    )
    filled = listing.select(
        base_name(F.col("path")).alias("filename"), "length",
        F.col("modificationTime").alias("time"), "path",
    )
    names = sorted({path.rpartition("/")[2] for path in listing.inputFiles()})
    root = landing_dir.rstrip("/")
    every = spark.createDataFrame([(n, f"{root}/{n}") for n in names], "filename string, place string")
    return every.join(filled, "filename", "left").select(
        "filename", F.coalesce("length", F.lit(0)).cast("bigint").alias("length"), "time",
        F.coalesce("path", "place").alias("path"),
    )


def missing_files(expected: DataFrame, landed: DataFrame) -> DataFrame:
    return expected.join(landed.select("filename"), "filename", "left_anti").select("filename")


def files_outside(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Landed files that no hour of the range asks for."""
    return landed.join(expected.select("filename"), "filename", "left_anti").select(
        *landed.columns
    )


def undersized_files(landed: DataFrame, min_bytes: int = MIN_FILE_BYTES) -> DataFrame:
    return landed.where(F.col("length") < min_bytes)


def incomplete_days(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """(file_date, files) for the days that do not have all their hourly files."""
    per_day = landed.groupBy(file_day(F.col("filename")).alias("file_date")).agg(
        F.count("*").alias("files")
    )
    return (
        expected.select("file_date")
        .distinct()
        .join(per_day, "file_date", "left")
        .select("file_date", F.coalesce("files", F.lit(0)).cast("bigint").alias("files"))
        .where(F.col("files") != HOURS_PER_DAY)
    )


def missing_report(expected: DataFrame, landed: DataFrame, shown: int = 10) -> DataFrame:
    """(filename, files): the first missing names in order, then the number left over."""
    by_name = Window.orderBy("filename")  # a row per expected hour at most
    place = F.when(F.row_number().over(by_name) <= shown, F.col("filename"))
    return (
        missing_files(expected, landed)
        .select(place.alias("filename"))
        .groupBy("filename")
        .agg(F.count("*").alias("files"))
    )


def audit(
    expected: DataFrame, landed: DataFrame, min_bytes: int = MIN_FILE_BYTES
) -> DataFrame:
    """(severity, issue, filename): a missing hour is a warning, a small file an error."""
    missing = missing_files(expected, landed).select(
        F.lit(WARN).alias("severity"), F.lit("missing").alias("issue"), "filename"
    )
    small = undersized_files(landed, min_bytes).select(
        F.lit(ERROR).alias("severity"), F.lit("too small").alias("issue"), "filename"
    )
    nothing = (
        landed.agg(F.count("*").alias("files"))
        .where("files = 0")
        .select(
            F.lit(ERROR).alias("severity"),
            F.lit("nothing landed").alias("issue"),
            F.lit(None).cast("string").alias("filename"),
        )
    )
    return missing.unionByName(small).unionByName(nothing)


VERDICTS = "filename string, length bigint, lines bigint, sound boolean, problem string"


def file_verdicts(
    spark: SparkSession, landing_dir: str, days: Sequence[date] | None = None
) -> DataFrame:
    """(filename, length, lines, sound, problem) of every landed file, read to its trailer.

    Files are listed by Spark, dealt out one to a task as far as there are tasks, and streamed
    through gzip a megabyte at a time: the trailer's checksum and length must agree, and
    nothing may be missing or follow. A file that is not sound has no lines and says why; one
    damaged file does not hide the next. No built-in function tells a file that breaks off from
    one that ends, which is why this is a function in Python.
    """

    def judge(batches):
        import zlib

        import pandas as pd
        from pyarrow import fs

        def stream(path):
            if path.startswith("file:") and not path.startswith("file://"):
                path = "file://" + path[5:]
            system, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
            return system.open_input_stream(inner, compression=None)

        def lines_of(path):
            lines, last, members = 0, b"\n", 0
            unpacker = zlib.decompressobj(wbits=31)
            with stream(path) as file:
                while data := file.read(1 << 20):
                    while data:
                        if unpacker.eof:  # another member, as gzip allows
                            unpacker = zlib.decompressobj(wbits=31)
                        text = unpacker.decompress(data, 8 << 20)
                        data = unpacker.unconsumed_tail or unpacker.unused_data
                        members += unpacker.eof
                        lines += text.count(b"\n")
                        last = text[-1:] or last
            if not members or not unpacker.eof:
                raise zlib.error("breaks off" if members or lines else "empty or breaks off")
            return lines + (last != b"\n")

        for batch in batches:
            rows = []
            for path, length in zip(batch["path"], batch["length"], strict=True):
                name = path.rpartition("/")[2]
                try:
                    rows.append((name, length, lines_of(path), True, None))
                except (zlib.error, EOFError) as error:
                    rows.append((name, length, None, False, str(error)))
            out = pd.DataFrame(rows, columns=["filename", "length", "lines", "sound", "problem"])
            yield out.astype({"lines": "Int64"})

    files = landed_files(spark, landing_dir, days).select("path", "length")
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "16"}):
        return files.repartition("path").mapInPandas(judge, VERDICTS)


def require_readable(
    spark: SparkSession, landing_dir: str, days: Sequence[date] | None = None
) -> int:
    """Decompress the landed files to their end and count the lines; the error names the
    first file that is damaged."""
    with settings(spark, {"spark.sql.files.ignoreCorruptFiles": "false"}):
        return spark.read.option("pathGlobFilter", files_of(days)).text(landing_dir).count()


def require_sound(issues: DataFrame, shown: int = 10) -> list[str]:
    """Raise if there is an error; otherwise name the first hours that have not landed.

    Only counts and `shown` names are fetched, however many files have an issue.
    """
    counts = issues.groupBy("severity", "issue").agg(
        F.count("*").alias("files"), F.min("filename").alias("first")
    ).collect()
    errors = [
        f"{row.issue}: {row.files} file(s), first {row.first}" if row.first else row.issue
        for row in counts
        if row.severity == ERROR
    ]
    if errors:
        raise LandingError("; ".join(errors))
    if not counts:
        return []
    names = issues.orderBy("filename").limit(shown).collect()
    total = sum(row.files for row in counts)
    lines = [f"not landed: {row.filename}" for row in names]
    return lines + [f"hours not landed beyond these: {total - shown}"] * (total > shown)
