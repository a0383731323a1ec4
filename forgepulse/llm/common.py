"""What the operators share: words, row keys and tables written between steps."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forgepulse.session import scratch_path, settings

# Space and the five ASCII controls from tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ROW = "__row"
NODE = "__node"


def words(text: Column, separators: str = SPACES) -> Column:
    """The words of a text, in order; none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, however often `body` names it.

    Inside the lambda of another function an expression is computed for every element.
    """
    return F.get(F.transform(F.array(value), body), 0)


def settled(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Add or replace columns that later filters may look at.

    Spark moves a filter below the projection it looks at and puts the columns' own
    expressions in it, where those inside a lambda are computed for every element. It
    does not move a filter below a generator, which here makes one row of each.
    """
    rest = [c for c in df.columns if c not in new]
    row = F.struct(*(c.alias(name) for name, c in new.items()))
    return df.select(*rest, F.explode_outer(F.array(row)).alias("__new")).select(*rest, "__new.*")


def shielded(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let an operator's first table have columns with dots, or names the operator uses inside.

    Columns with a dot or backtick, or that start with two underscores, have another name
    while the operator works.
    """

    @wraps(operator)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        odd = {c for c in docs.columns if "." in c or "`" in c or c.startswith("__")}
        if not odd:
            return operator(docs, *args, **options)
        plain = {c: f"kept_{uuid.uuid4().hex}" for c in odd}
        given = {name: c for c, name in plain.items()}
        out = operator(docs.toDF(*(plain.get(c, c) for c in docs.columns)), *args, **options)
        return out.toDF(*(given.get(c, c) for c in out.columns))

    return run


def keyed(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Add a key that tells rows apart even where ids repeat or are null.

    The key is (id, copy). Copies are numbered in order of their text, and only where
    an id occurs more than once, so tables with unique ids are not shuffled for it.
    """
    ids = docs.select(F.col(id_column).alias("__id"))
    if ids.groupBy("__id").count().where("count > 1").isEmpty():
        copy = F.lit(0)
    else:
        copy = F.row_number().over(Window.partitionBy(id_column).orderBy("text")) - 1
    return docs.withColumn(ROW, F.struct(F.col(id_column).alias("id"), copy.alias("copy")))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the folder the cluster shares and read it back.

    Later steps then start from files that every executor can read, so a lost executor
    costs a task and not the lineage behind it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_nodes(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Add `__node`, a number of its own for each row, and say whether it is the doc_id.

    It is where ids are unique and never null. Otherwise the rows are written with
    numbers in order of (doc_id, text), so that the numbers are the same in every task.
    """
    ids = docs.select(F.col("doc_id").alias("node"))
    odd = ids.groupBy("node").count().where("count > 1 OR node IS NULL")
    if odd.isEmpty():
        return docs.withColumn(NODE, F.col("doc_id")), True
    numbered = docs.orderBy("doc_id", "text").withColumn(NODE, F.monotonically_increasing_id())
    return stored(numbered, "nodes"), False


@contextmanager
def python_batches(spark: SparkSession, rows: int = 200) -> Iterator[None]:
    """Hand few rows at a time to Python, because texts can be very long."""
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}):
        yield


@contextmanager
def uncollected() -> Iterator[None]:
    """Without garbage collections, for code that makes many lists and no cycles: each of them
    would go through all that a worker remembers."""
    enabled = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if enabled:
            gc.enable()


# At most this many rows are broadcast: with an id and a flag, some 50 MB.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the table, counted, is small enough; else leave it to Spark."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def ship(spark: SparkSession) -> None:
    """Hand the package to the workers, as --py-files does, once per application."""
    context = spark.sparkContext
    if any("forgepulse-" in name for name in context._python_includes):
        return
    package = Path(__file__).parents[1]
    path = Path(tempfile.mkdtemp()) / f"forgepulse-{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(path))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
