"""Delete later copies of line runs that repeat, within and across documents.

The lines of all documents form sequences of line ids. Their suffixes are ranked by
prefix doubling, as in the construction of a suffix array: the rank of a suffix by its
first 2h lines is the rank of the pair (rank by h lines, rank of the suffix h lines on).
Suffixes of equal rank form an interval of the suffix array whose longest common prefix
is at least that long. Suffixes whose prefix is found nowhere else leave the array as
soon as that is known, which is after the first step for nearly all of them.

Whether a run may be deleted is known once it holds `min_words` words, so a suffix is
compared up to the line that completes them: for a window of l lines, h <= l < 2h, the
pair (rank at i, rank at i + l - h) names its interval. In each interval the first
position stays and the windows of all others go; windows that overlap or touch are one
run. Its last lines stay where they hold fewer words than that after the last window's
start. With `whole`, the same is done for the lines in reverse, whose windows end at each
line, and together they cover the maximal repeated run. No line disappears from the corpus altogether, because the
first occurrence of each line is never a later copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgepulse.llm.common import ROW, keyed, let, settled, shielded, stored, words

MIN_WORDS = 25

# Ranks within a group are counted in two steps, by blocks of this many ranks (2^16), so
# that a line followed by very many different lines is not numbered by one task.
BLOCK_BITS = 16


def text_lines(docs: DataFrame) -> DataFrame:
    """Lines with a word: (row, pos, line_no, line), pos counting only these."""
    numbered = F.transform(
        F.split(F.coalesce("text", F.lit("")), "\n", -1),
        lambda line, i: F.struct(i.alias("line_no"), line.alias("line")),
    )
    with_words = F.filter(numbered, lambda x: x["line"].rlike(r"[^\x20\x09-\x0D]"))
    # Outer, because Spark otherwise computes the array a second time to filter by its size.
    entries = docs.select(ROW, F.posexplode_outer(with_words).alias("pos", "entry"))
    return entries.where("pos IS NOT NULL").select(ROW, "pos", "entry.line_no", "entry.line")


def ranked(counts: DataFrame, group: list[str], block: Column, order: list[str]) -> DataFrame:
    """Add `offset`: how many suffixes of the group come before this row's."""
    blocked = counts.withColumn("block", block)
    within = Window.partitionBy(*group, "block").orderBy(*order)
    before = Window.partitionBy(*group).orderBy("block")
    starts = (
        blocked.groupBy(*group, "block")
        .agg(F.sum("n").alias("size"))
        .withColumn("start", F.sum("size").over(before) - F.col("size"))
        .drop("size")
    )
    return (
        blocked.withColumn("inside", F.sum("n").over(within) - F.col("n"))
        .join(starts, [*group, "block"])
        .withColumn("offset", F.col("start") + F.col("inside"))
        .drop("block", "start", "inside")
    )


def line_ranks(lines: DataFrame) -> DataFrame:
    """Repeated lines with their rank by one line: (row, pos, line_no, n_words, rank)."""
    # Two hashes with different seeds: 128 bits tell lines apart.
    keys = [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2")]
    coded = lines.select(ROW, "pos", "line_no", F.size(words(F.col("line"))).alias("n_words"), *keys)
    counts = coded.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
    ranks = ranked(
        counts.withColumn("all", F.lit(0)), ["all"], F.shiftright("h1", 64 - BLOCK_BITS), ["h1", "h2"]
    ).select("h1", "h2", (F.col("offset") + 1).alias("rank"))
    return coded.join(ranks, ["h1", "h2"]).drop("h1", "h2")


def decisive_windows(suffixes: DataFrame, min_words: int) -> DataFrame:
    """Per suffix, the fewest lines that hold `min_words` words, if they all are repeated.

    `before` counts words ahead of a line, so the lines that start within the next
    `min_words` words are a range of it.
    """
    in_order = Window.partitionBy(ROW).orderBy("pos")
    ahead = Window.partitionBy(ROW).orderBy("before").rangeBetween(0, min_words - 1)
    return (
        suffixes.withColumn("after", F.sum("n_words").over(in_order))
        .withColumn("before", F.col("after") - F.col("n_words"))
        .select(
            ROW, "pos", "line_no", "rank", "before",
            F.count("*").over(ahead).alias("lines"),
            F.max("pos").over(ahead).alias("last_pos"),
            F.max("line_no").over(ahead).alias("last_line"),
            F.max("after").over(ahead).alias("reached"),
        )
        .withColumn(
            "window",
            F.when(
                (F.col("last_pos") - F.col("pos") + 1 == F.col("lines"))
                & (F.col("reached") - F.col("before") >= min_words),
                F.col("lines"),
            ),
        )
        .select(ROW, "pos", "line_no", "rank", "window", "last_line")
    )


def later_copies(decided: DataFrame, mirrored: bool = False) -> DataFrame:
    """Windows of suffixes that are not the first of their interval."""
    place = F.struct(ROW, (-F.col("pos") if mirrored else F.col("pos")).alias("pos"))
    key = ["rank", "tail", "window"]
    intervals = decided.groupBy(*key).agg(F.min(place).alias("first"), F.count("*").alias("n"))
    return (
        decided.join(intervals.where("n > 1"), key)
        .where(place > F.col("first"))
        .select(ROW, F.col("line_no").alias("start"), F.col("last_line").alias("end"))
    )


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, whole: bool = False) -> DataFrame:
    """Runs of lines to delete: (row, start, end), line numbers from 0, both included.

    Takes the output of `keyed`. A run holds at least `min_words` words and repeats one
    that comes earlier in (doc_id, line) order. Lines without a word do not count as
    lines of a run, but go with it when they lie inside. With `whole`, runs reach to
    the last line they repeat.
    """
    lines = line_ranks(text_lines(docs))
    if not whole:
        return merged(window_copies(lines, min_words))
    lines = stored(lines, "lines")
    mirrored = lines.withColumn("pos", -F.col("pos")).withColumn("line_no", -F.col("line_no"))
    backward = window_copies(mirrored, min_words, mirrored=True)
    backward = backward.select(ROW, (-F.col("end")).alias("start"), (-F.col("start")).alias("end"))
    return merged(window_copies(lines, min_words).unionByName(backward))


def window_copies(lines: DataFrame, min_words: int, mirrored: bool = False) -> DataFrame:
    """Windows of `min_words` words that are later copies: (row, start, end).

    `mirrored` lines have their numbers negated, and still the first copy stays.
    """
    suffixes = stored(decisive_windows(lines, min_words), "suffixes")
    longest = suffixes.agg(F.max("window")).first()[0] or 0
    windows = suffixes.where("window IS NOT NULL").drop("rank")
    ranks = suffixes.select(ROW, "pos", "rank")
    found = []
    h = 1
    while h <= longest:
        tails = ranks.select(ROW, F.col("pos").alias("tail_pos"), F.col("rank").alias("tail"))
        decided = (
            windows.where(F.col("window").between(h, 2 * h - 1))
            .join(ranks, [ROW, "pos"])
            .withColumn("tail_pos", F.col("pos") + F.col("window") - h)
            .join(tails, [ROW, "tail_pos"])
        )
        found.append(stored(later_copies(decided, mirrored), "copies"))
        if 2 * h <= longest:
            ranks = doubled(ranks, windows.where(F.col("window") >= 2 * h), h)
        h *= 2
    if not found:
        nothing = suffixes.where("false")
        return nothing.select(ROW, F.col("line_no").alias("start"), F.col("last_line").alias("end"))
    copies = found[0]
    for more in found[1:]:
        copies = copies.unionByName(more)
    return copies


def doubled(ranks: DataFrame, windows: DataFrame, h: int) -> DataFrame:
    """Ranks by 2h lines, for suffixes inside a window that is still open."""
    ahead = Window.partitionBy(ROW).orderBy("pos").rangeBetween(h, h)
    reach = windows.select(ROW, F.explode(F.sequence("pos", F.col("pos") + F.col("window") - 1)).alias("pos"))
    open_ranks = ranks.join(reach, [ROW, "pos"], "left_semi")
    pairs = open_ranks.withColumn("next", F.max("rank").over(ahead)).where("next IS NOT NULL")
    counts = pairs.groupBy("rank", "next").agg(F.count("*").alias("n")).where("n > 1")
    block = F.shiftright("next", BLOCK_BITS)
    numbered = ranked(counts, ["rank"], block, ["next"]).select("rank", "next", "offset")
    return stored(
        pairs.join(numbered, ["rank", "next"]).select(
            ROW, "pos", (F.col("rank") + F.col("offset")).alias("rank")
        ),
        "ranks",
    )


def merged(windows: DataFrame) -> DataFrame:
    """Windows that overlap or touch, as one run."""
    earlier = Window.partitionBy(ROW).orderBy("start", "end")
    reached = F.max("end").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("start") > F.coalesce(reached, F.lit(-2)) + 1, 1).otherwise(0)
    return (
        windows.withColumn("fresh", fresh)
        .withColumn("run", F.sum("fresh").over(earlier))
        .groupBy(ROW, "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .drop("run")
    )


def without_runs(text: Column, runs: Column) -> Column:
    """The text's lines outside the runs (sorted, apart); null where none is left."""

    def kept(lines: Column) -> Column:
        n = F.size(runs)
        start = lambda k: F.when(k == 0, 0).otherwise(F.get(runs, k - 1)["end"] + 1)
        end = lambda k: F.when(k == n, F.size(lines)).otherwise(F.get(runs, k)["start"])
        between = lambda k: F.slice(
            lines, start(k) + 1, F.greatest(end(k) - start(k), F.lit(0))
        )
        return F.flatten(F.transform(F.sequence(F.lit(0), n), between))

    joined = lambda rest: F.when(F.size(rest) > 0, F.array_join(rest, "\n"))
    return let(let(F.split(text, "\n", -1), kept), joined)


@shielded
def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, whole: bool = False) -> DataFrame:
    """All rows and columns of `docs`, with later copies of repeated line runs deleted.

    Adds `runs` (array of (start, end) of deleted lines, empty where nothing was) and
    `clean_text` (null where the text is null or no line is left). `whole` is that of
    `repeated_runs`.

    A null or empty text has no runs; a null text stays null, an empty one empty. Rows
    that share a doc_id are told apart by their text's order, and a null doc_id sorts
    first. Repeated rows are copies like any others. Other columns are passed through,
    whatever their names, except for `runs` and `clean_text`, which are replaced.
    """
    rows = keyed(docs.drop("runs", "clean_text"))
    runs = repeated_runs(rows.select(ROW, "text"), min_words, whole)
    by_doc = runs.groupBy(ROW).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))
    nothing = F.array().cast("array<struct<start:int,end:int>>")
    joined = rows.join(by_doc.hint("merge"), ROW, "left").withColumn("runs", F.coalesce("runs", nothing))
    whole = F.size("runs") == 0
    clean = F.when(whole, F.col("text")).otherwise(without_runs(F.col("text"), F.col("runs")))
    return settled(joined, {"clean_text": clean}).drop(ROW)
