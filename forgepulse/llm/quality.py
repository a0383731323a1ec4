"""Keep documents that resemble trusted ones more than they resemble the raw corpus.

Words and word pairs are hashed into buckets. Two multinomials over the buckets are
estimated, one from trusted documents and one from all; a document's score is the mean
of log(trusted / raw) over its n-grams. A few plain rules come first.

Smoothing is a share of the counts it is added to, and the least score to keep comes from
trusted documents that were left out of the counts. So a verdict depends on what the
corpus holds, not on how much of it there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.common import settled, shielded, small, stored, words

BUCKETS = 1 << 14
# Smoothing, as shares of the trusted and of the raw n-grams.
PRIOR_SHARE = 0.1
RAW_SHARE = 1 / 64
# One in `HELD_OUT` trusted documents is left out of the counts. At most `LOSS` of these
# score below the threshold, which is a multiple of 1 / `GRID`; with fewer than
# `LEAST_HELD` of them it is MIN_SCORE.
HELD_OUT = 4
LOSS = 0.02
GRID = 1024
LEAST_HELD = 10
MIN_SCORE = -0.045
SYMBOLS = "#*$%&|<>"


def sorted_windows(w: Column) -> Column:
    """The text's three-word windows, (hash, pos), sorted, so that equal ones are neighbours."""
    n = F.size(w) - 2
    hashed = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    window = lambda i: F.struct(hashed(i).alias("hash"), i.alias("pos"))
    positions = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.sort_array(F.transform(positions, window))


def covered_words(w: Column, windows: Column) -> Column:
    """Words in windows that occur twice or more.

    Neighbours with equal hashes are compared word by word.
    """

    def same(x: Column, y: Column) -> Column:
        word = lambda p, k: F.get(w, p["pos"] + k)
        equal = x["hash"] == y["hash"]
        for k in range(3):
            equal = equal & (word(x, k) == word(y, k))
        return F.coalesce(equal, F.lit(False))

    repeated = F.filter(
        windows, lambda x, i: same(F.get(windows, i + 1), x) | same(F.get(windows, i - 1), x)
    )
    zero = F.lit(0).cast("bigint")
    return F.aggregate(
        F.sort_array(F.transform(repeated, lambda x: x["pos"])),
        F.struct(zero.alias("covered"), zero.alias("end")),
        lambda a, p: F.struct(
            (a["covered"] + p + 3 - F.greatest(p, a["end"])).alias("covered"),
            (p + F.lit(3).cast("bigint")).alias("end"),
        ),
        lambda a: a["covered"],
    )


def measures(text: Column, w: Column, windows: Column) -> dict[str, Column]:
    """What the plain rules look at."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return {
        "n_words": F.size(w).cast("bigint"),
        "word_chars": F.length(F.array_join(w, "")).cast("bigint"),
        "n_symbols": F.when(text.rlike("[#*$%&|<>]"), symbols).otherwise(0).cast("bigint"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
        "n_repeat_words": covered_words(w, windows),
    }


def bucket(hashed: Column, buckets: int) -> Column:
    """`buckets` is a power of two."""
    return hashed.bitwiseAND(F.lit(buckets - 1).cast("bigint")).cast("int")


def ngrams(w: Column, buckets: int) -> Column:
    """Buckets of the words and of the pairs of neighbouring words."""
    at = lambda i: F.get(w, i)
    single = F.transform(w, lambda x: bucket(F.xxhash64(x), buckets))
    starts = F.when(F.size(w) > 1, F.sequence(F.lit(0), F.size(w) - 2))
    pairs = F.transform(starts, lambda i: bucket(F.xxhash64(at(i), at(i + 1)), buckets))
    return F.concat(single, F.coalesce(pairs, F.array().cast("array<int>")))


def log_ratios(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, prior: int | None = None
) -> DataFrame:
    """One row with `weights`: log(trusted / raw) of each bucket.

    Raw counts get `RAW_SHARE` of their total added, in equal parts. Trusted counts get
    `prior` n-grams, `PRIOR_SHARE` of their total unless given, spread like the raw ones.

    `docs` is the raw corpus, all of it; `trusted` holds the doc_ids of trusted documents.
    Each task reduces its counts to one row per bucket before they are shuffled, and the
    result has `buckets` numbers whatever the size of the corpus.
    """
    ids = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct().withColumn("__trusted", F.lit(1))
    marked = docs.select("doc_id", words(F.col("text")).alias("w")).join(small(ids), "doc_id", "left")
    counts = (
        marked.select(F.explode_outer(ngrams(F.col("w"), buckets)).alias("bucket"), "__trusted")
        .where("bucket IS NOT NULL")
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count("__trusted").alias("trusted"))
    )
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    counted = stored(every.join(counts, "bucket", "left").fillna(0), "ngrams")
    totals = counted.agg(F.sum("raw").alias("raws"), F.sum("trusted").alias("trusteds")).first()
    added = totals["raws"] * RAW_SHARE or 1.0
    prior = prior or totals["trusteds"] * PRIOR_SHARE or 1.0
    raw = (F.col("raw") + added / buckets) / float(totals["raws"] + added)
    weight = F.log((F.col("trusted") + prior * raw) / float(totals["trusteds"] + prior)) - F.log(raw)
    listed = F.sort_array(F.collect_list(F.struct("bucket", weight.alias("weight"))))
    return counted.agg(listed["weight"].alias("weights"))


def score(w: Column, weights: Column, buckets: int) -> Column:
    """Mean log ratio over the same n-grams; 0 without any."""
    weight = lambda *x: F.get(weights, bucket(F.xxhash64(*x), buckets))
    pair = lambda i: weight(F.get(w, i), F.get(w, i + 1))
    last = F.size(w) - 1
    pairs = F.aggregate(
        F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>")),
        F.lit(0.0),
        lambda a, i: a + weight(F.get(w, i)) + pair(i),
    )
    total = pairs + F.coalesce(weight(F.get(w, last)), F.lit(0.0))
    return F.when(last >= 0, total / (2 * last + 1)).otherwise(0.0)


def held_out(trusted: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Trusted doc_ids to count and, if there are enough, those to derive a threshold from."""
    held = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(HELD_OUT)) == 0
    ids = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct()
    if ids.where(held).limit(LEAST_HELD).count() < LEAST_HELD:
        return ids, None
    return ids.where(~held), ids.where(held)


def least_score(held: DataFrame) -> float:
    """The highest multiple of 1 / `GRID` that at most `LOSS` of the held-out documents
    that pass the plain rules score below; of a repeated id the lowest score counts."""
    steps = held.where("NOT base_failed").groupBy("doc_id").agg(F.floor(F.min("score") * GRID).alias("step"))
    counts = steps.groupBy("step").count().orderBy("step").collect()
    total, below = sum(r["count"] for r in counts), 0
    if total < LEAST_HELD:
        return MIN_SCORE
    for r in counts:
        below += r["count"]
        if below > LOSS * total:
            return r["step"] / GRID
    return MIN_SCORE


@shielded
def judged(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, min_score: float | None = None,
    prior: int | None = None,
) -> DataFrame:
    """All rows and columns of `docs`, with `n_words`, `word_chars`, `n_symbols`,
    `n_dup_lines`, `n_repeat_words`, `score`, `base_failed` and `kept`.

    A document fails the plain rules with fewer than 50 words or when more than half of
    its words lie in repeated three-word windows. Of the others those are kept whose
    score is at least `min_score`; a score equal to it is kept. Unless it is given, it is
    derived from trusted documents held out of the counts (see `held_out`).

    A null text counts as empty: no words, failed. Repeated rows are judged alike, each
    counted in the corpus. Without trusted documents all scores are 0. Columns with the names added here are replaced.
    """
    counted, held = held_out(trusted) if min_score is None else (trusted, None)
    weights = stored(log_ratios(docs, counted, buckets, prior), "weights")
    found = scored(docs, weights, buckets)
    if min_score is None:
        min_score = MIN_SCORE
        if held is not None:
            some = docs.select("doc_id", "text").join(small(held), "doc_id", "left_semi")
            min_score = least_score(scored(some, weights, buckets))
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= min_score))


def scored(docs: DataFrame, weights: DataFrame, buckets: int) -> DataFrame:
    """`docs` with the measures, `score` and `base_failed`."""
    w, windows = F.col("__words"), F.col("__windows")
    split = (
        docs.withColumn("__words", words(F.col("text")))
        .withColumn("__weights", weights.scalar())
        .withColumn("__windows", sorted_windows(w))
    )
    found = settled(
        split, measures(F.col("text"), w, windows) | {"score": score(w, F.col("__weights"), buckets)}
    ).drop("__words", "__windows", "__weights")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled as good and not as toxic."""
    return labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id")
