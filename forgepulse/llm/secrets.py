"""Find secrets by patterns, and random strings by character Markov models.

Two first-order models over characters are estimated from labelled samples, one of
random strings and one of ordinary identifiers. A long run of key characters is taken
for a secret when its mean log-likelihood ratio per character is high enough. Patterns
of known kinds come first; what they find stays, whatever the models say.

Spark's functions give matches but not their places: the places follow from the lengths
of the matches and of the gaps between them, which splitting by the same pattern gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forgepulse.llm.common import let, shielded

# The kinds in their order, what they match, and what a match must have.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "model")
ASSIGN_CHARS = 6

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(ALPHABET) + 1
MIN_RATIO = 1.0

# Labelled samples: so many random strings of each form, and the words of so many
# documents.
RANDOM_STRINGS = 10_000
SAMPLE_DOCUMENTS = 2_000

SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Leftmost matches that do not overlap: (start, kind, end, value), in code points.

    The end is exclusive and the value is the given group; matches whose value is
    shorter than `least` are dropped after they have been found.
    """
    none = F.array().cast(SPANS)

    def located(found: Column, gaps: Column, values: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            start = a["at"] + F.length(F.get(gaps, i))
            end = start + F.length(F.get(found, i))
            span = F.struct(
                start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"),
                F.get(values, i).alias("value"),
            )
            long = F.length(F.get(values, i)) >= least
            spans = F.when(long, F.concat(a["spans"], F.array(span))).otherwise(a["spans"])
            return F.struct(end.alias("at"), spans.alias("spans"))

        zero = F.struct(F.lit(0).alias("at"), none.alias("spans"))
        return F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), zero, step, lambda a: a["spans"])

    p = F.lit(pattern)
    matched = let(
        F.struct(
            F.regexp_extract_all(text, p, F.lit(0)).alias("found"),
            F.split(text, pattern, -1).alias("gaps"),
            F.regexp_extract_all(text, p, F.lit(group)).alias("values"),
        ),
        lambda m: located(m["found"], m["gaps"], m["values"]),
    )
    return F.when(text.rlike(pattern), matched).otherwise(none)


def transition(text: Column, i: Column) -> Column:
    """Number of the pair of characters that begins at i (from 1)."""
    state = lambda at: F.call_function("instr", F.lit(ALPHABET), F.substring(text, at, F.lit(1)))
    return state(i) * STATES + state(i + 1)


def steps(text: Column) -> Column:
    """First places of the character pairs of a text."""
    return F.when(F.length(text) > 1, F.sequence(F.lit(1), F.length(text) - 1)).otherwise(
        F.array().cast("array<int>")
    )


def random_strings(docs: DataFrame, count: int = RANDOM_STRINGS) -> DataFrame:
    """(text, random): random strings in base 64, in hex, and in capitals and digits."""
    seed = F.sha2(F.col("id").cast("string"), 256)
    capitals = F.translate(F.upper(F.base64(F.unhex(seed))), "+/=", "")
    forms = F.array(F.base64(F.unhex(seed)), F.substring(seed, 1, 40), F.substring(capitals, 1, 20))
    return docs.sparkSession.range(count).select(F.explode(forms).alias("text"), F.lit(True).alias("random"))


def ordinary_words(docs: DataFrame, trusted: DataFrame, documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """(text, random): distinct words of trusted documents outside pattern matches.

    The documents are those `documents` trusted ones whose ids hash lowest, whatever the
    size of the corpus.
    """
    chosen = trusted.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents)
    text = F.coalesce("text", F.lit(""))
    for pattern in (ASSIGN, ACCESS, HEX):
        text = F.regexp_replace(text, pattern, " ")
    found = docs.join(F.broadcast(chosen), "doc_id", "left_semi").select(
        F.explode_outer(F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9+/_=-]{4,}"), F.lit(0))).alias("text")
    )
    return found.where("text IS NOT NULL").distinct().withColumn("random", F.lit(False))


def log_ratios(samples: DataFrame) -> DataFrame:
    """One row with `weights`: log(random / ordinary) of each pair of characters.

    Each model is the chance of the second character after the first. Where a model has
    seen the first too rarely to tell, its chance of the second after any other counts.
    """
    pairs = samples.select(
        F.explode_outer(F.transform(steps(F.col("text")), lambda i: transition(F.col("text"), i))).alias("pair"),
        "random",
    )
    counts = (
        pairs.where("pair IS NOT NULL")
        .groupBy("pair")
        .agg(F.count_if("random").alias("random"), F.count_if(~F.col("random")).alias("ordinary"))
    )
    # One row per pair of the alphabet.
    every = samples.sparkSession.range(STATES * STATES).select(F.col("id").cast("int").alias("pair"))
    full = every.join(counts, "pair", "left").fillna(0)
    full = full.withColumn("before", F.floor(F.col("pair") / STATES)).withColumn("after", F.col("pair") % STATES)
    total = lambda n, *by: F.sum(n).over(Window.partitionBy(*by, F.lit(0)))

    def chance(n: str) -> Column:
        anywhere = (total(n, "after") + 1.0) / (total(n) + float(STATES))
        return F.log((F.col(n) + STATES * anywhere) / (total(n, "before") + float(STATES)))

    rows = full.select(F.struct("pair", (chance("random") - chance("ordinary")).alias("weight")).alias("x"))
    return rows.agg(F.sort_array(F.collect_list("x"))["weight"].alias("weights"))


def ratio(text: Column, weights: Column) -> Column:
    """Mean log ratio per pair of characters."""
    total = F.aggregate(steps(text), F.lit(0.0), lambda a, i: a + F.get(weights, transition(text, i)))
    return total / F.greatest(F.length(text) - 1, F.lit(1))


@shielded
def find_secrets(docs: DataFrame, samples: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """All rows and columns of `docs`, with `base_spans` and `all_spans`.

    Both are arrays of (start, kind, end, value), sorted; kind counts in `KINDS`.
    `samples` holds (text, random). All pattern matches are in both; spans of the models
    are added where they touch no pattern match. A null or empty text has no spans;
    without samples the models add none. Repeated rows are scanned alike. Columns with
    the names added here are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    weights = log_ratios(samples).scalar()
    base = F.array_sort(
        F.concat(
            spans(text, ASSIGN, "assign", 2, ASSIGN_CHARS), spans(text, ACCESS, "access"), spans(text, HEX, "hex")
        )
    )
    apart = lambda s: ~F.exists("base_spans", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    random = F.filter("__runs", lambda s: (ratio(s["value"], F.col("__weights")) >= min_ratio) & apart(s))
    return (
        docs.withColumn("base_spans", base)
        .withColumn("__runs", spans(text, CANDIDATE, "model"))
        .withColumn("__weights", weights)
        .withColumn("all_spans", F.array_sort(F.concat(F.col("base_spans"), random)))
        .drop("__runs", "__weights")
    )


def listed(found: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(found, one), ",")
