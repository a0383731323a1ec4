"""Find passages that documents share with benchmark items, by winnowing.

A window is ten consecutive words. Every text is cut into five-word grams, which are
hashed; of each six consecutive hashes, which ten words give, the smallest is kept, with
its place. Two texts that share a window keep the same gram of it at the same offset, so
looking up a document's kept hashes among those of all items finds every place that may
lie in a shared window. Each such place is then extended: a window around it is named by
the hashes of the grams that make it up, 128 bits for ten words, and the windows of all
items are looked up by these names. That takes as many steps as a text has words, also
where text and item repeat a passage many times. Items of fewer words than a window are
one window themselves; for these all runs of their length are looked up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.common import ROW, keyed, lower_ascii, shielded, small, stored, words

WINDOW = 10
GRAM = 5

# Anything in ASCII but digits and lower-case letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    # `lower` is the faster way where it does the same.
    plain = F.octet_length(text) == F.length(text)
    return words(F.when(plain, F.lower(text)).otherwise(lower_ascii(text)), SEPARATORS)


def upto(n: Column) -> Column:
    """0 to n - 1; empty for n below 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def span_hashes(w: Column, length: int, *seed: Column) -> Column:
    """A hash of each run of `length` words."""
    hashed = lambda i: F.xxhash64(*seed, *(F.get(w, i + k) for k in range(length)))
    return F.transform(upto(F.size(w) - length + 1), hashed)


def winnowed(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """Add `hashes` of all grams of the column `w`, and `marks`, the places of those kept."""
    reach = window - gram + 1
    h, mins = F.col("hashes"), F.col("__mins")
    lowest = lambda i: F.least(*(F.get(h, i + k) for k in range(reach)))
    # A gram is kept if it is the minimum of any of the `reach` windows around it, and
    # then it equals the largest of their minima.
    around = lambda i: F.greatest(*(F.get(mins, i - k) for k in range(reach)))
    return (
        texts.withColumn("hashes", span_hashes(F.col("w"), gram))
        .withColumn("__mins", F.transform(upto(F.size(h) - reach + 1), lowest))
        .withColumn("marks", F.filter(upto(F.size(h)), lambda i: F.get(h, i) == around(i)))
        .drop("__mins")
    )


def named_window(h: Column, at: Column, window: int, gram: int) -> tuple[Column, Column]:
    """Two hashes that name the window whose first gram is the one at `at` of `h`.

    The grams at every `gram`-th place and the last one hold all words of the window.
    """
    rest = [*range(gram, window - gram, gram), window - gram]
    parts = [F.get(h, at + k) for k in rest]
    return F.get(h, at), parts[0] if len(parts) == 1 else F.xxhash64(*parts)


def short_names(w: Column, length: int) -> Column:
    """(start, length, h1, h2) of every run of so many words, apart from those of windows."""
    first = span_hashes(w, length, F.lit(-length))
    second = span_hashes(w, length, F.lit(length), F.lit("run"))
    run = lambda a, b: F.struct(a.alias("h1"), b.alias("h2"))
    placed = lambda x, i: F.struct(
        i.alias("start"), F.lit(length).alias("length"), x["h1"].alias("h1"), x["h2"].alias("h2")
    )
    return F.transform(F.zip_with(first, second, run), placed)


def item_names(items: DataFrame, lengths: list[int], window: int, gram: int) -> DataFrame:
    """The windows of all items: (h1, h2, item_id)."""
    long = items.where(F.size("w") >= window).withColumn("hashes", span_hashes(F.col("w"), gram))
    starts = upto(F.size("hashes") - (window - gram))
    h1, h2 = (lambda i, k=k: named_window(F.col("hashes"), i, window, gram)[k] for k in (0, 1))
    name = F.explode(F.transform(starts, lambda i: F.struct(h1(i).alias("h1"), h2(i).alias("h2"))))
    names = long.select("item_id", name.alias("name")).select("name.*", "item_id")
    for n in lengths:
        run = items.where(F.size("w") == n).select("item_id", F.explode(short_names(F.col("w"), n)).alias("run"))
        names = names.unionByName(run.select("run.h1", "run.h2", "item_id"))
    return names.distinct()


def candidates(texts: DataFrame, wanted: DataFrame, lengths: list[int], window: int, gram: int) -> DataFrame:
    """Windows of `texts` around marks that are wanted: (row, start, length, h1, h2)."""
    # Of the windows that hold a gram, the first starts `back` grams before it. Only the
    # hashes that name them go with the mark.
    back = window - gram
    near = lambda i: F.slice(
        "hashes", F.greatest(i - back, F.lit(0)) + 1, F.least(i, F.lit(back)) + back + 1
    )
    mark = lambda i: F.struct(F.get("hashes", i).alias("hash"), i.alias("pos"), near(i).alias("near"))
    marks = F.explode(F.transform("marks", mark)).alias("mark")
    met = (
        winnowed(texts, window, gram)
        .select(ROW, marks)
        .select(ROW, "mark.*")
        .join(small(stored(wanted, "marks")), "hash", "left_semi")
    )
    h1, h2 = (lambda k, n=n: named_window(F.col("near"), k, window, gram)[n] for n in (0, 1))
    around = lambda k: F.struct(
        (k + F.greatest(F.col("pos") - back, F.lit(0))).alias("start"),
        F.lit(window).alias("length"), h1(k).alias("h1"), h2(k).alias("h2"),
    )
    spans = F.explode(F.transform(upto(F.size("near") - back), around)).alias("span")
    found = met.select(ROW, spans).select(ROW, "span.*")
    if lengths:
        runs = F.concat(*(short_names(F.col("w"), n) for n in lengths))
        found = found.unionByName(texts.select(ROW, F.explode(runs).alias("run")).select(ROW, "run.*"))
    return found


@shielded
def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """All rows and columns of `docs`, with `n_words`, `hit_words` (sorted word positions
    inside any occurrence of an item's window) and `hit_items` (sorted item_ids, as
    strings, of items with occurring windows).

    Words are runs of digits, letters and non-ASCII characters, A-Z in lower case. A null
    or empty text has no words and no hits, on either side. Equal items under several
    ids are all reported; an item without an id marks words but is not listed. Repeated
    documents get equal results. Time and memory grow with the length of the texts, on
    either side. Columns with the names added here are replaced.
    """
    rows = keyed(docs.drop("n_words", "hit_words", "hit_items"))
    rows = rows.withColumn("n_words", F.size(item_words(F.col("text"))).cast("bigint"))
    items = stored(
        benchmark.select("item_id", item_words(F.col("text")).alias("w")).where(F.size("w") > 0).distinct(),
        "items",
    )
    short = items.where(F.size("w") < window).select(F.size("w").alias("n")).distinct()
    lengths = sorted(r["n"] for r in short.collect())  # fewer than `window` numbers
    texts = rows.select(ROW, item_words(F.col("text")).alias("w"))
    names = stored(item_names(items, lengths, window, gram), "names")
    wanted = winnowed(items.where(F.size("w") >= window), window, gram)
    wanted = wanted.select(F.explode(F.transform("marks", lambda i: F.get("hashes", i))).alias("hash")).distinct()
    known = small(names.select("h1", "h2").distinct())
    spans = candidates(texts, wanted, lengths, window, gram).join(known, ["h1", "h2"], "left_semi")
    spans = stored(spans, "spans")
    places = F.flatten(F.collect_set(F.sequence("start", F.col("start") + F.col("length") - 1)))
    by_place = spans.groupBy(ROW).agg(F.array_sort(F.array_distinct(places)).alias("hit_words"))
    named = spans.select(ROW, "h1", "h2").distinct().join(small(names), ["h1", "h2"])
    listed = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    by_item = named.groupBy(ROW).agg(listed.alias("hit_items"))
    found = by_place.join(by_item, ROW)
    joined = rows.join(found.hint("merge"), ROW, "left")
    nothing = F.array().cast("array<int>")
    return joined.withColumns(
        {
            "hit_words": F.coalesce("hit_words", nothing),
            "hit_items": F.coalesce("hit_items", nothing.cast("array<string>")),
        }
    ).drop(ROW)
