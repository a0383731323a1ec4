"""Near-duplicates by MinHash with tensored banding, links confirmed on full sets.

With s the share of shingles two texts have in common, one sub-key of `rows` minhashes
agrees with probability s^rows. A document has two collections of `keys` sub-keys each,
and a table key is a pair of one from either, so 2 * keys * rows minhashes serve
keys^2 tables of 2 * rows minhashes each. Two documents share a table exactly if they
share a sub-key in both collections: at s = 0.75, with 20 sub-keys of 3, all but one in
28,000 such pairs do, and more above.

Only sub-keys that two different texts share can make a table key that matters, so the
pairs are formed after the others have gone. Texts with equal sets are one node from the
start. The tables on the diagonal link most copies, each to the node of its table whose
sub-keys are shared most, which is the text that the others were copied from if there is
one. Then only sub-keys that still meet different components are paired.

Most texts that meet there have a passage in common and are not similar. Two similar sets
share one of their rarest shingles: with all shingles in order of frequency, the first
n - 0.75 n + 1 of a set of n. So a node whose rarest shingles are found in no other
component is done, and pairs are formed over rarest shingles only. What is left is
compared by size and by sub-keys, of which similar sets share 5 of 40 in all but one of
100,000 cases, and then on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.common import NODE, python_batches, shielded, small, stored, with_nodes
from forgepulse.llm.components import component_labels

SHINGLE = 5
SIMILARITY = (75, 100)
KEYS, ROWS = 20, 3
SHARED = 5

# Comparisons a last round may leave per rarest shingle of a node: below this, every open
# pair is listed.
OPEN_PAIRS = 8
PIVOT_ROUNDS = 1
# Shingles a worker remembers while it confirms pairs: some 30 MB.
REMEMBERED = 4_000_000

MIX = np.uint64(0x9E3779B97F4A7C15)
SKETCH = "node bigint, n_shingles bigint, h1 bigint, h2 bigint, a array<bigint>, b array<bigint>"


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * MIX
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


class Words:
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, most: int = 500_000):
        self.known: dict[bytes, int] = {}
        self.most = most

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > self.most:
            self.known.clear()
        for word in set(words).difference(self.known):
            self.known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


def shingles(text: str | None, hashes: Words, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles.

    bytes.lower and bytes.split know only ASCII: A-Z, and space and tab to carriage return.
    """
    h = hashes((text or "").encode("utf-8", "surrogatepass").lower().split())
    span = min(size, len(h))
    if not span:
        return h
    with np.errstate(over="ignore"):
        total = np.full(len(h) - span + 1, span, np.uint64)
        for k in range(span):
            total = mixed(total + h[k : len(h) - span + 1 + k])
    return np.unique(total)


def multipliers(count: int) -> np.ndarray:
    """Odd numbers, the same in every task."""
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, count + 1, dtype=np.uint64) * MIX) | np.uint64(1)


def minhashes(shingle_set: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """Least value of each hash function, over blocks so that long texts need no more memory."""
    least = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingle_set), 1024):
            block = shingle_set[at : at + 1024, None] * odd[None, :]
            least = np.minimum(least, (block ^ (block >> np.uint64(31))).min(axis=0))
    return least


def sketches(docs: DataFrame, keys: int, rows: int) -> DataFrame:
    """Per node the size of its set, a 128-bit hash of it, and its two key collections."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, odd = Words(), multipliers(2 * keys * rows)
        for batch in batches:
            out = []
            for node, text in zip(batch["node"], batch["text"], strict=True):
                s = shingles(text, hashes)
                if not len(s):
                    continue
                with np.errstate(over="ignore"):
                    h1, h2 = s.sum(dtype=np.uint64), mixed(s ^ MIX).sum(dtype=np.uint64)
                    least = minhashes(s, odd).reshape(2 * keys, rows)
                    key = np.arange(2 * keys, dtype=np.uint64)
                    for r in range(rows):
                        key = mixed(key * MIX + least[:, r])
                key = key.view(np.int64)
                pair = np.array([h1, h2], np.uint64).view(np.int64)
                out.append((node, len(s), pair[0], pair[1], key[:keys], key[keys:]))
            yield pd.DataFrame(out, columns=["node", "n_shingles", "h1", "h2", "a", "b"])

    return docs.select("node", "text").mapInPandas(sketch, SKETCH)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    share, whole = SIMILARITY

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, known, held = Words(), {}, 0

        def of(node: int, text: str) -> np.ndarray:
            nonlocal held
            if node not in known:
                if held > REMEMBERED:
                    known.clear()
                    held = 0
                known[node] = shingles(text, hashes)
                held += len(known[node])
            return known[node]

        for batch in batches:
            keep = []
            for u, v, u_text, v_text in batch[["u", "v", "u_text", "v_text"]].itertuples(index=False):
                mine, other = of(u, u_text), of(v, v_text)
                both = len(np.intersect1d(mine, other, assume_unique=True))
                if whole * both >= share * (len(mine) + len(other) - both):
                    keep.append((u, v))
            yield pd.DataFrame(keep, columns=["u", "v"])

    named = lambda side: texts.select(F.col("node").alias(side), F.col("text").alias(f"{side}_text"))
    # Texts are joined by merge at every size; adaptive execution splits a node with very
    # many partners.
    joined = pairs.join(named("u").hint("merge"), "u").join(named("v").hint("merge"), "v")
    return stored(joined.mapInPandas(check, "u bigint, v bigint"), "confirmed")


def rarest(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, size, place, shingle): what is found in other nodes too of each set's rarest
    shingles, with its place in the order, from 1.

    Those are the first n - k + 1 of its n shingles in order of (number of nodes, hash),
    where k is the least overlap with which a set of n can be linked. Two linked sets
    have one of them in common, whatever the order. Shingles of one node only come first
    and are not listed; they count as places.
    """
    share, whole = SIMILARITY

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Words()
        for batch in batches:
            found = [shingles(text, hashes).view(np.int64) for text in batch["text"]]
            yield pd.DataFrame({"node": batch["node"], "shingles": found})

    read = texts.join(nodes.select("node").hint("merge"), "node", "left_semi")
    listed = stored(read.mapInPandas(sets, "node bigint, shingles array<bigint>"), "sets")
    entries = listed.select("node", F.size("shingles").cast("bigint").alias("size"), F.explode("shingles").alias("shingle"))
    counts = entries.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    by_node = (
        entries.join(small(stored(counts, "counts")), "shingle")
        .groupBy("node", "size")
        .agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("common"))
    )
    least = F.ceil(F.col("size") * share / whole)
    alone = F.col("size") - F.size("common")
    first = F.slice("common", 1, F.greatest(F.col("size") - least + 1 - alone, F.lit(0)).cast("int"))
    listed = by_node.select("node", "size", alone.alias("alone"), F.posexplode(first["shingle"]).alias("at", "shingle"))
    return stored(listed.select("node", "size", (F.col("alone") + F.col("at") + 1).alias("place"), "shingle"), "rarest")


def reachable(size: Column, place: Column, other_size: Column) -> Column:
    """Whether two sets can be linked whose first common shingle has this place in one."""
    share, whole = SIMILARITY
    return (whole + share) * (size - place + 1) >= share * (size + other_size)


def shared_keys(reps: DataFrame) -> DataFrame:
    """Sub-keys that two nodes have, and by how many: (node, side, i, sub, n).

    Nodes with too few of them to be similar to any other are left out.
    """
    entries = reps.select(
        "node",
        F.posexplode_outer(F.concat(F.col("a"), F.col("b"))).alias("i", "sub"),
        F.size("a").alias("keys"),
    )
    common = entries.groupBy("sub").agg(F.count("*").alias("n")).where("n > 1")
    side = (F.col("i") >= F.col("keys")).cast("int")
    key = F.struct(side.alias("side"), (F.col("i") % F.col("keys")).alias("i"), "sub", "n")
    by_node = entries.join(common.hint("merge"), "sub").groupBy("node").agg(F.collect_list(key).alias("keys"))
    enough = by_node.where(F.size("keys") >= SHARED)
    return stored(enough.select("node", F.explode("keys").alias("key")).select("node", "key.*"), "keys")


def comparable(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (u, v) that share a table and whose sizes and sub-keys leave it open that
    they are similar."""
    share, whole = SIMILARITY
    named = lambda x: reps.select(
        F.col("node").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in ("n_shingles", "a", "b"))
    )
    near = whole * F.least("u_n_shingles", "v_n_shingles") >= share * F.greatest("u_n_shingles", "v_n_shingles")
    shared = lambda side: F.size(F.array_intersect(f"u_{side}", f"v_{side}"))
    alike = (shared("a") > 0) & (shared("b") > 0) & (shared("a") + shared("b") >= SHARED)
    joined = pairs.join(named("u").hint("merge"), "u").join(named("v").hint("merge"), "v")
    return joined.where(near & alike).select("u", "v")


def diagonal_pairs(keys: DataFrame, popular: DataFrame) -> DataFrame:
    """In the tables that pair equal places, each node with the most popular one."""
    both = keys.groupBy("node", "i").agg(
        F.max(F.when(F.col("side") == 0, F.col("sub"))).alias("a"),
        F.max(F.when(F.col("side") == 1, F.col("sub"))).alias("b"),
    )
    entries = (
        both.where("a IS NOT NULL AND b IS NOT NULL")
        .select("node", F.xxhash64("a", "b").alias("key"))
        .join(popular.hint("merge"), "node")
    )
    most = entries.groupBy("key").agg(F.max(F.struct("popularity", "node"))["node"].alias("other"))
    return ordered(entries.join(most, "key").where("node <> other"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def meeting(rows: DataFrame, by: str) -> DataFrame:
    """The values of a column that rows of different components have."""
    ends = rows.groupBy(by).agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    return ends.where("lo < hi").select(by)


def open_nodes(keys: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes with sub-keys, in both collections, that other components have too."""
    labelled = with_labels(keys, labels)
    left = labelled.join(meeting(labelled, "sub"), "sub", "left_semi")
    both = left.groupBy("node").agg(F.min("side").alias("lo"), F.max("side").alias("hi"))
    return stored(both.where("lo < hi").select("node"), "open")


def still_rare(rare: DataFrame, labels: DataFrame) -> DataFrame:
    """`rare` and the label, of shingles by which two components may be linked.

    Of two linked sets the smaller one has the shingle where a set of its own size is in reach.
    """
    labelled = with_labels(rare, labels)
    ends = labelled.groupBy("shingle").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"),
        F.max(reachable(F.col("size"), F.col("place"), F.col("size"))).alias("early"),
    )
    some = ends.where("lo < hi AND early").select("shingle")
    return stored(labelled.join(some.hint("merge"), "shingle", "left_semi"), "rare")


def open_tables(keys: DataFrame, live: DataFrame, popular: DataFrame) -> DataFrame:
    """Table keys where `live` nodes (node, label) of different components meet:
    (key, node, label, popularity)."""
    labelled = keys.join(live.hint("merge"), "node")
    left = labelled.join(meeting(labelled, "sub"), "sub", "left_semi")
    by_node = left.groupBy("node", "label").agg(
        F.collect_list(F.when(F.col("side") == 0, F.col("sub"))).alias("a"),
        F.collect_list(F.when(F.col("side") == 1, F.col("sub"))).alias("b"),
    )
    entries = (
        by_node.where("size(a) > 0 AND size(b) > 0")
        .join(popular, "node")
        .withColumn("x", F.explode("a"))
        .select("node", "label", "popularity", "x", F.explode("b").alias("y"))
        .select(F.xxhash64("x", "y").alias("key"), "node", "label", "popularity")
    )
    return stored(entries.join(meeting(entries, "key").hint("merge"), "key", "left_semi"), "tables")


def pivot_pairs(tables: DataFrame, turn: int) -> DataFrame:
    """Each node of a table with one of another component: the most popular, then any."""
    first_by = F.col("popularity") if turn == 0 else F.xxhash64(F.lit(turn), "node")
    order = F.struct(first_by.alias("by"), "node", "label")
    first = tables.groupBy("key").agg(F.max(order).alias("p"))
    with_first = tables.join(first, "key")
    second = with_first.where("label <> p.label").groupBy("key").agg(F.max(order).alias("q"))
    other = F.when(F.col("label") != F.col("p.label"), F.col("p.node")).otherwise(F.col("q.node"))
    return with_first.join(second, "key").select("node", other.alias("other"))


def all_open_pairs(rare: DataFrame) -> DataFrame:
    """Every two nodes of different components that may be linked by a rarest shingle."""
    share, whole = SIMILARITY
    x = rare.select("shingle", "node", "label", "size", "place")
    y = x.toDF("shingle", "other", "other_label", "other_size", "other_place")
    near = whole * F.least("size", "other_size") >= share * F.greatest("size", "other_size")
    size, place, other_size, other_place = map(F.col, ("size", "place", "other_size", "other_place"))
    reach = reachable(size, place, other_size) & reachable(other_size, other_place, size)
    return x.join(y, "shingle").where((F.col("label") < F.col("other_label")) & near & reach).select("node", "other")


def ordered(pairs: DataFrame) -> DataFrame:
    high, low = F.greatest("node", "other"), F.least("node", "other")
    return pairs.select(high.alias("u"), low.alias("v")).distinct()


def linked(docs: DataFrame, keys: int = KEYS, rows: int = ROWS) -> DataFrame:
    """(node, n_shingles, label) of every node of `docs` (node, text) with words.

    The label is the least node reachable over links. No bucket is cut: comparisons go
    round by round with one pivot per table, and when few open pairs are left, or after
    `PIVOT_ROUNDS`, all of them that share a rarest shingle are compared.
    """
    with python_batches(docs.sparkSession):
        sketched = stored(sketches(docs, keys, rows), "sketches")
        same = ["h1", "h2", "n_shingles"]
        firsts = sketched.groupBy(*same).agg(F.min("node").alias("rep"))
        reps = sketched.join(firsts.select(F.col("rep").alias("node")).hint("merge"), "node", "left_semi")
        key_rows = shared_keys(reps)
        meeting = key_rows.select("node").distinct()
        texts = stored(docs.select("node", "text").join(meeting.hint("merge"), "node", "left_semi"), "texts")

        popular = stored(key_rows.groupBy("node").agg(F.sum("n").alias("popularity")), "popular")
        reps = stored(reps.join(meeting.hint("merge"), "node", "left_semi"), "reps")

        tested = stored(diagonal_pairs(key_rows, popular), "pairs")
        links = confirmed(comparable(tested, reps), texts)
        labels = stored(component_labels(links), "labels")
        rare = rarest(open_nodes(key_rows, labels), texts)
        turn = 0
        while True:
            rare = still_rare(rare, labels)
            if rare.isEmpty():
                break
            few = OPEN_PAIRS * rare.count()
            last = turn >= PIVOT_ROUNDS or all_open_pairs(rare).limit(few + 1).count() <= few
            live = rare.select("node", "label").distinct()
            if last:
                pairs = all_open_pairs(rare)
            else:
                pairs = pivot_pairs(open_tables(key_rows, live, popular), turn)
            fresh = stored(ordered(pairs).join(tested, ["u", "v"], "left_anti"), "pairs")
            links = links.union(confirmed(comparable(fresh, reps), texts))
            labels = stored(component_labels(links), "labels")
            if last:
                break
            rare = rare.drop("label")
            tested = tested.union(fresh)
            turn += 1
        rep_labels = labels.select(F.col("node").alias("rep"), "label")
        return (
            sketched.join(firsts.hint("merge"), same)
            .join(rep_labels, "rep", "left")
            .select("node", "n_shingles", F.coalesce("label", "rep").alias("label"))
        )


@shielded
def near_duplicates(docs: DataFrame, keys: int = KEYS, rows: int = ROWS) -> DataFrame:
    """All rows and columns of `docs`, with `n_shingles`, `component_id`, `kept` and `first`.

    A document's set holds its distinct five-word shingles, or the whole word sequence if
    it has fewer words. Sets are compared as 64-bit hashes of shingles. Documents with
    100 * intersection >= 75 * union are linked; component_id is the smallest doc_id
    reachable, kept says whether it is the document's own, and first marks one row of
    each component.

    A null or empty text, or one without words, has an empty set and is linked with
    nothing: its component is itself. Rows that share a doc_id, or have none, are
    compared as rows of their own; a null id counts only where no other is reachable.
    Columns with the names added here are replaced.
    """
    rows_in, unique = with_nodes(docs.drop("n_shingles", "component_id", "kept", "first"))
    found = linked(rows_in.select(F.col(NODE).alias("node"), "text"), keys, rows)
    found = found.select(F.col("node").alias(NODE), "n_shingles", F.col("label").alias("__label"))
    label = F.coalesce("__label", NODE)
    joined = rows_in.join(found.hint("merge"), NODE, "left").withColumn("__label", label)
    joined = joined.withColumn("n_shingles", F.coalesce("n_shingles", F.lit(0).cast("bigint")))
    if unique:
        joined = joined.withColumn("component_id", F.col("__label"))
    else:
        least = joined.groupBy("__label").agg(F.min("doc_id").alias("component_id"))
        joined = joined.join(least, "__label")
    return (
        joined.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .withColumn("first", F.col(NODE) == F.col("__label"))
        .drop(NODE, "__label")
    )
