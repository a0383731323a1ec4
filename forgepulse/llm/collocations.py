"""Phrases whose words belong together, counted in burst tries.

A phrase of k words is the phrase of its first k - 1 words, a prefix with a number, and a last
word with a number. It can only be frequent if its two phrases of k - 1 words are, so phrases
are counted length by length, over numbers alone, and a position counts only where both are.

A task counts in a trie over prefix numbers whose leaves are hash containers. A container that
grows too large bursts into a node with containers of its own. When the trie is full, whole
subtrees are taken out as sorted runs; runs of a subtree, from all tasks, are merged together.
Numbers come from minimal perfect hashes, so no task holds a vocabulary, and sequences of
numbers are written once, in place of the texts.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgepulse.llm.common import python_batches, stored
from forgepulse.llm.minhash import mixed
from forgepulse.llm.perfect_hash import HashTable, hash_table

LONGEST, LEAST_COUNT, SHOWN = 5, 100, 2000
UNKNOWN = "und"

MOST_WORDS = 200_000
# A container bursts beyond so many entries; a trie spills beyond so many.
BURST, MOST_ENTRIES = 1 << 14, 1_500_000
FANOUT_BITS, DEPTH = 4, 12
# Words of the corpus per subtree at most, and subtrees at least.
WORDS_PER_SUBTREE, LEAST_SUBTREES = 1_000_000, 64
# Numbers handed to a trie, kept in a row of a sequence, and merged, at a time.
AT_ONCE = 1 << 20

PLACE = 32
BREAK = -1

_SPACED = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")


def tokens(text: str | None) -> list[bytes]:
    """The words of a text in order, in lower case (A-Z only), with a byte that no text has
    where a piece ends."""
    spaced = (text or "").encode("utf-8", "surrogatepass").lower().translate(_SPACED)
    return spaced.replace(b"\n", b" \xff ").split()


def key_of(lang: str, word: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass") + b"\n" + word)
    return h - (1 << 64) if h >> 63 else h


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all words of `docs` (lang, text)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                seen[lang].update(tokens(text))
            if sum(map(len, seen.values())) > MOST_WORDS:
                yield counted(seen)
                seen.clear()
        yield counted(seen)

    parts = docs.mapInPandas(count, "lang string, word string, n bigint")
    return stored(parts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")


def counted(seen: dict[str, Counter]) -> pd.DataFrame:
    rows = [
        (lang, word.decode("utf-8", "surrogatepass"), n)
        for lang, words in seen.items() for word, n in words.items() if word != b"\xff"
    ]
    return pd.DataFrame(rows, columns=["lang", "word", "n"]).astype({"n": "int64"})


def keyed_words(words: DataFrame) -> DataFrame:
    """Add the key of each word."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = [key_of(lang, w.encode("utf-8", "surrogatepass")) for lang, w in zip(batch["lang"], batch["word"], strict=True)]
            yield batch.assign(key=np.array(keys, np.int64))

    return words.mapInPandas(add, "lang string, word string, n bigint, key bigint")


def sequences(docs: DataFrame, words: HashTable) -> DataFrame:
    """The texts of `docs` (lang, text) as word numbers, with breaks between pieces and texts
    and in place of words that are not frequent; many texts to a row."""

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, dict[bytes, int]] = defaultdict(dict)
        waiting, size = [], 0
        for batch in batches:
            if sum(map(len, known.values())) > MOST_WORDS:
                known.clear()
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                found, numbers = tokens(text), known[lang]
                new = list(set(found).difference(numbers))
                slots, _ = words.look_up(np.array([key_of(lang, w) for w in new], np.int64))
                numbers.update(zip(new, slots.tolist(), strict=True))
                numbers[b"\xff"] = BREAK
                waiting.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                waiting.append(np.array([BREAK], np.int32))
                size += len(found) + 1
                if size > AT_ONCE:
                    yield joined(waiting)
                    waiting, size = [], 0
        if waiting:
            yield joined(waiting)

    def joined(parts: list[np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame({"numbers": [np.concatenate(parts).tobytes()]})

    return stored(docs.mapInPandas(number, "numbers binary"), "sequences")


class Trie:
    """Counts of keys, a prefix number and a word number each, below subtrees."""

    def __init__(self, subtrees: int):
        self.subtrees = subtrees
        self.nodes: dict[int, Counter | list] = {}
        self.entries: Counter = Counter()

    def add(self, keys: np.ndarray) -> None:
        """Count each of the keys."""
        paths = mixed((keys >> PLACE).view(np.uint64))
        # A prefix decides the subtree and the first turns below it, the word the last ones.
        turns = (paths >> np.uint64(40) << np.uint64(24)) | (mixed(keys.view(np.uint64)) >> np.uint64(40))
        for subtree, part in parts_by((paths % np.uint64(self.subtrees)).astype(np.int64)):
            node = self.nodes.setdefault(subtree, Counter())
            self.nodes[subtree], grown = below(node, keys[part], turns[part], 0)
            self.entries[subtree] += grown

    @property
    def size(self) -> int:
        return self.entries.total()

    def spilled(self, left: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Take out whole subtrees, the largest first, until so many entries are left: the
        number of each and its run, keys in order and their counts."""
        for subtree, n in self.entries.most_common():
            if self.size <= left:
                return
            keys, counts = np.empty(n, np.int64), np.empty(n, np.int64)
            at = 0
            for leaf in leaves(self.nodes.pop(subtree)):
                keys[at : at + len(leaf)] = np.fromiter(leaf.keys(), np.int64, len(leaf))
                counts[at : at + len(leaf)] = np.fromiter(leaf.values(), np.int64, len(leaf))
                at += len(leaf)
            order = np.argsort(keys)
            del self.entries[subtree]
            yield subtree, keys[order], counts[order]


def parts_by(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each number and where it occurs."""
    order = np.argsort(numbers, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(numbers[order])) + 1):
        if len(part):
            yield int(numbers[part[0]]), part


def below(node: Counter | list, keys: np.ndarray, turns: np.ndarray, depth: int) -> tuple[Counter | list, int]:
    """Count keys in a node; returns it, or what it burst into, and the new entries."""
    if isinstance(node, Counter):
        before = len(node)
        node.update(keys.tolist())
        if len(node) <= BURST or depth == DEPTH:
            return node, len(node) - before
        grown = len(node) - before
        mine = np.fromiter(node.keys(), np.int64, len(node))
        paths = mixed((mine >> PLACE).view(np.uint64))
        all_turns = (paths >> np.uint64(40) << np.uint64(24)) | (mixed(mine.view(np.uint64)) >> np.uint64(40))
        children: list[Counter | None] = [None] * (1 << FANOUT_BITS)
        for digit, part in parts_by(digits(all_turns, depth)):
            children[digit] = Counter({k: node[k] for k in mine[part].tolist()})
        return children, grown
    grown = 0
    for digit, part in parts_by(digits(turns, depth)):
        node[digit], more = below(node[digit] or Counter(), keys[part], turns[part], depth + 1)
        grown += more
    return node, grown


def digits(turns: np.ndarray, depth: int) -> np.ndarray:
    shift = np.uint64(48 - FANOUT_BITS * (depth + 1))
    return ((turns >> shift) & np.uint64((1 << FANOUT_BITS) - 1)).astype(np.int64)


def leaves(node: Counter | list | None) -> Iterator[Counter]:
    if isinstance(node, list):
        for child in node:
            yield from leaves(child)
    elif node:
        yield node


def to_run(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """A run in few bytes: steps between keys, and counts, byte by byte of all numbers."""
    import zstandard

    steps = np.diff(keys, prepend=np.int64(0))
    planes = np.concatenate([steps, counts]).view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def from_run(run: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(run), np.uint8).reshape(8, -1)
    both = np.ascontiguousarray(planes.T).view(np.int64).reshape(-1)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


def merged_runs(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Runs as one, the counts of equal keys summed."""
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(all_keys, kind="stable")  # merges stretches that are in order
    all_keys, all_counts = all_keys[order], all_counts[order]
    first = np.flatnonzero(np.diff(all_keys, prepend=all_keys[0] - 1 if len(all_keys) else 0))
    return all_keys[first], np.add.reduceat(all_counts, first) if len(first) else all_counts


def prefixes(numbers: np.ndarray, tables: list[HashTable]) -> np.ndarray:
    """At each place the number of the frequent phrase that starts there, or a break.

    Its length is one more than the number of tables, which number phrases of 2, 3.. words.
    """
    found = numbers.astype(np.int64)
    for length, table in enumerate(tables, start=2):
        keys, at = extended(found, numbers, length)
        found = np.full(len(found), BREAK, np.int64)
        distinct, back = np.unique(keys, return_inverse=True)
        found[at] = table.look_up(distinct)[0][back]
    return found


def extended(found: np.ndarray, numbers: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the phrases of a length both of whose shorter phrases are frequent, and their
    places. `found` has the numbers of the phrases that are one word shorter."""
    at = np.flatnonzero((found[:-1] >= 0) & (found[1:] >= 0))
    return found[at] << PLACE | numbers[at + length - 1], at


def frequent(rows: DataFrame, tables: list[HashTable], subtrees: int, least: int) -> DataFrame:
    """(key, n) of the phrases one word longer than those of the last table that occur at
    least `least` times."""
    length = len(tables) + 2

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = Trie(subtrees)
        for batch in batches:
            for row in batch["numbers"]:
                numbers = np.frombuffer(row, np.int32)
                for at in range(0, len(numbers), AT_ONCE):
                    # Phrases that start in this stretch; they may end in the next.
                    part = numbers[at : at + AT_ONCE + length - 1]
                    found = prefixes(part, tables)
                    keys, places = extended(found, part, length)
                    trie.add(keys[places < AT_ONCE])
                    if trie.size > MOST_ENTRIES:
                        yield runs(trie.spilled(MOST_ENTRIES // 2))
        yield runs(trie.spilled(0))

    def runs(spilled) -> pd.DataFrame:
        made = [(subtree, to_run(keys, counts)) for subtree, keys, counts in spilled]
        return pd.DataFrame(made, columns=["subtree", "run"])

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, keys, counts, size = None, [], [], 0
        for batch in batches:
            for subtree, run in zip(batch["subtree"], batch["run"], strict=True):
                if subtree != last and keys:
                    yield enough(keys, counts)
                    keys, counts, size = [], [], 0
                last = subtree
                more_keys, more_counts = from_run(run)
                keys.append(more_keys)
                counts.append(more_counts)
                size += len(more_keys)
                if size > 4 * AT_ONCE:
                    one = merged_runs(keys, counts)
                    keys, counts, size = [one[0]], [one[1]], 0
        if keys:
            yield enough(keys, counts)

    def enough(keys: list[np.ndarray], counts: list[np.ndarray]) -> pd.DataFrame:
        all_keys, n = merged_runs(keys, counts)
        return pd.DataFrame({"key": all_keys[n >= least], "n": n[n >= least]})

    spark = rows.sparkSession
    with python_batches(spark, 4):
        spilled = rows.mapInPandas(count, "subtree bigint, run binary")
        dealt = spilled.repartition("subtree").sortWithinPartitions("subtree")
        return stored(dealt.mapInPandas(merge, "key bigint, n bigint"), f"phrases{length}")


def numbered(rows: DataFrame, table: HashTable) -> DataFrame:
    """Add the `number` of each row's key."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(number=table.look_up(batch["key"].to_numpy(np.int64))[0])

    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.mapInPandas(add, f"{kinds}, number bigint")


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST_COUNT) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases (lang, phrase, words, n) of one to `longest` words, where `words` is
    their number, and (lang, n) with all words counted."""
    docs = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    with python_batches(docs.sparkSession):
        words = word_counts(docs)
    sizes = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    subtrees = max(LEAST_SUBTREES, -(-total // WORDS_PER_SUBTREE))

    keys = stored(keyed_words(words.where(F.col("n") >= least)), "keys")
    table = hash_table(keys)
    level = numbered(keys, table).select("lang", F.col("word").alias("phrase"), "n", "number")
    level = stored(level, "phrases1")
    last_words = level.select(F.col("number").alias("last"), F.col("phrase").alias("word"))
    found = level.select("lang", "phrase", F.lit(1).alias("words"), "n")
    with python_batches(docs.sparkSession):
        rows = sequences(docs, table)

    tables: list[HashTable] = []
    for length in range(2, longest + 1):
        counts = frequent(rows, tables, subtrees, least)
        tables.append(hash_table(counts))
        if not tables[-1].n_keys:
            break
        shorter = level.select(F.col("number").alias("first"), "lang", "phrase")
        level = stored(
            numbered(counts, tables[-1])
            .withColumn("first", F.shiftright("key", PLACE))
            .withColumn("last", F.col("key").bitwiseAND(F.lit((1 << PLACE) - 1)))
            .join(shorter, "first")
            .join(last_words, "last")
            .select("lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), "n", "number"),
            "phrases",
        )
        found = found.union(level.select("lang", "phrase", F.lit(length).alias("words"), "n"))
    return stored(found, "found"), sizes


def scored(phrases: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every phrase of two or more words with its lowest-scoring cut."""
    parts = F.split("phrase", " ")
    cut = F.col("cut")
    cuts = phrases.where("words > 1").select(
        "lang", "phrase", "words", F.col("n").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"),
    ).select(
        "*",
        F.array_join(F.slice(parts, F.lit(1), cut), " ").alias("left"),
        F.array_join(F.slice(parts, cut + 1, F.col("words") - cut), " ").alias("right"),
    )
    side = lambda name, count: phrases.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    # Exact in 128 bits: counts have up to 16 digits in the first product, 18 in the second.
    score = """cast(cast(1000 AS decimal(4)) * cast(a AS decimal(16)) * cast(n AS decimal(16))
                    div (cast(l AS decimal(18)) * cast(r AS decimal(18))) AS bigint)"""
    with_counts = (
        cuts.join(side("left", "l"), ["lang", "left"])
        .join(side("right", "r"), ["lang", "right"])
        .join(sizes, "lang")
        .withColumn("score", F.expr(score))
    )
    lowest = F.min(F.struct("score", "cut", "l", "r")).alias("low")
    return with_counts.groupBy("lang", "phrase", "words", "a", "n").agg(lowest).select(
        "lang", "phrase", "words", "a", "n", "low.l", "low.r", "low.score"
    )


def inside_longer(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, n): phrases that are part of one with a word more, and its count.

    A longer phrase still that occurs as often has one between it that does, too.
    """
    parts, words = F.split("phrase", " "), F.col("words")
    both = F.array(F.slice(parts, F.lit(1), words - 1), F.slice(parts, F.lit(2), words - 1))
    return (
        phrases.where("words > 2")
        .select("lang", F.explode(both).alias("part"), "n")
        .groupBy("lang", F.array_join("part", " ").alias("phrase"))
        .agg(F.max("n").alias("longer"))
    )


def mine_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST_COUNT, shown: int = SHOWN) -> DataFrame:
    """Each language's `shown` best phrases: (lang, rank, phrase, a, l, r, n, score).

    Texts are lower-cased (A-Z only), split into pieces at `.,;:!?` and line ends, and these
    into words at spaces and tabs. A phrase is two to `longest` words in a row within a piece
    that occurs a >= `least` times, overlaps included. Cut in two whose counts are l and r, it
    scores floor(1000 * a * n / (l * r)), n being all words of the language; the lowest cut
    counts, on a tie the one with the shorter first part. Phrases that occur as often within a
    longer one are left out. Ranks go by score, then count, descending, then phrase in byte
    order.

    Null, empty and blank texts have no words. A null language is `und`. Repeated rows count
    each, as do null and repeated ids, which are not read. Very long texts are read whole; an
    empty table, or one where nothing is frequent, gives no rows. Other columns, whatever their
    names, are not returned. Words are told apart by 64-bit hashes; counts are exact.
    """
    phrases, sizes = phrase_counts(docs, longest, least)
    best = scored(phrases, sizes).join(inside_longer(phrases), ["lang", "phrase"], "left")
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        best.where("longer IS NULL OR longer < a")
        .withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= shown)
        .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
