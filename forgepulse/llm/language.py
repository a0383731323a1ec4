"""Language identification: known words first, then ever shorter character n-grams.

A word that was learned scores each language by its log frequency there. An unseen word is
scored by its character n-grams (with a space on either side of the word): by the longest
length of which any n-gram was learned. A text's score is the mean over its words.

Words are runs of letters and the marks that follow them, in lower case. Counts cover every
document that may be learned from; they are kept in a hash table on shared storage, of which
a task reads the segments it needs, so the vocabulary may outgrow a worker's memory. Words and
n-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.common import python_batches, stored
from forgepulse.llm.perfect_hash import HashTable, hash_table

FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
LONGEST = 5
# Added to each count, so that a language without the word is unlikely and not impossible.
SMOOTHING = 0.1
# A vector of counts has a place per language.
MOST_LANGUAGES = 1000
MOST_WORDS = 200_000
# N-grams a task counts before it hands them on.
MOST_GRAMS = 50_000
# Words a task counts before it hands them on.
MOST_COUNTED = 100_000

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def grams_of(word: str, length: int) -> list[str]:
    padded = f" {word} "
    return [padded[k : k + length] for k in range(len(padded) - length + 1)]


def key_of(length: int, gram: str) -> int:
    """Words have length 0; an n-gram and a word that look alike differ."""
    h = xxhash.xxh3_64_intdigest(gram.encode("utf-8", "surrogatepass"), seed=length)
    return h - (1 << 64) if h >> 63 else h


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; a null id is not, and is not learned from."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all words of `docs` (lang, text)."""

    def counting(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                seen[lang].update(words_of(text))
            if sum(map(len, seen.values())) > MOST_COUNTED:
                yield counted(seen)
                seen.clear()
        yield counted(seen)

    parts = docs.select("lang", "text").mapInPandas(counting, "lang string, word string, n bigint")
    return stored(parts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")


def counted(seen: dict[str, Counter]) -> pd.DataFrame:
    rows = [(lang, word, n) for lang, words in seen.items() for word, n in words.items()]
    return pd.DataFrame(rows, columns=["lang", "word", "n"]).astype({"n": "int64"})


def all_grams(word: str) -> list[str]:
    """The n-grams of every length, of which each has as many characters as its length says."""
    padded, size = f" {word} ", len(word) + 2
    return [padded[k : k + length] for length in range(1, min(LONGEST, size) + 1) for k in range(size - length + 1)]


def add_times(seen: Counter, grams: Counter, n: int) -> None:
    if n == 1:
        seen.update(grams)
    else:
        for gram, times in grams.items():
            seen[gram] += n * times


def hashed(seen: dict[str, Counter]) -> pd.DataFrame:
    grams = [g for counts in seen.values() for g in counts]
    return pd.DataFrame({
        "lang": np.repeat(np.array([*seen], object), [*map(len, seen.values())]),
        "length": np.fromiter(map(len, grams), np.int64, len(grams)),
        "key": np.fromiter((key_of(len(g), g) for g in grams), np.int64, len(grams)),
        "n": np.fromiter((n for counts in seen.values() for n in counts.values()), np.int64, len(grams)),
    })


def feature_counts(words: DataFrame) -> DataFrame:
    """(lang, length, key, n) of the words, at length 0, and of the n-grams of each."""

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            keys = [key_of(0, word) for word in batch["word"]]
            yield pd.DataFrame({"lang": batch["lang"], "length": 0, "key": keys, "n": batch["n"]})
            # Words as frequent as each other are counted together, once.
            for (lang, n), words in batch.groupby(["lang", "n"])["word"]:
                grams = Counter(chain.from_iterable(map(all_grams, words)))
                add_times(seen[lang], grams, int(n))
            if sum(map(len, seen.values())) > MOST_GRAMS:
                yield hashed(seen)
                seen.clear()
        yield hashed(seen)

    parts = words.mapInPandas(features, "lang string, length int, key bigint, n bigint")
    return stored(parts.groupBy("lang", "length", "key").agg(F.sum("n").alias("n")), "features")


class Model:
    """Counts per language of words and n-grams, looked up by key."""

    def __init__(self, languages: list[str], totals: np.ndarray, table: HashTable):
        self.languages, self.totals, self.table = languages, totals, table
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(languages)))
        self.scored = np.zeros(0, bool)

    def __getstate__(self):
        return self.languages, self.totals, self.table

    def __setstate__(self, state):
        self.__init__(*state)

    def logs(self, keys: list[int], length: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key was learned, and its log frequency in each language."""
        slots, counts = self.table.look_up(np.array(keys, np.int64))
        return slots >= 0, np.log((counts + SMOOTHING) / (self.totals[length] + SMOOTHING))

    def learn(self, words: list[str]) -> None:
        """Score words not met before in this task."""
        if len(self.known) > MOST_WORDS:
            self.__init__(self.languages, self.totals, self.table)
        words = list(set(words).difference(self.known))
        if not words:
            return
        scored, scores = self.logs([key_of(0, w) for w in words], 0)
        for length in range(LONGEST, 0, -1):
            unseen = np.flatnonzero(~scored)
            grams = [grams_of(words[k], length) for k in unseen]
            if not any(grams):
                continue
            known, logs = self.logs([key_of(length, g) for gs in grams for g in gs], length)
            word = np.repeat(unseen, [len(gs) for gs in grams])[known]
            times = np.bincount(word, minlength=len(words))
            total = np.zeros_like(scores)
            np.add.at(total, word, logs[known])
            found = times > 0
            scores[found] = total[found] / times[found, None]
            scored |= found
        first = len(self.scores)
        self.known |= {w: first + k for k, w in enumerate(words)}
        self.scores = np.concatenate([self.scores, scores])
        self.scored = np.concatenate([self.scored, scored])

    def predict(self, words: list[str]) -> tuple[str, float]:
        """The likeliest language, the first in order on a tie, and its share."""
        if not words or not self.languages:
            return UNKNOWN, 0.0
        places = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        places = places[self.scored[places]]
        if len(places):
            mean = self.scores[places].mean(axis=0)
        else:
            mean = np.log(self.totals[0] + SMOOTHING) - np.log(self.totals[0].sum() + SMOOTHING)
        share = np.exp(mean - mean.max())
        best = int(mean.argmax())
        return self.languages[best], float(share[best] / share.sum())


def learned(docs: DataFrame) -> Model:
    """A model of every row of `docs` (lang, text) that has both."""
    spark = docs.sparkSession
    with python_batches(spark):
        words = word_counts(docs.where("lang IS NOT NULL AND text IS NOT NULL"))
    with python_batches(spark, 5000):
        features = feature_counts(words)
    sums = features.groupBy("lang", "length").agg(F.sum("n").alias("n"))
    languages = [row.lang for row in sums.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    totals = np.zeros((LONGEST + 1, len(languages)))
    for row in sums.collect():  # a row per language and length
        totals[row.length, languages.index(row.lang)] = row.n
    columns = [f"n{k}" for k in range(len(languages))]
    per_key = features.groupBy("key").agg(
        *(
            F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("n"))), F.lit(0)).alias(c)
            for c, lang in zip(columns, languages, strict=True)
        ),
        F.lit(0).alias("none"),
    )
    return Model(languages, totals, hash_table(per_key, columns))


def identify_languages(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text, lang): (doc_id, held_out, lang_pred, score).

    Learns from the text and lang of documents whose fold, crc32 of the doc_id as text modulo
    4, is not 2; only the text enters a prediction. `score` is the share of the predicted
    language when mean log frequencies are turned into shares, so it is 1 / languages at least.

    A null text, or one without a letter, is `und` with score 0; so is every text when nothing
    could be learned. A text none of whose n-grams was learned gets the language with the most
    words. Ties go to the first language in order. Repeated rows are predicted and learned from
    each; a null doc_id is neither held out nor learned from, a null text or lang not learned
    from. Very long texts are read whole, an empty table returns no rows, and other columns,
    whatever their names, are not returned. More than 1,000 languages are an error.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = learned(rows.where("NOT held_out AND doc_id IS NOT NULL"))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            split = list(map(words_of, batch["text"]))
            model.learn([w for words in split for w in words])
            found = list(map(model.predict, split))
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].array, "held_out": batch["held_out"].array,
                "lang_pred": [lang for lang, _ in found], "score": [score for _, score in found],
            })

    kinds = "doc_id bigint, held_out boolean, lang_pred string, score double"
    with python_batches(docs.sparkSession):
        return rows.select("doc_id", "text", "held_out").mapInPandas(predict, kinds)
