"""Where two tokenizers agree: groups, links and corpus-wide link counts.

A text with a space before it is cut into units, each a space and what follows up to the next
space that has no white space before it. Neither vocabulary joins across such a place, so a
text's tokens are those of its units, in order, and both tokenizers end a token at each cut.
Units repeat; a worker aligns a unit once and remembers it, up to a bound. Beyond it the units
met most stay, so that frequent ones are not aligned again.

The corpus is read twice. The first pass counts linked pairs per task. The distinct pairs get
a minimal perfect hash, and the counts are summed as dense vectors that it indexes. The second
pass aligns the documents again and looks the counts up; keys are compared, so no pair takes
another's count.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.common import python_batches, stored, uncollected
from forgepulse.llm.perfect_hash import HashTable, dense_counts, hash_table

# Units a worker remembers, and characters of all of them.
MOST_UNITS, MOST_CHARS = 300_000, 4_000_000
# Units that are tokenized in one text.
JOINED = 500
# Texts handed to a worker at a time; Arrow's bound on bytes holds as well.
DOCS_AT_ONCE = 1000
PLACE = 32

FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
CUT = re.compile(r"(?<=\S) ")
UNSURE = re.compile(r"\s ")


def vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def units_of(text: str) -> list[str]:
    """The units of a text, each without its leading space."""
    if text.startswith(" ") or UNSURE.search(text):
        return CUT.split(text)
    return text.split(" ")


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable bytes as
    themselves, the others as the letters from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def runs_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of these lengths, laid end to end, start and end."""
    ends = np.cumsum(counts)
    return ends - counts, ends


class Aligner:
    """Tokens of both vocabularies, and units as they have been aligned."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        self.a_bytes = {
            i: bytes(letters[c] for c in entry) if all(c in letters for c in entry) else b""
            for entry, i in self.a.get_vocab().items()
        }
        self.b = SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.space = self.b.piece_to_id("▁")
        self.a_sizes = np.zeros(self.a.get_vocab_size(), np.int64)
        for i, entry in self.a_bytes.items():
            self.a_sizes[i] = len(entry)
        self.b_sizes = np.fromiter(map(len, self.b_bytes), np.int64, len(self.b_bytes))
        self.names = np.array([str(i) for i in range(max(len(self.a_sizes), len(self.b_sizes)))], object)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.chars = 0
        self.valid = np.zeros(0, bool)
        # How often each unit was met, halved whenever others are forgotten.
        self.uses = np.zeros(0, np.int64)
        self.figures = np.zeros((0, len(FIGURES)), np.int64)
        self.pairs, self.pairs_of = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def full(self) -> bool:
        return len(self.known) > MOST_UNITS or self.chars > MOST_CHARS

    def thin(self) -> None:
        """Forget all units but those met most: half of the bounds at most, none met once."""
        units = list(self.known)
        order = np.argsort(-self.uses, kind="stable")[: MOST_UNITS // 2]
        order = order[self.uses[order] > 1]
        chars = np.cumsum(np.fromiter((len(units[k]) for k in order), np.int64, len(order)))
        keep = np.sort(order[chars <= MOST_CHARS // 2])
        self.known = {units[k]: at for at, k in enumerate(keep)}
        self.chars = sum(map(len, self.known))
        self.groups = [self.groups[k] for k in keep] if self.groups else []
        place = np.full(len(units), -1, np.int64)
        place[keep] = np.arange(len(keep))
        of = place[self.pairs_of]
        self.pairs, self.pairs_of = self.pairs[of >= 0], of[of >= 0]
        self.valid, self.figures, self.uses = self.valid[keep], self.figures[keep], self.uses[keep] // 2

    def places(self, texts: list[list[str]], table: HashTable | None) -> list[np.ndarray]:
        """The number of each unit of each text; new units are aligned first. With a table
        units are scored and their groups kept, without one their pairs are."""
        new = list(set().union(*texts).difference(self.known))
        with uncollected():
            for at in range(0, len(new), 20_000):
                self.learn(new[at : at + 20_000], table)
        found = [np.fromiter(map(self.known.__getitem__, units), np.int64, len(units)) for units in texts]
        if found:
            self.uses += np.bincount(np.concatenate(found), minlength=len(self.uses))
        return found

    def learn(self, units: list[str], table: HashTable | None) -> None:
        """Align units, all at once, as tokens laid out over one stretch of bytes."""
        first = len(self.figures)
        self.known |= {u: first + k for k, u in enumerate(units)}
        self.chars += sum(map(len, units))
        wholes = [(" " + u).encode("utf-8", "surrogatepass") for u in units]
        a_ids = self.a_tokens(units, wholes)
        b_ids = [ids or [self.space] for ids in self.b.encode(units, num_threads=1)]
        valid = self.faithful(wholes, a_ids, b_ids)
        if not valid.all():
            none: list[int] = []
            a_ids, b_ids = ([i if ok else none for i, ok in zip(x, valid, strict=True)] for x in (a_ids, b_ids))
            wholes = [w if ok else b"" for w, ok in zip(wholes, valid, strict=True)]
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (a_ids, b_ids))
        n_a, n_b, size = (np.fromiter(map(len, x), np.int64, len(units)) for x in (a_ids, b_ids, wholes))
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        total = int(size.sum())
        ends_a, ends_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        ends_a[a_ends] = ends_b[b_ends] = True
        # Between two ends next to each other lies what one token of either side shares.
        ends = np.flatnonzero(ends_a | ends_b)
        pairs = a[np.searchsorted(a_ends, ends)] << PLACE | b[np.searchsorted(b_ends, ends)]
        unit_ends = np.cumsum(size)
        cuts = np.flatnonzero(ends_a & ends_b)
        per_unit = lambda at: np.bincount(np.searchsorted(unit_ends, at), minlength=len(units))
        n_links, n_groups = per_unit(ends), per_unit(cuts)
        figures = np.zeros((len(units), len(FIGURES)), np.int64)
        figures[:, :4] = np.stack([n_a, n_b, n_groups, n_links], axis=1)
        if table is None:
            self.pairs = np.concatenate([self.pairs, pairs])
            self.pairs_of = np.concatenate([self.pairs_of, np.repeat(np.arange(first, first + len(units)), n_links)])
        else:
            self.groups += self.listed(a, b, np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends), n_a + n_b)
            best, counts = self.score(pairs, table)
            starts, stops = runs_of(n_links)
            for column, values in ((4, best), (5, counts)):
                sums = np.concatenate([[0], np.cumsum(values)])
                figures[:, column] = sums[stops] - sums[starts]
        self.figures = np.concatenate([self.figures, figures])
        self.valid = np.concatenate([self.valid, valid])
        self.uses = np.concatenate([self.uses, np.zeros(len(units), np.int64)])

    def a_tokens(self, units: list[str], wholes: list[bytes]) -> list[list[int]]:
        """The A ids of each unit. Units that end in a letter or sign are joined to longer texts,
        which the tokenizer is asked for at once and which are cut where units end; a text
        without a token's end at each of them is tokenized unit by unit, as all other units are."""
        encode = lambda texts: [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        out: list[list[int]] = [[]] * len(units)
        open_ended = [k for k, u in enumerate(units) if u[-1:].strip()]
        alone = [k for k, u in enumerate(units) if not u[-1:].strip()]
        parts = [open_ended[at : at + JOINED] for at in range(0, len(open_ended), JOINED)]
        for part, ids in zip(parts, encode(["".join([" " + units[k] for k in part]) for part in parts]), strict=True):
            ends = np.cumsum(self.a_sizes[ids])
            wanted = np.cumsum([len(wholes[k]) for k in part])
            stops = np.searchsorted(ends, wanted) + 1
            if len(ids) and stops[-1] == len(ids) and (ends[stops - 1] == wanted).all():
                start = 0
                for k, stop in zip(part, stops.tolist(), strict=True):
                    out[k], start = ids[start:stop], stop
            else:
                alone += part
        for k, ids in zip(alone, encode([" " + units[k] for k in alone]), strict=True):
            out[k] = ids
        return out

    def faithful(self, wholes: list[bytes], a_ids: list[list[int]], b_ids: list[list[int]]) -> np.ndarray:
        """Whether both vocabularies give each unit back byte by byte."""
        size = np.fromiter(map(len, wholes), np.int64, len(wholes))
        valid = np.ones(len(wholes), bool)
        sides = ((a_ids, self.a_bytes, self.a_sizes), (b_ids, self.b_bytes, self.b_sizes))
        for ids, _, sizes in sides:
            ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
            bytes_to = np.concatenate([[0], np.cumsum(sizes[np.fromiter(chain.from_iterable(ids), np.int64)])])
            valid &= np.diff(bytes_to[ends], prepend=0) == size
        # Units of the right length, laid end to end: a byte that differs tells its unit.
        for ids, entries, _ in sides:
            rows = np.flatnonzero(valid)
            given = b"".join(map(entries.__getitem__, chain.from_iterable(compress(ids, valid))))
            wanted = b"".join(compress(wholes, valid))
            if given != wanted:
                wrong = np.flatnonzero(np.frombuffer(given, np.uint8) != np.frombuffer(wanted, np.uint8))
                valid[rows[np.searchsorted(np.cumsum(size[rows]), wrong, side="right")]] = False
        return valid

    def listed(
        self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, counts: np.ndarray
    ) -> list[str]:
        """The groups of each unit as text, each ending in a semicolon."""
        groups = int(a_group[-1]) + 1 if len(a_group) else 0
        a_in, b_in = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        a_at = np.arange(len(a)) + runs_of(b_in)[0][a_group]
        b_at = np.arange(len(b)) + runs_of(a_in)[1][b_group]
        out = np.empty((len(a) + len(b), 2), object)
        out[a_at, 0], out[b_at, 0] = self.names[a], self.names[b]
        out[:, 1] = ","
        out[a_at[runs_of(a_in)[1] - 1], 1] = "|"
        out[b_at[runs_of(b_in)[1] - 1], 1] = ";"
        parts = out.ravel().tolist()
        starts, stops = runs_of(counts)
        return ["".join(parts[2 * i : 2 * j]) for i, j in zip(starts.tolist(), stops.tolist(), strict=True)]

    def score(self, pairs: np.ndarray, table: HashTable) -> tuple[np.ndarray, np.ndarray]:
        """Whether each pair's count is the highest of its B id, and the count."""
        distinct, back = np.unique(pairs, return_inverse=True)
        counts = table.look_up(distinct)[1][:, 0][back]
        return (counts == self.best[pairs & ((1 << PLACE) - 1)]).astype(np.int64), counts


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str, use: str) -> Aligner:
    """One per worker and use, whose memory so serves all its tasks."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Aligner(a_path, b_path)


def pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(key, n): linked pairs of ids, a * 2^32 + b, and how many links have them, per task."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units = aligner(a_path, b_path, "count")
        times = np.zeros(len(units.figures), np.int64)
        for batch in batches:
            if units.full:
                yield linked(units, times)
                units.thin()
                times = np.zeros(len(units.figures), np.int64)
            texts = units.places([units_of(t) for t in batch["text"] if t], None)
            met = [places for places in texts if units.valid[places].all()]
            times = np.concatenate([times, np.zeros(len(units.figures) - len(times), np.int64)])
            if met:
                times += np.bincount(np.concatenate(met), minlength=len(times))
        yield linked(units, times)

    def linked(units: Aligner, times: np.ndarray) -> pd.DataFrame:
        n = times[units.pairs_of]
        keys, back = np.unique(units.pairs[n > 0], return_inverse=True)
        totals = np.zeros(len(keys), np.int64)
        np.add.at(totals, back, n[n > 0])
        return pd.DataFrame({"key": keys, "n": totals})

    with python_batches(docs.sparkSession, DOCS_AT_ONCE):
        return stored(docs.select("text").mapInPandas(count, "key bigint, n bigint"), "pairs")


def highest(table_rows: DataFrame, pieces: int) -> np.ndarray:
    """The highest count of each B id: one number per vocabulary entry."""
    b = F.col("key").bitwiseAND(F.lit((1 << PLACE) - 1)).alias("b")
    found = table_rows.groupBy(b).agg(F.max("n").alias("n")).collect()
    best = np.zeros(pieces, np.int64)
    best[[row.b for row in found]] = [row.n for row in found]
    return best


def counted_pairs(table: HashTable, spark) -> DataFrame:
    """(key, n) of every distinct pair, from the segments' files."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number in batch["id"]:
                if table.files[number] is not None:
                    segment = table.segment(int(number))
                    yield pd.DataFrame({"key": segment.keys, "n": segment.columns[:, 0]})

    segments = len(table.files)
    numbers = spark.range(0, segments, 1, min(segments, 200))
    return numbers.mapInPandas(read, "key bigint, n bigint")


def align_documents(
    docs: DataFrame, a_path: str | None = None, b_path: str | None = None, digest: bool = False
) -> DataFrame:
    """One row per row of `docs` (doc_id, text): its figures and its groups.

    n_a, n_b and n_groups count tokens of either vocabulary and the groups they form, n_links
    the pairs of tokens whose bytes overlap. An id pair's count is the number of links that
    hold it in the whole corpus: count_sum adds it up over the document's links, and n_best
    counts links whose count is the highest that any pair with the same B id has, ties
    included. `groups` lists the groups as `a1,a2|b1;a3|b2`; with `digest` it is the lowercase
    hex SHA-256 of that list, which is much shorter than the text, and stays empty without tokens.

    A text that is null or empty, or that either vocabulary does not give back byte by byte,
    has no tokens: zeros and an empty `groups`, and it adds to no count. Repeated rows and
    rows that share a doc_id, or have none, are counted and returned each. Very long texts
    are aligned whole, in memory in proportion to the text; an empty table returns no rows.
    Other columns, whatever their names, are not returned.
    """
    default = vocabularies()
    a_path, b_path = a_path or default[0], b_path or default[1]
    spark = docs.sparkSession
    partials = pair_counts(docs, a_path, b_path)
    table = dense_counts(partials, hash_table(partials.select("key").distinct()))
    best = highest(counted_pairs(table, spark), Aligner(a_path, b_path).b.get_piece_size())
    use = uuid.uuid4().hex

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units = aligner(a_path, b_path, use)
        units.best = best
        for batch in batches:
            if units.full:
                units.thin()
            split = [units_of(t) if t else [] for t in batch["text"]]
            figures, groups = np.zeros((len(split), len(FIGURES)), np.int64), []
            for k, places in enumerate(units.places(split, table)):
                if len(places) and units.valid[places].all():
                    figures[k] = units.figures[places].sum(axis=0)
                    listed = "".join(map(units.groups.__getitem__, places.tolist()))[:-1]
                    groups.append(hashlib.sha256(listed.encode()).hexdigest() if digest else listed)
                else:
                    groups.append("")
            out = pd.DataFrame(figures, columns=list(FIGURES))
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out.assign(groups=groups)

    kinds = "doc_id bigint, " + "".join(f"{name} bigint, " for name in FIGURES) + "groups string"
    with python_batches(spark, DOCS_AT_ONCE):
        return docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(score, kinds)
