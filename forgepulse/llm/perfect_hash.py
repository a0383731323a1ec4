"""Tables on shared storage, addressed by a minimal perfect hash of 64-bit keys.

Keys are dealt into segments of some 30,000 by a hash. A segment's function is a cascade of
bit arrays: in each, a key marks one bit, bits that several keys want stay clear, and those
keys go on to the next, smaller array. A key's slot is the number of set bits before its own,
so n keys have the slots 0 to n - 1, and a segment's first slot is the number of keys in the
segments before it. The keys themselves are kept in slot order, so a key that was never added
is told apart from one that was.

A segment is a file with its function, keys and any dense columns. Tasks read the segments
they look into, hold a bounded number of them, and share nothing else; the driver knows one
row per segment. A table may so have any size.
"""

from __future__ import annotations

import io
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.common import stored
from forgepulse.llm.files import opened
from forgepulse.llm.minhash import MIX, mixed
from forgepulse.session import scratch_path

SEGMENT_KEYS = 30_000
# Segments a worker holds at once; a segment with one column takes about 1 MB.
MOST_SEGMENTS = 128
# Bits per key and level: more make the cascade shorter and the arrays larger.
GAMMA = 2


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    return (mixed(keys.view(np.uint64)) % np.uint64(segments)).astype(np.int64)


def bit_of(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """The bit each key wants in an array of a level."""
    with np.errstate(over="ignore"):
        seed = MIX * np.uint64(2 * level + 3)
    return (mixed(keys.view(np.uint64) ^ seed) % np.uint64(size)).astype(np.int64)


def narrow(columns: np.ndarray) -> np.ndarray:
    """The same whole numbers in half the bytes, if they all fit."""
    fits = np.iinfo(np.int32)
    small = columns.size and fits.min <= columns.min() and columns.max() <= fits.max
    return columns.astype(np.int32) if small else columns


class Segment:
    """The function, keys and columns of one segment."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, keys: np.ndarray, columns: np.ndarray):
        self.sizes, self.bits, self.keys, self.columns = sizes, bits, keys, columns
        # Held for many segments at once, so in as few bytes as its numbers need.
        self.rank = np.cumsum(bits, dtype=np.uint16 if len(keys) < 1 << 16 else np.int32) - bits

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Segment:
        """For distinct keys and a row of values for each."""
        sizes, arrays, rest = [], [], keys
        while len(rest):
            size = GAMMA * len(rest) + 1
            wanted = bit_of(rest, len(sizes), size)
            times = np.bincount(wanted, minlength=size)
            sizes.append(size)
            arrays.append((times == 1).astype(np.uint8))
            rest = rest[times[wanted] > 1]
        bits = np.concatenate([*arrays, np.zeros(0, np.uint8)])
        made = cls(np.array(sizes, np.int64), bits, np.zeros(len(keys), np.int64), np.zeros((len(keys), 0)))
        slots = made.slots(keys)
        order = np.empty(len(keys), np.int64)
        order[slots] = np.arange(len(keys))
        made.keys, made.columns = keys[order], values[order]
        return made

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key that was added; of others any slot, or -1."""
        found, open_, before = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = before + bit_of(keys[open_], level, size)
            hit = self.bits[at] == 1
            found[open_[hit]] = self.rank[at[hit]]
            open_, before = open_[~hit], before + size
            if not len(open_):
                break
        return found

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that were not added."""
        slots = self.slots(keys)
        if len(self.keys):
            slots[self.keys[slots] != keys] = -1
        return slots

    def write(self, path: str) -> None:
        out = io.BytesIO()
        np.savez(out, sizes=self.sizes, bits=np.packbits(self.bits), keys=self.keys, columns=narrow(self.columns))
        with opened(path, "wb") as file:
            file.write(out.getvalue())

    @classmethod
    def read(cls, path: str) -> Segment:
        with opened(path, "rb") as file:
            parts = np.load(io.BytesIO(file.read()))
        sizes = parts["sizes"]
        bits = np.unpackbits(parts["bits"], count=int(sizes.sum()))
        return cls(sizes, bits, parts["keys"], parts["columns"])


@dataclass
class HashTable:
    """What a task needs to look keys up: the segments' files and their first slots."""

    files: list[str | None]
    firsts: list[int]
    width: int
    n_keys: int
    held: OrderedDict = field(default_factory=OrderedDict)

    def __getstate__(self):
        return {**self.__dict__, "held": OrderedDict()}

    def segment(self, number: int) -> Segment:
        if number in self.held:
            self.held.move_to_end(number)
        else:
            if len(self.held) >= MOST_SEGMENTS:
                self.held.popitem(last=False)
            self.held[number] = Segment.read(self.files[number])
        return self.held[number]

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each key, -1 where unknown, and its row of values, then zeros."""
        slots = np.full(len(keys), -1, np.int64)
        values = np.zeros((len(keys), self.width), np.int64)
        if not len(keys) or not self.n_keys:
            return slots, values
        numbers = segment_of(keys, len(self.files))
        order = np.argsort(numbers, kind="stable")
        ends = np.cumsum(np.bincount(numbers, minlength=len(self.files)))
        for number in np.unique(numbers):
            if self.files[number] is None:
                continue
            mine = order[ends[number - 1] if number else 0 : ends[number]]
            segment = self.segment(int(number))
            found = segment.find(keys[mine])
            known = found >= 0
            slots[mine[known]] = found[known] + self.firsts[number]
            if self.width:
                values[mine[known]] = segment.columns[found[known]]
        return slots, values


def with_segment(rows: DataFrame, segments: int) -> DataFrame:
    """Add the number of the segment that each row's `key` belongs to."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(segment=segment_of(batch["key"].to_numpy(np.int64), segments))

    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.mapInPandas(add, f"{kinds}, segment bigint")


def table_of(manifest: DataFrame, segments: int, width: int) -> HashTable:
    """The table that a manifest (segment, file, n) describes: a row per segment."""
    files: list[str | None] = [None] * segments
    counts = [0] * segments
    for row in manifest.collect():
        files[row.segment], counts[row.segment] = row.file, row.n
    ends = np.cumsum(counts)
    return HashTable(files, [int(e) - n for e, n in zip(ends, counts, strict=True)], width, int(sum(counts)))


def hash_table(rows: DataFrame, columns: list[str] = (), segment_keys: int = SEGMENT_KEYS) -> HashTable:
    """A table of the distinct, non-null `key`s (bigint) of `rows` and their columns (bigint).

    An empty input makes a table that knows no key. No task holds more than the keys of one
    segment. A task writes under a name of its own, and only finished tasks' files count.
    """
    columns, spark = list(columns), rows.sparkSession
    segments = max(1, -(-rows.count() // segment_keys))
    path = scratch_path(spark, "hashed")

    def build(group: pd.DataFrame) -> pd.DataFrame:
        number = int(group["segment"].iloc[0])
        file = f"{path}/{number}-{uuid.uuid4().hex}"
        Segment.of(group["key"].to_numpy(np.int64), group[columns].to_numpy(np.int64)).write(file)
        return pd.DataFrame({"segment": [number], "file": [file], "n": [len(group)]})

    dealt = with_segment(rows.select("key", *columns), segments).groupBy("segment")
    manifest = stored(dealt.applyInPandas(build, "segment bigint, file string, n bigint"), "manifest")
    return table_of(manifest, segments, len(columns))


def dense_counts(partials: DataFrame, table: HashTable) -> HashTable:
    """The same table with one column: the sum of `n` over the rows (key, n) of each key.

    Each task adds its rows up in a dense vector per segment, indexed by the hash. Vectors of
    a segment are then summed in two steps, a few of them per task first, so neither a hot key
    nor a segment that every task has seen goes to one task unsummed.
    """
    spark, path, segments = partials.sparkSession, scratch_path(partials.sparkSession, "counted"), len(table.files)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors: OrderedDict[int, np.ndarray] = OrderedDict()
        for batch in batches:
            keys, n = batch["key"].to_numpy(np.int64), batch["n"].to_numpy(np.int64)
            numbers = segment_of(keys, segments)
            order = np.argsort(numbers, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(numbers[order])) + 1):
                if not len(part):
                    continue
                number = int(numbers[part[0]])
                segment = table.segment(number)
                if number not in vectors:
                    if len(vectors) >= MOST_SEGMENTS:
                        yield packed(*vectors.popitem(last=False))
                    vectors[number] = np.zeros(len(segment.keys), np.int64)
                vectors.move_to_end(number)
                np.add.at(vectors[number], segment.find(keys[part]), n[part])
        for item in vectors.items():
            yield packed(*item)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, total = None, None
        for batch in batches:
            for number, vector in zip(batch["segment"], batch["vector"], strict=True):
                if number != last and last is not None:
                    yield packed(last, total)
                vector = unpacked(vector)
                total = total + vector if number == last else vector
                last = number
        if last is not None:
            yield packed(last, total)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in add_up(batches):
            for number, vector in zip(batch["segment"], batch["vector"], strict=True):
                old, file = Segment.read(table.files[number]), f"{path}/{number}-{uuid.uuid4().hex}"
                Segment(old.sizes, old.bits, old.keys, unpacked(vector)[:, None]).write(file)
                yield pd.DataFrame({"segment": [number], "file": [file], "n": [len(old.keys)]})

    kinds = "segment bigint, vector binary"
    leaves = partials.select("key", "n").mapInPandas(count, kinds).withColumn("branch", F.spark_partition_id() % 16)
    branches = leaves.repartition("segment", "branch").sortWithinPartitions("segment", "branch")
    sums = branches.select("segment", "vector").mapInPandas(add_up, kinds)
    last = sums.repartition("segment").sortWithinPartitions("segment")
    manifest = stored(last.mapInPandas(finish, "segment bigint, file string, n bigint"), "manifest")
    return table_of(manifest, segments, 1)


def packed(number: int, vector: np.ndarray) -> pd.DataFrame:
    import zstandard

    return pd.DataFrame({"segment": [number], "vector": [zstandard.compress(vector.tobytes(), 1)]})


def unpacked(vector: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.decompress(vector), np.int64)
