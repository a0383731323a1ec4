"""Pack documents into token sequences of fixed length, by hierarchical best fit.

Documents longer than a sequence are cut into full pieces and a rest. Each task packs
its pieces by best fit, longest first, and emits sequences that are nearly full. The
others go up a tree as items of their own: the underfull sequences of several tasks meet
in one, are packed again by best fit, and so on. The number of tasks of a level follows
from how many sequences are left, so no task ever gets more than `ITEMS` of them, and
the tree ends when one task has them all or when a level has joined none.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgepulse.llm.common import NODE, python_batches, stored, with_nodes
from forgepulse.llm.tokens import token_ids, vocabulary

SEQUENCE = 2048
END = 0
# A sequence that lacks fewer tokens than this is not worth another level.
NEARLY = 16
ITEMS = 100_000

PIECES = "node bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
BINS = "level int, part int, bin bigint, used int, members array<struct<node:bigint,piece:int,length:int,at:int>>"


def pieces(docs: DataFrame, path: str, limit: int = SEQUENCE, end: int = END) -> DataFrame:
    """Tokenize `docs` (node, text) and cut it: (node, piece, start, length, ids_crc32)."""
    tail = end.to_bytes(4, "little")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = token_ids(path)
        for batch in batches:
            out = []
            for node, text in zip(batch["node"], batch["text"], strict=True):
                ids = ids_of(text) + tail
                for k, at in enumerate(range(0, len(ids), 4 * limit)):
                    piece = ids[at : at + 4 * limit]
                    out.append((node, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
            yield pd.DataFrame(out, columns=["node", "piece", "start", "length", "ids_crc32"])

    return docs.select("node", "text").mapInPandas(cut, PIECES)


def best_fit(lengths: list[int], limit: int) -> list[list[int]]:
    """Bins of indices: longest first, each into the open bin it leaves the least room in."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms: list[int] = []  # sorted rooms that some bin has
    for i in order:
        at = bisect.bisect_left(rooms, lengths[i])
        if at == len(rooms):
            bins.append([i])
            b, room = len(bins) - 1, limit
        else:
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
            bins[b].append(i)
        left = room - lengths[i]
        if left:
            if not by_room[left]:
                bisect.insort(rooms, left)
            by_room[left].append(b)
    return bins


def packed(items: DataFrame, level: int, limit: int) -> DataFrame:
    """Best fit within each `part` of items (part, members, used)."""

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["node", "piece"], kind="stable").reset_index(drop=True)
        used, members = group["used"].tolist(), group["members"].tolist()
        out = []
        for b, chosen in enumerate(best_fit(used, limit)):
            placed, at = [], 0
            for m in (m for i in chosen for m in members[i]):
                placed.append({**m, "at": at})
                at += m["length"]
            out.append((level, key[0], b, at, placed))
        return pd.DataFrame(out, columns=["level", "part", "bin", "used", "members"])

    return items.groupBy("part").applyInPandas(pack, BINS)


def sequences(lengths: DataFrame, limit: int = SEQUENCE, per_task: int = ITEMS) -> DataFrame:
    """(node, piece, sequence_id, offset) of pieces (node, piece, length)."""
    full = lengths.where(F.col("length") == limit)
    member = F.struct("node", "piece", F.col("length").cast("int").alias("length"), F.lit(0).alias("at"))
    items = lengths.where(F.col("length") < limit).select(
        "node", "piece", F.col("length").cast("int").alias("used"), F.array(member).alias("members")
    )
    done, level, count, before = [], 0, items.count(), None
    while True:
        parts = max(1, -(-count // per_task))
        part = F.pmod(F.xxhash64(F.lit(level), "node", "piece"), F.lit(parts)).cast("int")
        bins = stored(packed(items.withColumn("part", part), level, limit), "bins")
        open_bins = bins.where(F.col("used") <= limit - NEARLY)
        left = open_bins.count()
        if parts == 1 or left in (0, before):
            done.append(bins)
            break
        done.append(bins.where(F.col("used") > limit - NEARLY))
        first = F.get("members", 0)
        items = open_bins.select(first["node"].alias("node"), first["piece"].alias("piece"), "used", "members")
        level, count, before = level + 1, left, left
    bins = done[0]
    for more in done[1:]:
        bins = bins.union(more)
    # The bin's number in the low 32 bits, then its part and its level.
    number = F.shiftleft(F.col("level").cast("bigint"), 55) + F.shiftleft(F.col("part").cast("bigint"), 32) + F.col("bin")
    placed = bins.select(number.alias("sequence_id"), F.explode("members").alias("m")).select(
        "m.node", "m.piece", "sequence_id", F.col("m.at").cast("bigint").alias("offset")
    )
    whole = F.monotonically_increasing_id()
    return placed.unionByName(
        stored(full.select("node", "piece"), "full").select(
            "node", "piece", (-1 - whole).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
        )
    )


def pack_documents(docs: DataFrame, path: str | None = None, limit: int = SEQUENCE) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    A document is its token ids and then id 0; a null or empty text is that id alone.
    Only documents longer than a sequence are cut. Every piece has a place, and the
    places of a sequence follow each other from 0 without a gap. Rows that share a
    doc_id, or have none, are packed as documents of their own. Without documents there
    are no rows. Other columns are left out.
    """
    rows, unique = with_nodes(docs.select("doc_id", "text"))
    rows = rows.withColumnRenamed(NODE, "node")
    with python_batches(docs.sparkSession):
        cut = stored(pieces(rows, path or vocabulary(), limit), "pieces")
    places = sequences(cut.select("node", "piece", "length"), limit)
    joined = cut.join(places.hint("merge"), ["node", "piece"])
    if unique:
        joined = joined.withColumnRenamed("node", "doc_id")
    else:
        joined = joined.join(rows.select("node", "doc_id"), "node")
    return joined.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
