"""Documents into shards of nearly equal bytes, with equal texts kept together.

Longest-processing-time scheduling: groups sorted by size, each to the shard that has
the least so far, found by a heap. The heap runs on the driver over a number of items
that depends on the number of shards alone. Groups of at least total / (64 * shards)
bytes, of which there are 64 * shards at most, are items themselves. All others are
gathered by a hash of their text into bundles: seven eighths of the hash values into 48
coarse bundles per shard, one eighth into 128 fine ones, which come last and level out
what the coarse ones have left uneven.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgepulse.llm.common import stored

LARGE, COARSE, FINE = 64, 48, 128
OVERHEAD = 16
ROWS_PER_SLOT_TASK = 50_000


def least_loaded(items: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """The shard of each (size, name), longest first; ties go by name and lower shard."""
    heap = [(0, shard) for shard in range(shards)]
    chosen = {}
    for size, name in sorted(items, key=lambda x: (-x[0], str(x[1]))):
        load, shard = heapq.heappop(heap)
        chosen[name] = shard
        heapq.heappush(heap, (load + size, shard))
    return chosen


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row of `docs`.

    Size is the UTF-8 length of the text and 16. A null text counts as empty, and all
    these are one group. Rows that repeat get slots of their own. One group larger than
    an even share makes its shard that much larger, as it must stay together. Slots of a
    shard run from 0 without a gap. No documents give no rows; other columns are left out.
    """
    text = F.coalesce("text", F.lit(""))
    h1, h2 = F.xxhash64(text), F.xxhash64(F.lit(7), text)
    share = F.pmod(F.xxhash64(F.lit(11), h2), F.lit(8))
    place = F.xxhash64(F.lit(13), h2)
    bundle = F.when(share < 7, F.pmod(place, F.lit(COARSE * shards))).otherwise(
        COARSE * shards + F.pmod(place, F.lit(FINE * shards))
    )
    rows = stored(
        docs.select(
            "doc_id", (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"), h1.alias("h1"), h2.alias("h2"), bundle.alias("bundle"),
        ),
        "sizes",
    )
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    groups = stored(rows.groupBy("h1", "h2", "bundle").agg(F.sum("size").alias("size")), "groups")
    is_large = F.col("size") * (LARGE * shards) >= (total or 0)
    large = groups.where(is_large).select("h1", "h2", "size").collect()
    bundles = groups.where(~is_large).groupBy("bundle").agg(F.sum("size").alias("size")).collect()
    chosen = least_loaded(
        [(r["size"], (r["h1"], r["h2"])) for r in large] + [(r["size"], r["bundle"]) for r in bundles], shards
    )
    spark = docs.sparkSession
    # At most (LARGE + COARSE + FINE) rows per shard in both together.
    of_group = spark.createDataFrame(
        [(*k, s) for k, s in chosen.items() if isinstance(k, tuple)], "h1 bigint, h2 bigint, group_shard int"
    )
    of_bundle = spark.createDataFrame(
        [(k, s) for k, s in chosen.items() if not isinstance(k, tuple)], "bundle bigint, bundle_shard int"
    )
    dealt = (
        rows.join(F.broadcast(of_group), ["h1", "h2"], "left")
        .join(F.broadcast(of_bundle), "bundle", "left")
        .withColumn("shard", F.coalesce("group_shard", "bundle_shard"))
    )
    return with_slots(dealt, -(-(count or 0) // (shards * ROWS_PER_SLOT_TASK)) or 1).select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )


def with_slots(dealt: DataFrame, parts: int) -> DataFrame:
    """Number the rows of each shard, by parts of a shard so that no task gets a whole one."""
    split = dealt.withColumn("part", F.pmod(F.xxhash64("doc_id", "h1"), F.lit(parts)))
    counts = split.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part")
    starts = counts.withColumn("start", F.sum("n").over(before) - F.col("n")).drop("n")
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "h1", "h2")
    numbered = split.withColumn("nth", F.row_number().over(within))
    return numbered.join(starts, ["shard", "part"]).withColumn("slot", F.col("start") + F.col("nth") - 1)
