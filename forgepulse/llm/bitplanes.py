"""Token ids in files of bit planes, with a chunk index, and back.

Ids are cut into blocks. A block is transposed: one plane holds the lowest bit of all
its ids, the next one the second bit, up to the highest bit that any id of the block
has. (With byte planes, bytes take the place of bits.) Each plane is compressed with
zstandard. A file is

    magic | planes of block 0 | planes of block 1 | ... | index | length of index | magic

and the index, compressed as well, lists for each block its place, its number of ids and
the sizes of its planes, and for each document its id and its number of ids. Files hold
documents in ascending order; the manifest, a table, puts the files in order.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forgepulse.llm.common import python_batches, stored
from forgepulse.llm.files import opened
from forgepulse.llm.tokens import token_ids, vocabulary
from forgepulse.session import scratch_path

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16
END = 1

MANIFEST = "file string, n_docs bigint, n_ids bigint, first_doc bigint, first_hash bigint"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def to_planes(ids: np.ndarray, kind: str = "bit") -> list[bytes]:
    """Planes of a block of unsigned 32-bit ids, lowest first."""
    cells = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    width = max(1, int(ids.max()).bit_length())
    cells = cells[:, : -(-width // 8)]
    if kind == "byte":
        return [np.ascontiguousarray(p).tobytes() for p in cells.T]
    bits = np.unpackbits(cells, axis=1, bitorder="little")[:, :width]
    return [p.tobytes() for p in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def from_planes(planes: list[bytes], count: int, kind: str = "bit") -> np.ndarray:
    stacked = np.frombuffer(b"".join(planes), np.uint8).reshape(len(planes), -1)
    if kind == "bit":
        bits = np.unpackbits(stacked, axis=1, count=count, bitorder="little")
        stacked = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").T
    cells = np.zeros((count, 4), np.uint8)
    cells[:, : len(stacked)] = stacked.T
    return cells.view("<u4").reshape(-1)


class Writer:
    """Blocks as they fill up, then the index."""

    def __init__(self, out, kind: str, level: int = 3):
        import zstandard

        self.out, self.kind = out, kind
        self.packer = zstandard.ZstdCompressor(level=level)
        self.waiting, self.size = [], 0
        self.blocks: list[list] = []
        self.docs: list[tuple] = []
        self.at = len(MAGIC)
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, len(ids) // 4))
        self.waiting.append(ids)
        self.size += len(ids)
        if self.size >= 4 * BLOCK:
            joined = b"".join(self.waiting)
            whole = len(joined) // (4 * BLOCK) * (4 * BLOCK)
            for at in range(0, whole, 4 * BLOCK):
                self.block(joined[at : at + 4 * BLOCK])
            self.waiting, self.size = [joined[whole:]], len(joined) - whole

    def block(self, ids: bytes) -> None:
        planes = [self.packer.compress(p) for p in to_planes(np.frombuffer(ids, "<u4"), self.kind)]
        self.blocks.append([self.at, len(ids) // 4, [len(p) for p in planes]])
        for p in planes:
            self.out.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.size:
            self.block(b"".join(self.waiting))
        index = {"kind": self.kind, "blocks": self.blocks, "docs": self.docs}
        packed = self.packer.compress(json.dumps(index).encode())
        self.out.write(packed + len(packed).to_bytes(8, "little") + MAGIC)
        self.out.close()


def read_index(file) -> dict:
    import zstandard

    end = file.size()
    file.seek(end - 8 - len(MAGIC))
    length, magic = int.from_bytes(file.read(8), "little"), file.read(len(MAGIC))
    if magic != MAGIC:
        raise ValueError("not a file of token id planes, or cut short")
    file.seek(end - 8 - len(MAGIC) - length)
    return json.loads(zstandard.ZstdDecompressor().decompress(file.read(length)))


def read_block(file, block: list, kind: str) -> np.ndarray:
    import zstandard

    at, count, sizes = block
    file.seek(at)
    unpacker = zstandard.ZstdDecompressor()
    return from_planes([unpacker.decompress(file.read(n)) for n in sizes], count, kind)


def write_ids(docs: DataFrame, path: str, vocab: str | None = None, end: int = END, kind: str = "bit") -> DataFrame:
    """Tokenize `docs` (doc_id, text) and write their ids below `path`; returns the manifest.

    Documents are dealt out by ranges of (doc_id, hash of the text), so a file holds
    neighbours and the files have an order. Each task attempt writes a file of its own
    name and only files of finished tasks are in the manifest, so a task may run again.
    A null or empty text is the end id alone; rows that share a doc_id, or have none
    (these come first), are written one after the other.
    """
    vocab, tail = vocab or vocabulary(), end.to_bytes(4, "little")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of, writer, name = token_ids(vocab), None, f"ids-{uuid.uuid4().hex}.planes"
        first = None
        for batch in batches:
            missing = batch["doc_id"].isna()
            texts = ids_of.each(batch["text"])
            for doc_id, none, ids, h in zip(batch["doc_id"], missing, texts, batch["h"], strict=True):
                key = None if none else int(doc_id)
                if writer is None:
                    writer, first = Writer(opened(f"{path}/{name}", "wb"), kind), (key, h)
                writer.add(key, ids + tail)
        if writer is not None:
            writer.close()
            n_ids = sum(n for _, n in writer.docs)
            row = (f"{path}/{name}", len(writer.docs), n_ids, *first)
            yield pd.DataFrame([row], columns=["file", "n_docs", "n_ids", "first_doc", "first_hash"]).astype(
                {"first_doc": "Int64"}
            )

    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    dealt = hashed.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")
    with python_batches(docs.sparkSession):
        return stored(dealt.mapInPandas(write, MANIFEST), "manifest")


def read_ids(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: (doc_id, start, n_tokens, ids_crc32).

    Ids are decoded block by block; a document may span many. `start` counts the ids of
    all documents before it, over all files.
    """
    order = Window.orderBy(F.col("first_doc").asc_nulls_first(), "first_hash")  # a row per file
    starts = manifest.select("file", (F.sum("n_ids").over(order) - F.col("n_ids")).alias("start"))
    files = max(1, manifest.count())

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, start in zip(batch["file"], batch["start"], strict=True):
                with opened(name, "rb") as file:
                    index = read_index(file)
                    yield from documents(file, index, int(start))

    return starts.repartition(files, "file").mapInPandas(read, DOCUMENTS)


def documents(file, index: dict, start: int) -> Iterator[pd.DataFrame]:
    """The documents of a file, some thousand at a time."""
    blocks = iter(index["blocks"])
    rest, out = b"", []
    for doc_id, count in index["docs"]:
        need, crc = 4 * count, 0
        while need:
            if not rest:
                rest = read_block(file, next(blocks), index["kind"]).tobytes()
                view = memoryview(rest)
                at = 0
            part = view[at : at + need]
            crc = zlib.crc32(part, crc)
            need -= len(part)
            at += len(part)
            if at == len(view):
                rest = b""
        out.append((doc_id, start, count, crc))
        start += count
        if len(out) == 5000:
            yield frame(out)
            out = []
    yield frame(out)


def frame(rows: list[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
    return df.astype({"doc_id": "Int64"})


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write ids to the folder the cluster shares and read them back."""
    return read_ids(write_ids(docs, scratch_path(docs.sparkSession, "planes"), **options))
