"""Token-id files: bit-plane shuffled, zstandard-compressed blocks of ids.

A file holds the ids of consecutive documents, in ascending order of document
id. Ids are cut into blocks of a fixed size. A block is transposed into planes,
one per byte (or bit) of an id, so that the nearly constant high planes are next
to nothing, and each plane is compressed by itself.

File layout, all integers little-endian:

    "BPLANE1\\n"
    planes of block 0, planes of block 1, ...
    document index: compressed int64 ids, uint8 null marks, int64 token counts
    chunk index:    per block the uint32 number of ids, uint8 number of planes,
                    uint64 place, and a uint32 length per plane
    footer:         uint64 place of the document index and of the chunk index,
                    uint32 lengths of its three parts, uint64 documents,
                    uint64 ids, uint32 blocks, uint8 bits per plane, "BPLANE1\\n"

A task writes files under names of its own; the manifest, a table committed by
Spark, names those that count. A repeated task leaves files nobody reads.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noticehouse.llm.common import stage, text_bytes, write_file
from noticehouse.llm.tokens import encoder, slices
from noticehouse.session import scratch_path

MAGIC = b"BPLANE1\n"
FOOTER = struct.Struct("<QQIIIQQIB8s")
CHUNK = struct.Struct("<IBQ")
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 24
MANIFEST = "part int, seq int, name string, n_docs bigint, n_ids bigint"
DOCUMENTS = "name string, doc_id bigint, local_start bigint, n_tokens bigint, ids binary"


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """The planes of a block, lowest first; all-zero planes at the top are left out."""
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits == 8:
        planes = np.ascontiguousarray(octets.T)
    else:
        each = np.unpackbits(octets, axis=1, bitorder="little")
        planes = np.packbits(each.T, axis=1, bitorder="little")
    used = [k for k in range(len(planes)) if planes[k].any()]
    return [planes[k].tobytes() for k in range(max(used, default=-1) + 1)]


def from_planes(planes: list[bytes], count: int, bits: int) -> np.ndarray:
    """The ids of a block, as unsigned 32-bit."""
    if bits == 8:
        octets = np.zeros((count, 4), np.uint8)
        for k, plane in enumerate(planes):
            octets[:, k] = np.frombuffer(plane, np.uint8)
    else:
        each = np.zeros((count, 32), np.uint8)
        for k, plane in enumerate(planes):
            packed = np.frombuffer(plane, np.uint8)
            each[:, k] = np.unpackbits(packed, count=count, bitorder="little")
        octets = np.packbits(each, axis=1, bitorder="little")
    return octets.reshape(-1).view("<u4")


class FileWriter:
    """One file, built block by block."""

    def __init__(self, bits: int, block_ids: int, level: int = 3):
        self.bits, self.block_bytes = bits, 4 * block_ids
        self._zstd = zstandard.ZstdCompressor(level=level)
        self._out, self._rest = [MAGIC], bytearray()
        self._place, self._chunks = len(MAGIC), []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self.n_ids = 0

    def _put(self, data: bytes) -> None:
        self._out.append(data)
        self._place += len(data)

    def _block(self, data: bytes) -> None:
        ids = np.frombuffer(data, "<u4")
        planes = [self._zstd.compress(p) for p in to_planes(ids, self.bits)]
        head = CHUNK.pack(len(ids), len(planes), self._place)
        self._chunks.append(head + struct.pack(f"<{len(planes)}I", *map(len, planes)))
        for plane in planes:
            self._put(plane)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.n_ids += len(ids) // 4
        self._rest += ids
        while len(self._rest) >= self.block_bytes:
            self._block(bytes(self._rest[: self.block_bytes]))
            del self._rest[: self.block_bytes]

    def finish(self) -> bytes:
        if self._rest:
            self._block(bytes(self._rest))
        docs_at = self._place
        parts = (
            np.array([i or 0 for i in self.doc_ids], "<i8"),
            np.array([i is None for i in self.doc_ids], np.uint8),
            np.array(self.counts, "<i8"),
        )
        packed = [self._zstd.compress(p.tobytes()) for p in parts]
        for part in packed:
            self._put(part)
        chunks_at = self._place
        self._put(b"".join(self._chunks))
        self._put(
            FOOTER.pack(
                docs_at,
                chunks_at,
                *map(len, packed),
                len(self.doc_ids),
                self.n_ids,
                len(self._chunks),
                self.bits,
                MAGIC,
            )
        )
        return b"".join(self._out)


class FileReader:
    """The documents of one file, read block by block."""

    def __init__(self, data: bytes):
        self._data, self._zstd = data, zstandard.ZstdDecompressor()
        if data[: len(MAGIC)] != MAGIC or data[-len(MAGIC) :] != MAGIC:
            raise ValueError("not a token-id file, or cut off")
        docs_at, chunks_at, *sizes, n_docs, self.n_ids, self._blocks, self.bits, _ = (
            FOOTER.unpack_from(data, len(data) - FOOTER.size)
        )
        parts = []
        for size, kind in zip(sizes, ("<i8", np.uint8, "<i8")):
            raw = self._zstd.decompress(data[docs_at : docs_at + size])
            parts.append(np.frombuffer(raw, kind))
            docs_at += size
        ids, null, self.counts = parts
        self.doc_ids = [None if x else int(i) for i, x in zip(ids, null)]
        self._chunks_at = chunks_at

    def blocks(self) -> Iterator[np.ndarray]:
        at = self._chunks_at
        for _ in range(self._blocks):
            count, n_planes, place = CHUNK.unpack_from(self._data, at)
            at += CHUNK.size
            sizes = struct.unpack_from(f"<{n_planes}I", self._data, at)
            at += 4 * n_planes
            planes = []
            for size in sizes:
                planes.append(self._zstd.decompress(self._data[place : place + size]))
                place += size
            yield from_planes(planes, count, self.bits)

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """Id, first id's position in the file, and ids of each document."""
        blocks, have, start = self.blocks(), bytearray(), 0
        for doc_id, count in zip(self.doc_ids, self.counts.tolist()):
            while len(have) < 4 * count:
                have += next(blocks).tobytes()
            yield doc_id, start, bytes(have[: 4 * count])
            del have[: 4 * count]
            start += count


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    bits: int = 8,
    block_ids: int = BLOCK_IDS,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode whole texts and write them in ascending order of ``doc_id``.

    Returns the manifest: one row per file with its place in the order. Null ids
    come first, equal ids are ordered by a hash of the text, null texts are empty, an empty
    table gives no file. A file is closed at the first document's end beyond
    ``file_ids``, so a reader holds about that many compressed ids.
    """
    if bits not in (1, 8):
        raise ValueError("a plane holds 1 or 8 bits of each id")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, part, seq = encoder(tokenizer, end_id).encode, TaskContext.get().partitionId(), 0
        writer = None

        def close() -> pd.DataFrame:
            name = f"{uuid.uuid4().hex}.bplane"
            write_file(folder, name, writer.finish())
            row = (part, seq, name, len(writer.doc_ids), writer.n_ids)
            return pd.DataFrame([row], columns=["part", "seq", "name", "n_docs", "n_ids"])

        for batch in batches:
            keys = batch["doc_id"].astype("Int64").tolist()
            texts = batch["body"].tolist()
            for a, b in slices(texts):
                for key, ids in zip(keys[a:b], encode(texts[a:b])):
                    writer = writer or FileWriter(bits, block_ids)
                    writer.add(None if key is pd.NA else key, ids)
                    if writer.n_ids >= file_ids:
                        yield close()
                        writer, seq = None, seq + 1
        if writer:
            yield close()

    # Ties by a hash: rows of one id, or without one, are spread over partitions too,
    # and a repeated task meets them in the same order.
    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("body"))
        .withColumn("tie", F.xxhash64("body"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "body")
        .drop("tie")
    )
    return stage(ordered.mapInPandas(write, MANIFEST), "token-manifest")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """The documents of the files a manifest names: ``doc_id``, ``start`` (ids of
    all documents before it), ``n_tokens`` and ``ids``."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch["name"], batch["content"]):
                rows, size = [], 0
                for doc_id, start, ids in FileReader(bytes(data)).documents():
                    rows.append((name, doc_id, start, len(ids) // 4, ids))
                    size += len(ids)
                    if size >= 8 << 20:
                        yield _documents(rows)
                        rows, size = [], 0
                if rows:
                    yield _documents(rows)

    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select(
        "name", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("base")
    )
    files = spark.read.format("binaryFile").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    found = named.join(manifest.select("name"), "name", "left_semi")
    return (
        found.mapInPandas(read, DOCUMENTS)
        .join(bases, "name")
        .select(
            "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids"
        )
    )


def _documents(rows: list[tuple]) -> pd.DataFrame:
    made = pd.DataFrame(rows, columns=["name", "doc_id", "local_start", "n_tokens", "ids"])
    return made.astype({"doc_id": "Int64"})


def token_files(
    docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None, **layout
) -> DataFrame:
    """Write token-id files and read them back: one row per document."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    manifest = write_token_files(docs, folder, tokenizer, end_id, **layout)
    if not manifest.head(1):
        return spark.createDataFrame([], "doc_id bigint, start bigint, n_tokens bigint, ids binary")
    return read_token_files(spark, folder, manifest)
