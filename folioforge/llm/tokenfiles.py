"""Token-id output in bit-packed files.

A file holds documents in order. All integers are little-endian:

    8 bytes   magic FOLIOTK1
    u32 u32   bits of an id, ids of a block (a multiple of 64)
    u64 u64   ids, documents
    i64 * documents       doc_id (0 where null)
    u8  * documents       1 where doc_id is null
    u64 * (documents + 1) first id of each document, and the number of ids
    u64 * (blocks + 1)    byte offset of each block in the payload, and its length
    payload   blocks of u64 words

Each id takes the fewest bits that the vocabulary needs. 64 ids fill `bits` words, so a block is
unpacked by 64 vectorised shifts, and any range of ids by reading its blocks only.

Documents are sorted by id through a range shuffle; each partition writes its own files under
names that no other attempt uses, and the manifest lists only those of the attempts that counted.
The manifest has one row a file; the driver adds up the ids before each file.

Nulls: a null text is empty (its end id alone); a null id sorts first. Repeated ids are kept, in
the order of their texts' hashes. An empty table gives no file. Other columns are not written.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import textkit as tk
from folioforge.llm.bpe import encoder
from folioforge.llm.session import discard, fresh_path, partitions, written

MAGIC = b"FOLIOTK1"
BLOCK_IDS = 1 << 14
#: Ids of a file, after which the next one is begun.
FILE_IDS = 1 << 24


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """ids, filled up to a multiple of 64, as u64 words."""
    lanes = np.zeros((-(-len(ids) // 64), 64), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    out = np.zeros((len(lanes), bits), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[:, word] |= lanes[:, j] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= lanes[:, j] >> np.uint64(64 - shift)
    return out.reshape(-1)


def unpack(words: np.ndarray, bits: int, n: int) -> np.ndarray:
    words = words.reshape(-1, bits)
    out = np.empty((len(words), 64), np.uint32)
    mask = np.uint64(2**bits - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        lane = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            lane = lane | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = lane & mask
    return out.reshape(-1)[:n]


class FileWriter:
    """Gathers documents and gives one file's bytes."""

    def __init__(self, bits: int, block_ids: int = BLOCK_IDS):
        self.bits, self.block_ids = bits, block_ids
        self.blocks: list[bytes] = []
        self.open: list[np.ndarray] = []
        self.open_ids = self.n_ids = 0
        self.doc_ids: list[int | None] = []
        self.starts = [0]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.open.append(ids)
        self.open_ids += len(ids)
        self.n_ids += len(ids)
        self.starts.append(self.n_ids)
        if self.open_ids >= self.block_ids:
            ids = np.concatenate(self.open)
            full = len(ids) // self.block_ids * self.block_ids
            for s in range(0, full, self.block_ids):
                self.blocks.append(pack(ids[s : s + self.block_ids], self.bits).tobytes())
            self.open, self.open_ids = [ids[full:].copy()], len(ids) - full

    def content(self) -> bytes:
        if self.open_ids:
            self.blocks.append(pack(np.concatenate(self.open), self.bits).tobytes())
            self.open, self.open_ids = [], 0
        sizes = np.cumsum([0, *map(len, self.blocks)]).astype("<u8")
        ids = np.array([x or 0 for x in self.doc_ids], "<i8")
        nulls = np.array([x is None for x in self.doc_ids], np.uint8)
        head = MAGIC + struct.pack("<IIQQ", self.bits, self.block_ids, self.n_ids, len(self.doc_ids))
        return b"".join([head, ids.tobytes(), nulls.tobytes(), np.array(self.starts, "<u8").tobytes(), sizes.tobytes(), *self.blocks])


class FileReader:
    """Random access to a file that has seek() and read()."""

    def __init__(self, file):
        self.file = file
        head = file.read(32)
        if head[:8] != MAGIC:
            raise ValueError("not a token file")
        self.bits, self.block_ids, self.n_ids, n_docs = struct.unpack("<IIQQ", head[8:])
        self.doc_ids = np.frombuffer(file.read(8 * n_docs), "<i8")
        self.nulls = np.frombuffer(file.read(n_docs), np.uint8)
        self.starts = np.frombuffer(file.read(8 * (n_docs + 1)), "<u8").astype(np.int64)
        n_blocks = -(-self.n_ids // self.block_ids)
        self.offsets = np.frombuffer(file.read(8 * (n_blocks + 1)), "<u8").astype(np.int64)
        self.payload = 32 + 17 * n_docs + 8 + 8 * (n_blocks + 1)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids start to end of the file; only their blocks are read."""
        if end <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (end - 1) // self.block_ids
        self.file.seek(int(self.payload + self.offsets[first]))
        raw = self.file.read(int(self.offsets[last + 1] - self.offsets[first]))
        had = first * self.block_ids
        got = unpack(np.frombuffer(raw, "<u8"), self.bits, min(self.n_ids, (last + 1) * self.block_ids) - had)
        return got[start - had : end - had]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))

    def documents(self, step: int = 1 << 20) -> Iterator[np.ndarray]:
        """All documents in order; whole runs of blocks are read and unpacked at once."""
        n, k = len(self.doc_ids), 0
        while k < n:
            end = max(k + 1, int(np.searchsorted(self.starts, self.starts[k] + step, side="right")) - 1)
            ids = self.ids(int(self.starts[k]), int(self.starts[end]))
            yield from np.split(ids, self.starts[k + 1 : end] - self.starts[k])
            k = end


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri("file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def _encode_and_write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, bits: int, end_id: int, file_ids: int, special_in_text: bool) -> Iterator[pa.RecordBatch]:
    system, base = _filesystem(folder)
    part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
    coder, seq, writer = encoder(tokenizer, special_in_text), 0, FileWriter(bits)

    def close() -> pa.RecordBatch:
        nonlocal seq, writer
        name = f"part-{part:06d}-{seq:05d}-{attempt}.tok"
        with system.open_output_stream(f"{base}/{name}") as out:
            out.write(writer.content())
        row = pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "file": name, "n_docs": len(writer.doc_ids), "n_ids": writer.n_ids}])
        seq, writer = seq + 1, FileWriter(bits)
        return row

    for batch in tk.chunks(batches, "text"):
        coded = coder.encode(*tk.text_bytes(batch.column("text")))
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), coded, strict=True):
            if writer.n_ids and writer.n_ids + len(ids) >= file_ids:
                yield close()
            writer.add(doc_id, np.append(ids, np.uint32(end_id)))
    if writer.doc_ids:
        yield close()


def write_tokens(docs: DataFrame, *, tokenizer: str, folder: str | None = None, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, file_ids: int = FILE_IDS, special_in_text: bool = True) -> DataFrame:
    """Encodes and writes all documents in ascending order of id. Returns the manifest:
    file, first (ids of all documents before it), n_docs, n_ids.

    special_in_text: a special token spelt out in a text gets its own id, as the library gives it;
    else it is encoded as any other text.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "tokens")
    system, base = _filesystem(folder)
    system.create_dir(base, recursive=True)
    bits = bits_for(max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1))
    ordered = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = ordered.repartitionByRange(partitions(spark), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    files = ordered.mapInArrow(lambda it: _encode_and_write(it, folder, tokenizer, bits, end_id, file_ids, special_in_text), "part bigint, seq bigint, file string, n_docs bigint, n_ids bigint")
    listed = written(files, "manifest")
    rows = sorted(listed.collect())
    discard(listed)
    first, out = 0, []
    for r in rows:
        out.append((f"{folder}/{r['file']}", first, r["n_docs"], r["n_ids"]))
        first += r["n_ids"]
    return spark.createDataFrame(out, "file string, first bigint, n_docs bigint, n_ids bigint")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            system, path = _filesystem(row["file"])
            with system.open_input_file(path) as file:
                reader = FileReader(file)
                crc = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in reader.documents()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(reader.doc_ids.astype(np.int64), mask=reader.nulls.astype(bool)), pa.array(reader.starts[:-1] + row["first"]), pa.array(np.diff(reader.starts)), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_tokens(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    return manifest.select("file", "first").repartition(partitions(spark)).mapInArrow(_read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
