"""Token ids in files of fixed-width bit fields, with block offsets for random access.

File: the magic word, one line of JSON (bits, block, documents, ids, where each part
begins), then little-endian arrays: document ids (64 bit) and their null marks (8
bit), each document's first id and the end (64 bit), each block's first byte and the
end (64 bit), and the blocks. A block holds ``block`` ids (the last one fewer) in the
least bits that the vocabulary needs; id k of a block has bits k*bits up, the lowest
bit first.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm.common import SharedFiles, arrow_schema, batch_of, text_batches
from tenura.llm.tokens import encoder, vocabulary_path, vocabulary_size
from tenura.operators.ordering import running_totals
from tenura.session import scratch_path, settle

MAGIC = b"TOKBITS1"
BLOCK = 4096
SHARD_IDS = 1 << 22
#: Bytes of text that are encoded at a time.
TEXT_BYTES = 4_000_000
#: Rows drawn to place each bound between parts.
DRAWN = 64


def bits_for(vocab_size: int) -> int:
    """Least bits that hold every id below ``vocab_size``."""
    return max(1, (vocab_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids below 2**bits as bit fields; eight ids fill ``bits`` bytes."""
    n = len(ids)
    if bits in (8, 16, 32):  # whole bytes
        return ids.astype(f"<u{bits // 8}").tobytes()
    groups = np.zeros((-(-n // 8), 8), np.uint64)
    groups.reshape(-1)[:n] = ids
    out = np.zeros((len(groups), bits + 8), np.uint8)
    for k in range(8):
        at, shift = divmod(k * bits, 8)
        moved = groups[:, k] << np.uint64(shift)
        for j in range((shift + bits + 7) // 8):
            out[:, at + j] |= (moved >> np.uint64(8 * j)).astype(np.uint8)
    return out[:, :bits].tobytes()[: (n * bits + 7) // 8]


def unpack_bits(raw: bytes | memoryview, n: int, bits: int) -> np.ndarray:
    """The ``n`` ids of bit fields."""
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}")[:n].astype(np.uint32)
    groups = -(-n // 8)
    filled = np.zeros(groups * bits, np.uint8)
    filled[: len(raw)] = np.frombuffer(raw, np.uint8)
    fields = np.concatenate([filled.reshape(groups, bits), np.zeros((groups, 8), np.uint8)], axis=1)
    out = np.zeros((groups, 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(8):
        at, shift = divmod(k * bits, 8)
        value = np.zeros(groups, np.uint64)
        for j in range((shift + bits + 7) // 8):
            value |= fields[:, at + j].astype(np.uint64) << np.uint64(8 * j)
        out[:, k] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:n]


def encode_shard(keys: list[int | None], documents: list[np.ndarray], bits: int, block: int = BLOCK) -> bytes:
    """One file's bytes."""
    ids = np.concatenate(documents) if documents else np.zeros(0, np.uint32)
    starts = np.cumsum([0, *map(len, documents)]).astype("<i8")
    blocks = [pack_bits(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<i8")
    head = {"bits": bits, "block": block, "documents": len(keys), "ids": len(ids)}
    null = np.array([k is None for k in keys], np.uint8)
    known = np.array([0 if k is None else k for k in keys], "<i8")
    line = MAGIC + json.dumps(head).encode() + b"\n"
    return b"".join([line, known.tobytes(), null.tobytes(), starts.tobytes(), offsets.tobytes(), *blocks])


class Shard:
    """Reads one file's bytes; ``ids`` unpacks only the blocks it needs."""

    def __init__(self, raw: bytes | memoryview):
        view = memoryview(raw)
        if bytes(view[: len(MAGIC)]) != MAGIC:
            raise ValueError("not a file of bit-packed token ids")
        end = bytes(view[: 4096]).index(b"\n")
        head = json.loads(bytes(view[len(MAGIC) : end]))
        self.bits, self.block, self.n_ids = head["bits"], head["block"], head["ids"]
        n, at = head["documents"], end + 1
        self.known = np.frombuffer(view[at : at + 8 * n], "<i8")
        self.null = np.frombuffer(view[at + 8 * n : at + 9 * n], np.uint8)
        at += 9 * n
        self.starts = np.frombuffer(view[at : at + 8 * (n + 1)], "<i8")
        at += 8 * (n + 1)
        blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(view[at : at + 8 * (blocks + 1)], "<i8")
        self.body = view[at + 8 * (blocks + 1) :]

    def keys(self) -> list[int | None]:
        return [None if gone else key for key, gone in zip(self.known.tolist(), self.null.tolist(), strict=True)]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block + 1
        parts = [
            unpack_bits(self.body[self.offsets[b] : self.offsets[b + 1]], min(self.block, self.n_ids - b * self.block), self.bits)
            for b in range(first, last)
        ]
        whole = np.concatenate(parts)
        return whole[start - first * self.block : stop - first * self.block]


def _place(key: int | None, rank: int) -> tuple[int, int, int]:
    """Where a document stands in the order of ids, null first, then of text hashes."""
    return (0, 0, rank) if key is None else (1, key, rank)


def _bounds(rows: DataFrame, n_parts: int) -> list[tuple[int, int, int]]:
    """Places that cut the order into ``n_parts`` about equal parts, from a bounded draw of rows.

    Only balance depends on the draw: whatever the bounds, all documents are placed in order.
    """
    drawn = rows.select("id", "rank").orderBy(F.rand(7)).limit(DRAWN * n_parts).collect()
    places = sorted(_place(r.id, r["rank"]) for r in drawn)
    return [places[i * len(places) // n_parts] for i in range(1, n_parts)] if places else []


def write_token_shards(
    docs: DataFrame,
    folder: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 2,
    vocabulary: str | None = None,
    shard_ids: int = SHARD_IDS,
    block: int = BLOCK,
) -> DataFrame:
    """Writes every document's ids, ``end_id`` last, in ascending id order; returns one row per file.

    Texts are encoded where they are read, and only ids are shuffled and sorted. Columns:
    file, part, seq, n_documents, n_ids, first (ids in earlier files). Files
    end at a document once they hold ``shard_ids`` ids. A null id comes first; rows
    that repeat an id follow each other by their text's hash. A null text has its end
    id alone; an empty table writes no file. Other columns are not read.
    """
    spark = docs.sparkSession
    path = vocabulary or vocabulary_path()
    folder = folder or scratch_path(spark, "tokens")
    bits = bits_for(max(vocabulary_size(path), end_id + 1))
    kind = "<u2" if bits <= 16 else "<u4"
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text_column).alias("rank"), F.col(text_column).alias("text"))
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(rows, n_parts)
    encoded_columns = "id long, rank long, part int, ids binary"
    encoded_shape = arrow_schema(encoded_columns)

    def encoded(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, size = encoder(path), np.dtype(kind).itemsize
        for frame in text_batches(frames, "text", TEXT_BYTES):
            keys, ranks = frame.column("id").to_pylist(), frame.column("rank").to_pylist()
            parts = [bisect_right(bounds, _place(key, rank)) for key, rank in zip(keys, ranks, strict=True)]
            flat, at = encode.arrays(frame.column("text"))
            ended = np.insert(flat, at[1:], end_id).astype(kind)
            offsets = ((at + np.arange(len(at))) * size).astype(np.int32)
            ids = pa.Array.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(offsets), pa.py_buffer(ended)])
            columns = [frame.column("id"), frame.column("rank"), pa.array(parts, pa.int32()), ids]
            yield pa.RecordBatch.from_arrays(columns, schema=encoded_shape)

    shape = arrow_schema("file string, part long, seq long, n_documents long, n_ids long")

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = SharedFiles(folder)
        part, seq, held = TaskContext.get().partitionId(), 0, 0
        keys: list[int | None] = []
        documents: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal seq, held, keys, documents
            name = f"part-{part:07d}-{seq:06d}.tok"
            files.write(name, iter([encode_shard(keys, documents, bits, block)]))
            row = (name, part, seq, len(keys), held)
            seq, held, keys, documents = seq + 1, 0, [], []
            return batch_of(shape, [row])

        for frame in frames:
            for key, raw in zip(frame.column("id").to_pylist(), frame.column("ids").to_pylist(), strict=True):
                ids = np.frombuffer(raw, kind)
                keys.append(key)
                documents.append(ids)
                held += len(ids)
                if held >= shard_ids:
                    yield close()
        if keys:
            yield close()

    placed = rows.mapInArrow(encoded, encoded_columns).repartitionById(n_parts, F.col("part"))
    ordered = placed.sortWithinPartitions(F.col("id").asc_nulls_first(), "rank").select("id", "ids")
    written = ordered.mapInArrow(task, "file string, part long, seq long, n_documents long, n_ids long")
    files = running_totals(settle(written), ["n_ids"], ["part", "seq"], settled=True)
    return files.select("file", "part", "seq", "n_documents", "n_ids", F.col("n_ids_before").alias("first"), F.lit(folder).alias("folder"))


def read_token_shards(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """One row per document from the files of ``folder``: file, id, local_start, n_tokens, ids_crc32 and ids (little-endian, 32 bit)."""
    columns = "file string, id long, local_start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    shape = arrow_schema(columns)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for i in range(len(frame)):
                shard = Shard(frame.column("content")[i].as_buffer())
                ids = shard.ids(0, shard.n_ids).astype("<u4")
                name, out = frame.column("file")[i].as_py(), []
                starts = shard.starts.tolist()
                for key, a, b in zip(shard.keys(), starts, starts[1:], strict=False):
                    raw = ids[a:b].tobytes()
                    out.append((name, key, a, b - a, crc32(raw), *([raw] if with_ids else [])))
                yield batch_of(shape, out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder)
    return files.select(F.substring_index("path", "/", -1).alias("file"), "content").mapInArrow(task, columns)


def token_index(spark: SparkSession, docs: DataFrame, with_ids: bool = False, **options: object) -> DataFrame:
    """Writes ``docs`` as token files and reads back one row per document with its place in the whole order."""
    folder = scratch_path(spark, "tokens")
    files = write_token_shards(docs, folder, **options)
    SharedFiles(folder)  # an empty table has the folder, too
    places = files.select("file", "first")
    back = read_token_shards(spark, folder, with_ids)
    ids = ["ids"] if with_ids else []
    return back.join(places, "file").select(
        F.col("id").alias("doc_id"), (F.col("first") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", *ids, "file", "local_start"
    )
