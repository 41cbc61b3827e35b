"""Token ids as directly addressable codes: any token of a file is read without decoding a block.

An image holds the ids of whole documents as little-endian chunks of 8 bits on up to four levels. Level 0 has the
lowest chunk of every id, level k the next chunk of those ids that need one. A level above the last has a
continuation bitmap (one bit per id of the level, lowest bit first) and a rank directory (set bits before every
512th bit), so the place of an id on the next level is one directory entry and at most 64 bytes of bits away.

    image  = b"DAC1", levels u4, then for each level: n u4, chunks u1[n], bitmap u1[ceil(n/8)], ranks u4[ceil(n/512)]

The last level has no bitmap and no ranks; integers are little-endian. A file is a Parquet table of images with
the ids and token counts of their documents, written by Spark's committer, so a retried task leaves no half file.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paywatch.llm.common import sized, texts, utf8
from paywatch.llm.encoding import encoder

MAGIC = b"DAC1"
RANK_BITS = 512
IMAGE_TOKENS = 1 << 18
FILE_BYTES = 16 << 20
MAX_FILES = 1 << 16
END_ID = 1
FILE = "shard long, image_no long, doc_ids array<long>, doc_tokens array<long>, n_tokens long, image binary"


def pack(ids: np.ndarray) -> bytes:
    """The image of an array of ids below 2^32."""
    rest, parts = np.asarray(ids, np.uint32), []
    while True:
        more = rest >> np.uint32(8)
        flags = more > 0
        parts.append((rest & np.uint32(255)).astype(np.uint8))
        if not flags.any():
            break
        parts.append(flags)
        rest = more[flags]
    out = [MAGIC, np.uint32(len(parts) // 2 + 1).tobytes()]
    for level in range(0, len(parts), 2):
        out += [np.uint32(len(parts[level])).tobytes(), parts[level].tobytes()]
        if level + 1 < len(parts):
            flags = parts[level + 1]
            ones = np.add.reduceat(flags, np.arange(0, len(flags), RANK_BITS), dtype=np.uint32)
            ranks = np.concatenate([[0], ones.cumsum()[:-1]]).astype("<u4")
            out += [np.packbits(flags, bitorder="little").tobytes(), ranks.tobytes()]
    return b"".join(out)


class Image:
    """Random access to an image; nothing is decoded but what is asked for."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not an image of directly addressable codes")
        at, self._levels = 8, []
        levels = int(np.frombuffer(data, "<u4", 1, 4)[0])
        for level in range(levels):
            n = int(np.frombuffer(data, "<u4", 1, at)[0])
            chunks = np.frombuffer(data, np.uint8, n, at + 4)
            at += 4 + n
            bits = ranks = None
            if level < levels - 1:
                bits = np.frombuffer(data, np.uint8, -(-n // 8), at)
                ranks = np.frombuffer(data, "<u4", -(-n // RANK_BITS), at + len(bits))
                at += len(bits) + 4 * len(ranks)
            self._levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self._levels[0][0])

    def _rank(self, level: int, i: int) -> int:
        """Set bits before bit i of a level."""
        chunks, bits, ranks = self._levels[level]
        if i >= len(chunks):
            return len(self._levels[level + 1][0])
        word = i // RANK_BITS
        inside = bits[word * RANK_BITS // 8 : i // 8]
        left = int(bits[i // 8]) & ((1 << i % 8) - 1)
        return int(ranks[word]) + int(np.bitwise_count(inside).sum()) + left.bit_count()

    def __getitem__(self, i: int) -> int:
        """The i-th id: one chunk and one rank per level it has."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, _) in enumerate(self._levels):
            value |= int(chunks[i]) << 8 * level
            if bits is None or not bits[i // 8] >> i % 8 & 1:
                return value
            i = self._rank(level, i)
        return value

    def span(self, begin: int, end: int) -> np.ndarray:
        """Ids begin to end: a slice of every level, found by two ranks."""
        values = np.zeros(end - begin, np.uint32)
        place = np.arange(end - begin)
        for level, (chunks, bits, _) in enumerate(self._levels):
            values[place] |= chunks[begin:end].astype(np.uint32) << np.uint32(8 * level)
            if bits is None or begin == end:
                break
            flags = np.unpackbits(bits[begin // 8 : -(-end // 8)], bitorder="little")[begin % 8 : begin % 8 + end - begin].astype(bool)
            place = place[flags]
            begin, end = self._rank(level, begin), self._rank(level, end)
        return values


def _images(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    shard = TaskContext.get().partitionId()
    held: tuple[list, list, list] = ([], [], [])
    image_no = 0

    def flush() -> pa.RecordBatch:
        nonlocal held, image_no
        doc_ids, sizes, data = held
        ids = np.frombuffer(b"".join(data), "<u4")
        row = [[shard], [image_no], [doc_ids], [sizes], [len(ids)], [pack(ids)]]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
        held, image_no = ([], [], []), image_no + 1
        return pa.record_batch([pa.array(x, k) for x, k in zip(row, kinds)], names=["shard", "image_no", "doc_ids", "doc_tokens", "n_tokens", "image"])

    end, size = np.array([END_ID], "<u4").tobytes(), 0
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder(path).encode(utf8(part.column("text")))):
                n = len(ids) // 4 + 1
                if held[0] and size + n > IMAGE_TOKENS:
                    yield flush()
                    size = 0
                for store, value in zip(held, (doc_id, n, ids + end)):
                    store.append(value)
                size += n
    if held[0]:
        yield flush()


def write(docs: DataFrame, tokenizer_path: str, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of all documents, an end id 1 after each, in ascending order of doc_id.

    Rows are dealt by ranges of doc_id; a range is a shard of images of up to IMAGE_TOKENS ids (one document at
    least). Null and empty texts are their end id alone. Rows without an id come first; rows of one id follow each
    other in order of their text. An empty table gives an empty file. Other columns are not read.
    """
    rows = texts(docs)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = min(MAX_FILES, size // file_bytes + 1)
    ordered = rows.repartitionByRange(shards, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ordered.mapInArrow(partial(_images, path=tokenizer_path), FILE).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE).parquet(path)


def _read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            image, at, out = Image(row["image"]), row["start"], []
            begin = 0
            for doc_id, n in zip(row["doc_ids"], row["doc_tokens"]):
                out.append((doc_id, at, n, image.span(begin, begin + n).astype("<u4").tobytes()))
                begin, at = begin + n, at + n
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc_id", "start", "n_tokens", "ids"])


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document read back from a file by its place in an image.

    `start` counts the ids of all documents before. Shard totals, one row for each of at most MAX_FILES shards, are
    summed up first, then images within their shard.
    """
    table = read(spark, path)
    sizes = table.select("shard", "image_no", "n_tokens")
    before = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select("shard", F.expr("sum(n) over (order by shard) - n").alias("shard_start"))
    inside = sizes.select("shard", "image_no", F.expr("sum(n_tokens) over (partition by shard order by image_no) - n_tokens").alias("image_start"))
    starts = inside.join(F.broadcast(before), "shard").select("shard", "image_no", (F.col("shard_start") + F.col("image_start")).alias("start"))
    placed = table.join(sized(starts), ["shard", "image_no"]).select("start", "doc_ids", "doc_tokens", "image")
    return placed.mapInArrow(_read_documents, "doc_id long, start long, n_tokens long, ids binary")

