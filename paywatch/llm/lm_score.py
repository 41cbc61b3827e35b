"""Language-model scoring with a log-frequency Bloom filter.

A filter holds, for every n-gram with count c, the items (n-gram, 1) to (n-gram, q) with q = 1 + floor(log2 c). Probes
for 1, 2, ... until one misses give q back, so the filter keeps quantised counts without keys. It consists of
segments of the key space, each of ITEM_BITS for every item it holds; all n-grams are held, and its size follows
their number.

A filter that is sure to fit MAX_BITS is broadcast. Beyond that a segment is probed where it has been built, with the
distinct n-grams every chunk of texts asks for, and the levels found go back to the chunk. Both ways give equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywatch.llm.common import runs_of, stage, texts, training_bucket, utf8
from paywatch.llm.repeats import MEMO, _mix

UNIGRAM, BIGRAM = 0, 1
MIX = 0.6
PROBES = 4
ITEM_BITS = 10
MAX_BITS = 1 << 28
LEAST_BLOCK = 64
# Texts are kept and scored in chunks of this many bytes, a longer text alone.
CHUNK_BYTES = 1 << 22
SEGMENT_TOKENS = 1 << 21
WIDTH = {UNIGRAM: "<u8", BIGRAM: "<u4"}
END, BEGIN = (np.uint64(int.from_bytes(xxhash.xxh64_digest(s), "big")) for s in (b"\n", b"\r"))
GOLD = 0x9E3779B97F4A7C15
CHUNK = "chunk long, doc_ids array<long>, held array<boolean>, sizes array<long>, body binary"
ASKED = "part long, chunk long, keys binary, counts binary"
FOUND = "chunk long, part long, levels binary, counts binary, tokens long, words long"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def tokens(text: bytes) -> np.ndarray:
    """Hashes of a text's words and the end token."""
    words = np.frombuffer(b"".join(map(MEMO.__getitem__, text.lower().split())), ">u8")
    return np.append(words.astype(np.uint64), END)


def pairs(hashes: np.ndarray, first: np.ndarray, segment_bits: int) -> np.ndarray:
    """Bigram keys of 32 + segment_bits bits; a text's first token follows the begin mark."""
    before = np.roll(hashes, 1)
    before[first] = BEGIN
    return _mix(_mix(before) + hashes) >> np.uint64(32 - segment_bits)


def segments(kind: int, keys: np.ndarray, bits: int) -> np.ndarray:
    """The segment of a key: its upper bits."""
    shift = 64 - bits if kind == UNIGRAM else 32
    return (keys >> np.uint64(shift)).astype(np.int64) if shift < 64 else np.zeros(len(keys), np.int64)


# ---- the filter ---------------------------------------------------------------------------------


def _places(key: np.ndarray, level: int, size) -> Iterator[np.ndarray]:
    """The PROBES bits of the items (key, level) in blocks of `size` bits."""
    item = _mix(key + np.uint64(level * GOLD % (1 << 64)))
    low, step = item & np.uint64(0xFFFFFFFF), (item >> np.uint64(32)) | np.uint64(1)
    for i in range(PROBES):
        yield ((low + np.uint64(i) * step) % size).astype(np.int64)


def build_block(kind: int, keys: np.ndarray, counts: np.ndarray, item_bits: int) -> np.ndarray:
    """The packed bits of one segment's n-grams; as many as its items need."""
    q = np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1
    size = max(LEAST_BLOCK, -(-int(q.sum()) * item_bits // 8) * 8)
    bits = np.zeros(size, bool)
    key = filter_key(kind, keys)
    for level in range(1, int(q.max(initial=0)) + 1):
        for place in _places(key[q >= level], level, np.uint64(size)):
            bits[place] = True
    return np.packbits(bits, bitorder="little")


def filter_key(kind: int, keys: np.ndarray) -> np.ndarray:
    return _mix(keys.astype(np.uint64) * np.uint64(2) + np.uint64(kind) + np.uint64(GOLD))


def levels_of(kind: int, keys: np.ndarray, bits: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Quantised counts by repeated membership probes, 0 for what is not held.

    The block of a key begins at bit `begin` of the packed `bits` and has `size` bits.
    """
    key = filter_key(kind, keys)
    level = np.zeros(len(key), np.uint8)
    left = np.arange(len(key))
    for step in range(1, 64):
        hit = np.ones(len(left), bool)
        for place in _places(key[left], step, size[left]):
            at = begin[left] + place
            hit &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        left = left[hit]
        if not len(left):
            break
        level[left] = step
    return level


def about(level: np.ndarray) -> np.ndarray:
    """The middle of a quantised range."""
    up = 2.0 ** level.astype(np.float64)
    return np.where(level > 0, (up / 2 + up - 1) / 2, 0.0)


class Filter(NamedTuple):
    """All blocks of a filter one after the other: (begin, size) in bits of each kind's segments."""

    bits: np.ndarray
    begin: dict[int, np.ndarray]
    size: dict[int, np.ndarray]

    def levels(self, kind: int, keys: np.ndarray, segment: np.ndarray) -> np.ndarray:
        return levels_of(kind, keys, self.bits, self.begin[kind][segment], self.size[kind][segment])


def join_blocks(blocks: dict[int, bytes], segment_bits: int) -> Filter:
    """The filter of blocks by part; a part without n-grams has an empty block."""
    arrays, begin, size, at = [], {}, {}, 0
    for kind in (UNIGRAM, BIGRAM):
        starts, sizes = [], []
        for segment in range(1 << segment_bits):
            block = np.frombuffer(blocks.get(2 * segment + kind, bytes(LEAST_BLOCK // 8)), np.uint8)
            arrays.append(block)
            starts.append(8 * at)
            sizes.append(8 * len(block))
            at += len(block)
        begin[kind], size[kind] = np.array(starts, np.int64), np.array(sizes, np.uint64)
    return Filter(np.concatenate(arrays), begin, size)


# ---- chunks of texts, and what they ask for -----------------------------------------------------


def _columns(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64(),
             "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    names, types = zip(*(c.split() for c in schema.split(", ")))
    values = list(zip(*rows)) or [()] * len(names)
    return pa.record_batch([pa.array(v, kinds[t]) for v, t in zip(values, types)], names=list(names))


def _chunks(batches: Iterator[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Texts packed into chunks, which are what the later steps read."""
    number = TaskContext.get().partitionId() << 32
    press = zstandard.ZstdCompressor(level=1)
    held: list[tuple] = []
    size = 0

    def row() -> tuple:
        ids, outs, bodies = zip(*held)
        return number, list(ids), list(outs), [len(b) for b in bodies], press.compress(b"".join(bodies))

    for batch in batches:
        for doc_id, out, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), utf8(batch.column("text"))):
            if held and size + len(text) > chunk_bytes:
                yield _columns(CHUNK, [row()])
                number, held, size = number + 1, [], 0
            held.append((doc_id, out, text))
            size += len(text)
    if held:
        yield _columns(CHUNK, [row()])


def _tokenised(sizes: list[int], body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All token hashes of a chunk, the place of each text's first one, and its number of tokens."""
    joined, at, found = zstandard.decompress(body), 0, []
    for size in sizes:
        found.append(tokens(joined[at : at + size]))
        at += size
    n = np.array([len(x) for x in found])
    return np.concatenate(found), np.cumsum(n) - n, n


def _asked(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of every chunk by segment, part = 2 * segment + kind, with their counts in training texts."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for chunk, held, sizes, body in zip(*(batch.column(c).to_pylist() for c in ("chunk", "held", "sizes", "body"))):
            hashes, first, n = _tokenised(sizes, body)
            learned = np.repeat(~np.array(held, bool), n).astype(np.int64)
            rows = []
            for kind, keys in ((UNIGRAM, hashes), (BIGRAM, pairs(hashes, first, bits))):
                order = np.argsort(keys)
                starts = np.flatnonzero(np.diff(keys[order], prepend=keys[order[0]] ^ np.uint64(1)))
                counts = np.add.reduceat(learned[order], starts).astype("<u4")
                keys = keys[order][starts]
                segment = segments(kind, keys, bits)
                edges = [*np.flatnonzero(np.diff(segment, prepend=-1)).tolist(), len(keys)]
                rows += [
                    (2 * int(segment[a]) + kind, chunk, keys[a:b].astype(WIDTH[kind]).tobytes(), press.compress(counts[a:b].tobytes()))
                    for a, b in zip(edges, edges[1:])
                ]
            yield _columns(ASKED, rows)


def _found(batches: Iterator[pa.RecordBatch], probe: bool, item_bits: int) -> Iterator[pa.RecordBatch]:
    """Build a segment's block from all chunks' counts and answer every chunk.

    The answers hold exact counts of words, for the base score, and the levels the probes give if `probe`; else the
    block itself is handed on, in a row with chunk -1 that also has the segment's training tokens and words.
    """
    press = zstandard.ZstdCompressor(level=1)
    for run in runs_of(batches, "part"):
        part = run.column("part")[0].as_py()
        kind = part % 2
        chunks = run.column("chunk").to_pylist()
        keys = [np.frombuffer(k, WIDTH[kind]) for k in run.column("keys").to_pylist()]
        counts = [np.frombuffer(zstandard.decompress(c), "<u4") for c in run.column("counts").to_pylist()]
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)
        whole = distinct.astype(np.uint64) | (np.uint64(part // 2 << 32) if kind == BIGRAM else np.uint64(0))
        block = build_block(kind, whole[total > 0], total[total > 0], item_bits)
        if kind == UNIGRAM or not probe:
            yield _columns(FOUND, [(-1, part, None if probe else block.tobytes(), None, int(total.sum()), int((total > 0).sum()))])
        if probe:
            size = np.full(len(whole), 8 * len(block), np.uint64)
            levels = levels_of(kind, whole, block, np.zeros(len(whole), np.int64), size)
        elif kind == BIGRAM:
            continue
        ends = np.cumsum([len(k) for k in keys])
        for chunk, end, size in zip(chunks, ends.tolist(), map(len, keys)):
            mine = inverse[end - size : end]
            exact = press.compress(total[mine].astype("<u8").tobytes()) if kind == UNIGRAM else None
            yield _columns(FOUND, [(chunk, part, levels[mine].tobytes() if probe else None, exact, None, None)])


# ---- scores -------------------------------------------------------------------------------------


class Scale(NamedTuple):
    """Training tokens N and distinct words V."""

    n: int
    v: int

    @property
    def floor(self) -> float:
        return self.n + 0.5 * (self.v + 1)


def _scored(batches: Iterator[pa.RecordBatch], bits: int, scale: Scale, model: Broadcast | None) -> Iterator[pa.RecordBatch]:
    for run in runs_of(batches, "chunk"):
        rows = run.select(["part", "doc_ids", "held", "sizes", "body", "levels", "counts"]).to_pylist()
        rows.sort(key=lambda r: r["part"])
        own, answers = rows[0], rows[1:]
        hashes, first, n = _tokenised(own["sizes"], own["body"])
        words, word = np.unique(hashes, return_inverse=True)
        together, pair = np.unique(pairs(hashes, first, bits), return_inverse=True)
        exact = np.concatenate([np.frombuffer(zstandard.decompress(r["counts"]), "<u8") for r in answers if r["part"] % 2 == UNIGRAM]).astype(np.int64)
        if model is None:
            level = [np.concatenate([np.frombuffer(r["levels"], np.uint8) for r in answers if r["part"] % 2 == kind]) for kind in (UNIGRAM, BIGRAM)]
        else:
            level = [model.value.levels(kind, keys, segments(kind, keys, bits)) for kind, keys in ((UNIGRAM, words), (BIGRAM, together))]
        single, double = about(level[0]), about(level[1])
        before = np.roll(single[word], 1)
        before[first] = single[np.searchsorted(words, END)]  # as many begins as ends
        follows = np.where(before > 0, np.minimum(double[pair] / np.maximum(before, 1), 1.0), 0.0)
        chance = np.log10(MIX * follows + (1 - MIX) * ((single + 0.5) / scale.floor)[word])
        base = np.log10((exact + 0.5) / scale.floor)[word]
        known = (exact > 0).astype(np.int64)[word]
        sums = [np.add.reduceat(x, first).tolist() for x in (known, base, chance)]
        yield _columns(SCORED, list(zip(own["doc_ids"], own["held"], n.tolist(), *sums)))


def lm_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per document row.

    Rows whose id's crc32 is 1 modulo 5 are held out, the others are learned from. base_score is the smoothed
    unigram log10 probability from exact counts. score is the model's: a mixture of bigram and unigram probabilities,
    both from the counts the Bloom filter gives back. All words and pairs of the training texts are held.

    Null, empty and blank texts are their end token alone; repeated rows and rows without an id (learned from)
    each give a row. Without training rows every probability is that of an empty table. An empty table gives an empty
    result. Other columns are not read. A very long text is a chunk of its own and costs about 100 bytes of a worker's
    memory a word.
    """
    rows = texts(docs).withColumn("held_out", training_bucket(F.col("doc_id")) == 1)
    chunks = stage(rows.mapInArrow(partial(_chunks, chunk_bytes=CHUNK_BYTES), CHUNK), "chunks")
    per_text = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)
    bytes_, n_texts = chunks.agg(F.sum(per_text), F.sum(F.size("sizes"))).first()
    bytes_, n_texts = bytes_ or 0, n_texts or 0
    segment_bits = max(0, int(np.ceil(np.log2(max(1.0, (bytes_ / 6 + n_texts) / SEGMENT_TOKENS)))))
    # No text has more tokens than half its bytes and two, and n-grams have no more items than occurrences.
    probe = 2 * ITEM_BITS * (bytes_ / 2 + 2 * n_texts) > MAX_BITS
    asked = chunks.mapInArrow(partial(_asked, bits=segment_bits), ASKED).repartition("part").sortWithinPartitions("part", "chunk")
    found = stage(asked.mapInArrow(partial(_found, probe=probe, item_bits=ITEM_BITS), FOUND), "found")
    totals = found.where(F.col("part") % 2 == UNIGRAM).agg(F.sum("tokens").alias("n"), F.sum("words").alias("v")).first()
    scale = Scale(totals["n"] or 0, totals["v"] or 0)
    model = None
    if not probe:
        table = found.where("chunk = -1").select("part", "levels").toArrow()  # MAX_BITS at most
        blocks = dict(zip(table.column("part").to_pylist(), table.column("levels").to_pylist()))
        model = docs.sparkSession.sparkContext.broadcast(join_blocks(blocks, segment_bits))
    own = chunks.withColumn("part", F.lit(-1).cast("long"))
    answers = found.where("chunk >= 0").drop("tokens", "words")
    dealt = own.unionByName(answers, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", "part")
    scored = dealt.mapInArrow(partial(_scored, bits=segment_bits, scale=scale, model=model), SCORED)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(scale.n).cast("long").alias("train_tokens"), "base_score", "score")
