"""Sequence packing by lexical retrieval: a sharded BM25 index fills each window with neighbours of its seed.

Documents are encoded once and dealt by lexical keys, the least hash of their runs of two ids and, within that, of
longer runs, so that documents that share passages meet in one shard from wherever they stand in the input. Inside a shard a BM25 index, with document
frequencies counted over all documents, gives every window's seed its unused neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywatch.llm.common import handed_back, stage, texts, utf8
from paywatch.llm.encoding import GROUP_BYTES, encoder
from paywatch.llm.repeats import _mix

WINDOW = 1024
SHARD_DOCS = 256
SHARD_TOKENS = 1 << 21
# Ids that one task packs.
DEAL_TOKENS = 1 << 22
RUNS = (2, 5)
WEIGHTS = np.random.default_rng(3).integers(1, 1 << 63, max(RUNS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
K1 = 1.2
B = 0.75
END = np.zeros(1, "<u4").tobytes()
ENCODED = "doc_id long, ids binary, n long, key long, key2 long"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class Statistics:
    """What BM25 knows of all documents: the idf of every id, always positive, and the mean length."""

    def __init__(self, df: np.ndarray, docs: int, mean: float):
        self.idf = np.log1p((docs - df + 0.5) / (df + 0.5))
        self.mean = mean


class Index:
    """BM25 inverted index of one shard: for every id a range of postings (document, weight).

    An id that only one of the shard's documents holds leads to no other and has no postings.
    """

    def __init__(self, ids: list[np.ndarray], known: Statistics):
        self.docs = len(ids)
        length = np.array([len(x) for x in ids])
        owner = np.repeat(np.arange(self.docs), length)
        key = np.sort(np.concatenate(ids).astype(np.int64) * self.docs + owner)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        tf = np.diff(first, append=len(key))
        term, doc = np.divmod(key[first], self.docs)
        begin = np.flatnonzero(np.diff(term, prepend=-1))
        held = np.diff(begin, append=len(term))
        place, useful = np.repeat(np.arange(len(begin)), held), np.repeat(held, held) > 1
        place, doc, tf, idf = place[useful], doc[useful], tf[useful], known.idf[term[useful]]
        self.doc = doc
        self.weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[doc] / known.mean))
        self.begin = np.searchsorted(place, np.arange(len(begin)))
        self.end = np.searchsorted(place, np.arange(len(begin)), side="right")
        order = np.argsort(doc.astype(np.uint16 if self.docs < 1 << 16 else np.int64), kind="stable")
        self.terms = np.split(place[order], np.searchsorted(doc[order], np.arange(1, self.docs)))

    def scores(self, seed: int) -> np.ndarray:
        begin, end = self.begin[self.terms[seed]], self.end[self.terms[seed]]
        size = end - begin
        at = np.arange(size.sum()) + np.repeat(begin - np.concatenate([[0], size.cumsum()[:-1]]), size) if len(size) else np.zeros(0, np.int64)
        return np.bincount(self.doc[at], self.weight[at], self.docs)


class Packer:
    """Fills windows in order; what does not fit is cut and opens the next window as its seed."""

    def __init__(self, first_sequence: int, window: int):
        self.sequence, self.window = first_sequence, window
        self.open: list[tuple] = []
        self.fill = 0
        self.rows: list[tuple] = []

    def _close(self) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in self.open:
            self.rows.append((doc_id, start, len(ids) // 4, doc_tokens, self.sequence, offset, ids))
            offset += len(ids) // 4
        self.sequence += 1
        self.open, self.fill = [], 0

    def place(self, doc_id: int | None, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        while start < total:
            size = min(self.window - self.fill, total - start)
            self.open.append((doc_id, start, ids[4 * start : 4 * (start + size)], total))
            start += size
            self.fill += size
            if self.fill == self.window:
                self._close()

    def finish(self) -> None:
        """Cut what is left into sequences of powers of two, which need no padding."""
        left, self.open, rest = self.open, [], self.fill
        for doc_id, start, ids, total in left:
            at = 0
            while at < len(ids) // 4:
                room = (1 << (rest.bit_length() - 1)) - sum(len(x[2]) // 4 for x in self.open)
                size = min(room, len(ids) // 4 - at)
                self.open.append((doc_id, start + at, ids[4 * at : 4 * (at + size)], total))
                at += size
                if size == room:
                    rest -= 1 << (rest.bit_length() - 1)
                    self._close()
        self.fill = 0

    def take(self) -> pa.RecordBatch:
        names, kinds = zip(*(x.split() for x in PIECES.split(", ")))
        arrow = {"long": pa.int64(), "binary": pa.binary()}
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.record_batch([pa.array(c, arrow[k]) for c, k in zip(columns, kinds)], names=list(names))


def pack_shard(packer: Packer, doc_ids: list, encoded: list[bytes], known: Statistics) -> None:
    """Put every document of a shard into windows, each window's seed choosing among the unused ones."""
    index = Index([np.frombuffer(x, "<u4") for x in encoded], known)
    unused = np.ones(len(encoded), bool)
    best = np.zeros(len(encoded))  # scores for the window's seed
    following = 0
    for _ in range(len(encoded)):
        choice = int(np.where(unused, best, 0.0).argmax())
        found = unused[choice] and best[choice] > 0
        if not found:  # no neighbour left: the next document in order becomes the seed
            while not unused[following]:
                following += 1
            choice = following
        opens = packer.fill == 0 or packer.fill + len(encoded[choice]) // 4 > packer.window
        packer.place(doc_ids[choice], encoded[choice])
        unused[choice] = False
        if opens or not found:
            best = index.scores(choice)


def lexical_keys(encoded: list[bytes], run: int) -> np.ndarray:
    """For every document, given with its end id, the least hash of its runs of ids; a shorter one is one run."""
    size = np.array([len(x) // 4 for x in encoded])
    filled = END * (run - 1)
    ids = np.frombuffer(b"".join(x + filled for x in encoded), "<u4").astype(np.uint64)
    hashes = _mix(sum((ids[i : len(ids) - run + 1 + i] + np.uint64(1)) * WEIGHTS[i] for i in range(run)))
    begin = np.cumsum(size + run - 1) - (size + run - 1)
    place = np.arange(len(hashes)) - np.repeat(begin, size + run - 1)[: len(hashes)]
    hashes[place >= np.repeat(np.maximum(1, size - run), size + run - 1)[: len(hashes)]] = np.iinfo(np.uint64).max
    return np.minimum.reduceat(hashes, begin).view(np.int64)


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    small = encoder(path).size <= 1 << 16
    for batch in handed_back(batches):
        group = np.cumsum(pc.binary_length(batch.column("text")).to_numpy()) // GROUP_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts, cuts[1:]):
            if begin == end:
                continue
            part = batch.slice(begin, end - begin)
            ids = [x + END for x in encoder(path).encode(utf8(part.column("text")))]
            kept = [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in ids] if small else ids
            sizes = pa.array([len(x) // 4 for x in ids], pa.int64())
            keys = [np.concatenate([lexical_keys(ids[at : at + 64], run) for at in range(0, len(ids), 64)]) for run in RUNS]
            yield pa.record_batch([part.column("doc_id"), pa.array(kept, pa.binary()), sizes, *keys], names=["doc_id", "ids", "n", "key", "key2"])


def _frequencies(batches: Iterator[pa.RecordBatch], width: str, vocabulary: int) -> Iterator[pa.RecordBatch]:
    """In how many of a task's documents each id occurs: an id counts where it stands last in a document."""
    counts, last = np.zeros(vocabulary, np.int64), np.zeros(vocabulary, np.int64)
    for batch in batches:
        for held in batch.column("ids").to_pylist():
            ids = np.frombuffer(held, width)
            place = np.arange(len(ids))
            last[ids] = place
            counts[ids[last[ids] == place]] += 1
    used = np.flatnonzero(counts)
    yield pa.record_batch([used, counts[used]], names=["id", "df"])


def statistics(encoded: DataFrame, vocabulary: int, width: str) -> Statistics:
    """Document frequencies over all documents; a vocabulary's worth of them reaches the driver."""
    parts = encoded.select("ids").mapInArrow(partial(_frequencies, width=width, vocabulary=vocabulary), "id long, df long")
    rows = parts.groupBy("id").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(vocabulary, np.int64)
    df[rows.column("id").to_numpy()] = rows.column("df").to_numpy()
    docs, tokens = encoded.agg(F.count("*"), F.sum("n")).first()
    return Statistics(df, docs, (tokens or 0) / max(1, docs))


def _pack(batches: Iterator[pa.RecordBatch], known: Broadcast, width: str, window: int, shard_docs: int) -> Iterator[pa.RecordBatch]:
    packer = Packer(TaskContext.get().partitionId() << 40, window)
    ids: list = []
    encoded: list[bytes] = []
    tokens = 0
    for batch in handed_back(batches):
        for doc_id, held in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
            ids.append(doc_id)
            encoded.append(np.frombuffer(held, width).astype("<u4").tobytes())
            tokens += len(encoded[-1]) // 4
            if len(ids) == shard_docs or tokens >= SHARD_TOKENS:
                pack_shard(packer, ids, encoded, known.value)
                ids, encoded, tokens = [], [], 0
                yield packer.take()
    if ids:
        pack_shard(packer, ids, encoded, known.value)
    packer.finish()
    yield packer.take()


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids): all documents, cut into sequences.

    Every token id of every document, with one end id 0 after each, lies in exactly one piece. Sequences have
    `window` ids, or a power of two where a partition ends, so nothing is padded. Documents are dealt by ranges of
    their lexical keys; a group of copies of any size is cut like other ranges. A shard is SHARD_DOCS documents (or
    about SHARD_TOKENS ids) in key order, so the index never outgrows a task, and a lost task repeats the same
    sequences. The ids of special tokens' strings in a text are those of ordinary text.

    Null and empty texts are their end id alone. Repeated rows and rows without an id are packed like others; ties
    in a score go to the earlier row. An empty table gives an empty result. Other columns are not read. A very long
    text costs about 20 bytes of a worker's memory a character.
    """
    vocabulary = encoder(tokenizer_path).size
    width = "<u2" if vocabulary <= 1 << 16 else "<u4"
    encoded = stage(texts(docs).mapInArrow(partial(_encoded, path=tokenizer_path), ENCODED), "encoded")
    stats = statistics(encoded, vocabulary, width)
    known = docs.sparkSession.sparkContext.broadcast(stats)
    total = encoded.agg(F.sum("n")).first()[0] or 0
    tie = F.xxhash64("doc_id", "n", "ids")  # copies of one text may be dealt to several ranges
    order = ("key", "key2", "tie")
    dealt = encoded.withColumn("tie", tie).repartitionByRange(total // DEAL_TOKENS + 1, *order).sortWithinPartitions(*order)
    return dealt.select("doc_id", "ids").mapInArrow(partial(_pack, known=known, width=width, window=window, shard_docs=SHARD_DOCS), PIECES)
