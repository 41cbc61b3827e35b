"""Repeated passages across documents, by sparse suffix arrays.

Only suffixes that begin at minimiser positions are kept: of any WINDOW consecutive K-word grams the one with the
least hash. A passage of PASSAGE words has one among its first WINDOW positions, chosen by its own words, so both
copies keep the same one and at least PREFIX words follow it. Suffixes are sorted by the name of their first PREFIX
words and compared with their neighbours; equal ones are extended left and right to every PASSAGE-word window
around them, which are sorted and compared in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywatch.llm.common import sized, stage, texts, utf8

PASSAGE = 50
K = 5
WINDOW = 16
PREFIX = PASSAGE - WINDOW + 1
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MEMO_WORDS = 400_000
BATCH_ROWS = 1 << 16
SPACE = np.zeros(256, bool)
SPACE[list(b" \t\n\r\x0b\x0c")] = True
SUFFIX = pa.schema([("key", pa.int64()), ("class", pa.int64()), ("at", pa.int32())])
PASSAGE_ROW = pa.schema([("key", pa.int64()), ("class", pa.int64()), ("at", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())])


class _Memo(dict):
    """XXH64 digests of words, computed once while remembered."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > MEMO_WORDS:
            self.clear()
        self[word] = digest = xxhash.xxh64_digest(word)
        return digest


MEMO = _Memo()
POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(POWERS["up"]) < n:
        for name, base in (("up", BASE), ("down", INVERSE)):
            POWERS[name] = np.concatenate([np.ones(1, np.uint64), np.full(2 * n - 1, base).cumprod(dtype=np.uint64)])
    return POWERS["up"], POWERS["down"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Names:
    """Names of all runs of n words of one text, from prefix sums."""

    def __init__(self, text: bytes):
        words = np.frombuffer(b"".join(map(MEMO.__getitem__, text.lower().split())), ">u8").astype(np.uint64)
        self.words = len(words)
        up, self._down = _powers(self.words + 1)
        self._sums = np.concatenate([np.zeros(1, np.uint64), (words * up[: self.words]).cumsum(dtype=np.uint64)])

    def of(self, n: int) -> np.ndarray:
        count = max(0, self.words - n + 1)
        return _mix((self._sums[n : n + count] - self._sums[:count]) * self._down[:count] + np.uint64(n))


def anchors(names: Names) -> np.ndarray:
    """For every start of PASSAGE words, the minimiser among its first WINDOW positions."""
    starts = names.words - PASSAGE + 1
    if starts <= 0:
        return np.zeros(0, np.int64)
    grams = names.of(K)[: starts + WINDOW - 1]
    return np.lib.stride_tricks.sliding_window_view(grams, WINDOW).argmin(axis=1) + np.arange(starts)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held, rows = [], 0
        for kind, text in zip(batch.column("class").to_pylist(), utf8(batch.column("text"))):
            names = Names(text)
            at = np.unique(anchors(names))
            held.append((names.of(PREFIX)[at].view(np.int64), np.full(len(at), kind), at.astype(np.int32)))
            rows += len(at)
            if rows > BATCH_ROWS:
                yield pa.record_batch([np.concatenate(x) for x in zip(*held)], schema=SUFFIX)
                held, rows = [], 0
        if held:
            yield pa.record_batch([np.concatenate(x) for x in zip(*held)], schema=SUFFIX)


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First code point and end of every word."""
    data = np.frombuffer(text, np.uint8)
    space = np.concatenate([[True], SPACE[data], [True]])
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points[np.flatnonzero(space[:-1] & ~space[1:])], points[np.flatnonzero(~space[:-1] & space[1:])]


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every PASSAGE-word window around the kept suffixes of a text."""
    for batch in batches:
        for kind, at, text in zip(batch.column("class").to_pylist(), batch.column("kept").to_pylist(), utf8(batch.column("text"))):
            names = Names(text)
            starts = np.flatnonzero(np.isin(anchors(names), at))
            begin, end = word_places(text)
            columns = [names.of(PASSAGE)[starts].view(np.int64), np.full(len(starts), kind), starts, begin[starts], end[starts + PASSAGE - 1]]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, PASSAGE_ROW.types)], schema=PASSAGE_ROW)


@dataclass
class _Run:
    """Rows of one key that may go on: in the next batch, or in the next partition if it is at an edge."""

    key: int
    kind: int
    edge: bool
    many: bool = False
    parts: list[pa.RecordBatch] = field(default_factory=list)

    def add(self, part: pa.RecordBatch, kinds: np.ndarray) -> None:
        self.parts.append(part)
        self.many = self.many or bool(kinds[0] != self.kind or kinds[-1] != kinds[0])

    def release(self) -> Iterator[pa.RecordBatch]:
        """The rows so far of a run that is known to be repeated; the last one stays, for the edge."""
        *whole, last = self.parts
        for part in [*whole, last.slice(0, last.num_rows - 1)]:
            if part.num_rows:
                yield _flagged(part, True, self.edge)
        self.parts = [last.slice(last.num_rows - 1)]

    def flush(self, edge: bool) -> Iterator[pa.RecordBatch]:
        if self.many or edge:
            for part in self.parts:
                yield _flagged(part, self.many, edge)
        self.parts = []


def _flagged(part: pa.RecordBatch, repeated: bool, edge: bool) -> pa.RecordBatch:
    flags = [pa.array(np.full(part.num_rows, f)) for f in (repeated, edge)]
    return pa.record_batch([*part.columns, *flags], names=[*part.schema.names, "repeated", "edge"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and class: those whose key has several classes, and the runs at both edges."""
    run: _Run | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, kind = batch.column("key").to_numpy(), batch.column("class").to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
        ends = np.append(starts[1:], batch.num_rows)
        if run is None:
            run = _Run(int(key[0]), int(kind[0]), edge=True)
        goes_on = int(key[0]) == run.key
        if goes_on:
            run.add(batch.slice(0, ends[0]), kind[: ends[0]])
        if goes_on and len(starts) == 1:
            if run.many:  # known to be repeated: nothing to wait for
                yield from run.release()
            continue
        yield from run.flush(run.edge)
        inner = np.arange(int(goes_on), len(starts) - 1)
        inner = inner[kind[starts[inner]] != kind[ends[inner] - 1]]
        if len(inner):
            rows = np.concatenate([np.arange(starts[i], ends[i]) for i in inner])
            yield _flagged(batch.take(pa.array(rows)), True, False)
        run = _Run(int(key[-1]), int(kind[starts[-1]]), edge=False)
        run.add(batch.slice(starts[-1]), kind[starts[-1] :])
    if run is not None:
        yield from run.flush(True)


def across_classes(rows: DataFrame, name: str) -> DataFrame:
    """The rows whose key occurs in more than one class, found by sorting and comparing neighbours.

    Rows are dealt by ranges of (key, class, at), so a key with a third of all rows is spread over tasks; keys that
    cross from one partition to the next are settled afterwards from the runs at the edges, two keys a partition.
    """
    rows = stage(rows, name)
    order = ["key", "class", "at"]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema), "repeated boolean", "edge boolean"])
    out = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_compare, schema), f"{name}-repeated")
    # An edge row of a run that is repeated already settles its key, whatever classes the other edge rows have.
    several = (F.min("class") != F.max("class")) | F.bool_or("repeated")
    crossing = out.where("edge").groupBy("key").agg(several.alias("several")).where("several").select("key")
    crossed = out.where("edge and not repeated").join(F.broadcast(crossing), "key", "left_semi")
    return out.where("repeated").unionByName(crossed.select(*out.columns)).select(*rows.columns)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, start_word, end_word, start_char, end_char): passages that also stand in another document.

    A word is covered if one of the windows of PASSAGE words around it occurs in at least two documents; rows are
    the maximal covered stretches, ends exclusive, characters as code points. Words are runs without white space,
    A-Z lower-cased. A text that several rows hold is covered from its first to its last word if it has PASSAGE
    words; what repeats within one document only is not.

    Null, empty and short texts have no passage. Repeated rows are documents of their own and each give their
    rows; so do rows without an id. An empty table gives an empty result. Other columns are not read.
    """
    hashed = texts(docs).withColumn("class", F.xxhash64("text"))
    ids = stage(hashed.select("doc_id", "class"), "classes")
    classes = ids.groupBy("class").agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep"))
    kept = across_classes(hashed.select("class", "text").mapInArrow(_suffixes, "key long, class long, at int"), "suffixes")
    chosen = kept.groupBy("class").agg(F.collect_set("at").alias("kept")).join(classes, "class")
    chosen = stage(chosen.select(F.col("rep"), F.col("class").alias("of"), "kept"), "chosen")
    same = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("class") == F.col("of"))
    windows = hashed.join(chosen, same).select("class", "kept", "text").mapInArrow(_extended, "key long, class long, at int, begin int, end int")
    covered = across_classes(windows, "passages").dropDuplicates(["class", "at"])
    fresh = f"at > coalesce(lag(at) over (partition by class order by at) + {PASSAGE}, -1)"
    islands = covered.withColumn("fresh", F.expr(fresh)).withColumn("island", F.expr("sum(cast(fresh as int)) over (partition by class order by at)"))
    spans = islands.groupBy("class", "island").agg(
        F.min("at").alias("start_word"), (F.max("at") + PASSAGE).alias("end_word"), F.min("begin").alias("start_char"), F.max("end").alias("end_char")
    )
    columns = ["start_word", "end_word", "start_char", "end_char"]
    copied = classes.where("copies > 1").select("class")
    partly = spans.join(copied, "class", "left_anti").select("class", *columns)
    single = ids.join(partly, "class").select("doc_id", *columns)
    whole = hashed.join(sized(copied), "class").select("doc_id", "text").mapInArrow(_whole, "doc_id long, start_word int, end_word int, start_char int, end_char int")
    return single.unionByName(whole).select("doc_id", *(F.col(c).cast("long").alias(c) for c in columns))


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
            begin, end = word_places(text)
            if len(begin) >= PASSAGE:
                rows.append((doc_id, 0, len(begin), int(begin[0]), int(end[-1])))
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64(), *[pa.int32()] * 4]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "start_word", "end_word", "start_char", "end_char"])
