"""Document fingerprints by locally consistent parsing.

Deterministic coin tossing cuts a text into phrases at places that depend on a few neighbouring characters only, and
names each phrase by its content; parsing the names again gives longer phrases, up to two for the whole text. Equal
substrings get equal phrases inside, on every level, wherever they stand, so the set of phrase names shows what two
texts share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywatch.llm.common import texts, utf8

# Names from this level on count, phrases of about ten characters; the ones below are too common.
LEAST_LEVEL = 2
# A sketch holds all of SKETCH names, and of more a SHARE-th: the share of a text that an edit must touch to be seen
# does not grow with the text.
SKETCH, SHARE = 64, 16
GROUP_CHARS = 1 << 17
SLICE_BYTES = 4 << 20
MAX_SLICES = 1 << 14
WEIGHTS = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWEST = np.array([0] + [(i & -i).bit_length() - 1 for i in range(1, 256)], np.uint8)
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _named(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A name for every stretch of values, from its content."""
    size = np.diff(np.append(starts, len(values)))
    place = np.arange(len(values)) - np.repeat(starts, size)
    return _mix(np.add.reduceat(values * WEIGHTS[place % 64] + place.astype(np.uint64), starts) + size.astype(np.uint64))


def parse(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: the phrases of symbols `names`; `first` marks where a text begins, here and in the result."""
    # A run of one symbol is one symbol, so neighbours differ.
    change = first.copy()
    change[1:] |= names[1:] != names[:-1]
    starts = np.flatnonzero(change)
    first = first[starts]
    runs = _mix(names[starts] + np.diff(np.append(starts, len(names))).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    # Coin tossing: the lowest bit in which a symbol differs from its left neighbour, and its value. 64 bits become
    # 7, then 4, 3 and 3: labels below 6, neighbours still different. A text's first symbol has its bit 0.
    differ = runs.copy()
    differ[1:] ^= runs[:-1]
    differ[first] = 1
    lowest = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1))
    label = (2 * lowest + ((runs >> lowest.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)).astype(np.uint8)
    for _ in range(3):
        differ = label.copy()
        differ[1:] ^= label[:-1]
        differ[first] = 1
        lowest = LOWEST[differ]
        label = 2 * lowest + ((label >> lowest) & 1)
    # A phrase begins at a text's first symbol and at every local maximum.
    peak = np.ones(len(label), bool)
    peak[1:] = label[1:] > label[:-1]
    last = np.append(first[1:], True)
    peak[:-1] &= (label[:-1] > label[1:]) | last[:-1]
    starts = np.flatnonzero(peak | first)
    return _named(runs, starts), first[starts]


def phrase_names(symbols: list[np.ndarray]) -> list[np.ndarray]:
    """For every text, given as code points, the distinct names of its phrases on all levels from LEAST_LEVEL on,
    32 bits each, in order. A text is parsed until two phrases are left: two may stay two."""
    found: list[list[np.ndarray]] = [[] for _ in symbols]
    owners = np.array([i for i, s in enumerate(symbols) if len(s)])
    if not len(owners):
        return [np.zeros(0, np.uint32)] * len(symbols)
    names = np.concatenate([symbols[i] for i in owners]).astype(np.uint64)
    first = np.zeros(len(names), bool)
    first[np.cumsum([0, *(len(symbols[i]) for i in owners[:-1])])] = True
    level = 0
    while len(owners):
        names, first = parse(names, first)
        level += 1
        if level < LEAST_LEVEL:
            continue
        starts = np.flatnonzero(first)
        for owner, part in zip(owners.tolist(), np.split((names >> np.uint64(32)).astype(np.uint32), starts[1:])):
            found[owner].append(part)
        # Texts that are done are left out; the others do not depend on them.
        longer = np.diff(np.append(starts, len(names))) > 2
        stay = np.repeat(longer, np.diff(np.append(starts, len(names))))
        owners, names, first = owners[longer], names[stay], first[stay]
    return [np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint32) for parts in found]


def sketches(symbols: list[np.ndarray]) -> list[np.ndarray]:
    """For every text the least of its phrase names, in order: SKETCH, and one of SHARE beyond."""
    return [names[: SKETCH + max(0, len(names) - SKETCH) // SHARE] for names in phrase_names(symbols)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two phrase sets, from their sketches; 1 for two empty texts.

    A sketch of SKETCH names or more may lack those beyond its last one, so only names up to there are compared.
    """
    for x in (a, b):
        if len(x) >= SKETCH:
            a, b = a[a <= x[-1]], b[b <= x[-1]]
    together = len(np.intersect1d(a, b, assume_unique=True))
    return together / (len(a) + len(b) - together) if len(a) or len(b) else 1.0


def _points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode().encode("utf-32-le"), "<u4")


def edited(own: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The last third of a text's code points replaced by as many first ones of the next text, or all it has."""
    cut = len(own) // 3
    return np.concatenate([own[: len(own) - cut], after[:cut]])


def _compared(rows: list[tuple[int | None, np.ndarray]], after: np.ndarray) -> pa.RecordBatch:
    """Rows in order, the last one followed by the text `after`."""
    own = [x for _, x in rows] + [after]
    changed = [edited(a, b) for a, b in zip(own, own[1:])]
    found = sketches(own + changed)
    mine, theirs = found[: len(own)], found[len(own) :]
    texts_ = [x.astype("<u4").tobytes().decode("utf-32-le").encode() for x in changed]
    return pa.record_batch(
        {
            "doc_id": pa.array([i for i, _ in rows], pa.int64()),
            "n_chars": pa.array([len(x) for _, x in rows], pa.int64()),
            "edited_sha256": [hashlib.sha256(t).hexdigest() for t in texts_],
            "fingerprint": [x.astype(">u4").tobytes().hex() for x in mine[:-1]],
            "edited_fingerprint": [x.astype(">u4").tobytes().hex() for x in theirs],
            "near_edited": [likeness(a, b) for a, b in zip(mine, theirs)],
            "near_next": [likeness(a, b) for a, b in zip(mine, mine[1:])],
        }
    )


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted slices, each ended by a row that only serves as the next text."""
    held: list[tuple[int | None, np.ndarray]] = []
    chars = 0
    for batch in batches:
        for doc_id, tail, text in zip(batch.column("doc_id").to_pylist(), batch.column("tail").to_pylist(), utf8(batch.column("text"))):
            points = _points(text)
            if held and (tail or chars > GROUP_CHARS):
                yield _compared(held, points)
                held, chars = [], 0
            if not tail:
                held.append((doc_id, points))
                chars += len(points)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint and that of its edited text, with the columns of SCHEMA.

    Documents follow each other by descending doc_id, rows of one id by text, rows without an id last; after the
    last comes the first. A fingerprint is a sketch of the names of the text's phrases on all levels, in hex, and grows
    with the text; `likeness` compares two. Measured against the whole sets at a likeness of one half, its standard
    deviation is 0.04 for texts of 1,000 characters, 0.024 for 17,000 and 0.011 for 115,000.
    Null and empty texts have an empty fingerprint, which is like another empty one only. Repeated rows each give
    a row. An empty table gives an empty result; a single row follows itself. Other columns are not read.

    The order is cut into slices of about SLICE_BYTES at percentiles of the id. Only the first row of each slice
    is read twice, to end the slice before, so each text is shuffled once.
    """
    rows = texts(docs)
    size = rows.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    slices = int(min(MAX_SLICES, (size[0] or 0) // SLICE_BYTES + 1))
    steps = [i / slices for i in range(1, slices)]
    cuts = rows.agg(F.percentile_approx("doc_id", steps, 20 * slices + 10_000)).first()[0] if steps else []
    inner = sorted({float(c) for c in cuts or []})
    bucket = F.lit(0)
    if inner:
        bucketed = Bucketizer(splits=[-float("inf"), *inner, float("inf")], inputCol="place", outputCol="bucket", handleInvalid="keep")
        rows, bucket = bucketed.transform(rows.withColumn("place", F.col("doc_id").cast("double"))), F.col("bucket").cast("int")
    placed = rows.select("doc_id", "text", F.when(F.col("doc_id").isNull(), -1).otherwise(bucket).alias("slice"))
    heads = placed.groupBy("slice").agg(F.max("doc_id").alias("head")).orderBy(F.desc("slice")).toArrow().to_pylist()  # at most MAX_SLICES rows
    if not heads:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    before = {h["slice"]: heads[i - 1]["slice"] for i, h in enumerate(heads)}
    to = docs.sparkSession.createDataFrame([(h["slice"], h["head"], before[h["slice"]]) for h in heads], "slice int, head long, ends int")
    same = (placed.slice == to.slice) & placed.doc_id.eqNullSafe(to["head"])
    tails = placed.join(F.broadcast(to), same).groupBy("ends").agg(F.min("text").alias("text"))
    dealt = placed.withColumn("tail", F.lit(0)).unionByName(tails.select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("ends").alias("slice"), F.lit(1).alias("tail")))
    ordered = dealt.repartition("slice").sortWithinPartitions("slice", "tail", F.desc_nulls_last("doc_id"), "text")
    return ordered.mapInArrow(_in_order, SCHEMA)
