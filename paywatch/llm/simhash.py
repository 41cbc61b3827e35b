"""Near duplicates by SimHash, searched with a forest of vantage-point trees."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywatch.llm.common import runs_of, sized, stage, texts, utf8
from paywatch.llm.graph import components

RADIUS = 3
SHINGLE = 3
SEED = 42
LEAF_ROWS = 256
HOT_ROWS = 50_000
BLOCK = 1024
COUNT_BLOCK = 1 << 16
MAX_LEVELS = 40
# Ids from here on stand for fingerprints that only rows without a doc_id have.
UNNAMED = 1 << 62
# A pair within 3 bits has at most 1 differing bit in one 32-bit half: one tree per half, searched with radius 1.
HALVES = (32, 0)
HALF_RADIUS = 1
EDGE = 16
CELL = pa.schema([("cell", pa.int64()), ("fp", pa.int64()), ("rep", pa.int64())])
LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text, as a signed long; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.array([digest(join(g), SEED) for g in grams], dtype=">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNT_BLOCK):
        part = hashes[at : at + COUNT_BLOCK]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = pa.array([fingerprint(t, shingle) for t in utf8(batch.column("text"))], pa.int64())
        yield pa.record_batch([batch.column("doc_id"), fps], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): one row per document row."""
    return texts(docs).mapInArrow(partial(_fingerprints, shingle=shingle), "doc_id long, fp long")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _vantages(levels: int, seed: int = 20240229) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 32, size=(len(HALVES), MAX_LEVELS), dtype=np.uint64).astype(np.uint32)[:, :levels]


def _route(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    """Every fingerprint in its own leaf of each tree and in the leaves its search ball reaches.

    A level asks for the distance to its vantage point: below EDGE or not. Two halves one bit apart differ by at
    most one in that distance, so only distance EDGE itself reaches over the boundary; one side's visit is enough.
    """
    vantages = _vantages(levels)
    for batch in batches:
        fps = batch.column("fp").to_numpy().view(np.uint64)
        for tree, shift in enumerate(HALVES):
            half = (fps >> np.uint64(shift)).astype(np.uint32)
            rows = np.arange(len(fps))
            cell = np.full(len(fps), tree, np.int64)
            for level in range(levels):
                far = np.bitwise_count(half[rows] ^ vantages[tree, level]).astype(np.int64)
                over = far == EDGE + HALF_RADIUS - 1
                cell = np.concatenate([cell * 2 + (far >= EDGE), cell[over] * 2])
                rows = np.concatenate([rows, rows[over]])
            taken = pa.array(rows)
            yield pa.record_batch([pa.array(cell), batch.column("fp").take(taken), batch.column("rep").take(taken)], schema=CELL)


def _settle(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Union the pairs (left, right) into root labels."""
    while True:
        a, b = label[left], label[right]
        open_ = a != b
        if not open_.any():
            return label
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(shorter := label[label], label):
            label = shorter


def leaf_links(fps: np.ndarray, reps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (a > b) that join all fingerprints of one leaf within the radius, a star for each local component.

    Rows are ordered by distance to a vantage point; a block meets only the rows whose distance its own triangle
    bound allows.
    """
    order = np.argsort(np.bitwise_count(fps ^ fps[0]), kind="stable")
    fps, reps = fps[order], reps[order]
    far = np.bitwise_count(fps ^ fps[0]).astype(np.int64)
    label = np.arange(len(fps))
    for begin in range(0, len(fps), BLOCK):
        end = min(begin + BLOCK, len(fps))
        until = np.searchsorted(far, far[end - 1] + radius, side="right")
        for at in range(begin, until, 8 * BLOCK):
            stop = min(at + 8 * BLOCK, until)
            left, right = np.nonzero(np.bitwise_count(fps[begin:end, None] ^ fps[None, at:stop]) <= radius)
            label = _settle(label, left + begin, right + at)
    root = np.full(len(fps), np.iinfo(np.int64).max)
    np.minimum.at(root, label, reps)
    root = root[label]
    linked = root < reps
    return reps[linked], root[linked]


def _search(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0
    for leaf in runs_of(batches, "key"):
        if leaf.num_rows > 1:
            held.append(leaf_links(leaf.column("fp").to_numpy().view(np.uint64), leaf.column("rep").to_numpy(), radius))
            rows += len(held[-1][0])
        if rows > 10_000:
            yield pa.record_batch([np.concatenate(x) for x in zip(*held)], schema=LINK)
            held, rows = [], 0
    if held:
        yield pa.record_batch([np.concatenate(x) for x in zip(*held)], schema=LINK)


def leaf_levels(distinct: int) -> int:
    """Depth at which a leaf of evenly spread fingerprints holds about LEAF_ROWS: a level keeps 57 % of the rows."""
    return min(MAX_LEVELS, max(0, math.ceil(math.log(max(1, distinct) / LEAF_ROWS) / -math.log(0.57))))


def near_links(distinct: DataFrame, radius: int = RADIUS, levels: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(a, b): links that connect all fingerprints at most `radius` <= 3 bits apart.

    `distinct` has one row (fp, rep) per fingerprint. Leaves are independent tasks; a leaf of more than `hot_rows`
    fingerprints is dealt out as pairs of blocks, so that no pair is lost and no task holds the whole leaf.
    """
    if radius > RADIUS:
        raise ValueError("the trees are exact for up to 3 differing bits")
    levels = leaf_levels(distinct.count()) if levels is None else levels
    cells = stage(distinct.mapInArrow(partial(_route, levels=levels), "cell long, fp long, rep long"), "cells")
    # Hot leaves number at most rows / hot_rows, whatever the input.
    hot = cells.groupBy("cell").count().where(F.col("count") > hot_rows).select("cell", F.ceil(F.col("count") / hot_rows).alias("parts"))
    dealt = (
        cells.join(F.broadcast(hot), "cell", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("fp"), "parts"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .select(F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp", "rep")
    )
    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(partial(_search, radius=radius), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per document row.

    component_id is the smallest doc_id reachable over links between fingerprints. Null, empty and blank texts
    have fingerprint zero and link like any other; repeated rows each give a row. A row without a doc_id has a
    fingerprint and joins its group, but never names it: its component_id is null when no member has an id.
    An empty table gives an empty result. Other columns are not read.
    """
    table = stage(fingerprints(docs, shingle), "fingerprints")
    stand_in = F.shiftrightunsigned(F.xxhash64("fp"), 2).bitwiseOR(F.lit(UNNAMED))
    distinct = stage(table.groupBy("fp").agg(F.coalesce(F.min("doc_id"), stand_in).alias("rep")), "distinct")
    groups = components(near_links(distinct, radius))
    named = distinct.join(groups, distinct.rep == groups.node, "left").select("fp", F.coalesce("root", "rep").alias("least"))
    component = F.when(F.col("least") < UNNAMED, F.col("least")).alias("component_id")
    return table.join(named, "fp", "left").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), component)


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of a documents table, with all their columns, one for each near-duplicate group: the smallest doc_id.

    Groups are those of `near_duplicates`, but of rows: two texts under one doc_id are two rows and stay apart unless
    their fingerprints link. Of several rows with a group's smallest doc_id one stays, chosen by a hash of the text;
    equal rows are interchangeable. Null, empty and blank texts are one group. A row without a doc_id cannot be
    named in a group and stays. An empty table gives an empty result. Columns may have any names.
    """

    @F.arrow_udf("long")
    def named(text: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, shingle) for t in utf8(text)], pa.int64())

    id_, h = F.col("row.doc_id"), F.xxhash64("row.text")
    held = docs.select(F.struct("*").alias("row"))
    fps = named(F.coalesce("row.text", F.lit(""))).alias("fp")
    table = stage(held.select(id_.alias("id"), h.alias("h"), fps), "near-rows")  # no text is stored or shuffled
    distinct = stage(table.select("fp").distinct().select("fp", F.col("fp").alias("rep")), "distinct")
    groups = stage(components(near_links(distinct, radius)), "groups")
    texts_of = table.where("id is not null").groupBy("id", "h", "fp").agg(F.count(F.lit(1)).alias("n"))
    texts_of = stage(texts_of.join(sized(groups), F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp")), "near-texts")
    # One row for every group; of a group of many texts each task sends one.
    first = texts_of.groupBy("root").agg(F.min(F.struct("id", "h")).alias("first"))
    judged = texts_of.join(sized(first), "root").withColumn("stays", F.struct("id", "h") == F.col("first"))
    gone = stage(judged.where(~F.col("stays")).select(F.col("id").alias("of_id"), F.col("h").alias("of_h")), "near-gone")
    twice = stage(judged.where(F.col("stays") & (F.col("n") > 1)).select(F.col("id").alias("of_id"), F.col("h").alias("of_h")), "near-twice")
    same = (id_ == F.col("of_id")) & (h == F.col("of_h"))
    kept = held.join(sized(gone), same, "left_anti")
    if not twice.isEmpty():
        again = kept.join(sized(twice), same).groupBy("of_id", "of_h").agg(F.any_value("row").alias("row")).select("row")
        kept = kept.join(sized(twice), same, "left_anti").unionByName(again)
    return kept.select("row.*")
