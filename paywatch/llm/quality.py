"""Quality classifier: histogram gradient-boosted trees over document statistics, flattened into arrays."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywatch.llm.common import handed_back, texts, training_bucket, utf8

# Labelled rows the trees are fitted on: the ones with the least id hash, a uniform sample that bounds the driver.
TRAIN_ROWS = 50_000
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
RIDGE = 1.0
LEAST_HESSIAN = 2.0
KEEP_FROM = 0.3

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "word_bytes_sd", "distinct_words", "top_word", "same_next", "distinct_pairs",
    "lines", "distinct_lines", "line_bytes", "upper", "lower", "digit", "beyond_ascii", "space", "stop_comma", "bar",
    "exclaim", "symbols", "other_marks", "entropy", "marked_words",
)


def _byte_classes() -> np.ndarray:
    """Rows of 0/1 weights over the 256 byte values, one for each share from `upper` on."""
    groups = [
        range(0x41, 0x5B), range(0x61, 0x7B), range(0x30, 0x3A), range(0x80, 0x100), b" \t\n\r\x0b\x0c", b".,", b"|", b"!", b"#$%&*@^~_=+<>{}[]\\",
        b"\"'()-/:;?`",
    ]
    table = np.zeros((len(groups), 256))
    for row, group in zip(table, groups):
        row[list(group)] = 1
    return table


BYTE_CLASSES = _byte_classes()
WORD_END = np.zeros(256, bool)
WORD_END[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100), *b".,;:?"]] = True


def statistics(text: bytes) -> list[float]:
    """The FEATURES of a text; an empty one has zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    words, lines = text.split(), text.split(b"\n")
    n, count = len(text), np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = count[count > 0] / n
    entropy = -float((share * np.log2(share)).sum())
    classes = (BYTE_CLASSES @ count / n).tolist()
    line_stats = [len(lines) / n * 100, len(set(lines)) / len(lines), n / len(lines)]
    if not words:
        return [np.log1p(n), 0, 0, 0, 0, 0, 0, 0, *line_stats, *classes, entropy, 0]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    kinds = Counter(words)
    pairs = max(1, len(words) - 1)
    ends = np.frombuffer(b"".join([w[-1:] for w in words]), np.uint8)
    return [
        np.log1p(n), np.log1p(len(words)), sizes.mean(), sizes.std(), len(kinds) / len(words), max(kinds.values()) / len(words),
        sum(map(eq, words, words[1:])) / pairs, len(set(zip(words, words[1:]))) / pairs, *line_stats, *classes, entropy,
        1 - WORD_END[ends].mean(),
    ]


def matrix(column: pa.Array) -> np.ndarray:
    return np.array([statistics(t) for t in utf8(column.fill_null(""))], np.float64).reshape(-1, len(FEATURES))


class Trees(NamedTuple):
    """Complete binary trees as arrays: node i has children 2i+1 and 2i+2; a row goes right if it is above the cut."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1, all rows and trees at once, level by level."""
        trees, inner = self.feature.shape
        if not trees:
            return np.full(len(x), _logistic(self.base))
        total = np.empty(len(x))
        tree = np.arange(trees)
        for at in range(0, len(x), 4096):
            part = x[at : at + 4096]
            row = np.arange(len(part))[:, None]
            node = np.zeros((len(part), trees), np.int64)
            while node.size and node[0, 0] < inner:
                node = 2 * node + 1 + (part[row, self.feature[tree, node]] > self.cut[tree, node])
            total[at : at + 4096] = self.value[tree, node - inner].sum(axis=1)
        return _logistic(self.base + total)


def _logistic(x):
    return 1 / (1 + np.exp(-x))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Trees:
    """Boosted trees for labels 0/1 with logistic loss; splits are taken from histograms of quantile bins.

    Without rows the probability is 0.5; with one class it is that class's share, smoothed by one row of each.
    """
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    inner, features = 2**depth - 1, x.shape[1]
    feature, cut, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    if len(np.unique(y)) < 2:
        return Trees(base, feature[:0], cut[:0], value[:0])
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(features)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    margin = np.full(len(y), base)
    for t in range(trees):
        p = _logistic(margin)
        gradient, hessian = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local = node - first
            best = np.full(width, 1e-6)
            for f in range(features):
                key = local * bins + binned[:, f]
                g = np.bincount(key, gradient, width * bins).reshape(width, bins).cumsum(axis=1)
                h = np.bincount(key, hessian, width * bins).reshape(width, bins).cumsum(axis=1)
                gain = g**2 / (h + RIDGE) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + RIDGE) - g[:, -1:] ** 2 / (h[:, -1:] + RIDGE)
                gain[(h < LEAST_HESSIAN) | (h[:, -1:] - h < LEAST_HESSIAN)] = 0
                gain = gain[:, : len(edges[f])]
                if not gain.shape[1]:
                    continue
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                better = np.nonzero(top > best)[0]
                best[better] = top[better]
                feature[t, first + better] = f
                cut[t, first + better] = edges[f][at[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > cut[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, hessian, inner + 1)
        value[t] = RATE * g / (h + RIDGE)
        margin += value[t, leaf]
    return Trees(base, feature, cut, value)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in handed_back(batches):
        rows = pa.array(list(matrix(batch.column("text"))), pa.list_(pa.float64()))
        yield pa.record_batch([batch.column("label"), rows], names=["label", "x"])


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, **shape: int) -> Trees:
    """Fit on the labelled documents whose id's crc32 is not 0 modulo 5, at most `train_rows` of them.

    The rows with the least id hash are taken. Labels without a quality or an id are left out; repeated labels of an
    id count once, as 0 if they disagree. Only the statistics of these rows reach the driver.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("label_id"))
    known = known.agg(F.min("quality").cast("int").alias("label")).where(training_bucket(F.col("label_id")) != 0)
    taken = known.orderBy(F.xxhash64("label_id"), "label_id").limit(train_rows)
    joined = texts(docs).join(F.broadcast(taken), F.col("doc_id") == F.col("label_id"))
    rows = joined.select("label", "text").mapInArrow(_described, "label int, x array<double>").toArrow()
    x = np.array(rows.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    y = rows.column("label").to_numpy().astype(np.float64)
    order = np.lexsort((*x.T, y))  # rows come in any order; sums shall not depend on it
    return fit(x[order], y[order], **shape)


def _scored(batches: Iterator[pa.RecordBatch], model: Trees) -> Iterator[pa.RecordBatch]:
    for batch in handed_back(batches):
        yield pa.record_batch([batch.column("doc_id"), pa.array(model.score(matrix(batch.column("text"))))], names=["doc_id", "score"])


def scores(docs: DataFrame, model: Trees) -> DataFrame:
    """(doc_id, score): the probability of good quality of every document row, from its text alone.

    Null, empty and blank texts have a score like any other; repeated rows each give a row and equal texts equal
    scores. An empty table gives an empty result. Other columns are not read.
    """
    return texts(docs).mapInArrow(partial(_scored, model=model), "doc_id long, score double")


def _kept(batches: Iterator[pa.RecordBatch], model: Trees, least: float) -> Iterator[pa.RecordBatch]:
    for batch in handed_back(batches):
        text = batch.column(batch.schema.get_field_index("text")).cast(pa.string())
        yield batch.filter(pa.array(model.score(matrix(text)) >= least))


def keep(docs: DataFrame, model: Trees, least: float = KEEP_FROM) -> DataFrame:
    """The rows of `docs`, all columns, whose score reaches `least`."""
    return docs.mapInArrow(partial(_kept, model=model, least=least), docs.schema)
