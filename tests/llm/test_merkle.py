"""The Merkle manifest against trees built in plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from paywatch.llm import merkle, ordering, queries
from tests.conftest import SMALL
from tests.llm.conftest import CLASHES, EDGES, text

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """All levels above a list of nodes, and every node's siblings on the way up."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    ways = []
    for at in range(len(nodes)):
        way = []
        for level in levels[:-1]:
            run = at // 3 * 3
            way.append((level[run:at], level[at + 1 : run + 3]))
            at //= 3
        ways.append(way)
    return levels[-1][0], ways


def plain(rows):
    """(doc_id, leaf, subroot, root, proof digest, root folded from the tampered leaf) of every row."""
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append((row[0], plain_leaf(row), row))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([n for _, n, _ in sorted(by_source[s], key=lambda x: (x[0] is not None, x[:2]))]) for s in names}
    root, tops = climb([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for (i, node, row), way in zip(sorted(by_source[s], key=lambda x: (x[0] is not None, x[:2])), trees[s][1]):
            told = zlib.crc32(("" if i is None else str(i)).encode()) % 2 == 0
            now = plain_leaf((*row[:4], row[4].replace("\n", ""))) if told and row[4] is not None else node
            for left, right in way + top:
                now = h(*left, now, *right)
            out.append((i, node, trees[s][0], root, h(*(x for left, right in way + top for x in left + right)), now))
    return sorted(out, key=str)


def got(spark, df, monkeypatch):
    monkeypatch.setattr(queries, "read_documents", lambda spark, folder: df)
    rows = queries.op12_merkle_manifest(spark, "").collect()
    assert all(r.verified == (r.folded_root == r.root) for r in rows)
    return sorted([(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in rows], key=str)


@pytest.mark.parametrize("levels,slice_rows", [(5, 200_000), (1, 7), (2, 5)])
def test_sources_of_every_size(spark, monkeypatch, levels, slice_rows):
    """From one leaf to several blocks of blocks; ids out of order, a hot source, a null one."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", merkle.ARITY**levels)
    monkeypatch.setattr(ordering, "SLICE_ROWS", slice_rows)
    sizes = {None: 5, "": 1, "é": 3, "z": 4, "a": 9, "b": 10, "src|hot": 95, "c": 27, "Z": 2}
    rows = [(n * 1000 + i * 37 % size, s, "en", i, f"{text(i, 3)}\n{i}") for n, (s, size) in enumerate(sizes.items()) for i in range(size)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    assert got(spark, df, monkeypatch) == plain(rows)


def test_edges(spark, docs, monkeypatch):
    rows = [r for r in EDGES] + [(20, "a\nb"), (20, "a\nb"), (20, None), (None, None), (-3, "\n\n")]
    table = docs(rows, **CLASHES, grp="x", node="x", pos="x", row="x", path="x", root="x", levels="x")
    full = [(i, "src0", "en", None if t is None else len(t), t) for i, t in rows]
    assert got(spark, table, monkeypatch) == plain(full)
    bare = spark.createDataFrame([(1, None, None, None, None)], COLUMNS)
    assert got(spark, bare, monkeypatch) == plain([(1, None, None, None, None)])
    assert got(spark, docs([]), monkeypatch) == [] and merkle.manifest(docs([])).root().count() == 0


def test_fields_cannot_run_into_each_other(spark):
    rows = [(1, "ab", "c", None, ""), (1, "a", "bc", None, ""), (1, "a", "bc", None, None), (1, None, "-", None, None), (1, "-", None, None, None)]
    leaves = [r[0] for r in spark.createDataFrame(rows, COLUMNS).select(merkle.leaf()).collect()]
    assert len(set(leaves)) == 5 and set(leaves) == set(map(plain_leaf, rows))


def test_proofs_and_roots_of_the_library(spark):
    tree = merkle.manifest(spark.read.parquet(f"{SMALL}/documents.parquet"))
    rows = tree.proofs().withColumn("folded", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    root = tree.root().first().root
    assert rows and all(r.folded == r.root == root for r in rows)
    assert {(r.source, r.subroot) for r in rows} == {tuple(r) for r in tree.subroots().collect()}
