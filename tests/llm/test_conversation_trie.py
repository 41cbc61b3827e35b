"""The trie of rebuilt conversations against plain Python, with rebuilt texts and nested dictionaries."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from paywatch.llm import conversation_trie as ct
from paywatch.llm import ordering

COLUMNS = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Rows of the trie from (conv_id, turn, role, text) rows whose turn numbers differ inside a conversation."""
    convs = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            convs.setdefault(c, []).append((role or "", text or ""))
    nodes = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        rebuilt = tuple(convs.get(base, [])[:h] + own[h:])
        for d in range(len(rebuilt) + 1):
            node = nodes.setdefault(rebuilt[:d], {"members": [], "ends": []})
            node["members"].append(c)
        node["ends"].append(c)
    out = []
    for path, node in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        childless = [p for p in below if not any(q[: len(p)] == p and len(q) == len(p) + 1 for q in nodes)]
        saved = sum((len(nodes[p]["members"]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(map(str, sorted(node["ends"])))
        parent = min(nodes[path[:-1]]["members"]) if path else None
        out.append((min(node["members"]), len(path), parent, len(node["members"]), len(children), len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, **more):
    return sorted(map(tuple, ct.trie(df, **more).collect()), key=str)


def conversations(seed, n, spread=2, longest=12):
    """Few different turns, so that prefixes meet; some conversations are copies of others."""
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-20, 4 * n), n):
        turns = [(rng.choice(["user", "assistant", None]), rng.choice(["é", "bb", None, "c" * 9, ""][: spread + 3])) for _ in range(rng.randint(1, longest))]
        if c % 3 == 0:
            turns = [("user", "bb")] * 4
        places = rng.sample(range(50), len(turns))
        rows += [(c, None if p == min(places) else p, *t) for p, t in zip(places, turns)]
    return rows


@pytest.mark.parametrize("slice_rows,chunk", [(200_000, 1000), (9, 3)])
def test_trie_equals_plain_python(spark, monkeypatch, slice_rows, chunk):
    """Small slices cut conversations and the lists of ends; the smallest chunks are streamed."""
    monkeypatch.setattr(ordering, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(ct, "CHUNK_IDS", chunk)
    rows = conversations(1, 60)
    assert got(spark.createDataFrame(rows, COLUMNS).repartition(3)) == plain(rows)


def test_a_long_conversation_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SLICE_ROWS", 50)
    monkeypatch.setattr(ct, "CHUNK_IDS", 7)
    rows = [(5, i, "user", f"t{i}") for i in range(150)] + [(c, i, "user", "same") for c in range(1000, 1060) for i in range(9)]
    assert got(spark.createDataFrame(rows, COLUMNS)) == plain(rows)


def test_colliding_hashes_are_seen_and_drawn_anew(spark):
    rows = conversations(2, 40)
    df = spark.createDataFrame(rows, COLUMNS)
    weak_turns, weak_products = ct.Draw(1, bits=2), ct.Draw(1, primes=(5, 3, 7))
    assert got(df, draws=[weak_turns, weak_products, ct.Draw(9)]) == plain(rows)
    for weak in (weak_turns, weak_products):
        with pytest.raises(ValueError):
            ct.trie(df, draws=[weak])


def test_edges(spark):
    more = ", key string, depth string, owner string, fa string, slice string, ref string"
    rows = [(None, 1, "user", "lost"), (1, None, None, None), (2, 1, "user", ""), (3, 1, "user", "x" * 100_000), (4, 1, "user", "x" * 100_000), (4, 2, "a", "b")]
    wide = spark.createDataFrame([(*r, *"abcdef") for r in rows], COLUMNS + more)
    assert got(wide) == plain(rows)
    assert got(spark.createDataFrame([], COLUMNS)) == []
    twice = [(0, 1, "user", "a"), (0, 1, "user", "a"), (0, 2, "user", "b")]
    assert got(spark.createDataFrame(twice, COLUMNS)) == plain([(0, 1, "user", "a"), (0, 1, "user", "a"), (0, 2, "user", "b")])


def test_turns_of_one_number_have_one_order(spark):
    rows = [(10, 1, "user", t) for t in "abcdefgh"]
    left = got(spark.createDataFrame(rows, COLUMNS).coalesce(1))
    assert left == got(spark.createDataFrame(rows[::-1], COLUMNS).repartition(3))


def test_a_turnless_conversation_is_a_member(spark):
    """Conversation 6 takes its first turns from 5, which is absent, and has no turn after them."""
    assert zlib.crc32(b"6") % 9 >= 1
    rows = [(6, 0, "user", "own")]
    assert got(spark.createDataFrame(rows, COLUMNS)) == plain(rows) and len(plain(rows)) == 1


def test_powers(spark):
    row = spark.range(1).select(*(ct._power(ct.F.lit(k).cast("long"), 12345, ct.PRIMES[0], 6).alias(f"p{k}") for k in (0, 1, 63, 64, 10**9))).first()
    assert list(row) == [pow(12345, k, ct.PRIMES[0]) for k in (0, 1, 63, 64, 10**9)]


def test_streamed_digests_across_batches():
    rows = [(1, 2, 3, "1,2"), (1, 2, 3, "3"), (1, 2, 4, "9")]
    batches = [pa.record_batch([pa.array([r[i]]) for i in range(4)], names=["depth", "fa", "fb", "ids"]) for r in rows]
    out = pa.Table.from_batches(list(ct._hash_chunks(iter(batches)))).to_pylist()
    assert [r["digest"] for r in out] == [hashlib.sha256(x).hexdigest() for x in (b"1,2,3", b"9")]
