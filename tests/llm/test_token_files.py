import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paywatch.llm import encoding, packing, token_codes
from paywatch.llm.common import stage_path
from tests.llm.conftest import CLASHES, EDGES, text, words

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ODD = [
    "", "  a  b\n\n c\t", "İKK á ́x\x1cy", "don't 'S it's!! <|endoftext|> a<|endoftext|>", " lead", "trail ", "x y  z", "a\r\nb", "日本 語",
    "é.\nÉ.", "end. end, end.. end!. 3. ok", "a | b|c |", "\n", " ", ".", "é. É", "word word", "“quoted” text’s",
]


def plain(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return lambda t: tokenizer.encode(t, add_special_tokens=False).ids


loaded = cache(plain)
LETTERS = str.maketrans("0123456789", "abcdefghij")


@pytest.mark.parametrize("name", FILES)
def test_remembered_words_give_the_tokenizers_ids(name, monkeypatch):
    monkeypatch.setattr(encoding, "MEMO_WORDS", 20)
    own, want = encoding.Encoder(public_tokenizers.path(name)), plain(name)
    texts = ODD * 2 + [text(i, 50) for i in range(20)]
    for _ in range(2):
        for t, got in zip(texts, own.encode([x.encode() for x in texts])):
            assert np.frombuffer(got, "<u4").tolist() == want(t), t


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=40), st.sampled_from(FILES))
def test_any_text_gives_the_tokenizers_ids(t, name):
    (got,) = encoding.encoder(public_tokenizers.path(name)).encode([t.encode()])
    assert np.frombuffer(got, "<u4").tolist() == plain(name)(t)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("aZ7é—'rst.,!%|<>_ \n", max_size=30), max_size=4), st.sampled_from(FILES))
def test_marks_behind_words_give_the_tokenizers_ids(texts, name):
    got = encoding.encoder(public_tokenizers.path(name)).encode([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [loaded(name)(t) for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_a_word_is_encoded_once_whatever_marks_stand_behind(name, monkeypatch):
    """The library's slow way for whole texts only sees the marks, a few letters, not every word with marks behind."""
    own, want, seen = encoding.Encoder(public_tokenizers.path(name)), plain(name), []
    library = own._ids
    monkeypatch.setattr(own, "_ids", lambda strings: seen.extend(strings) or library(strings))
    texts = [" ".join(f"{w}%%% {w}é,*** {w}.### {w}" for w in words(i, 30, 4000)).translate(LETTERS) for i in range(20)]
    for t, got in zip(texts, own.encode([t.encode() for t in texts])):
        assert np.frombuffer(got, "<u4").tolist() == want(t)
    assert sum(map(len, seen)) < 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500), st.randoms())
def test_image_gives_any_token_and_span(ids, rnd):
    image = token_codes.Image(token_codes.pack(np.array(ids, np.uint32)))
    assert len(image) == len(ids)
    for i in rnd.sample(range(len(ids)), min(len(ids), 20)):
        assert image[i] == ids[i]
    a, b = sorted((rnd.randrange(len(ids) + 1), rnd.randrange(len(ids) + 1)))
    assert image.span(a, b).tolist() == ids[a:b]
    with pytest.raises(IndexError):
        image[len(ids)]


def test_file_round_trip(spark, docs, monkeypatch):
    monkeypatch.setattr(token_codes, "IMAGE_TOKENS", 300)
    rows = EDGES + [(i, text(i, i % 90)) for i in range(100, 10, -1)]
    path, want = stage_path(spark, "t"), plain(FILES[0])
    token_codes.write(docs(rows, **CLASHES).repartition(5), public_tokenizers.path(FILES[0]), path, file_bytes=20_000)
    assert token_codes.read(spark, path).count() > 3
    got = token_codes.documents(spark, path).orderBy("start").collect()
    ordered = sorted(rows, key=lambda r: -1 if r[0] is None else r[0])
    assert [r.doc_id for r in got] == [i for i, _ in ordered]
    assert sorted(r.ids for r in got) == sorted(np.array(want(t or "") + [1], "<u4").tobytes() for _, t in rows)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    assert all(r.n_tokens * 4 == len(r.ids) for r in got)


def test_empty_table(spark, docs):
    path = stage_path(spark, "t")
    token_codes.write(docs([]), public_tokenizers.path(FILES[0]), path)
    assert token_codes.documents(spark, path).count() == 0
    assert packing.pack(docs([]), public_tokenizers.path(FILES[1])).count() == 0


@pytest.mark.parametrize("shard", [3, 256])
def test_packing_keeps_every_id_and_pads_nothing(docs, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD_DOCS", shard)
    monkeypatch.setattr(packing, "DEAL_TOKENS", 4096)
    rows = EDGES[:5] + EDGES[6:] + [(i, text(i, i * 7 % 700)) for i in range(50, 90)]
    got = packing.pack(docs(rows, **CLASHES).repartition(3), public_tokenizers.path(FILES[1])).collect()
    want = plain(FILES[1])
    whole = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert len(r.ids) == 4 * r.length > 0
        whole.setdefault((r.doc_id, r.doc_tokens), {}).setdefault(r.start, []).append(np.frombuffer(r.ids, "<u4").tolist())
    for i, t in {r for r in rows if r[0] != 4}:
        ids = want(t or "") + [0]
        parts = whole[(i, len(ids))]
        assert sum((parts[s][0] for s in sorted(parts)), []) == ids and all(len(p) == 1 for p in parts.values())
    assert sum(len(p) for p in whole[(4, len(want("one")) + 1)].values()) >= 2  # a repeated row is packed twice
    for sequence in {r.sequence_id for r in got}:
        mine = sorted((r.offset, r.length) for r in got if r.sequence_id == sequence)
        size = sum(n for _, n in mine)
        assert [o for o, _ in mine] == np.cumsum([0, *(n for _, n in mine[:-1])]).tolist()
        assert size <= 1024 and size.bit_count() == 1


def known_of(ids, vocabulary=2000):
    df = np.zeros(vocabulary, np.int64)
    for x in ids:
        df[np.unique(x)] += 1
    return packing.Statistics(df, len(ids), np.mean([len(x) for x in ids]))


def bm25(own, theirs, known):
    """The formula, term by term."""
    score = 0.0
    for term in set(own.tolist()):
        tf = int((theirs == term).sum())
        if tf:
            score += known.idf[term] * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(theirs) / known.mean))
    return score


def test_bm25_equals_the_formula():
    rng = np.random.default_rng(0)
    ids = [rng.integers(0, 40, n).astype(np.uint32) for n in (30, 50, 7, 20, 41, 5)]
    known = known_of(ids + ids[:2], 40)
    for term in range(40):
        df = sum(term in x for x in ids + ids[:2])
        assert known.idf[term] == pytest.approx(np.log(1 + (8 - df + 0.5) / (df + 0.5))) and known.idf[term] > 0
    index = packing.Index(ids, known)
    for seed, own in enumerate(ids):
        scores = index.scores(seed)
        for other, theirs in enumerate(ids):
            if other != seed:  # an id of one document has no postings, which only changes a document's own score
                assert scores[other] == pytest.approx(bm25(own, theirs, known))


def test_neighbours_share_a_window():
    groups = [np.random.default_rng(g).integers(100 * g, 100 * g + 60, (8, 100)).astype("<u4") for g in range(1, 6)]
    encoded = [g[i].tobytes() for i in range(8) for g in groups]  # the groups alternate
    packer = packing.Packer(0, 1024)
    packing.pack_shard(packer, list(range(40)), encoded, known_of([np.frombuffer(x, "<u4") for x in encoded]))
    packer.finish()
    pairs = [(a[0] % 5, b[0] % 5) for a, b in zip(packer.rows, packer.rows[1:]) if a[4] == b[4] and a[0] != b[0]]
    assert sum(a == b for a, b in pairs) >= 35  # of 39 steps, 4 must change the group


def test_statistics_count_all_documents(docs):
    rows = [(i, text(i % 9, 3 + i % 40)) for i in range(100)] + EDGES[:3]
    path = public_tokenizers.path(FILES[1])
    encoded = docs(rows).repartition(7).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        packing.partial(packing._encoded, path=path), packing.ENCODED)
    got = packing.statistics(encoded, packing.encoder(path).size, "<u2")
    want = known_of([np.array(plain(FILES[1])(t or "") + [0]) for _, t in rows], packing.encoder(path).size)
    assert np.allclose(got.idf, want.idf) and got.mean == pytest.approx(want.mean)


def test_keys_do_not_depend_on_what_stands_beside():
    encoded = [np.array(x, "<u4").tobytes() for x in ([5, 6, 7, 8, 9, 0], [0], [1, 0], [9, 5, 6, 7, 8, 0], [5, 6, 7, 8, 9, 0])]
    for run in packing.RUNS:
        keys = packing.lexical_keys(encoded, run)
        assert keys[0] == keys[4] and all(packing.lexical_keys([x], run)[0] == k for x, k in zip(encoded, keys))


def test_copies_from_far_apart_meet(docs):
    """Near copies stand at both ends of the input. Each window's seed gets its own copy, if it is unused."""
    base = {i: words(i + 1, 60, 5000) for i in range(300)}
    rows = [(i, " ".join(w)) for i, w in base.items()]
    rows += [(1000 + i, " ".join([*w[:30], f"edit{i}", *w[31:]])) for i, w in base.items()]
    want = plain(FILES[1])
    keys = {i: packing.lexical_keys([np.array(want(t) + [0], "<u4").tobytes()], 2)[0] for i, t in rows}
    assert np.mean([keys[i] == keys[1000 + i] for i in base]) > 0.85
    got = sorted(packing.pack(docs(rows), public_tokenizers.path(FILES[1])).collect(), key=lambda r: (r.sequence_id, r.offset))
    where, used, found = {}, set(), []
    for r in got:
        where.setdefault(r.doc_id, r.sequence_id)
    for r in got:
        twin = (r.doc_id + 1000) % 2000
        if r.offset == 0 and twin not in used and keys[twin] == keys[r.doc_id]:
            found.append(where[twin] in (r.sequence_id, r.sequence_id + 1))
        used.add(r.doc_id)
    assert len(found) > 20 and np.mean(found) > 0.9


def test_crc_is_the_unsigned_one(spark):
    df = spark.createDataFrame([(bytearray(b"\x01\x00\x00\x00\xff\xff\x00\x00"),)], "ids binary")
    assert df.select(F.crc32("ids")).first()[0] == zlib.crc32(b"\x01\x00\x00\x00\xff\xff\x00\x00")
