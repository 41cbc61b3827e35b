"""Encoding by merges against the sentencepiece library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from paywatch.llm import queries, sentence_pieces
from tests.conftest import SMALL
from tests.llm.conftest import CLASHES, EDGES

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=PATH)
PARTS = st.sampled_from(["a", "the", "ing", "▁", " ", "   ", "\n", "\t", "é", "é", "日本", "က", "😀", "12", ",", ".", "<s>", "</s>", "<0x0A>", "\0", "x" * 20])


def plain(text):
    return np.array(LIBRARY.encode(text, add_bos=True, add_eos=True), "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(PARTS, max_size=30).map("".join)))
def test_merges_give_the_ids_of_the_library(text):
    assert sentence_pieces.encoder(PATH).encode(text) == plain(text)


def test_long_texts_and_a_small_memory(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "MEMO_WORDS", 3)
    own = sentence_pieces.MergeEncoder(PATH)
    for text in (" " * 50_000, "ab" * 50_000, "one two three four five one two " * 200):
        assert own.encode(text) == plain(text)


def test_pieces_come_best_score_first_then_leftmost():
    own = sentence_pieces.encoder(PATH)
    assert "".join(own.merge("▁thing")) == "▁thing" and own.merge("▁" * 5) == ["▁" * 5]
    assert own.merge("\n\n") == ["\n", "\n"]


@given(st.text(alphabet="▁abcehinort.,;日本é\n1", max_size=40))
def test_both_agendas_agree(word):
    own = sentence_pieces.encoder(PATH)
    assert own._merge_short(word) == own._merge_long(word)


def test_words_are_cut_where_no_piece_goes_on():
    cut = sentence_pieces.re.compile(sentence_pieces._word_pattern(["ab", "bc", "▁x", "▁▁", "..", "q"])).findall
    assert cut("▁▁abc..xq▁▁ab▁") == ["▁▁abc", "..", "x", "q", "▁▁ab", "▁"]
    assert sentence_pieces.re.compile(sentence_pieces._word_pattern(["a▁b"])).findall("a▁b\nc") == ["a▁b\nc"]


def test_rows(docs, spark):
    table = docs(EDGES, **CLASHES)
    got = sentence_pieces.encode(table, PATH).collect()
    assert sorted(((r.doc_id, bytes(r.ids), r.decoded, r.agrees) for r in got), key=str) == sorted(
        ((i, plain(t or ""), LIBRARY.decode(LIBRARY.encode(t or "")), True) for i, t in EDGES), key=str
    )
    back = sentence_pieces.decode(sentence_pieces.encode(table, PATH), PATH).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((i, t or "") for i, t in EDGES), key=str)
    assert sentence_pieces.encode(docs([]), PATH).count() == 0
    assert sentence_pieces.decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), PATH).first().text is None


def test_a_row_the_merges_miss_has_the_ids_of_the_library(docs, monkeypatch):
    own = sentence_pieces.MergeEncoder(PATH)
    monkeypatch.setattr(own, "encode", lambda text: b"")
    monkeypatch.setattr(sentence_pieces, "encoder", lambda path: own)
    import pyarrow as pa

    batch = pa.record_batch([pa.array([1]), pa.array(["some text"])], names=["doc_id", "text"])
    row = next(sentence_pieces._encode(iter([batch]), PATH)).to_pylist()[0]
    assert row == {"doc_id": 1, "ids": plain("some text"), "decoded": "some text", "agrees": False}


def test_query(spark):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.op11_sentence_pieces(spark, SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = plain(rows[r.doc_id])
        text = LIBRARY.decode(np.frombuffer(ids, "<u4").tolist())
        assert r.agrees and r.n_tokens == len(ids) // 4 and r.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("word", ["▁a", "▁hello", "日"])
def test_groups_keep_every_text(word, monkeypatch):
    monkeypatch.setattr(sentence_pieces, "GROUP_CHARS", 4)
    strings = [word * n for n in range(6)]
    assert [s for g in sentence_pieces._groups(strings) for s in g] == strings
