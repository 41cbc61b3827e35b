"""Every stage against brute force on its own input, and the whole on the smallest tables."""

from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from paywatch.llm import quality, simhash
from tests.conftest import SMALL
from tests.llm.conftest import CLASHES, EDGES, text, words
from tests.llm.test_text_search import brute_components, brute_leaks, brute_secrets


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage on the smallest tables."""
    from paywatch.llm.common import read_documents, stage

    rows, seen = read_documents(spark, SMALL), {}
    for name, function in corpus_pipeline.STAGES:
        out = stage(function(spark, rows, SMALL), name)
        seen[name], rows = (rows, out), out
    return seen


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "secrets", "packing"]
    for name in ("quality", "near_dedup", "decontamination", "secrets"):
        before, after = stages[name]
        assert before.columns == after.columns and 0 < after.count() <= before.count()


def test_quality_keeps_what_the_score_says(spark, stages):
    before, after = stages["quality"]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scores = {r.doc_id: r.score for r in quality.scores(before, quality.learn(before, labels)).collect()}
    kept = {r.doc_id for r in after.collect()}
    assert kept == {i for i, s in scores.items() if s >= 0.3}
    marked = {r.doc_id: r.quality for r in labels.collect()}
    assert sum(i in kept for i, q in marked.items() if q) / sum(marked.values()) > 0.95


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    pairs = [(i, simhash.fingerprint(t.encode()) % 2**64) for i, t in rows]
    assert Counter(r.doc_id for r in after.collect()) == Counter(set(brute_components(pairs)))


def test_leaks_go_and_others_stay(spark, stages):
    before, after = stages["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    hit = {d for d, *_ in brute_leaks(rows, items)}
    assert {r.doc_id for r in after.collect()} == {i for i, _ in rows} - hit and hit


def test_secrets_are_replaced(stages):
    before, after = stages["secrets"]
    texts = {r.doc_id: r.text for r in before.collect()}
    got = {r.doc_id: r.text for r in after.collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        assert (got[i] == t) == (not brute_secrets(t))


def test_packing_holds_every_id(stages):
    before, after = stages["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    parts = {}
    for r in after.orderBy("doc_id", "start").collect():
        parts.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert parts == {r.doc_id: tokenizer.encode(r.text, add_special_tokens=False).ids + [0] for r in before.collect()}


def test_run_is_all_stages(spark, stages):
    assert corpus_pipeline.run(spark, SMALL).count() == stages["packing"][1].count()


@pytest.mark.parametrize("name,function", corpus_pipeline.STAGES)
def test_stages_handle_edges(spark, docs, name, function):
    rows = EDGES + [(20, text(5, 80)), (20, text(5, 80)), (21, " ".join(words(5, 80)))]
    for table in (docs(rows, **CLASHES), docs([], **CLASHES)):
        out = function(spark, table, SMALL)
        n = out.count()
        assert n == 0 or table.count() > 0
        if name != "packing":
            assert out.columns == table.columns
        if name == "near_dedup" and n:
            kept = sorted((r.doc_id for r in out.collect() if r.doc_id is not None))
            assert kept == [1, 4, 5, 7, 20] and out.where("doc_id is null").count() == 1


def test_clashing_columns_keep_their_values(docs):
    """Every name the stages use themselves is an extra column; its values must come through."""
    from paywatch.llm import decontaminate, secret_scan

    names = ["row", "key", "blob", "marks", "new", "marked", "fp", "h", "id", "of_id", "of_h", "root", "node", "leak", "rep", "first",
             "stays", "keep_id", "leak_id", "_key", "_blob", "_marks", "item_id", "n", "s", "run", "reach", "cell"]
    secret = "password: abcdefgh12345678 end"
    table = docs([(1, "one two three four"), (2, secret), (3, None)], **{n: f"value of {n}" for n in names})
    items = docs([(9, "completely different words in here")]).selectExpr("doc_id as item_id", "text")
    for out in (simhash.one_of_each(table), decontaminate.without_leaks(table, items), secret_scan.redact(table, secret_scan.new_ledger(table.sparkSession))):
        assert out.columns == table.columns
        rows = out.collect()
        assert len(rows) == 3 and all(r[n] == f"value of {n}" for r in rows for n in names)
    assert {r.doc_id: r.text for r in rows}[2] == "[assign] end"


def test_rows_of_one_id_with_different_texts_stay_apart(docs):
    from paywatch.llm import decontaminate

    passage = text(77, 12)
    rows = [(1, text(1, 40)), (1, text(2, 40)), (1, text(1, 40)), (2, text(2, 40)), (3, f"{text(4, 20)} {passage} {text(5, 20)}"), (3, text(6, 40))]
    kept = simhash.one_of_each(docs(rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted({rows[0], rows[1], rows[4], rows[5]})
    items = docs([(9, passage)]).selectExpr("doc_id as item_id", "text")
    left = decontaminate.without_leaks(docs(rows), items).collect()
    assert sorted((r.doc_id, r.text) for r in left) == sorted(r for r in rows if passage not in r[1])


def test_a_blob_recorded_twice_counts_once(spark, docs):
    """Two runs at once leave two rows of a blob in the ledger."""
    from paywatch.llm import secret_scan

    table = docs([(1, "x password: abcdefgh12345678 y token=zzzzzzzzzzzz9999 z"), (2, "😀😀 api_key=0123456789abcdef0123")])
    ledger = secret_scan.new_ledger(spark)
    want = {r.doc_id: r.spans for r in secret_scan.find_secrets(table, ledger).collect()}
    held = spark.createDataFrame(ledger.read().collect(), ledger.schema)
    held.write.mode("append").parquet(ledger.path)
    assert {r.doc_id: r.spans for r in secret_scan.find_secrets(table, ledger).collect()} == want
    assert {r.doc_id: r.text for r in secret_scan.redact(table, ledger).collect()} == {1: "x [assign] y [assign] z", 2: "😀😀 [assign]"}


def test_batches_of_long_texts_are_small(spark, docs):
    """A stage's texts reach Python in batches bounded in bytes, not only in rows."""
    from paywatch.llm.common import BATCH_BYTES

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        table = spark.range(0, 2000, 1, 1).selectExpr("id as doc_id", "repeat('long text ', 2000) as text", "'en' as lang", "'s' as source", "20000L as n_chars")
        corpus_pipeline.good_quality(spark, table, SMALL)
        sizes = table.mapInArrow(lambda bs: (b.slice(0, 1).select(["doc_id"]).set_column(0, "n", [b.nbytes]) for b in bs), "n long").collect()
        assert len(sizes) > 1 and max(r.n for r in sizes) <= 2 * BATCH_BYTES and spark.conf.get(name) == str(BATCH_BYTES)
    finally:
        spark.conf.set(name, before)


def test_arrow_hands_back_what_earlier_batches_held():
    """While a batch is worked on, the pool has been asked to give up what earlier ones left."""
    import pyarrow as pa

    from paywatch.llm import common

    asked = []
    pool = pa.default_memory_pool()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(common.pa, "default_memory_pool", lambda: SimpleNamespace(release_unused=lambda: (asked.append(1), pool.release_unused())))
        batches = [pa.record_batch([pa.array([i])], names=["n"]) for i in range(3)]
        seen = [(b.column("n")[0].as_py(), len(asked)) for b in common.handed_back(iter(batches))]
    assert seen == [(0, 0), (1, 1), (2, 2)] and len(asked) == 3
