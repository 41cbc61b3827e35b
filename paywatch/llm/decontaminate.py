"""Benchmark decontamination: size-partitioned MinHash containment search, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywatch.llm.common import ascii_lower, sized, stage

SHINGLE = 5
THRESHOLD = 0.8
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-case words: letters, digits and everything beyond ASCII."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def shingle_rows(df: DataFrame, key: str, n: int = SHINGLE) -> DataFrame:
    """(key, h): the distinct hashes of a text's runs of n words, row by row of `df`.

    A shorter text is one shingle, one without words has none. Words are a column of their own first: within the
    transform their expression would be computed once per shingle.
    """
    split = df.select(key, words(F.col("text")).alias("w"))
    long = F.transform(F.sequence(F.lit(0), F.size("w") - n), lambda i: F.xxhash64(*(F.get("w", i + k) for k in range(n))))
    whole = F.array(F.xxhash64(F.concat_ws(" ", "w")))
    hashes = F.when(F.size("w") >= n, long).when(F.size("w") > 0, whole)
    return split.select(key, F.explode(F.array_distinct(hashes)).alias("h"))


def item_shingles(items: DataFrame, n: int = SHINGLE) -> DataFrame:
    """(item_id, h): every distinct shingle of every item."""
    return shingle_rows(items, "item_id", n).distinct()


def sketches(item_rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(item_id, h, n_item, needed): the bottom-k MinHash sketch of every item.

    Items are partitioned by size into classes (2^(c-1), 2^c]. A document that contains `needed` of an item's n
    shingles misses at most n - needed of them, so among the k = n - needed + 1 least hashes at least one must
    occur in it. k is taken for the upper end of the class, so a class shares one sketch length and none misses.
    """
    sizes = item_rows.groupBy("item_id").agg(F.count("*").alias("n_item"), F.array_sort(F.collect_list("h")).alias("hs"))
    upper = F.pow(F.lit(2), F.ceil(F.log2(F.col("n_item"))))
    needed = F.ceil(F.col("n_item") * threshold - 1e-9).cast("long")
    length = (upper - F.ceil(upper * threshold - 1e-9)).cast("int") + 1
    kept = sizes.select("item_id", "n_item", needed.alias("needed"), F.slice("hs", 1, length).alias("hs"))
    return kept.select("item_id", "n_item", "needed", F.explode("hs").alias("h"))


def leaks(docs: DataFrame, items: DataFrame, n: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment): every document that holds an item.

    containment is the share of the item's distinct n-word shingles that occur in the document; rows have at least
    `threshold`. MinHash sketches of the documents would drown a short item in a long text, so the sketch stays on
    the item's side and every document shingle is looked up in it; candidates are then counted exactly.

    Null and empty texts hold nothing and are not held. An item of fewer than n words is one shingle and matches
    only a text of just these words. Rows of one doc_id count as one document, rows of one item_id as one item,
    repeated rows once; a null id is an id like any other. Empty tables give an empty result; other columns are
    not read.
    """
    rows = stage(item_shingles(items.select(F.col("item_id").cast("long").alias("item_id"), "text"), n), "items")
    sketch = stage(sketches(rows, threshold), "sketches")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = shingle_rows(texts, "doc_id", n).join(sized(sketch.select("h", "item_id")), "h").select("doc_id", "item_id").distinct()
    candidates = stage(found, "candidates")
    marked = candidates.select(F.col("doc_id").alias("marked_id")).distinct()
    held = texts.join(sized(marked), F.col("doc_id").eqNullSafe(F.col("marked_id")), "left_semi")
    shared = shingle_rows(held, "doc_id", n).join(sized(rows), "h")
    counts = shared.groupBy("doc_id", "item_id").agg(F.size(F.collect_set("h")).cast("long").alias("n_shared"))
    sizes = sketch.select(F.col("item_id").alias("of_item"), "n_item", "needed").distinct()
    exact = counts.join(sizes, F.col("item_id").eqNullSafe(F.col("of_item"))).where(F.col("n_shared") >= F.col("needed"))
    both = F.col("doc_id").eqNullSafe(F.col("c_doc")) & F.col("item_id").eqNullSafe(F.col("c_item"))
    sure = exact.join(candidates.select(F.col("doc_id").alias("c_doc"), F.col("item_id").alias("c_item")), both, "left_semi")
    return sure.select("doc_id", "item_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def without_leaks(docs: DataFrame, items: DataFrame, n: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of a documents table, with all their columns, whose text holds no item.

    Rows are judged by their text, so rows of one doc_id with different texts are judged apart, and copies are looked
    up once. Null and empty texts stay, rows without a doc_id are judged like any other, repeated rows go or stay
    together. An empty table gives an empty result. Columns may have any names. A very long text costs its shingles.
    """
    found = leaks(docs.select(F.xxhash64("text").alias("doc_id"), "text"), items, n, threshold)
    leaky = stage(found.select(F.col("doc_id").alias("leak")).distinct(), "leaky")
    rows = docs.select(F.struct("*").alias("row"))
    return rows.join(sized(leaky), F.xxhash64("row.text") == F.col("leak"), "left_anti").select("row.*")
