"""Class balance, reproducible sampling, shuffling and splits.

Randomness is a hash of the row id and a seed, so a rerun of a lost task draws the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywatch.functions.columns import mix32, ratio, whole_part
from paywatch.operators.slices import cut_at, hash_cuts, hash_slice, running_totals
from paywatch.sources.schema import FIRST_REPLAY_ID, LABEL, POSITIVE_CAP_PERCENT, SPLIT_PERCENT

SEED = 42
SPLITS = ("train", "val", "test")


def _keyed(df: DataFrame, cls: Column, txn_id: str, seed: int) -> DataFrame:
    return df.select(
        cls.cast("string").alias("_class"), mix32(F.col(txn_id), seed).alias("_hash"), F.col(txn_id).alias("_id")
    )


def _kept(cut: Column, txn_id: str, seed: int) -> Column:
    """Whether the row lies at or before a cut in (hash, id) order."""
    here = F.struct(mix32(F.col(txn_id), seed).alias("h"), F.col(txn_id).alias("id"))
    return F.coalesce(here <= cut, F.lit(False))


def _single_cut(df: DataFrame, n: Column, txn_id: str, seed: int) -> Column:
    """The cut after the first n rows of a whole table."""
    cuts = hash_cuts(_keyed(df, F.lit("all"), txn_id, seed), lambda rows, cls: [n])
    return cuts.select(cut_at(F.col("_map"), F.lit("all"), 0).alias("_cut")).scalar()


def cap_positives(
    df: DataFrame,
    percent: int = POSITIVE_CAP_PERCENT,
    label: str = LABEL,
    txn_id: str = "transaction_id",
    seed: int = SEED,
) -> DataFrame:
    """Keep at most ``percent`` of the table's row count as positives, all others unchanged.

    The big table is only filtered, never shuffled: the cut comes from a hash histogram.
    """
    total = df.agg(F.count(F.lit(1)).alias("_total")).scalar()
    cut = _single_cut(df.filter(F.col(label) == 1), whole_part(total * percent, 100), txn_id, seed)
    positive = F.coalesce(F.col(label) == 1, F.lit(False))
    return df.filter(~positive | _kept(cut, txn_id, seed))


def union_classes(legit: DataFrame, fraud: DataFrame) -> DataFrame:
    return legit.unionByName(fraud)


def sample_n(df: DataFrame, n: int, txn_id: str = "transaction_id", seed: int = SEED) -> DataFrame:
    """Exactly n rows without replacement (all rows if there are fewer)."""
    return df.filter(_kept(_single_cut(df, F.lit(n), txn_id, seed), txn_id, seed))


def with_row_index(
    df: DataFrame, first: int = 0, output: str = "row_index", txn_id: str = "transaction_id", seed: int = SEED
) -> DataFrame:
    """Consecutive index in shuffled order: one shuffle by hash slice plus the slice sizes."""
    hashed = df.withColumn("_hash", mix32(F.col(txn_id), seed)).withColumn("_slice", hash_slice(F.col("_hash")))
    ranked = running_totals(hashed, "_slice", [F.col("_hash"), F.col(txn_id)], {"_rank": F.lit(1)})
    return ranked.withColumn(output, F.col("_rank") + F.lit(first - 1)).drop("_hash", "_slice", "_rank")


def shuffled(df: DataFrame, txn_id: str = "transaction_id", seed: int = SEED) -> DataFrame:
    """The table in random order: ``row_index`` is the new position."""
    return with_row_index(df, 0, "row_index", txn_id, seed)


def surrogate_ids(
    df: DataFrame, base: int = FIRST_REPLAY_ID, txn_id: str = "transaction_id", seed: int = SEED
) -> DataFrame:
    """Replace the id by base, base + 1, ... in replay (shuffled) order; the old one is ``source_id``."""
    numbered = with_row_index(df, base, "_new_id", txn_id, seed)
    return numbered.withColumnRenamed(txn_id, "source_id").withColumnRenamed("_new_id", txn_id)


def split_by_hash(
    df: DataFrame,
    percent: Sequence[int] = SPLIT_PERCENT,
    txn_id: str = "transaction_id",
    seed: int = SEED,
) -> DataFrame:
    """Add ``split``. No shuffle; class shares match up to sampling error."""
    place = F.shiftrightunsigned(mix32(F.col(txn_id), seed) * 100, 32)
    return df.withColumn(
        "split",
        F.when(place < percent[0], SPLITS[0]).when(place < percent[0] + percent[1], SPLITS[1]).otherwise(SPLITS[2]),
    )


def split_exact(
    df: DataFrame,
    percent: Sequence[int] = SPLIT_PERCENT,
    label: str = LABEL,
    txn_id: str = "transaction_id",
    seed: int = SEED,
) -> DataFrame:
    """Add ``split`` with exact shares in every class, remainders going to the later splits.

    First train against the rest, then the rest is divided; no shuffle of the table.
    """
    rest = sum(percent[1:])

    def wanted(rows: Column, cls: Column) -> list[Column]:
        train = whole_part(rows * percent[0], sum(percent))
        return [train, train + whole_part((rows - train) * percent[1], rest)]

    cls = F.coalesce(F.col(label).cast("string"), F.lit("none"))
    cuts = hash_cuts(_keyed(df, cls, txn_id, seed), wanted).scalar()
    return df.withColumn(
        "split",
        F.when(_kept(cut_at(cuts, cls, 0), txn_id, seed), SPLITS[0])
        .when(_kept(cut_at(cuts, cls, 1), txn_id, seed), SPLITS[1])
        .otherwise(SPLITS[2]),
    )


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), ratio(F.sum(label), F.count(label)).alias("positive_rate")
    )


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Per class: rows, balanced weight N / (2 * n_c), and n_0 / n_1."""
    counts = df.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    total = F.col("n0") + F.col("n1")
    rows = F.array(*[
        F.struct(F.lit(c).alias(label), F.col(n).alias("rows"), ratio(total, 2 * F.col(n)).alias("weight"),
                 ratio(F.col("n0"), F.col("n1")).alias("scale_pos_weight"))
        for c, n in ((0, "n0"), (1, "n1"))
    ])
    return counts.select(F.inline(rows))


def with_class_weight(df: DataFrame, train: DataFrame | None = None, label: str = LABEL,
                      output: str = "weight", balanced: bool = True) -> DataFrame:
    """Add the weight of the row's class: balanced, or 1 and n_0 / n_1."""
    weights = class_weights(train if train is not None else df, label)
    pos = weights.filter(F.col(label) == 1)
    if not balanced:
        return df.withColumn(
            output, F.when(F.col(label) == 1, pos.select("scale_pos_weight").scalar()).otherwise(F.lit(1.0))
        )
    neg = weights.filter(F.col(label) == 0)
    return df.withColumn(
        output,
        F.when(F.col(label) == 1, pos.select("weight").scalar()).otherwise(neg.select("weight").scalar()),
    )
