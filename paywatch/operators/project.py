"""Projections, filters and defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paywatch.sources.schema import CANARY_PERIOD, RULE_AMOUNT, SYSTEM_COLUMNS


def fill_zero(df: DataFrame) -> DataFrame:
    """Nulls of numeric columns become 0; strings keep theirs."""
    return df.fillna(0)


def align(df: DataFrame, features: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Exactly ``features`` in that order; a missing column is filled."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in features])


def over_threshold(df: DataFrame, threshold: float, score: str = "fraud_score") -> DataFrame:
    """Rows scored strictly above the threshold."""
    return df.filter(F.col(score) > F.lit(float(threshold)))


def rule_hit(amount: str = "amount", limit: float = RULE_AMOUNT) -> Column:
    """The amount rule used when no model exists."""
    return F.col(amount) > F.lit(float(limit))


def rule_count(df: DataFrame, amount: str = "amount", limit: float = RULE_AMOUNT) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("batch_size"),
        F.count_if(rule_hit(amount, limit)).alias("detected"),
    )


def of_class(df: DataFrame, value: int, label: str = "is_fraud") -> DataFrame:
    return df.filter(F.col(label) == value)


# What a canary row carries.
CANARY_VALUES = {
    "amount": 950000.0,
    "device_type": "unknown",
    "location": "foreign_ip",
    "velocity": 150,
    "time_since_last_txn": 0.01,
    "merchant_risk_score": 1.0,
    "is_fraud": 1,
}


def is_canary(txn_id: str = "transaction_id", period: int = CANARY_PERIOD) -> Column:
    """The id counter has already moved on when it is tested, so the row before the multiple is hit."""
    return F.pmod(F.col(txn_id) + 1, F.lit(period)) == 0


def inject_canaries(
    df: DataFrame,
    period: int = CANARY_PERIOD,
    values: Mapping[str, object] = CANARY_VALUES,
    txn_id: str = "transaction_id",
) -> DataFrame:
    """Overwrite the canary fields of every ``period``-th id; derived columns are left as they are."""
    types = {f.name: f.dataType for f in df.schema}
    hit = is_canary(txn_id, period)
    return df.withColumns({
        c: F.when(hit, F.lit(v).cast(types[c])).otherwise(F.col(c)) for c, v in values.items() if c in types
    })


def clamp_low(column: Column, low: float = 1.0) -> Column:
    return F.greatest(F.lit(float(low)), column)


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace missing values, and add the default as a column where the column is missing."""
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) if c in types else F.lit(v)
        for c, v in defaults.items()
    })


def public_columns(df: DataFrame, store_id: str = "_id") -> DataFrame:
    """Drop what the pipeline and the store added."""
    return df.drop(*SYSTEM_COLUMNS, store_id)


def alert_line(df: DataFrame) -> DataFrame:
    """Integer id, score at three decimals, amount, and the same as one line of text."""
    score = F.round("fraud_score", 3)
    return df.select(
        F.col("transaction_id").cast("long").alias("transaction_id"),
        score.alias("score"),
        "amount",
        F.concat(
            F.col("amount").try_cast("decimal(18,2)").cast("string"), F.lit(" in transaction "),
            F.col("transaction_id").cast("long").cast("string"), F.lit(", risk "), score.try_cast("decimal(10,3)").cast("string"),
        ).alias("line"),
    )


def preview(df: DataFrame, n: int = 5, order_by: str = "transaction_id") -> DataFrame:
    return df.orderBy(order_by).limit(n)
