"""Per-user, per-merchant and rule features of a transaction table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paywatch.functions.columns import cents, flag, micros
from paywatch.operators.slices import hot_keys, mark_hot, small_side
from paywatch.session import cut_lineage
from paywatch.sources.schema import RISK_LIMIT

HOUR = 3600
SLICES_PER_WINDOW = 60


def user_profile(df: DataFrame) -> DataFrame:
    """One row per user: average, spread, home location, primary device, activity rate.

    Ties of the most frequent value go to the smallest name; rows without a user belong to no profile.
    One scan and one partial aggregation: a user with very many rows sends one row per task, which
    holds the user's places, devices and active hours.
    """
    rows = df.filter(F.col("user_id").isNotNull()).withColumns({
        "_hour": F.floor(micros(F.col("timestamp")) / F.lit(HOUR * 1_000_000)),
        "_cents": cents(F.col("amount")),
    })
    hours = F.size(F.collect_set("_hour")).cast("long")
    return rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("txn_count"),
        (F.sum("_cents") / (F.count("_cents") * F.lit(100.0))).alias("avg_amount"),
        F.stddev_samp("amount").alias("std_amount"),
        F.when(hours > 0, hours).alias("active_hours"),
        F.mode("location", True).alias("home_location"),
        F.mode("device_type", True).alias("primary_device"),
        F.when(hours > 0, F.count(F.lit(1)) / hours).alias("txn_frequency"),
    )


def hot_users(df: DataFrame, hot_rows: int) -> DataFrame:
    """Users with more than ``hot_rows`` rows, computed now and stored: to be looked up once per load."""
    return cut_lineage(hot_keys(df, "user_id", hot_rows))


def user_features(
    df: DataFrame,
    window_seconds: int = HOUR,
    hot: DataFrame | None = None,
    slices_per_window: int = SLICES_PER_WINDOW,
) -> DataFrame:
    """Add everything that depends on the user's other transactions.

    Adds ``user_avg`` (whole history, unrounded), ``prior_avg`` (earlier rows only), ``is_new_device``
    (first time on this device), ``previous_location`` (home location where the last row has none),
    ``location_change``, ``time_since_last_txn`` (minutes, 0 for a first row) and ``velocity``
    (rows in the trailing window, this one included). Rows are ordered by (timestamp, id). A row
    without a user or a time stands alone.

    One shuffle by (user, slice). Ordinary users are one slice. The users in ``hot`` (see
    ``hot_users``) are cut into time slices of ``window_seconds / slices_per_window``; what a slice
    needs from earlier ones arrives as one carry row, and for the trailing window each row is also
    sent, shifted by the window, to the slice where it drops out. Which users are named changes where
    rows are worked on and never the result; building the plan starts no job.
    """
    width, rest = divmod(window_seconds * 1_000_000, slices_per_window)
    if rest:
        raise ValueError("the window must divide into slices of whole microseconds")
    span = width * slices_per_window
    us = micros(F.col("timestamp"))
    keyed = df.withColumns({
        "_us": us, "_cents": cents(F.col("amount")), "_user": F.when(us.isNotNull(), F.col("user_id"))
    })
    if hot is None:
        full = _unsliced(keyed, span)
    else:
        full = _sliced(keyed, hot.select(F.col("user_id").alias("_user")), width, span, slices_per_window)

    is_hot = F.col("_hot")
    last = F.coalesce(F.col("_last"), F.col("_c_last"))
    first_row = last.isNull()
    prior_rows = F.col("_n_before") + F.coalesce("_c_n", F.lit(0))
    prior_cents = F.col("_sum_before") + F.coalesce("_c_sum", F.lit(0))
    new_device = (F.col("_device_row") == 1) & (~is_hot | F.array_contains("_c_new_devices", F.struct("device_type")))
    features = {
        "user_avg": F.when(is_hot, F.col("_c_avg")).otherwise(F.col("_avg")),
        "prior_avg": F.when(prior_rows > 0, prior_cents / (prior_rows * F.lit(100.0))),
        "is_new_device": flag(new_device),
        "previous_location": F.coalesce(last["location"], F.when(is_hot, F.col("_c_home")).otherwise(F.col("_home"))),
        "time_since_last_txn": F.when(first_row, F.lit(0.0)).otherwise(
            F.round((F.col("_us") - last["_us"]) / F.lit(60_000_000.0), 2)
        ),
        "velocity": F.when(F.col("_user").isNull(), F.lit(1)).otherwise(
            F.col("_upto") - F.col("_gone") + F.coalesce("_c_live", F.lit(0))
        ),
    }
    added = {*features, "location_change"}
    return (
        full.select(*[c for c in df.columns if c not in added], *[e.alias(n) for n, e in features.items()])
        .withColumn("location_change", flag(F.col("location") != F.col("previous_location")))
    )


# What the carry rows hold; all of it missing where no user is hot.
CARRY = {
    "_c_new_devices": "array<struct<device_type: string>>",
    "_c_home": "string",
    "_c_avg": "double",
    "_c_last": "struct<location: string, _us: bigint>",
    "_c_n": "bigint",
    "_c_sum": "bigint",
    "_c_live": "bigint",
}


def _unsliced(keyed: DataFrame, span: int) -> DataFrame:
    rows = keyed.withColumns({
        "_hot": F.lit(False),
        "_own": F.lit(1),
        "_slice": F.when(F.col("_user").isNull(), F.col("transaction_id")).otherwise(F.lit(0)),
    })
    return _within_slices(rows, span).withColumns({c: F.lit(None).cast(t) for c, t in CARRY.items()})


def _sliced(keyed: DataFrame, hot_users: DataFrame, width: int, span: int, slices_per_window: int) -> DataFrame:
    rows = mark_hot(keyed, "_user", hot_users).withColumn(
        "_slice",
        F.when(F.col("_user").isNull(), F.col("transaction_id"))
        .when(F.col("_hot"), F.floor(F.col("_us") / F.lit(width)))
        .otherwise(F.lit(0)),
    )
    hot = rows.filter("_hot")
    leaving = hot.select(
        "_user",
        "_hot",
        (F.col("_us") + span).alias("_us"),
        (F.col("_slice") + slices_per_window).alias("_slice"),
        F.lit(0).alias("_own"),
    )
    both = rows.withColumn("_own", F.lit(1)).unionByName(leaving, allowMissingColumns=True)
    return _within_slices(both, span).join(_carry(hot, slices_per_window), ["_user", "_slice"], "left")


def _within_slices(both: DataFrame, span: int) -> DataFrame:
    """What a row can learn from its own (user, slice).

    The window by (user, slice) comes first, so the later ones reuse its shuffle, and the ones in
    time order share its sort.
    """
    part = Window.partitionBy("_user", "_slice")
    order = part.orderBy("_us", "transaction_id")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # Growing frames are linear in the slice; a sliding frame would recount its rows every time.
    by_time = part.orderBy("_us")
    until_now = by_time.rangeBetween(Window.unboundedPreceding, 0)
    gone_hot = by_time.rangeBetween(Window.unboundedPreceding, -1)
    gone_cold = by_time.rangeBetween(Window.unboundedPreceding, -span - 1)
    by_device = Window.partitionBy("_user", "_slice", "device_type", "_own").orderBy("_us", "transaction_id")

    own = F.col("_own") == 1
    zero = F.lit(0)
    return (
        both.withColumns({
            "_last": F.last(F.when(own, F.struct("location", "_us")), ignorenulls=True).over(before),
            "_n_before": F.count("_cents").over(before),
            "_sum_before": F.coalesce(F.sum("_cents").over(before), zero),
        })
        .withColumns({
            "_upto": F.sum("_own").over(until_now),
            "_gone": F.coalesce(
                F.when(F.col("_hot"), F.sum(1 - F.col("_own")).over(gone_hot))
                .otherwise(F.sum("_own").over(gone_cold)),
                zero,
            ),
        })
        .withColumns({
            "_avg": F.sum("_cents").over(part) / (F.count("_cents").over(part) * F.lit(100.0)),
            "_home": F.mode("location", True).over(part),
        })
        .withColumn("_device_row", F.row_number().over(by_device))
        .filter(own)
    )


def _carry(hot: DataFrame, slices_per_window: int) -> DataFrame:
    """One row per (hot user, time slice) with what the user's earlier slices contribute.

    Rows are first combined map-side into cells of (user, slice, device, location); the windows run
    over cells and slices. ``_c_live`` holds the full slices inside the trailing window plus the
    whole slice at its far end, whose rows then drop out one by one.
    """
    cells = hot.groupBy("_user", "_slice", "device_type", "location").agg(
        F.count(F.lit(1)).alias("_k"),
        F.count("_cents").alias("_ka"),
        F.sum("_cents").alias("_s"),
        F.max(F.struct("_us", "transaction_id")).alias("_at"),
    )
    user = Window.partitionBy("_user")
    by_location = Window.partitionBy("_user", "location")
    by_device = Window.partitionBy("_user", "device_type")
    known = (
        cells.withColumn("_c_avg", F.sum("_s").over(user) / (F.sum("_ka").over(user) * F.lit(100.0)))
        .withColumn("_first", F.min("_slice").over(by_device))
        .withColumn("_n_location", F.when(F.col("location").isNotNull(), F.sum("_k").over(by_location)))
        .withColumn("_c_home", F.min_by("location", F.when(
            F.col("_n_location").isNotNull(), F.struct((-F.col("_n_location")).alias("n"), "location")
        )).over(user))
    )
    per_slice = known.groupBy("_user", "_slice").agg(
        F.sum("_k").alias("_k"),
        F.sum("_ka").alias("_ka"),
        F.sum("_s").alias("_s"),
        F.max_by(F.struct("location", F.col("_at._us").alias("_us")), "_at").alias("_end"),
        F.collect_set(F.when(F.col("_first") == F.col("_slice"), F.struct("device_type"))).alias("_c_new_devices"),
        F.first("_c_home").alias("_c_home"),
        F.first("_c_avg").alias("_c_avg"),
    )
    ordered = user.orderBy("_slice")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    gone = ordered.rangeBetween(Window.unboundedPreceding, -slices_per_window - 1)
    zero = F.lit(0)
    return per_slice.select(
        "_user",
        "_slice",
        "_c_new_devices",
        "_c_home",
        "_c_avg",
        F.lag("_end").over(ordered).alias("_c_last"),
        F.coalesce(F.sum("_ka").over(earlier), zero).alias("_c_n"),
        F.coalesce(F.sum("_s").over(earlier), zero).alias("_c_sum"),
        (F.coalesce(F.sum("_k").over(earlier), zero) - F.coalesce(F.sum("_k").over(gone), zero)).alias("_c_live"),
    )


def amount_deviation() -> Column:
    return F.abs(F.col("amount") - F.col("user_avg"))


def high_amount(factor: float = 2.0) -> Column:
    return flag(F.col("amount") > F.col("user_avg") * F.lit(float(factor)))


def hour_of_day(ts: str = "timestamp") -> Column:
    return F.hour(ts)


def is_night(night_from: int = 24, night_to: int = 5, ts: str = "timestamp") -> Column:
    """Hours before ``night_to`` or from ``night_from`` on (24: never, the default)."""
    hour = F.hour(ts)
    return flag((hour < night_to) | (hour >= night_from))


def merchant_risk(df: DataFrame, train: DataFrame, weight: float = 20.0, label: str = "is_fraud") -> DataFrame:
    """Smoothed positive rate per merchant, learned from ``train`` only; unseen merchants get the prior."""
    prior = train.agg(F.avg(F.col(label).cast("double")).alias("prior")).scalar()
    known = (
        train.groupBy(F.col("merchant_id").alias("_m"))
        .agg(F.count(label).alias("_n"), F.sum(F.col(label).cast("double")).alias("_pos"))
    )
    smoothed = (F.col("_pos") + F.lit(weight) * prior) / (F.col("_n") + F.lit(weight))
    return (
        df.join(small_side(known), df["merchant_id"] == F.col("_m"), "left")
        .withColumn("merchant_risk_score", F.round(F.coalesce(smoothed, prior), 3))
        .drop("_m", "_n", "_pos")
    )


# Weights of the rule score.
RULE_WEIGHTS = {
    "high_amount": 0.30,
    "new_device": 0.20,
    "location_change": 0.15,
    "velocity": 0.15,
    "deviation": 0.10,
    "merchant": 0.10,
}
NOISE_WIDTH = 0.15
RULE_VELOCITY = 3


def id_noise(txn_id: str = "transaction_id") -> Column:
    """Stand-in for the uniform noise term, reproducible from the id."""
    return F.lit(NOISE_WIDTH) * F.pmod(F.pmod(F.col(txn_id), F.lit(1000)) * 7919, F.lit(1000)) / F.lit(1000.0)


def rule_score(noise: Column | None = None) -> Column:
    w = RULE_WEIGHTS
    score = (
        F.lit(w["high_amount"]) * F.col("high_amount_flag")
        + F.lit(w["new_device"]) * F.col("is_new_device")
        + F.lit(w["location_change"]) * F.col("location_change")
        + F.lit(w["velocity"]) * flag(F.col("velocity") > RULE_VELOCITY)
        + F.lit(w["deviation"]) * flag(amount_deviation() > F.col("user_avg"))
        + F.lit(w["merchant"]) * F.col("merchant_risk_score")
    )
    return score + noise if noise is not None else score


def rule_label(score: str = "risk_score", limit: float = RISK_LIMIT) -> Column:
    return flag(F.col(score) > F.lit(limit))


# Borders of the amount mixture.
AMOUNT_BORDERS = (10.0, 500.0, 5000.0, 50000.0)


def amount_tier(borders: Sequence[float] = AMOUNT_BORDERS, amount: str = "amount") -> Column:
    """Name of the half-open amount range, such as ``500-5000``."""
    tier = F.when(F.col(amount) < borders[0], f"under {borders[0]:.0f}")
    for low, high in zip(borders, borders[1:]):
        tier = tier.when(F.col(amount) < high, f"{low:.0f}-{high:.0f}")
    return tier.otherwise(f"from {borders[-1]:.0f}")


def amount_tiers(df: DataFrame, label: str = "is_fraud", borders: Sequence[float] = AMOUNT_BORDERS) -> DataFrame:
    return df.groupBy(amount_tier(borders).alias("tier")).agg(
        F.count(F.lit(1)).alias("txn_count"),
        (F.sum(cents(F.col("amount"))) / F.lit(100.0)).alias("amount_sum"),
        F.avg(F.col(label).cast("double")).alias("positive_rate"),
    )


def transaction_features(
    df: DataFrame,
    window_seconds: int = HOUR,
    hot: DataFrame | None = None,
    noise: Column | None = None,
) -> DataFrame:
    """All derived columns of the transaction record, plus ``risk_score`` and the rule label."""
    return (
        user_features(df, window_seconds, hot)
        .withColumns({
            "high_amount_flag": high_amount(),
            "amount_deviation": F.round(amount_deviation(), 2),
            "user_avg_amount": F.round("user_avg", 2),
            "hour": hour_of_day(),
            "is_night": is_night(),
            "transaction_count_last_hour": F.col("velocity"),
        })
        .withColumn("risk_score", rule_score(noise))
        .withColumn("is_fraud", rule_label())
    )
