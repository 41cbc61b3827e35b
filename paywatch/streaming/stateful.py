"""User features on a stream, in event-time order.

Rows wait in keyed state until the watermark has passed them, then they are worked off in
(timestamp, id) order, so late rows inside the allowed delay change nothing. Users are dealt to groups by a hash, and a
group is one key: its users are worked off together in arrays, and state is asked a fixed number of times per group and
micro-batch, however many rows or minutes these have. State per user is bounded by the delay (waiting rows) and the
trailing window (the times in it), and kept as Arrow tables; a group holds below 2 GB of each. The micro-batch limits of
the source bound what one task receives for a group. With a time to live, what a user or a device that stays away longer
has left in state is removed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from paywatch.functions.columns import cents, flag, micros
from paywatch.operators.features import HOUR

# The processor travels with the query, so workers need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT = (
    "user_id long, transaction_id long, has_id int, location string, last_location string, prior_rows long, prior_cents long, "
    "is_new_device int, time_since_last_txn double, velocity long"
)
INPUT = ["user_id", "transaction_id", "timestamp", "device_type", "location", "amount"]
# Keys of the stream. More of them rewrite less state for a small micro-batch, fewer need fewer calls for a large one.
GROUPS = 4096
# No long is ever missing, since pandas would turn its column into floats.
ROW = {"user_id": "int64", "us": "int64", "has_id": "int32", "transaction_id": "int64", "device_type": "string",
       "location": "string", "priced": "int32", "cents": "int64"}
LAST = {"user_id": "int64", "us": "int64", "location": "string", "priced": "int64", "cents": "int64"}
DEVICE = {"user_id": "int64", "device": "string", "us": "int64"}
TIME = {"user_id": "int64", "us": "int64"}


def _packed(kinds: dict[str, str], columns) -> bytes:
    """A table as Arrow's own bytes."""
    schema = pa.schema([(name, pa.type_for_alias(kind)) for name, kind in kinds.items()])
    batch = pa.record_batch([pa.array(columns[name], kind) for name, kind in zip(schema.names, schema.types)], schema=schema)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _arrays(kinds: dict[str, str], blobs: list[bytes]) -> dict[str, np.ndarray]:
    """The columns of packed tables, one after the other; strings as objects."""
    tables = [pa.ipc.open_stream(blob).read_all() for blob in blobs]
    if not tables:
        return {name: np.empty(0, object if kind == "string" else kind) for name, kind in kinds.items()}
    whole = pa.concat_tables(tables)
    return {name: whole.column(name).to_numpy() for name in kinds}


def _taken(columns: dict[str, np.ndarray], which: np.ndarray) -> dict[str, np.ndarray]:
    return {name: column[which] for name, column in columns.items()}


def _joined(first: dict[str, np.ndarray], second: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {name: np.concatenate([first[name], second[name]]) for name in first}


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Which rows of sorted keys are the first with theirs."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


class UserFeatures(StatefulProcessor):
    """Last location and time, running amounts, devices seen, and the trailing count of the users of a group.

    ``ttl_seconds`` is a time to live in event time: a user who has had no row for longer starts anew, and a device
    not seen for longer is new again. That holds exactly, row by row; removing what has run out is done by timers
    once the watermark has passed it, or up to an eighth of that time later. One timer is pending per group.
    """

    def __init__(self, window_seconds: int = HOUR, ttl_seconds: int | None = None):
        if ttl_seconds is not None and ttl_seconds < window_seconds:
            raise ValueError("state must live as long as the trailing window")
        self.span = window_seconds * 1_000_000
        self.ttl = None if ttl_seconds is None else ttl_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "place int", "rows binary")
        self.known = handle.getValueState("known", "users binary, devices binary, times binary")
        self.wake = handle.getValueState("wake", "ms long, parts int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        if len(new):
            wake, parts = self.wake.get() if self.wake.exists() else (None, 0)
            self.waiting.updateValue((parts,), (_packed(ROW, new),))
            ms = int(new["us"].min()) // 1000 + 1
            if wake is None or ms < wake:
                self.handle.registerTimer(ms)
                wake = ms
            self.wake.update((wake, parts + 1))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wake, parts = self.wake.get() if self.wake.exists() else (None, 0)
        if expiredTimerInfo.getExpiryTimeInMs() != wake:
            return  # an earlier one has taken its place
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        rows = _arrays(ROW, [bytes(self.waiting.getValue((n,))[0]) for n in range(parts)])
        due = rows["us"] < upto
        ready, later = _taken(rows, due), _taken(rows, ~due)
        packed = self.known.get() if self.known.exists() else (None,) * 3
        users, devices, times = (_arrays(kinds, [] if blob is None else [bytes(blob)]) for kinds, blob in zip((LAST, DEVICE, TIME), packed))
        if len(ready["us"]):
            order = np.lexsort([ready[c] for c in ("transaction_id", "has_id", "us", "user_id")])
            ready = _taken(ready, order)
            shown, users = self._running(ready, users)
            shown["is_new_device"], devices = self._new_devices(ready, devices)
            shown["velocity"], times = self._trailing(ready, times)
            yield pd.DataFrame({**{c: ready[c] for c in ("user_id", "transaction_id", "has_id", "location")}, **shown})
            for n in range(1 if len(later["us"]) else 0, parts):
                self.waiting.removeKey((n,))
            parts = 0
            if len(later["us"]):
                self.waiting.updateValue((0,), (_packed(ROW, later),))
                parts = 1
        times = _taken(times, times["us"] >= upto - self.span)
        if self.ttl is not None:
            users, devices = (_taken(held, held["us"] + self.ttl >= upto) for held in (users, devices))
        held = [len(t["us"]) for t in (users, devices, times)]
        if any(held):
            self.known.update(tuple(_packed(kinds, held) for kinds, held in zip((LAST, DEVICE, TIME), (users, devices, times))))
        else:
            self.known.clear()
        next_us = [int(later["us"].min())] if len(later["us"]) else []
        if self.ttl is not None and any(held):
            oldest = min(int(t["us"].min()) for t in (users, devices) if len(t["us"]))
            next_us.append(max(oldest + self.ttl, upto + self.ttl // 8))
        if next_us:
            ms = min(next_us) // 1000 + 1
            self.handle.registerTimer(ms)
            self.wake.update((ms, parts))
        else:
            self.wake.clear()

    def _running(self, rows: dict[str, np.ndarray], users: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
        """What the row before and the running amounts tell, and the last row of every user."""
        n = len(rows["us"])
        first = _starts(rows["user_id"])
        at = np.flatnonzero(first)
        place = np.searchsorted(users["user_id"], rows["user_id"][at])
        found = np.zeros(len(at), bool)
        inside = place < len(users["user_id"])
        found[inside] = users["user_id"][place[inside]] == rows["user_id"][at[inside]]
        place = place[found]
        before_us, before = np.roll(rows["us"], 1), np.roll(rows["location"], 1)
        before_us[at[found]], before[at[found]] = users["us"][place], users["location"][place]
        has_before = ~first
        has_before[at[found]] = True
        if self.ttl is not None:
            has_before &= rows["us"] - before_us <= self.ttl
        before[~has_before] = None
        carried = {c: np.zeros(n, np.int64) for c in ("priced", "cents")}
        begin = first | ~has_before
        run = np.flatnonzero(begin)[np.cumsum(begin) - 1]
        prior = {}
        for c, carry in carried.items():
            carry[at[found]] = users[c][place]
            carry[~has_before] = 0
            own = rows[c].astype(np.int64)
            upto = np.cumsum(own) - own
            prior[c] = upto - upto[run] + carry[run]
        end = np.append(at[1:], n) - 1
        newest = {"user_id": rows["user_id"][end], "us": rows["us"][end], "location": rows["location"][end],
                  **{c: prior[c][end] + rows[c][end] for c in prior}}
        absent = np.ones(len(users["user_id"]), bool)
        absent[place] = False
        users = _joined(_taken(users, absent), newest)
        users = _taken(users, np.argsort(users["user_id"], kind="stable"))
        gap = np.where(has_before, rows["us"] - before_us, 0)
        return {"last_location": before, "prior_rows": prior["priced"], "prior_cents": prior["cents"],
                "time_since_last_txn": np.floor(gap / 60_000_000.0 * 100 + 0.5) / 100}, users

    def _new_devices(self, rows: dict[str, np.ndarray], devices: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Which rows show a device for the first time; a missing one is a device of its own, unlike ""."""
        held = len(devices["us"])
        seen = _joined(devices, {"user_id": rows["user_id"], "device": rows["device_type"], "us": rows["us"]})
        code = pa.array(seen["device"], pa.string()).dictionary_encode(null_encoding="encode").indices.to_numpy()
        order = np.lexsort((np.arange(len(code)), seen["us"], code, seen["user_id"]))
        seen, code = _taken(seen, order), code[order]
        fresh = _starts(seen["user_id"], code)
        end = np.append(fresh[1:], True)
        if self.ttl is not None:
            fresh = fresh | (seen["us"] - np.roll(seen["us"], 1) > self.ttl)
        result = np.empty(len(code), np.int32)
        result[order] = fresh
        return result[held:], _taken(seen, end)

    def _trailing(self, rows: dict[str, np.ndarray], times: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Rows in [t - window, t] of the same user, and all times so far."""
        times = _joined(times, {c: rows[c] for c in TIME})
        times = _taken(times, np.lexsort((times["us"], times["user_id"])))
        ids, points = np.unique(times["user_id"]), np.unique(times["us"])
        # A time's place among the points instead of the time itself: no product of the two can overflow.
        key = lambda user, place: np.searchsorted(ids, user) * (len(points) + 1) + place
        known = key(times["user_id"], np.searchsorted(points, times["us"]))
        upto = np.searchsorted(known, key(rows["user_id"], np.searchsorted(points, rows["us"], side="right")))
        below = np.searchsorted(known, key(rows["user_id"], np.searchsorted(points, rows["us"] - self.span)))
        return upto - below, times

    def close(self) -> None:
        pass


def stream_features(
    txns: DataFrame,
    delay: str = "10 minutes",
    window_seconds: int = HOUR,
    profile: DataFrame | None = None,
    ttl_seconds: int | None = None,
    groups: int = GROUPS,
) -> DataFrame:
    """Streaming form of the user features that look back; needs a timestamp with time zone.

    ``profile`` is a stored table as ``user_profile`` gives it: it tells the home location, which a user's first row
    has as its previous one, and the user's average. Without it a first row has no previous location and there is no
    ``user_avg``. Rows without a user or a time have no history: they are never keyed and pass at once, standing
    alone. With ``ttl_seconds`` state is removed, see ``UserFeatures``. ``groups`` must stay the same for a checkpoint.
    """
    placed = F.col("user_id").isNotNull() & F.col("timestamp").isNotNull()
    money = cents(F.col("amount"))
    alone = txns.filter(~placed).select(
        "user_id",
        "transaction_id",
        F.lit(1).alias("is_new_device"),
        F.col("location").alias("previous_location"),
        F.lit(0).alias("location_change"),
        F.lit(0.0).alias("time_since_last_txn"),
        F.lit(1).cast("long").alias("velocity"),
        F.lit(None).cast("double").alias("prior_avg"),
        *([(money / F.lit(100.0)).alias("user_avg")] if profile is not None else []),
    )
    rows = txns.select(*INPUT).filter(placed).withWatermark("timestamp", delay).withColumns({
        "us": micros(F.col("timestamp")), "priced": money.isNotNull().cast("int"), "cents": F.coalesce(money, F.lit(0)),
        "has_id": F.col("transaction_id").isNotNull().cast("int"), "transaction_id": F.coalesce(F.col("transaction_id").cast("long"), F.lit(0)),
        "user_id": F.col("user_id").cast("long"), "user_group": F.pmod(F.hash(F.col("user_id").cast("long")), F.lit(groups)),
    }).drop("amount")
    keyed = rows.groupBy("user_group").transformWithStateInPandas(
        statefulProcessor=UserFeatures(window_seconds, ttl_seconds=ttl_seconds),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="EventTime",
    ).withColumn("transaction_id", F.when(F.col("has_id") == 1, F.col("transaction_id")))
    previous = F.col("last_location")
    known = []
    if profile is not None:
        homes = profile.select(F.col("user_id").alias("_user"), F.col("home_location").alias("_home"), F.col("avg_amount").alias("user_avg"))
        keyed = keyed.join(homes, keyed["user_id"] == homes["_user"], "left")
        previous = F.coalesce(previous, "_home")
        known = ["user_avg"]
    full = keyed.withColumn("previous_location", previous).select(
        "user_id",
        "transaction_id",
        "is_new_device",
        "previous_location",
        flag(F.col("location") != F.col("previous_location")).alias("location_change"),
        "time_since_last_txn",
        "velocity",
        F.when(F.col("prior_rows") > 0, F.col("prior_cents") / (F.col("prior_rows") * F.lit(100.0))).alias("prior_avg"),
        *known,
    )
    return full.unionByName(alone)
