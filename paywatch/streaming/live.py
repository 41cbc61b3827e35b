"""The live view: totals of everything seen and the newest entries of the alert list, kept by a stream.

Every task first reduces what it reads to one row of totals and the few rows that can be among the newest entries, so
the one state instance that merges them receives a handful of rows per task, whatever the size of a micro-batch.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from paywatch.functions.columns import flag
from paywatch.sources.schema import ALERT_LIST_ROWS, BATCH_ALERTS, TRIGGER
from paywatch.streaming.jobs import RunPaths, start

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOTALS = ["total", "detected", "actual", "missed"]
ENTRY = "batch_id long, transaction_id long, amount double, fraud_score double, location string"
ENTRY_COLUMNS = ["batch_id", "transaction_id", "amount", "fraud_score", "location"]
SUMS = ", ".join(f"{c} long" for c in TOTALS)
# No long is ever missing between tasks and state, since pandas would turn its column into floats.
PARTIAL = f"view int, {SUMS}, is_entry int, {ENTRY}"
OUTPUT = f"position int, {SUMS}, {ENTRY}"


def newest_entries(rows: pd.DataFrame, n: int, k: int) -> pd.DataFrame:
    """All candidates for the newest n entries: the k largest amounts of each of the n newest batches, in list order.

    Every batch has at least one entry, so older batches cannot reach the list; rows without a batch are in none.
    """
    rows = rows[rows["is_entry"] == 1]
    newest = rows["batch_id"].drop_duplicates().nlargest(n)
    rows = rows[rows["batch_id"].isin(newest)]
    rows = rows.sort_values(["batch_id", "amount", "transaction_id"], ascending=[False, False, True], na_position="last", kind="stable")
    return rows.groupby("batch_id", sort=False).head(k)


def reduced(n: int, k: int):
    """One row of totals and the candidate entries of a task.

    Between Arrow batches a task keeps its candidates, n * k rows; only rows of a batch as new as the oldest of n
    candidate batches are looked at, and become Python objects.
    """

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, kept, since = dict.fromkeys(TOTALS, 0), None, None
        schema = None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = batch.schema
            for c in TOTALS:
                sums[c] += pc.sum(batch.column(c)).as_py()
            wanted = pc.equal(batch.column("is_entry"), 1)
            if since is not None:
                wanted = pc.and_(wanted, pc.greater_equal(batch.column("batch_id"), since))
            fresh = batch.filter(wanted)
            if fresh.num_rows:
                fresh = fresh.to_pandas()
                kept = newest_entries(fresh if kept is None else pd.concat([kept, fresh], ignore_index=True), n, k)
                newest = kept["batch_id"].drop_duplicates()
                since = int(newest.min()) if len(newest) == n else None
        if schema is not None:
            counts = pd.DataFrame([{**dict.fromkeys(schema.names), "view": 0, **sums, "is_entry": 0, "batch_id": 0, "transaction_id": 0}])
            yield pa.RecordBatch.from_pandas(counts[schema.names], schema, preserve_index=False)
            if kept is not None:
                yield pa.RecordBatch.from_pandas(kept.assign(**dict.fromkeys(TOTALS, 0))[schema.names], schema, preserve_index=False)

    return reduce


class LiveView(StatefulProcessor):
    """Running totals, and a list state of the candidates for the newest n entries: n * k at most."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", ", ".join(f"{c} long" for c in TOTALS))
        self.entries = handle.getListState("entries", ENTRY)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        if not len(new):
            return
        held = self.totals.get() if self.totals.exists() else (0,) * len(TOTALS)
        sums = tuple(int(h + new[c].sum()) for h, c in zip(held, TOTALS))
        self.totals.update(sums)
        old = pd.DataFrame(list(self.entries.get()) if self.entries.exists() else [], columns=ENTRY_COLUMNS).assign(is_entry=1)
        entries = newest_entries(pd.concat([old, new], ignore_index=True) if len(old) else new, self.n, self.k)
        kept = [tuple(None if pd.isna(v) else v for v in entry) for entry in entries[ENTRY_COLUMNS].astype(object).itertuples(index=False, name=None)]
        if kept:
            self.entries.put(kept)
        shown = kept[: self.n] or [(None,) * len(ENTRY_COLUMNS)]
        yield pd.DataFrame([(at, *sums, *entry) for at, entry in enumerate(shown, 1)], columns=["position", *TOTALS, *ENTRY_COLUMNS])

    def close(self) -> None:
        pass


def live_view(scored: DataFrame, n: int = ALERT_LIST_ROWS, k: int = BATCH_ALERTS) -> DataFrame:
    """After every micro-batch the newest n entries, numbered from 1, each with the totals so far.

    ``scored`` has batch_id, the ids, amounts, scores and places, pred and the label. A batch may arrive in any number
    of micro-batches and in any order. Before the first batch with a number there is one row of totals alone.
    """
    hit, fraud = F.col("pred") == 1, F.col("is_fraud") == 1
    sums = {"total": F.lit(1), "detected": flag(hit), "actual": flag(fraud), "missed": flag((F.col("pred") == 0) & fraud)}
    counted = scored.select(
        F.lit(0).alias("view"),
        *(c.cast("long").alias(name) for name, c in sums.items()),
        F.col("batch_id").isNotNull().cast("int").alias("is_entry"),
        *(F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in ("batch_id", "transaction_id")),
        F.col("amount").cast("double").alias("amount"), F.col("fraud_score").cast("double").alias("fraud_score"), "location",
    )
    parts = counted.mapInArrow(reduced(n, k), PARTIAL)
    return parts.groupBy("view").transformWithStateInPandas(
        statefulProcessor=LiveView(n, k), outputStructType=OUTPUT, outputMode="Update", timeMode="None"
    )


def live_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Keep a view, a handful of rows, under the number of the micro-batch that produced it."""

    def write(view: DataFrame, batch_id: int) -> None:
        view.drop("view").coalesce(1).write.mode("overwrite").parquet(f"{path}/micro_batch={batch_id}")

    return write


def live_stream(scored: DataFrame, paths: RunPaths, trigger: str | None = TRIGGER, n: int = ALERT_LIST_ROWS) -> StreamingQuery:
    """Keep the live view of a run."""
    writer = live_view(scored, n).writeStream.outputMode("update").foreachBatch(live_sink(paths.of("live")))
    return start(writer, paths.checkpoint("live"), trigger)


def read_live(spark: SparkSession, paths: RunPaths) -> DataFrame:
    """The newest view of a run: its entries in list order, each with the totals."""
    rows = spark.read.parquet(paths.of("live"))
    return rows.filter(F.col("micro_batch") == rows.agg(F.max("micro_batch").alias("b")).scalar()).drop("micro_batch")
