"""Column layout of transactions, messages and alerts."""

from __future__ import annotations

from pyspark.sql import types as T

# The transaction record, in column order.
TXN_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("merchant_id", T.LongType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("user_avg_amount", T.DoubleType()),
    T.StructField("amount_deviation", T.DoubleType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("is_new_device", T.IntegerType()),
    T.StructField("location", T.StringType()),
    T.StructField("previous_location", T.StringType()),
    T.StructField("location_change", T.IntegerType()),
    T.StructField("velocity", T.LongType()),
    T.StructField("transaction_count_last_hour", T.LongType()),
    T.StructField("time_since_last_txn", T.DoubleType()),
    T.StructField("merchant_risk_score", T.DoubleType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("is_night", T.IntegerType()),
    T.StructField("high_amount_flag", T.IntegerType()),
    T.StructField("is_fraud", T.IntegerType()),
])

TXN_COLUMNS = TXN_SCHEMA.fieldNames()

def _message_type(kind: T.DataType) -> T.DataType:
    """Messages may carry a whole number as ``5`` or ``5.0``; a decimal reads both, exact to 64 bits and beyond."""
    if isinstance(kind, (T.StringType, T.TimestampType)):
        return T.StringType()
    return T.DoubleType() if isinstance(kind, T.DoubleType) else T.DecimalType(20, 0)


MESSAGE_SCHEMA = T.StructType([T.StructField(f.name, _message_type(f.dataType)) for f in TXN_SCHEMA])

# The columns the per-batch metrics read.
NARROW_COLUMNS = [
    "transaction_id", "amount", "velocity", "time_since_last_txn", "location", "is_fraud",
]
NARROW_SCHEMA = T.StructType([MESSAGE_SCHEMA[c] for c in NARROW_COLUMNS])

LABEL = "is_fraud"
RUN_COUNTERS = "run_counters"  # name of the metrics a scoring stream observes
# Columns that are not model inputs.
NON_FEATURES = ["transaction_id", "timestamp", "previous_location", LABEL]
FEATURES = [c for c in TXN_COLUMNS if c not in NON_FEATURES]
CATEGORICAL = ["device_type", "location"]

# Columns the pipeline adds to an alert, hidden on display.
SYSTEM_COLUMNS = ["pipeline_detected_at", "batch_id", "total_batch_txns"]

# Configured limits.
POSITIVE_CAP_PERCENT = 3
FIRST_REPLAY_ID = 200_000
CANARY_PERIOD = 5_000
REPLAY_BATCH_ROWS = 1_000
TRIGGER = "2 seconds"
RULE_AMOUNT = 1_000.0
BATCH_ALERTS = 2
ALERT_LIST_ROWS = 10
HISTORY_BATCHES = 5
TOP_LOCATIONS = 5
RISK_LIMIT = 0.6
SPLIT_PERCENT = (70, 15, 15)
