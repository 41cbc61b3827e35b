"""The registered queries as SQL over the same tables, written independently of the operators."""

from __future__ import annotations


def _round(x: str, n: int) -> str:
    """Half-up on the shortest decimal text of a double."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {n}) AS DOUBLE)"


def _hash(rel: str, key: str, seed: int = 42) -> str:
    """All columns of a relation and ``h``, a 32-bit mix of a long key."""
    steps = (
        f"(({key} & 4294967295) * 1013904223 + ({key} >> 32) * 461845907 + CAST({seed} AS BIGINT) * 69069) % 4294967291 AS h1, "
        "(xor(h1, h1 >> 15) * 739982445) & 4294967295 AS h2, (xor(h2, h2 >> 13) * 695872825) & 4294967295 AS h"
    )
    return f"SELECT * EXCLUDE (h1, h2) FROM (SELECT *, {steps} FROM {rel})"


RAW = f"""
raw AS (
  SELECT e.* EXCLUDE (nk), n.n_name AS location
  FROM (
    SELECT event_id AS transaction_id, user_id, k AS merchant_id, value AS amount, ts AS timestamp,
           event_type AS device_type, {_round("k / 99.0::DOUBLE", 3)} AS merchant_risk_score,
           event_id // 1000 AS batch_id,
           (user_id + CASE WHEN k % 20 < 17 THEN 0 ELSE k END) % 25 AS nk
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
  ) e LEFT JOIN nation n ON n.n_nationkey = e.nk
)"""

ORDERS = """
raw AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_totalprice AS amount, o_orderdate AS timestamp,
         o_orderpriority AS device_type, n_name AS location, o_orderstatus AS status,
         CAST(o_orderstatus = 'F' AS INTEGER) AS is_fraud
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
)"""


def _user(window_us: int) -> str:
    return f"""
home AS (
  SELECT user_id, location AS home_location FROM (
    SELECT user_id, location, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, location) AS rn
    FROM raw GROUP BY user_id, location) WHERE rn = 1
),
usr AS (
  SELECT * EXCLUDE (c, us, lag_us, prev_loc, home_location, pn, ps, dn),
    CAST(dn = 1 AS INTEGER) AS is_new_device,
    coalesce(prev_loc, home_location) AS previous_location,
    CAST(location <> coalesce(prev_loc, home_location) AS INTEGER) AS location_change,
    coalesce({_round("(us - lag_us) / 60000000.0::DOUBLE", 2)}, 0.0::DOUBLE) AS time_since_last_txn,
    CAST(ps AS DOUBLE) / (pn * 100.0::DOUBLE) AS prior_avg
  FROM (
    SELECT *,
      CAST(sum(c) OVER (PARTITION BY user_id) AS DOUBLE) / (count(c) OVER (PARTITION BY user_id) * 100.0::DOUBLE) AS user_avg,
      lag(us) OVER o AS lag_us,
      lag(location) OVER o AS prev_loc,
      nullif(count(c) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pn,
      sum(c) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ps,
      row_number() OVER (PARTITION BY user_id, device_type ORDER BY us, transaction_id) AS dn,
      count(*) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN {window_us} PRECEDING AND CURRENT ROW) AS velocity
    FROM (SELECT *, CAST(round(amount * 100) AS BIGINT) AS c, epoch_us(timestamp) AS us FROM raw) JOIN home USING (user_id)
    WINDOW o AS (PARTITION BY user_id ORDER BY us, transaction_id)
  )
)"""


DAY_US = 86_400_000_000
USER = f"{RAW},{_user(DAY_US)}"
USER_HOUR = f"{RAW},{_user(3_600_000_000)}"
USER_ORDERS = f"{ORDERS},{_user(30 * DAY_US)}"

RISK = """0.30::DOUBLE * high_amount_flag + 0.20::DOUBLE * is_new_device + 0.15::DOUBLE * location_change
  + 0.15::DOUBLE * CAST(velocity > 3 AS INTEGER) + 0.10::DOUBLE * CAST(abs(amount - user_avg) > user_avg AS INTEGER)
  + 0.10::DOUBLE * merchant_risk_score"""

FEAT = f"""{USER},
feat AS (
  SELECT *, CAST(risk_score > 0.6::DOUBLE AS INTEGER) AS is_fraud FROM (
    SELECT *, {RISK} + 0.15::DOUBLE * ((transaction_id % 1000 * 7919) % 1000) / 1000.0::DOUBLE AS risk_score FROM (
      SELECT *, CAST(amount > user_avg * 2.0::DOUBLE AS INTEGER) AS high_amount_flag,
        {_round("abs(amount - user_avg)", 2)} AS amount_deviation, {_round("user_avg", 2)} AS user_avg_amount,
        CAST(hour(timestamp) AS INTEGER) AS hour, CAST(hour(timestamp) < 5 AS INTEGER) AS is_night,
        velocity AS transaction_count_last_hour
      FROM usr)))"""

SCORES = """score_a, score_b, 0.5::DOUBLE * score_a + 0.5::DOUBLE * score_b AS fraud_score"""
PAIR = "risk_score / 1.15::DOUBLE AS score_a, amount / (amount + user_avg) AS score_b"

SCORED = f"""{FEAT},
scored AS (
  SELECT *, CAST(fraud_score > 0.5::DOUBLE AS INTEGER) AS pred FROM (
    SELECT * EXCLUDE (score_a, score_b), {SCORES} FROM (SELECT *, {PAIR} FROM feat)))"""

ALERTS = f"""{SCORED},
meta AS (
  SELECT batch_id, count(*) AS total_batch_txns, max(timestamp) AS pipeline_detected_at FROM raw GROUP BY batch_id
),
alerts AS (SELECT * FROM scored JOIN meta USING (batch_id) WHERE fraud_score > 0.5::DOUBLE),
latest AS (SELECT * FROM alerts WHERE batch_id = (SELECT max(batch_id) FROM alerts)),
five AS (
  SELECT batch_id, max(total_batch_txns) AS total_txns, max(pipeline_detected_at) AS detected_at,
         count(*) AS fraud_count
  FROM alerts GROUP BY batch_id ORDER BY batch_id DESC LIMIT 5
)"""


def _split(rel: str) -> str:
    return f"""split AS (
  SELECT * EXCLUDE (h), CASE WHEN (h * 100) >> 32 < 70 THEN 'train' WHEN (h * 100) >> 32 < 85 THEN 'val' ELSE 'test' END AS split
  FROM ({_hash(rel, "transaction_id")}))"""


REPLAY = f"""{FEAT},
replay AS (
  SELECT * EXCLUDE (transaction_id, h), transaction_id AS source_id,
         199999 + row_number() OVER (ORDER BY h, transaction_id) AS transaction_id
  FROM ({_hash("feat", "transaction_id")})
),
canary AS (
  SELECT * REPLACE (
    CASE WHEN hit THEN 950000.0::DOUBLE ELSE amount END AS amount,
    CASE WHEN hit THEN 'unknown' ELSE device_type END AS device_type,
    CASE WHEN hit THEN 'foreign_ip' ELSE location END AS location,
    CASE WHEN hit THEN 150 ELSE velocity END AS velocity,
    CASE WHEN hit THEN 0.01::DOUBLE ELSE time_since_last_txn END AS time_since_last_txn,
    CASE WHEN hit THEN 1.0::DOUBLE ELSE merchant_risk_score END AS merchant_risk_score,
    CASE WHEN hit THEN 1 ELSE is_fraud END AS is_fraud)
  FROM (SELECT *, transaction_id % 5000 = 4999 AS hit FROM replay)
)"""

TXN20 = """transaction_id, user_id, merchant_id, amount, user_avg_amount, amount_deviation, timestamp, device_type,
  is_new_device, location, previous_location, location_change, velocity, transaction_count_last_hour,
  time_since_last_txn, merchant_risk_score, hour, is_night, high_amount_flag, is_fraud"""

CURVE = f"""{SCORED},
pts AS (
  SELECT fraud_score AS threshold, sum(is_fraud) AS pos, sum(1 - is_fraud) AS neg FROM scored GROUP BY fraud_score
),
curve AS (
  SELECT threshold, pos, neg, sum(pos) OVER d AS tp, sum(neg) OVER d AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM pts WINDOW d AS (ORDER BY threshold DESC)
),
pr AS (
  SELECT threshold, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision, CAST(tp AS DOUBLE) / CAST(p AS DOUBLE) AS recall FROM curve
)"""

CELLS = f"""{SCORED},
cells AS (
  SELECT CAST(count(*) FILTER (is_fraud = 0 AND pred = 0) AS DOUBLE) AS tn, CAST(count(*) FILTER (is_fraud = 0 AND pred = 1) AS DOUBLE) AS fp,
         CAST(count(*) FILTER (is_fraud = 1 AND pred = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (is_fraud = 1 AND pred = 1) AS DOUBLE) AS tp
  FROM scored
),
cls AS (
  SELECT '0' AS class, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall, 2 * tn / (2 * tn + fn + fp) AS f1, tn + fp AS s, tn + fp + fn + tp AS total FROM cells
  UNION ALL
  SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fn + fp), tp + fn, tn + fp + fn + tp FROM cells
)"""

TOP2 = """top2 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY amount DESC, transaction_id) AS alert_rank FROM scored)
  WHERE alert_rank <= 2
)"""
COUNTS = """counts AS (
  SELECT batch_id, count(*) AS batch_size, count(*) FILTER (pred = 1) AS detected, count(*) FILTER (is_fraud = 1) AS actual,
         count(*) FILTER (pred = 0 AND is_fraud = 1) AS missed
  FROM scored GROUP BY batch_id
)"""
SYSTEM = "pipeline_detected_at, batch_id, total_batch_txns"


def _profile(raw: str) -> str:
    def mode(column: str, name: str) -> str:
        return f"""(SELECT user_id, {column} AS {name} FROM (
          SELECT user_id, {column}, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, {column}) AS rn
          FROM raw GROUP BY user_id, {column}) WHERE rn = 1)"""

    return f"""WITH {raw}
SELECT user_id, txn_count, avg_amount, std_amount, home_location, primary_device, txn_frequency
FROM (
  SELECT user_id, count(*) AS txn_count,
    CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS DOUBLE) / (count(*) * 100.0::DOUBLE) AS avg_amount,
    {_round("stddev_samp(amount)", 4)} AS std_amount,
    CAST(count(*) AS DOUBLE) / CAST(count(DISTINCT date_trunc('hour', timestamp)) AS DOUBLE) AS txn_frequency
  FROM raw GROUP BY user_id)
JOIN {mode("location", "home_location")} USING (user_id) JOIN {mode("device_type", "primary_device")} USING (user_id)"""


def _user_column(expr: str, source: str = USER) -> str:
    return f"WITH {source} SELECT transaction_id, {expr} FROM usr"


def _dictionary(rel: str, column: str) -> str:
    return (
        f"SELECT {column} AS value, CAST(row_number() OVER (ORDER BY {column}) - 1 AS INTEGER) AS code "
        f"FROM (SELECT DISTINCT {column} FROM {rel})"
    )


def _best(rel: str) -> str:
    return f"""SELECT threshold, precision, recall, 2 * (precision * recall) / (precision + recall + 0.000001::DOUBLE) AS f1
  FROM {rel} ORDER BY f1 DESC, threshold LIMIT 1"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}

    q["s1_scan"] = f"WITH {RAW} SELECT * FROM raw"
    q["s3_splits"] = f"WITH {FEAT}, {_split('feat')} SELECT split, is_fraud, count(*) AS row_count FROM split GROUP BY ALL"
    q["s2_write_read"] = f"WITH {FEAT} SELECT * REPLACE (epoch_us(timestamp) AS timestamp) FROM (SELECT {TXN20} FROM feat)"
    q["s3_saved_splits"] = f"""WITH {FEAT}, {_split('feat')} SELECT is_fraud, count(*) AS row_count, 17 AS column_count
  FROM split WHERE split = 'val' GROUP BY ALL"""
    q["s5_json_decode"] = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events"
    q["s6_narrow_decode"] = f"""WITH {FEAT} SELECT CAST(transaction_id AS DOUBLE) AS transaction_id, amount,
  CAST(velocity AS DOUBLE) AS velocity, time_since_last_txn, location, CAST(is_fraud AS DOUBLE) AS is_fraud FROM feat"""
    q["s7_json_encode"] = f"WITH {FEAT} SELECT * REPLACE (epoch_us(timestamp) AS timestamp) FROM (SELECT {TXN20} FROM feat)"

    q["p1_fill_zero"] = f"""WITH {FEAT} SELECT transaction_id, coalesce(prior_avg, 0.0::DOUBLE) AS prior_avg,
  nullif(device_type, 'error') AS device_type FROM feat"""
    q["p2_drop"] = f"""WITH {FEAT} SELECT * EXCLUDE (transaction_id, timestamp, previous_location, is_fraud)
  FROM (SELECT {TXN20} FROM feat)"""
    zero = "0.0::DOUBLE AS "
    q["p3_align"] = f"""WITH {FEAT} SELECT {zero}user_id, {zero}merchant_id, amount, {zero}user_avg_amount, {zero}amount_deviation,
  {zero}device_type, {zero}is_new_device, location, {zero}location_change, velocity, {zero}transaction_count_last_hour,
  time_since_last_txn, {zero}merchant_risk_score, {zero}hour, {zero}is_night, {zero}high_amount_flag FROM feat"""
    q["p4_alert_filter"] = f"WITH {SCORED} SELECT transaction_id, fraud_score FROM scored WHERE fraud_score > 0.5::DOUBLE"
    q["p5_rule_count"] = f"WITH {ORDERS} SELECT count(*) AS batch_size, count(*) FILTER (amount > 1000) AS detected FROM raw"
    q["p6_class_filter"] = f"WITH {FEAT} SELECT transaction_id, is_fraud FROM feat WHERE is_fraud = 1"
    q["p7_casts"] = f"""WITH {FEAT} SELECT CAST(transaction_id AS DOUBLE) AS id_number, CAST(transaction_id AS VARCHAR) AS id_text,
  CAST(merchant_id AS INTEGER) AS merchant_code, is_fraud AS over_limit, TRY_CAST(device_type AS DOUBLE) AS device_number FROM feat"""
    q["p8_canary"] = f"""WITH {REPLAY} SELECT transaction_id, source_id, amount, device_type, location, velocity,
  time_since_last_txn, merchant_risk_score, is_fraud FROM canary"""
    q["p9_surrogate_id"] = f"""WITH {RAW} SELECT 199999 + row_number() OVER (ORDER BY h, transaction_id) AS transaction_id,
  transaction_id AS source_id FROM ({_hash("raw", "transaction_id")})"""
    q["p10_round"] = f"""WITH {FEAT} SELECT transaction_id, {_round("user_avg", 2)} AS avg_2, {_round("user_avg", 3)} AS avg_3,
  {_round("risk_score", 3)} AS risk_3 FROM feat"""
    q["p11_clamp"] = f"WITH {RAW} SELECT transaction_id, greatest(1.0::DOUBLE, amount) AS amount FROM raw"
    q["p13_defaults"] = f"""WITH {RAW} SELECT transaction_id, merchant_id,
  CASE WHEN device_type = 'error' THEN 'Unknown' ELSE location END AS location, 0 AS batch_id FROM raw"""
    fields = "transaction_id, user_id, amount, device_type, location, fraud_score"
    q["p14_public_cols"] = f"WITH {ALERTS} SELECT {fields} FROM alerts"
    score3 = _round("fraud_score", 3)
    q["p15_alert_line"] = f"""WITH {SCORED} SELECT transaction_id, {score3} AS score, amount,
  CAST(CAST(amount AS DECIMAL(18, 2)) AS VARCHAR) || ' in transaction ' || transaction_id || ', risk ' || CAST(CAST({score3} AS DECIMAL(10, 3)) AS VARCHAR) AS line
  FROM scored WHERE fraud_score > 0.5::DOUBLE"""
    q["p16_preview"] = f"WITH {RAW} SELECT transaction_id, user_id, amount, location FROM raw ORDER BY transaction_id LIMIT 5"

    q["f1_user_profile"] = _profile(RAW)
    q["f1_user_profile_orders"] = _profile(ORDERS)
    q["f2_user_avg"] = _user_column(f"{_round('user_avg', 2)} AS user_avg_amount")
    q["f2_prior_avg"] = _user_column("prior_avg")
    q["f3_deviation"] = _user_column(f"{_round('abs(amount - user_avg)', 2)} AS amount_deviation")
    q["f4_high_amount"] = _user_column("CAST(amount > user_avg * 2 AS INTEGER) AS high_amount_flag")
    q["f5_new_device"] = _user_column("is_new_device")
    q["f6_prev_location"] = _user_column("previous_location")
    q["f7_location_change"] = _user_column("location_change")
    q["f8_hour"] = f"WITH {RAW} SELECT transaction_id, CAST(hour(timestamp) AS INTEGER) AS hour FROM raw"
    q["f9_night"] = f"""WITH {RAW} SELECT transaction_id, CAST(hour(timestamp) < 5 AS INTEGER) AS is_night,
  CAST(hour(timestamp) < 5 OR hour(timestamp) >= 22 AS INTEGER) AS is_late FROM raw"""
    q["f10_gap"] = _user_column("time_since_last_txn")
    q["f11_velocity_1h"] = _user_column("velocity", USER_HOUR)
    q["f11_velocity_24h"] = _user_column("velocity")
    q["f5_f11_orders"] = _user_column(
        "user_avg, prior_avg, is_new_device, previous_location, location_change, time_since_last_txn, velocity", USER_ORDERS
    )
    q["f5_f11_sliced"] = _user_column(
        "user_avg, prior_avg, is_new_device, previous_location, location_change, time_since_last_txn, velocity"
    )
    q["f12_merchant_risk"] = f"""WITH {FEAT}, {_split('feat')},
train AS (SELECT * FROM split WHERE split = 'train'),
prior AS (SELECT CAST(sum(is_fraud) AS DOUBLE) / count(*) AS prior FROM train),
known AS (SELECT merchant_id, CAST(count(*) AS DOUBLE) AS n, CAST(sum(is_fraud) AS DOUBLE) AS pos FROM train GROUP BY merchant_id)
SELECT transaction_id, {_round("coalesce((pos + 20.0::DOUBLE * prior) / (n + 20.0::DOUBLE), prior)", 3)} AS merchant_risk_score
FROM split LEFT JOIN known USING (merchant_id) CROSS JOIN prior"""
    q["f13_risk_score"] = f"WITH {FEAT} SELECT transaction_id, risk_score FROM feat"
    q["f14_label"] = f"WITH {FEAT} SELECT transaction_id, is_fraud FROM feat"
    q["f15_amount_tiers"] = f"""WITH {ORDERS} SELECT tier, count(*) AS txn_count,
  CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS DOUBLE) / 100.0::DOUBLE AS amount_sum,
  CAST(sum(is_fraud) AS DOUBLE) / count(*) AS positive_rate
FROM (SELECT *, CASE WHEN amount < 10 THEN 'under 10' WHEN amount < 500 THEN '10-500' WHEN amount < 5000 THEN '500-5000'
  WHEN amount < 50000 THEN '5000-50000' ELSE 'from 50000' END AS tier FROM raw) GROUP BY tier"""

    q["b1_cap_positives"] = f"""WITH {FEAT} SELECT transaction_id, is_fraud FROM (
  SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY h, transaction_id) AS rn, count(*) OVER () AS total
  FROM ({_hash("feat", "transaction_id")})) WHERE is_fraud = 0 OR rn <= total * 3 // 100"""
    q["b2_union"] = f"WITH {ORDERS} SELECT transaction_id, amount, is_fraud FROM raw"
    q["b3_shuffle"] = f"""WITH {RAW} SELECT transaction_id, amount, row_number() OVER (ORDER BY h, transaction_id) - 1 AS row_index
  FROM ({_hash("raw", "transaction_id")})"""
    q["b4_sample_n"] = f"""WITH {RAW} SELECT transaction_id, amount FROM ({_hash("raw", "transaction_id")})
  ORDER BY h, transaction_id LIMIT 1000"""
    q["b5_split_hash"] = f"WITH {ORDERS}, {_split('raw')} SELECT transaction_id, is_fraud, split FROM split"
    q["b5_split_exact"] = f"""WITH {ORDERS} SELECT transaction_id, is_fraud,
  CASE WHEN rn <= t THEN 'train' WHEN rn <= t + (n - t) * 15 // 30 THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, n * 70 // 100 AS t FROM (
  SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY h, transaction_id) AS rn, count(*) OVER (PARTITION BY is_fraud) AS n
  FROM ({_hash("raw", "transaction_id")})))"""
    q["b6_balance"] = f"WITH {FEAT} SELECT count(*) AS total_rows, CAST(sum(is_fraud) AS DOUBLE) / count(*) AS positive_rate FROM feat"
    q["b7_class_weights"] = f"""WITH {FEAT}, {_split('feat')},
n AS (SELECT count(*) FILTER (is_fraud = 0) AS n0, count(*) FILTER (is_fraud = 1) AS n1 FROM split WHERE split = 'train')
SELECT 0 AS is_fraud, n0 AS rows, CAST(n0 + n1 AS DOUBLE) / (2 * n0) AS weight, CAST(n0 AS DOUBLE) / n1 AS scale_pos_weight FROM n
UNION ALL SELECT 1, n1, CAST(n0 + n1 AS DOUBLE) / (2 * n1), CAST(n0 AS DOUBLE) / n1 FROM n"""

    q["m1_label_dict"] = f"""WITH {RAW} SELECT 'device_type' AS field, * FROM ({_dictionary('raw', 'device_type')})
UNION ALL SELECT 'location', * FROM ({_dictionary('raw', 'location')})"""
    q["m2_encode"] = f"""WITH {RAW}, {_split('raw')}, train AS (SELECT * FROM split WHERE split = 'train'),
d AS ({_dictionary('train', 'device_type')}), l AS ({_dictionary('train', 'location')})
SELECT s.transaction_id, CASE WHEN s.device_type = 'view' THEN 0 ELSE coalesce(d.code, 0) END AS device_type, coalesce(l.code, 0) AS location
FROM split s LEFT JOIN d ON d.value = s.device_type LEFT JOIN l ON l.value = s.location"""
    q["m7_predict"] = f"""WITH {RAW}, {_split('raw')} SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS out_of_range, CAST(0 AS BIGINT) AS forest_wrong,
  CAST(0 AS BIGINT) AS boost_wrong, CAST(0 AS BIGINT) AS mean_wrong FROM split WHERE split = 'test'"""
    q["s13_saved_models"] = f"WITH {RAW}, {_split('raw')} SELECT count(*) AS same, CAST(0 AS BIGINT) AS different FROM split WHERE split = 'test'"
    # A leaf of one tree on a 0/1 feature: the weighted share of positives, or for boosting the weighted mean of -1 and 1.
    stump = f"""WITH {FEAT}, {_split('feat')}, train AS (SELECT * FROM split WHERE split = 'train'),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(is_fraud) AS DOUBLE) AS p FROM train),
leaf AS (SELECT is_new_device, sum(is_fraud * {{pos}}) AS wp, sum((1 - is_fraud) * {{neg}}) AS wn FROM train CROSS JOIN n GROUP BY is_new_device)
SELECT transaction_id, round({{score}}, 9) AS {{name}}_score, CAST({{score}} > 0.5 AS INTEGER) AS {{name}}_pred
FROM split JOIN leaf USING (is_new_device) WHERE split = 'test'"""
    q["m4_stump"] = stump.format(pos="n / (2 * p)", neg="n / (2 * (n - p))", score="(wp / (wp + wn))", name="forest")
    q["m5_one_round"] = stump.format(pos="(n - p) / p", neg="1.0::DOUBLE", score="(1 / (1 + exp(-2 * (wp - wn) / (wp + wn))))", name="boost")
    # Second order: gradient p - y, hessian p * (1 - p) at p = 1/2, both times the weight; leaves -0.05 * G / (H + 1).
    flags = "[is_new_device, location_change, high_amount_flag]"

    def best(name: str, rows: str) -> str:
        return f"""{name}_cell AS (SELECT node, f, sum(g) AS g, sum(h) AS h, coalesce(sum(g) FILTER (flag = 0), 0) AS gb,
  coalesce(sum(h) FILTER (flag = 0), 0) AS hb FROM (SELECT node, g, h, unnest(range(3)) AS f, unnest(flags) AS flag FROM {rows}) GROUP BY node, f),
{name} AS (SELECT node, any_value(g) AS g, any_value(h) AS h, arg_max(f, gain * 1e6 - f * 1e-6) FILTER (fair) AS f, max(gain) FILTER (fair) AS gain FROM (
  SELECT *, gb * gb / (hb + 1) + (g - gb) * (g - gb) / (h - hb + 1) - g * g / (h + 1) AS gain, hb >= 1 AND h - hb >= 1 AND gain > 1e-9 AS fair FROM {name}_cell) GROUP BY node)"""

    newton = f"""WITH {FEAT}, {_split('feat')}, flagged AS (SELECT transaction_id, split, is_fraud, {flags} AS flags FROM split),
w AS (SELECT CAST(count(*) FILTER (is_fraud = 0) AS DOUBLE) / count(*) FILTER (is_fraud = 1) AS w FROM flagged WHERE split = 'train'),
train0 AS (SELECT flags, 0 AS node, (0.5::DOUBLE - is_fraud) * CASE WHEN is_fraud = 1 THEN w ELSE 1.0::DOUBLE END AS g,
  0.25::DOUBLE * CASE WHEN is_fraud = 1 THEN w ELSE 1.0::DOUBLE END AS h FROM flagged CROSS JOIN w WHERE split = 'train'),
{best("first", "train0")},
train1 AS (SELECT t.flags, CASE WHEN f IS NULL THEN 0 ELSE 1 + flags[f + 1] END AS node, t.g, t.h FROM train0 t CROSS JOIN first),
{best("second", "train1")},
train2 AS (SELECT CASE WHEN f IS NULL OR node = 0 THEN node ELSE node * 10 + flags[f + 1] END AS node, t.g, t.h FROM train1 t JOIN second USING (node)),
leaf AS (SELECT node, -0.05::DOUBLE * sum(g) / (sum(h) + 1) AS v FROM train2 GROUP BY node)"""
    q["m5_newton_tree"] = f"""{newton} SELECT transaction_id, round(1 / (1 + exp(-v)), 9) AS newton_score,
  CAST(1 / (1 + exp(-v)) > 0.5 AS INTEGER) AS newton_pred
FROM (SELECT transaction_id, CASE WHEN s.f IS NULL OR s.node = 0 THEN s.node ELSE s.node * 10 + flags[s.f + 1] END AS node FROM (
  SELECT transaction_id, flags, CASE WHEN f IS NULL THEN 0 ELSE 1 + flags[f + 1] END AS node FROM flagged CROSS JOIN first WHERE split = 'test') x
  JOIN second s USING (node)) JOIN leaf USING (node)"""
    q["m8_newton_gain"] = f"""{newton}, gains AS (SELECT f, avg(gain) AS gain FROM (
  SELECT f, gain FROM first UNION ALL SELECT f, gain FROM second WHERE node > 0) WHERE gain IS NOT NULL GROUP BY f),
named AS (SELECT ['is_new_device', 'location_change', 'high_amount_flag'][i + 1] AS feature, coalesce(gain, 0) AS gain
  FROM (SELECT unnest(range(3)) AS i) LEFT JOIN gains ON f = i)
SELECT feature, round(gain / (SELECT sum(gain) FROM named), 9) AS importance FROM named"""
    simple = f"""{newton.replace("flagged AS (SELECT transaction_id,", "flagged AS (SELECT transaction_id, batch_id,")},
sn AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(is_fraud) AS DOUBLE) AS p FROM flagged WHERE split = 'train'),
stump AS (SELECT flags[1] AS d, sum(is_fraud * n / (2 * p)) AS wp, sum((1 - is_fraud) * n / (2 * (n - p))) AS wn
  FROM flagged CROSS JOIN sn WHERE split = 'train' GROUP BY 1),
simple AS (SELECT transaction_id, batch_id, wp / (wp + wn) AS forest_score, 1 / (1 + exp(-v)) AS boost_score FROM (
  SELECT transaction_id, batch_id, flags, CASE WHEN s.f IS NULL OR s.node = 0 THEN s.node ELSE s.node * 10 + flags[s.f + 1] END AS node FROM (
    SELECT transaction_id, batch_id, flags, CASE WHEN f IS NULL THEN 0 ELSE 1 + flags[f + 1] END AS node FROM flagged CROSS JOIN first WHERE split = 'test') x
  JOIN second s USING (node)) JOIN leaf USING (node) JOIN stump ON d = flags[1])"""
    q["m6_simple_proba"] = f"""{simple} SELECT transaction_id, round(forest_score, 9) AS forest_score, round(boost_score, 9) AS boost_score,
  round(0.7::DOUBLE * boost_score + 0.3::DOUBLE * forest_score, 9) AS fraud_score FROM simple"""
    q["t1_simple_score"] = f"""{simple}, meta AS (
  SELECT batch_id, count(*) AS total_batch_txns, max(timestamp) AS pipeline_detected_at FROM raw GROUP BY batch_id)
SELECT transaction_id, fraud_score, {SYSTEM} FROM (
  SELECT *, round(0.5::DOUBLE * boost_score + 0.5::DOUBLE * forest_score, 9) AS fraud_score FROM simple) JOIN meta USING (batch_id) WHERE fraud_score > 0.5"""
    q["m9_ensemble_weighted"] = f"WITH {SCORED} SELECT transaction_id, 0.7::DOUBLE * score_b + 0.3::DOUBLE * score_a AS fraud_score FROM scored"
    q["m10_ensemble_mean"] = f"WITH {SCORED} SELECT transaction_id, 0.5::DOUBLE * score_b + 0.5::DOUBLE * score_a AS fraud_score FROM scored"

    q["e1_report"] = f"""WITH {CELLS}
SELECT class, precision, recall, f1, CAST(s AS BIGINT) AS support FROM cls
UNION ALL SELECT 'accuracy', NULL, NULL, (tn + tp) / (tn + fp + fn + tp), CAST(tn + fp + fn + tp AS BIGINT) FROM cells
UNION ALL SELECT 'macro avg', (sum(precision)) / 2, sum(recall) / 2, sum(f1) / 2, CAST(max(total) AS BIGINT) FROM cls
UNION ALL SELECT 'weighted avg', sum(precision * s) / max(total), sum(recall * s) / max(total), sum(f1 * s) / max(total), CAST(max(total) AS BIGINT) FROM cls"""
    q["s12_report_file"] = q["e1_report"]
    q["e2_roc_auc"] = f"""WITH {CURVE} SELECT CAST(sum(CAST(pos AS DOUBLE) * (CAST(n - fp AS DOUBLE) + CAST(neg AS DOUBLE) / 2)) AS DOUBLE)
  / (max(CAST(p AS DOUBLE)) * max(CAST(n AS DOUBLE))) AS roc_auc FROM curve"""
    q["e3_pr_curve"] = f"WITH {CURVE} SELECT * FROM pr UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE"
    q["e4_best_threshold"] = f"WITH {CURVE} {_best('pr')}"
    on_val = CURVE.replace("FROM scored GROUP BY fraud_score", "FROM split WHERE split = 'val' GROUP BY fraud_score").replace(
        "\npts AS", f"\n{_split('scored')},\npts AS")
    q["e5_apply_threshold"] = f"""WITH {on_val}, best AS ({_best('pr')})
SELECT transaction_id, CAST(fraud_score > threshold AS INTEGER) AS pred FROM split CROSS JOIN best WHERE split = 'test'"""
    q["e6_confusion"] = f"""WITH {CELLS} SELECT 0 AS label, 0 AS pred, CAST(tn AS BIGINT) AS rows FROM cells
UNION ALL SELECT 0, 1, CAST(fp AS BIGINT) FROM cells UNION ALL SELECT 1, 0, CAST(fn AS BIGINT) FROM cells UNION ALL SELECT 1, 1, CAST(tp AS BIGINT) FROM cells"""
    q["e7_roc_curve"] = f"""WITH {CURVE} SELECT threshold, CAST(fp AS DOUBLE) / CAST(n AS DOUBLE) AS fpr, CAST(tp AS DOUBLE) / CAST(p AS DOUBLE) AS tpr FROM curve
UNION ALL SELECT NULL, 0.0::DOUBLE, 0.0::DOUBLE"""

    q["t2_batch_meta"] = f"WITH {ALERTS} SELECT transaction_id, {SYSTEM} FROM alerts"
    q["t3_batch_metrics"] = f"""WITH {SCORED}, {TOP2}, {COUNTS}
SELECT counts.*, a.alert_count, a.alert_ids FROM counts JOIN (
  SELECT batch_id, CAST(count(*) AS INTEGER) AS alert_count, string_agg(CAST(transaction_id AS VARCHAR), ',' ORDER BY alert_rank) AS alert_ids
  FROM top2 GROUP BY batch_id) a USING (batch_id)"""
    q["t4_top2"] = f"WITH {SCORED}, {TOP2} SELECT batch_id, CAST(alert_rank AS INTEGER) AS alert_rank, transaction_id, amount FROM top2"
    q["t5_alert_structs"] = f"""WITH {SCORED}, {TOP2} SELECT batch_id, CAST(alert_rank - 1 AS INTEGER) AS position,
  CAST(transaction_id AS VARCHAR) AS id, fraud_score AS score, location FROM top2"""
    running = "CAST(sum({0}) OVER (ORDER BY batch_id) AS BIGINT) AS {1}"
    q["t6_running_totals"] = f"""WITH {SCORED}, {COUNTS} SELECT batch_id, {running.format('batch_size', 'total')},
  {running.format('detected', 'detected_total')}, {running.format('actual', 'actual_total')} FROM counts"""
    q["t7_missed"] = f"WITH {SCORED}, {COUNTS} SELECT batch_id, {running.format('missed', 'missed_total')} FROM counts"
    ten = "SELECT * FROM top2 ORDER BY batch_id DESC, alert_rank LIMIT 10"
    q["t8_latest10"] = f"WITH {SCORED}, {TOP2} SELECT batch_id, transaction_id, amount, fraud_score FROM ({ten})"
    q["t9_snapshot"] = f"""WITH {SCORED}, {TOP2}, {COUNTS} SELECT CAST(sum(batch_size) AS BIGINT) AS total, CAST(sum(detected) AS BIGINT) AS detected,
  CAST(sum(actual) AS BIGINT) AS actual, CAST(sum(missed) AS BIGINT) AS missed,
  (SELECT string_agg(CAST(transaction_id AS VARCHAR), ',' ORDER BY batch_id DESC, alert_rank) FROM ({ten})) AS alert_ids FROM counts"""
    q["t10_alert_rate"] = f"WITH {ALERTS} SELECT batch_id, count(*) AS alert_count FROM alerts GROUP BY batch_id"
    q["t10_window"] = f"""WITH {ALERTS} SELECT epoch_us(date_trunc('hour', timestamp)) AS window_start_us, count(*) AS alert_count
  FROM alerts GROUP BY ALL"""
    q["t6_stream_totals"] = f"""WITH {FEAT} SELECT count(*) AS total, count(*) FILTER (amount > 100) AS detected,
  count(*) FILTER (is_fraud = 1) AS actual, count(*) FILTER (amount <= 100 AND is_fraud = 1) AS missed FROM feat"""
    q["t10_stream_window"] = """SELECT epoch_us(date_trunc('hour', ts)) AS window_start_us, count(*) AS alert_count
FROM events WHERE value > 100 GROUP BY ALL"""
    q["t11_stream_features"] = q["f5_f11_sliced"]
    q["f5_f11_heavy"] = q["f5_f11_sliced"]
    q["f1_user_profile_merged"] = q["f1_user_profile"]
    q["t8_stream_latest10"] = q["t8_latest10"]
    q["t9_stream_snapshot"] = q["t9_snapshot"]
    q["s8_compaction"] = q["t2_batch_meta"]
    q["s8_redelivery"] = f"WITH {RAW} SELECT transaction_id, amount FROM raw"
    # Every part of a stream that holds the ids of one remainder is one micro-batch.
    q["s15_run_counters"] = f"""WITH {SCORED} SELECT transaction_id % 4 AS batch_id, count(*) AS rows,
  count(*) FILTER (fraud_score > 0.5::DOUBLE) AS alerts, true AS has_rate FROM scored GROUP BY ALL"""
    in_parts = "ORDER BY transaction_id % 4, h, transaction_id"
    q["p9_stream_ids"] = f"""WITH {RAW} SELECT 199999 + row_number() OVER ({in_parts}) AS transaction_id,
  transaction_id AS source_id FROM ({_hash("raw", "transaction_id")})"""
    q["t12_canary_recall"] = f"""WITH {REPLAY},
flagged AS (
  SELECT hit, 0.5::DOUBLE * (({RISK} + 0.15::DOUBLE * ((source_id % 1000 * 7919) % 1000) / 1000.0::DOUBLE) / 1.15::DOUBLE)
    + 0.5::DOUBLE * (amount / (amount + user_avg)) > 0.5::DOUBLE AS flag FROM canary
)
SELECT count(*) AS canaries, count(*) FILTER (flag) AS flagged,
  coalesce(CAST(count(*) FILTER (flag) AS DOUBLE) / nullif(count(*), 0), 0.0::DOUBLE) AS recall FROM flagged WHERE hit"""

    q["t12_stream_recall"] = q["t12_canary_recall"].replace("ORDER BY h, transaction_id", in_parts)

    q["v1_latest_alert"] = f"WITH {ALERTS} SELECT transaction_id, fraud_score, {SYSTEM} FROM alerts ORDER BY pipeline_detected_at DESC, transaction_id LIMIT 1"
    q["v2_latest_batch"] = f"WITH {ALERTS} SELECT transaction_id, batch_id, amount, fraud_score FROM latest"
    q["v3_latest_summary"] = f"""WITH {ALERTS} SELECT CASE WHEN count(*) = 0 THEN 'empty' ELSE 'success' END AS status,
  coalesce(max(batch_id), 0) AS batch_id, count(*) AS fraud_count, coalesce(max(total_batch_txns), 0) AS total_txns,
  max(pipeline_detected_at) AS detected_at FROM latest"""
    q["v4_last_five"] = f"WITH {ALERTS} SELECT * FROM five"
    q["v4_nested"] = f"""WITH {ALERTS} SELECT batch_id, CAST(0 AS BIGINT) AS chunk, max(total_batch_txns) AS total_txns, max(pipeline_detected_at) AS detected_at,
  CAST(count(*) AS INTEGER) AS fraud_count, string_agg(CAST(transaction_id AS VARCHAR), ',' ORDER BY transaction_id) AS fraud_ids
FROM alerts WHERE batch_id IN (SELECT batch_id FROM five) GROUP BY batch_id"""
    q["v5_strip_nested"] = f"WITH {ALERTS} SELECT {fields}, batch_id, total_batch_txns FROM alerts WHERE batch_id IN (SELECT batch_id FROM five)"
    q["v6_chronological"] = f"WITH {ALERTS} SELECT CAST(row_number() OVER (ORDER BY batch_id) AS INTEGER) AS position, batch_id, fraud_count FROM five"
    q["v7_device_counts"] = f"WITH {ALERTS} SELECT device_type AS name, count(*) AS value FROM latest GROUP BY device_type"
    q["v8_top_locations"] = f"WITH {ALERTS} SELECT location AS name, count(*) AS frauds FROM latest GROUP BY location ORDER BY frauds DESC, name LIMIT 5"
    q["v9_history"] = f"WITH {ALERTS} SELECT batch_id, total_txns AS transactions, fraud_count AS frauds FROM five"
    text = "CAST(CAST({0} AS DECIMAL(38, 2)) AS VARCHAR) AS {1}"
    q["v10_detail"] = f"""WITH {ALERTS} SELECT {text.format('transaction_id', 'TRANSACTION_ID')}, {text.format('amount', 'AMOUNT')},
  device_type AS DEVICE_TYPE, location AS LOCATION, {text.format('velocity', 'VELOCITY')} FROM latest"""
    return q
