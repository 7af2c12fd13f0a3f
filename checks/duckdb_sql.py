"""DuckDB texts that state the result of each query on its own.

Each text starts from the driver's tables and repeats the whole definition with plain window
functions and joins; none of the library's stages are used.
"""

from auditloom.schema import (
    ACTION_TIERS, CATEGORY_INFO, MERCHANT_BRANDS, OTHER_COLOR, RISK_COLORS, SIGNALS)

RAW = """
events_typed AS (
    SELECT event_id AS id, user_id,
           CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 24 + hour(ts) AS BIGINT) AS step,
           CASE event_type WHEN 'purchase' THEN 'PAYMENT' WHEN 'view' THEN 'TRANSFER' WHEN 'click' THEN 'CASH_OUT'
                WHEN 'error' THEN 'DEBIT' WHEN 'signup' THEN 'CASH_IN' END AS kind,
           CAST(round(value * 100) AS BIGINT) AS c,
           CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k,
           10000 + (event_id * 7919) % 4990000 AS o, (event_id * 104729) % 10000000 AS d
    FROM events),
plain AS (
    SELECT id AS row_id, step,
           CASE WHEN id % 50 = 0 THEN '  ' || lower(kind) || ' ' ELSE kind END AS type,
           CASE WHEN id % 211 = 0 THEN NULL WHEN id % 401 = 1 THEN c * 1000 WHEN id % 499 = 5 THEN -c ELSE c END
               / CAST(100 AS DOUBLE) AS amount,
           'C' || CAST(20000000 + user_id AS VARCHAR) AS nameOrig,
           CASE WHEN id % 307 = 0 THEN NULL ELSE o / CAST(100 AS DOUBLE) END AS oldbalanceOrg,
           greatest(0, o - c) / CAST(100 AS DOUBLE) AS newbalanceOrig,
           (CASE WHEN k < 80 THEN 'M' ELSE 'C' END) || CAST(10000000 + k * 123457 AS VARCHAR) AS nameDest,
           d / CAST(100 AS DOUBLE) AS oldbalanceDest, (d + c) / CAST(100 AS DOUBLE) AS newbalanceDest,
           CAST(id % 401 = 1 OR id % 287 = 3 AS INTEGER) AS isFraud, 0 AS isFlaggedFraud
    FROM events_typed),
txn AS (
    SELECT * FROM plain
    UNION ALL SELECT * REPLACE (row_id + 1000000000 AS row_id) FROM plain WHERE row_id % 331 = 2
    UNION ALL SELECT * REPLACE (row_id + 2000000000 AS row_id, step + 1 AS step) FROM plain WHERE row_id % 287 = 3
    UNION ALL SELECT row_id + (3 + j) * 1000000000, step, 'TRANSFER',
                     (800000 + (row_id * 13 + j * 97700) % 700000) / CAST(100 AS DOUBLE),
                     nameOrig, 50000, 35000, nameDest, 10000, 22000, 1, 1
              FROM plain, range(4) AS r(j) WHERE row_id % 997 = 4
    UNION ALL SELECT 9000000000 + j, 250, 'PAYMENT', (50000 + j * 3700) / CAST(100 AS DOUBLE),
                     'C' || CAST(20000000 + j % 15 AS VARCHAR), 10000, 8500, 'M10000000', 50000, 51500,
                     CAST(j % 2 = 0 AS INTEGER), 0
              FROM range(40) AS r(j))
"""

CLEAN = RAW + """,
kept AS (SELECT * FROM txn WHERE amount IS NOT NULL),
medians AS (SELECT quantile_cont(oldbalanceOrg, 0.5) AS mo, quantile_cont(oldbalanceDest, 0.5) AS md FROM kept),
filled AS (
    SELECT row_id, step, upper(trim(type)) AS type, round(amount, 2) AS amount, nameOrig,
           coalesce(oldbalanceOrg, mo) AS oldbalanceOrg, newbalanceOrig, nameDest,
           coalesce(oldbalanceDest, md) AS oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud,
           FALSE AS is_missing_amount, oldbalanceOrg IS NULL AS is_missing_orig_balance,
           TIMESTAMP '2024-01-01' + to_hours(CAST(step AS INTEGER)) AS timestamp,
           CAST(step % 24 AS INTEGER) AS hour_of_day, CAST((step // 24) % 7 AS INTEGER) AS day_of_week,
           (step // 24) % 7 IN (5, 6) AS is_weekend, step % 24 BETWEEN 1 AND 5 AS is_night,
           nameDest AS vendor_id, upper(trim(type)) AS category, nameDest LIKE 'M%' AS is_merchant_dest
    FROM kept, medians),
clean AS (
    SELECT *, row_number() OVER (
               PARTITION BY step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest,
                            oldbalanceDest, newbalanceDest, isFraud, isFlaggedFraud ORDER BY row_id) > 1
               AS is_exact_duplicate,
           coalesce(nameOrig IS NOT NULL AND step - lag(step) OVER (
               PARTITION BY nameOrig, amount ORDER BY step, row_id) <= 1, FALSE) AS is_near_duplicate
    FROM filled)
"""

SIGNAL = CLEAN + """,
cutoffs AS (
    SELECT category, n, q25, q75,
           CASE WHEN q75 - q25 > 0 THEN q75 + 2.5 * (q75 - q25) ELSE mean + 3 * std END AS cutoff
    FROM (SELECT category, count(*) AS n, quantile_cont(amount, 0.25) AS q25, quantile_cont(amount, 0.75) AS q75,
                 avg(amount) AS mean, stddev_samp(amount) AS std FROM clean GROUP BY category)),
hours AS (
    SELECT vendor_id, count(*) AS n, quantile_cont(hour_of_day, 0.05) AS p05, quantile_cont(hour_of_day, 0.95) AS p95
    FROM clean GROUP BY vendor_id HAVING count(*) >= 10),
daily AS (
    SELECT vendor_id, step // 24 AS day_bucket, count(amount) AS daily_count,
           CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS daily_volume
    FROM clean GROUP BY ALL),
baseline AS (
    SELECT *, CASE WHEN past >= 2 THEN mean END AS rolling_count_mean, CASE WHEN past >= 2 THEN std END AS rolling_count_std,
           coalesce(daily_count > 5 AND past >= 2 AND daily_count > mean + 2.5 * coalesce(std, 0), FALSE)
               AS is_vendor_spike_day
    FROM (SELECT *, count(daily_count) OVER w AS past, avg(daily_count) OVER w AS mean,
                 stddev_samp(daily_count) OVER w AS std
          FROM daily
          WINDOW w AS (PARTITION BY vendor_id ORDER BY day_bucket ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))),
spend AS (
    SELECT nameOrig, vendor_id, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS vendor_amount, count(*) AS rows
    FROM clean GROUP BY ALL),
totals AS (
    SELECT nameOrig, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_user_amount, count(*) AS txn_count
    FROM clean GROUP BY ALL),
shares AS (
    SELECT nameOrig, vendor_id, vendor_amount, txn_count, total_user_amount,
           vendor_amount / CASE WHEN total_user_amount = 0 THEN 1 ELSE total_user_amount END AS share
    FROM spend JOIN totals USING (nameOrig)),
hhi AS (
    SELECT nameOrig, any_value(txn_count) AS txn_count, any_value(total_user_amount) AS total_user_amount,
           sum(share * share) AS hhi,
           any_value(txn_count) >= 3 AND sum(share * share) >= 0.85 AS concentrated
    FROM shares GROUP BY nameOrig),
marked AS (
    SELECT c.*,
           row_number() OVER (PARTITION BY step, type, amount, nameOrig, nameDest ORDER BY row_id) > 1
               AS flag_exact_duplicate,
           coalesce(step - lag(step) OVER (
               PARTITION BY nameOrig, nameDest, amount ORDER BY step, row_id) <= 2, FALSE) AS flag_near_duplicate,
           coalesce(step - lag(step, 2) OVER u <= 2, FALSE) OR coalesce(lead(step) OVER u - step <= 2, FALSE)
               AS flag_velocity
    FROM clean c WINDOW u AS (PARTITION BY nameOrig ORDER BY step, nameDest, amount, row_id)),
signals AS (
    SELECT m.*, flag_exact_duplicate OR flag_near_duplicate AS flag_duplicate,
           coalesce(amount > cutoff, FALSE) AS flag_large_transaction,
           hour_of_day BETWEEN 1 AND 5 OR coalesce(hour_of_day < p05 OR hour_of_day > p95, FALSE)
               AS flag_unusual_timing,
           coalesce(is_vendor_spike_day, FALSE) AS flag_vendor_spike,
           oldbalanceOrg - newbalanceOrig AS balance_delta_orig, FALSE AS flag_multivariate_outlier,
           round_even(coalesce(hhi, 0) * 10000, 0) / 10000 AS user_hhi,
           coalesce(concentrated, FALSE) AS flag_concentration
    FROM marked m LEFT JOIN cutoffs USING (category) LEFT JOIN hours USING (vendor_id)
         LEFT JOIN baseline b ON b.vendor_id = m.vendor_id AND b.day_bucket = m.step // 24
         LEFT JOIN hhi USING (nameOrig))
"""

FLAGGED = SIGNAL + """,
scored AS (
    SELECT *, least(100, 25 * CAST(flag_duplicate AS INTEGER) + 20 * CAST(flag_large_transaction AS INTEGER)
               + 20 * CAST(flag_vendor_spike AS INTEGER) + 15 * CAST(flag_velocity AS INTEGER)
               + 10 * CAST(flag_unusual_timing AS INTEGER) + 10 * CAST(flag_concentration AS INTEGER)
               + 50 * isFraud) AS anomaly_score,
           concat_ws('; ', CASE WHEN flag_duplicate THEN 'Duplicate Transaction' END,
               CASE WHEN flag_large_transaction THEN 'High Amount vs Category' END,
               CASE WHEN flag_vendor_spike THEN 'Abnormal Vendor Spike' END,
               CASE WHEN flag_velocity THEN 'High Velocity Burst' END,
               CASE WHEN flag_unusual_timing THEN 'Unusual Timing / Night' END,
               CASE WHEN flag_concentration THEN 'High Spend Concentration' END,
               CASE WHEN isFraud = 1 THEN 'Reported Fraud Ground Truth' END) AS flag_reasons
    FROM signals),
flagged AS (
    SELECT *, anomaly_score >= 35 OR flag_duplicate OR isFraud = 1 AS is_flagged,
           CASE WHEN anomaly_score >= 75 THEN 'CRITICAL' WHEN anomaly_score >= 45 THEN 'HIGH'
                WHEN anomaly_score >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
           row_number() OVER (ORDER BY nameOrig, step, nameDest, amount, row_id) AS row_number
    FROM scored)
"""

_PRIME = 2147483647


def _mixed(name, number, other):
    """Select items that end in ``name``, the forest's hash of two whole numbers with seed 42."""
    return f"""({number} * 48271 + {other} * 69621 + 42 * 40692 + 1) % {_PRIME} AS {name}_0, {name}_0 * {name}_0 % {_PRIME} AS {name}_1,
           ({name}_1 * {name}_1 % {_PRIME} * {name}_0 % {_PRIME} * 16807 + 12345) % {_PRIME} AS {name}_2,
           {name}_2 * {name}_2 % {_PRIME} AS {name}_3,
           ({name}_3 * {name}_3 % {_PRIME} * {name}_2 % {_PRIME} * 16807 + 54321) % {_PRIME} AS {name}"""


_PICKED = "CASE feature WHEN 0 THEN f0 WHEN 1 THEN f1 WHEN 2 THEN f2 ELSE f3 END"

# The isolation forest: trees are relations of splits and leaves, and rows walk down them.
_FOREST = f""",
points AS MATERIALIZED (
    SELECT row_id, CAST(coalesce(amount, 0) AS DOUBLE) AS f0, CAST(hour_of_day AS DOUBLE) AS f1, CAST(step AS DOUBLE) AS f2,
           CAST(coalesce(balance_delta_orig, 0) AS DOUBLE) AS f3
    FROM signals),
sampled AS MATERIALIZED (
    SELECT row_id, f0, f1, f2, f3 FROM (SELECT *, {_mixed("h", f"(row_id % {_PRIME})", "-1")} FROM points)
    WHERE h / CAST({_PRIME} AS DOUBLE) < 200000 / CAST((SELECT count(*) FROM points) AS DOUBLE)),
drawn AS MATERIALIZED (
    SELECT tree, f0, f1, f2, f3
    FROM (SELECT *, {_mixed("h", f"(row_id % {_PRIME})", "tree")} FROM sampled, range(100) AS t(tree))
    WHERE h < floor(least(CAST(1 AS DOUBLE), 512 / CAST((SELECT count(*) FROM sampled) AS DOUBLE)) * {_PRIME})
    QUALIFY row_number() OVER (PARTITION BY tree ORDER BY h, row_id) <= 256),
grown AS (
    SELECT 0 AS level, tree, CAST(0 AS BIGINT) AS slot, f0, f1, f2, f3, CAST(NULL AS BIGINT) AS feature,
           CAST(NULL AS DOUBLE) AS cut FROM drawn
    UNION ALL
    SELECT level + 1, tree, 2 * slot + 1 + CAST({_PICKED} >= cut AS BIGINT), f0, f1, f2, f3, feature, cut
    FROM (SELECT *, usable[CAST(1 + which * len(usable) // {_PRIME} AS BIGINT)] AS feature,
                 low[feature + 1] + place / CAST({_PRIME} AS DOUBLE) * (high[feature + 1] - low[feature + 1]) AS cut
          FROM (SELECT level, tree, slot, f0, f1, f2, f3, n, low, high,
                       list_filter([CASE WHEN high[1] > low[1] THEN 0 END, CASE WHEN high[2] > low[2] THEN 1 END,
                                    CASE WHEN high[3] > low[3] THEN 2 END, CASE WHEN high[4] > low[4] THEN 3 END],
                                   lambda x: x IS NOT NULL) AS usable,
                       {_mixed("which", "slot", "(2 * tree)")}, {_mixed("place", "slot", "(2 * tree + 1)")}
                FROM (SELECT level, tree, slot, f0, f1, f2, f3, count(*) OVER node AS n,
                             [min(f0) OVER node, min(f1) OVER node, min(f2) OVER node, min(f3) OVER node] AS low,
                             [max(f0) OVER node, max(f1) OVER node, max(f2) OVER node, max(f3) OVER node] AS high
                      FROM grown WINDOW node AS (PARTITION BY tree, slot)))
          WHERE n > 1 AND len(usable) > 0
              AND level < ceil(log2(least(256, (SELECT count(*) FROM sampled)))))),
splits AS MATERIALIZED (SELECT DISTINCT tree, (slot - 1) // 2 AS slot, feature, cut FROM grown WHERE level > 0),
leaves AS MATERIALIZED (
    SELECT tree, slot, count(*) AS n FROM grown ANTI JOIN splits USING (tree, slot) GROUP BY ALL),
walk AS (
    SELECT row_id, tree, CAST(0 AS BIGINT) AS slot, 0 AS level, f0, f1, f2, f3 FROM points, range(100) AS t(tree)
    UNION ALL
    SELECT row_id, w.tree, 2 * w.slot + 1 + CAST({_PICKED} >= cut AS BIGINT), level + 1, f0, f1, f2, f3
    FROM walk w JOIN splits s ON w.tree = s.tree AND w.slot = s.slot),
path_totals AS MATERIALIZED (
    SELECT row_id, CAST(sum(level * 1000000 + CASE WHEN coalesce(n, 0) <= 1 THEN 0 WHEN n = 2 THEN 1000000 ELSE
               CAST(round((2e0 * (ln(n - 1) + 0.5772156649015329e0) - 2e0 * (n - 1) / n) * 1000000) AS BIGINT) END) AS BIGINT) AS total
    FROM (SELECT * FROM walk ANTI JOIN splits USING (tree, slot)) LEFT JOIN leaves USING (tree, slot) GROUP BY row_id),
outliers AS MATERIALIZED (
    SELECT row_id FROM path_totals WHERE total < (
        SELECT total FROM (SELECT total, row_number() OVER (ORDER BY total DESC) - 1 AS place, count(*) OVER () AS n FROM path_totals)
        WHERE place = floor((1e0 - 0.015e0) * (n - 1)))),
outlying AS (
    SELECT * REPLACE (row_id IN (SELECT row_id FROM outliers) AS flag_multivariate_outlier) FROM signals)
"""

FLAGGED_ALL = SIGNAL + _FOREST + FLAGGED[len(SIGNAL):].replace("FROM signals)", "FROM outlying)").replace(
    "+ 10 * CAST(flag_unusual_timing", "+ 15 * CAST(flag_multivariate_outlier AS INTEGER) + 10 * CAST(flag_unusual_timing").replace(
    "CASE WHEN flag_unusual_timing",
    "CASE WHEN flag_multivariate_outlier THEN 'Multivariate Outlier' END,\n               CASE WHEN flag_unusual_timing")

FLAGGED_LIST = """row_id, step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest, oldbalanceDest,
    newbalanceDest, isFraud, isFlaggedFraud, is_missing_amount, is_missing_orig_balance, timestamp, hour_of_day,
    day_of_week, is_weekend, is_night, vendor_id, category, is_merchant_dest, is_exact_duplicate, is_near_duplicate"""
SIGNAL_LIST = """flag_exact_duplicate, flag_near_duplicate, flag_duplicate, flag_large_transaction,
    flag_unusual_timing, flag_vendor_spike, flag_velocity, balance_delta_orig, flag_multivariate_outlier, user_hhi,
    flag_concentration, anomaly_score"""


def _text(value):
    return "'" + value.replace("'", "''") + "'"


_INFO = ", ".join(f"({', '.join(_text(v) for v in row)})" for row in CATEGORY_INFO)
_BRANDS = "[" + ", ".join(_text(b) for b in MERCHANT_BRANDS) + "]"

STAR = FLAGGED + f""",
fact AS (
    SELECT 'TXN_' || lpad(CAST(row_number AS VARCHAR), CAST(greatest(8, length(CAST(row_number AS VARCHAR))) AS INTEGER), '0')
               AS transaction_id,
           step, type, amount, nameOrig AS user_orig_id, oldbalanceOrg AS old_balance_orig,
           newbalanceOrig AS new_balance_orig, nameDest, oldbalanceDest AS old_balance_dest,
           newbalanceDest AS new_balance_dest, isFraud AS is_fraud_ground_truth, isFlaggedFraud,
           is_missing_amount, is_missing_orig_balance, timestamp, hour_of_day, day_of_week, is_weekend, is_night,
           vendor_id, category, is_merchant_dest, is_exact_duplicate, is_near_duplicate,
           {SIGNAL_LIST}, nullif(flag_reasons, '') AS flag_reasons, is_flagged, risk_level,
           CAST(strftime(timestamp, '%Y%m%d') AS INTEGER) AS date_key
    FROM flagged),
money AS (SELECT *, CAST(amount AS DECIMAL(18,2)) AS m FROM fact),
dim_category AS (
    SELECT category AS category_id, coalesce(i.name, category) AS category_name,
           coalesce(i.text, 'General ' || category || ' transaction') AS description,
           coalesce(i.risk, 'Medium') AS category_risk_profile
    FROM (SELECT DISTINCT category FROM flagged) LEFT JOIN (VALUES {_INFO}) AS i(id, name, text, risk)
         ON i.id = category),
dim_vendor AS (
    SELECT vendor_id, total_transactions, total_volume, total_volume / total_transactions AS avg_transaction_amount,
           flagged_count, vendor_id LIKE 'M%' AS is_merchant, rate AS flagged_rate_pct,
           CASE WHEN vendor_id LIKE 'M%' THEN
                    list_extract({_BRANDS}, CAST(1 + CAST('0x' || substr(md5(vendor_id), 1, 8) AS BIGINT) % 20 AS BIGINT))
                    || ' (' || substr(vendor_id, 1, 6) || ')'
                ELSE 'Private Account ' || vendor_id END AS vendor_name,
           CASE WHEN rate >= 15 THEN 'HIGH_RISK' WHEN rate >= 5 THEN 'MEDIUM_RISK' ELSE 'STANDARD' END
               AS vendor_risk_tier
    FROM (SELECT vendor_id, count(amount) AS total_transactions, CAST(sum(m) AS DOUBLE) AS total_volume,
                 count(*) FILTER (is_flagged) AS flagged_count,
                 round_even(count(*) FILTER (is_flagged) / greatest(count(amount), 1) * 100 * 100, 0) / 100 AS rate
          FROM money GROUP BY vendor_id)),
dim_date AS (
    SELECT CAST(day AS DATE) AS full_date, CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key,
           CAST(year(day) AS INTEGER) AS year, 'Q' || quarter(day) AS quarter, CAST(month(day) AS INTEGER) AS month,
           strftime(day, '%B') AS month_name, CAST(day(day) AS INTEGER) AS day,
           CAST(isodow(day) - 1 AS INTEGER) AS day_of_week, strftime(day, '%A') AS day_name,
           isodow(day) IN (6, 7) AS is_weekend
    FROM (SELECT unnest(generate_series(min(CAST(timestamp AS DATE)), max(CAST(timestamp AS DATE)), INTERVAL 1 DAY))
              AS day FROM fact)),
v_suspicious AS (
    SELECT f.transaction_id, f.timestamp, f.amount, f.category, v.vendor_name, f.vendor_id, f.user_orig_id,
           f.anomaly_score, f.risk_level, f.flag_reasons, f.flag_duplicate, f.flag_large_transaction,
           f.flag_unusual_timing, f.flag_vendor_spike, f.flag_velocity, f.flag_multivariate_outlier,
           f.flag_concentration, f.is_fraud_ground_truth
    FROM fact f LEFT JOIN dim_vendor v ON f.vendor_id = v.vendor_id WHERE f.is_flagged)
"""

STAR_ALL = FLAGGED_ALL + STAR[len(FLAGGED):]

_BLIND = """(25 * CAST(flag_duplicate AS INTEGER) + 20 * CAST(flag_large_transaction AS INTEGER)
                + 20 * CAST(flag_vendor_spike AS INTEGER) + 15 * CAST(flag_velocity AS INTEGER)
                + 10 * CAST(flag_unusual_timing AS INTEGER) + 10 * CAST(flag_concentration AS INTEGER))"""

# The same names as in STAR, scored without the fraud label.
HONEST = SIGNAL + f""",
fact AS (
    SELECT *, CASE WHEN anomaly_score >= 75 THEN 'CRITICAL' WHEN anomaly_score >= 45 THEN 'HIGH'
                   WHEN anomaly_score >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
    FROM (SELECT amount, isFraud AS is_fraud_ground_truth, {_BLIND} AS anomaly_score,
                 flag_duplicate OR {_BLIND} >= 35 AS is_flagged FROM signals)),
money AS (SELECT *, CAST(amount AS DECIMAL(18,2)) AS m FROM fact)
"""

_FLAG = "count(*) FILTER (is_flagged)"
_FLAG_VALUE = "CAST(coalesce(sum(m) FILTER (is_flagged), 0) AS DOUBLE)"
_PCT = f"round(100.0 * {_FLAG} / count(*), 2)"
_FRAUD = "is_fraud_ground_truth = 1"


def _ratio(a, b):
    return f"CASE WHEN {b} = 0 THEN CAST(0 AS DOUBLE) ELSE {a} / CAST({b} AS DOUBLE) END"


def _measures(by=None, source="money"):
    def n(condition):
        return f"count(*) FILTER ({condition})"

    key = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    value = "CAST(coalesce(sum(m), 0) AS DOUBLE)"
    tp = n(f"{_FRAUD} AND is_flagged")
    return f"""
    SELECT {key}count(*) AS total_transactions, round({value}, 6) AS total_value,
           round({value} / count(*), 6) AS avg_transaction_value, round(max(amount), 6) AS max_transaction_value,
           round(quantile_cont(amount, 0.5), 6) AS median_transaction_value,
           {_FLAG} AS flagged_transactions, round({_FLAG_VALUE}, 6) AS flagged_value,
           round({_ratio(_FLAG, "count(*)")}, 6) AS anomaly_ratio,
           round({_ratio(_FLAG_VALUE, value)}, 6) AS flagged_value_ratio,
           round(avg(anomaly_score), 6) AS avg_anomaly_score,
           {n("risk_level IN ('HIGH', 'CRITICAL')")} AS high_critical_txns,
           round(CAST(coalesce(sum(m) FILTER (risk_level = 'CRITICAL'), 0) AS DOUBLE), 6) AS critical_risk_value,
           {n("flag_duplicate")} AS duplicates_count, {n("flag_exact_duplicate")} AS exact_duplicates_count,
           {n("flag_near_duplicate")} AS near_duplicates_count,
           {n("flag_large_transaction")} AS large_transaction_count, {n("flag_vendor_spike")} AS vendor_spike_count,
           {n("flag_velocity")} AS velocity_burst_count, {n("flag_unusual_timing")} AS unusual_timing_count,
           {n("flag_multivariate_outlier")} AS multivariate_outlier_count,
           {n("flag_concentration")} AS high_concentration_count, {n(_FRAUD)} AS ground_truth_fraud_count,
           {tp} AS true_positives, {n(f"{_FRAUD} AND NOT is_flagged")} AS false_negatives,
           {n("is_fraud_ground_truth = 0 AND is_flagged")} AS false_positives,
           round({_ratio(tp, n(_FRAUD))}, 6) AS recall, round({_ratio(tp, _FLAG)}, 6) AS precision
    FROM {source} {group}"""


def _profile():
    types = {
        "step": "bigint", "type": "string", "amount": "double", "nameOrig": "string", "oldbalanceOrg": "double",
        "newbalanceOrig": "double", "nameDest": "string", "oldbalanceDest": "double", "newbalanceDest": "double",
        "isFraud": "int", "isFlaggedFraud": "int"}
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) - count("{c}") AS n_missing,
            round_even(100.0 * (count(*) - count("{c}")) / count(*) * 1000, 0) / 1000 AS pct_missing,
            count(DISTINCT "{c}") AS n_unique FROM txn""" for c, t in types.items())


_SAMPLE = RAW + """,
placed AS (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS place FROM txn),
normal AS (
    SELECT *, md5(CAST(place AS VARCHAR) || '-42') AS h FROM placed WHERE isFraud = 0),
capped AS (
    SELECT * FROM normal
    QUALIFY row_number() OVER (PARTITION BY place // 5000 ORDER BY h, row_id) <= 800),
sample AS (
    SELECT row_id, isFraud, amount, nameOrig FROM txn WHERE isFraud = 1
    UNION ALL (SELECT row_id, isFraud, amount, nameOrig FROM capped ORDER BY h, row_id LIMIT 20000))
"""


def _bins(source, value, bins, by="", name="transactions"):
    key = f", {by}" if by else ""
    return f"""
    bounds AS (SELECT CAST(min({value}) AS DOUBLE) AS lo, CAST(max({value}) AS DOUBLE) AS hi FROM {source})
    SELECT bin{key}, count(*) AS {name}, round(any_value(lo + bin * width), 6) AS bin_start
    FROM (SELECT *, (hi - lo) / {bins} AS width,
                 least(CAST(floor(({value} - lo) / ((hi - lo) / {bins})) AS BIGINT), {bins - 1}) AS bin
          FROM {source}, bounds WHERE {value} IS NOT NULL)
    GROUP BY ALL"""


_SWEEP = f""",
cutoffs_0_100 AS (SELECT CAST(t AS INTEGER) AS threshold FROM range(101) AS r(t)),
sweep AS (
    SELECT threshold, count(*) FILTER ({_FRAUD} AND anomaly_score >= threshold) AS true_positives,
           count(*) FILTER (NOT {_FRAUD} AND anomaly_score >= threshold) AS false_positives,
           count(*) FILTER ({_FRAUD} AND anomaly_score < threshold) AS false_negatives,
           CAST(coalesce(sum(m) FILTER ({_FRAUD} AND anomaly_score < threshold), 0) AS DOUBLE) AS missed
    FROM cutoffs_0_100, money GROUP BY threshold)
"""


def _scaled():
    columns = ["amount", "hour_of_day", "step", "balance_delta_orig"]
    stats = ", ".join(
        f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS {c}_a, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}_b, "
        f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS {c}_c" for c in columns)
    out = ", ".join(
        f"round(({c} - {c}_b) / CASE WHEN {c}_c = {c}_a THEN 1 ELSE {c}_c - {c}_a END, 4) AS {c}_scaled" for c in columns)
    return CLEAN + f""",
    features AS (
        SELECT row_id, amount, hour_of_day, step, oldbalanceOrg - newbalanceOrig AS balance_delta_orig FROM clean),
    stats AS (SELECT {stats} FROM features)
    SELECT row_id, {out} FROM features, stats"""


def _color():
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in RISK_COLORS.items())
    return f"CASE risk_level {cases} ELSE '{OTHER_COLOR}' END"


def _action():
    cases = " ".join(f"WHEN anomaly_score >= {floor} THEN {_text(name)}" for floor, name in ACTION_TIERS)
    return f"CASE {cases} END"


def _view():
    return RAW + """,
    base AS (
        SELECT row_id, step, upper(trim(type)) AS category, round(amount, 2) AS amount, nameOrig AS user_orig_id,
               oldbalanceOrg AS old_balance_orig, newbalanceOrig AS new_balance_orig, nameDest AS vendor_id,
               oldbalanceDest AS old_balance_dest, newbalanceDest AS new_balance_dest,
               isFraud AS is_fraud_ground_truth, isFlaggedFraud AS is_flagged_fraud_system
        FROM txn WHERE amount IS NOT NULL AND amount >= 0),
    view_rows AS (
        SELECT row_id, step, TIMESTAMP '2024-01-01' + to_hours(CAST(step AS INTEGER)) AS transaction_timestamp,
               step % 24 AS hour_of_day, step // 24 % 7 AS day_of_week_num,
               CAST(step % 24 BETWEEN 1 AND 5 AS INTEGER) AS is_night,
               CAST(step // 24 % 7 IN (5, 6) AS INTEGER) AS is_weekend, category, amount, user_orig_id,
               old_balance_orig, new_balance_orig,
               CASE WHEN abs((old_balance_orig - amount) - new_balance_orig) > 1 THEN 1 ELSE 0 END
                   AS is_balance_inconsistent,
               vendor_id, CAST(vendor_id ILIKE 'M%' AS INTEGER) AS is_merchant_dest, old_balance_dest,
               new_balance_dest, is_fraud_ground_truth, is_flagged_fraud_system,
               CAST(count(*) OVER (PARTITION BY step, category, amount, user_orig_id, vendor_id) > 1 AS INTEGER)
                   AS flag_exact_duplicate,
               CAST(coalesce(step - lag(step) OVER (
                   PARTITION BY user_orig_id, vendor_id, amount ORDER BY step, row_id) <= 1, FALSE) AS INTEGER)
                   AS flag_near_duplicate
        FROM base)
    """


def _texts():
    out = {}

    def add(name, ctes, body):
        out[name] = f"WITH RECURSIVE {ctes.strip()} {body}" if _FOREST in ctes else f"WITH {ctes.strip()} {body}"

    def both(name, more, body):
        """The evaluation with the label in the score, and without it."""
        add(name, STAR + more, body)
        add(f"honest_{name}", HONEST + more, body)

    raw_list = """row_id, step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest, oldbalanceDest,
        newbalanceDest, isFraud, isFlaggedFraud"""
    add("raw_transactions", RAW, f"SELECT {raw_list} FROM txn")
    add("scan_transactions", RAW, f"SELECT {raw_list} FROM txn")
    add("scan_by_suffix", RAW, """
        SELECT f AS format, count(*) AS rows, CAST(sum(row_id) AS BIGINT) AS id_sum
        FROM txn, (VALUES ('parquet'), ('csv')) AS v(f) GROUP BY f""")
    spoilt = RAW + """,
spoilt AS (
    SELECT *, CASE WHEN row_id % 37 = 0 THEN '$' || printf('%.2f', amount)
                   WHEN row_id % 41 = 0 THEN format('{:,.2f}', amount)
                   WHEN row_id % 43 = 0 THEN 'N/A' ELSE printf('%.2f', amount) END AS amount_text,
           CASE WHEN row_id % 5 = 0 THEN step || '.0' WHEN row_id % 53 = 0 THEN step || '.5'
                ELSE CAST(step AS VARCHAR) END AS step_text,
           CASE WHEN row_id % 3 = 0 THEN CASE WHEN isFraud = 1 THEN 'True' ELSE 'False' END WHEN row_id % 59 = 0 THEN 'yes'
                ELSE CAST(isFraud AS VARCHAR) END AS label_text
    FROM txn),
judged AS (
    SELECT *, concat_ws(',', CASE WHEN step_text LIKE '%.5' THEN 'step' END,
               CASE WHEN amount_text LIKE '$%' OR amount_text LIKE '%,%' THEN 'amount' END,
               CASE WHEN label_text = 'yes' THEN 'isFraud' END) AS unreadable
    FROM spoilt)
"""
    add("rejected_rows", spoilt, """
        SELECT row_id, unreadable, amount_text, step_text, label_text FROM judged WHERE unreadable <> ''""")
    add("load_audit", spoilt, """
        SELECT count(*) FILTER (unreadable = '') AS rows_read, count(*) FILTER (unreadable <> '') AS rows_rejected,
               count(*) FILTER (unreadable = '' AND (amount IS NULL OR amount_text = 'N/A')) AS rows_without_amount,
               CAST(sum(step) FILTER (unreadable = '') AS BIGINT) AS step_sum,
               count(*) FILTER (unreadable = '' AND isFraud = 1) AS fraud_rows,
               CAST(sum(CAST(amount AS DECIMAL(18,2))) FILTER (unreadable = '' AND amount_text <> 'N/A') AS DOUBLE) AS amount_sum
        FROM judged""")
    add("write_roundtrip", CLEAN, """
        SELECT row_id, step, category, amount, vendor_id, timestamp, is_night, is_near_duplicate FROM clean""")
    add("warehouse_load", STAR, """
        SELECT 'fact_transactions' AS table_name, count(*) AS rows FROM fact
        UNION ALL SELECT 'dim_vendor', count(*) FROM dim_vendor
        UNION ALL SELECT 'dim_category', count(*) FROM dim_category
        UNION ALL SELECT 'dim_date', count(*) FROM dim_date
        UNION ALL SELECT 'data_quality_summary', 1""")
    add("dq_summary_table", CLEAN, "SELECT 'Completed' AS status, count(*) AS records_evaluated FROM clean")
    money = ["amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]
    cast = {c: f"CAST({c} AS DECIMAL(18,2)) AS {c}" for c in money} | {"step": "CAST(step AS INTEGER) AS step"}
    add("staging_cast", RAW, "SELECT " + ", ".join(
        cast.get(c.strip(), c.strip()) for c in raw_list.split(",")) + " FROM txn")
    add("stratified_sample", _SAMPLE, "SELECT * FROM sample")
    add("sample_shuffled", _SAMPLE, """
        SELECT row_id, isFraud, amount, row_number() OVER (
                   ORDER BY md5('shuffle-' || CAST(row_id AS VARCHAR) || '-42'), row_id) - 1 AS position
        FROM sample""")
    add("sample_summary", _SAMPLE, """
        SELECT count(*) AS total_records, count(*) FILTER (isFraud = 1) AS fraud_records,
               count(*) FILTER (isFraud = 0) AS normal_records FROM sample""")

    add("column_profile", RAW, _profile())
    add("dq_checks", RAW, """
        SELECT count(*) FILTER (amount < 0) AS negative_amounts, count(*) FILTER (amount = 0) AS zero_amounts,
               count(*) FILTER (abs(oldbalanceOrg - amount - newbalanceOrig) > 1) AS balance_mismatches FROM txn""")
    add("drop_missing_amount", RAW, "SELECT row_id, amount FROM txn WHERE amount IS NOT NULL")
    add("missing_flags", RAW, """
        SELECT row_id, amount IS NULL AS is_missing_amount, oldbalanceOrg IS NULL AS is_missing_orig_balance FROM txn""")
    add("impute_median", CLEAN, "SELECT row_id, oldbalanceOrg, oldbalanceDest, newbalanceOrig FROM clean")
    add("normalize_category", RAW, "SELECT row_id, upper(trim(type)) AS type FROM txn")
    add("step_to_timestamp", RAW, """
        SELECT row_id, step, TIMESTAMP '2024-01-01' + to_hours(CAST(step AS INTEGER)) AS timestamp FROM txn""")
    add("temporal_features", RAW, """
        SELECT row_id, CAST(step % 24 AS INTEGER) AS hour_of_day, CAST(step // 24 % 7 AS INTEGER) AS day_of_week,
               step // 24 % 7 IN (5, 6) AS is_weekend, step % 24 BETWEEN 1 AND 5 AS is_night FROM txn""")
    add("merchant_predicate", RAW, """
        SELECT row_id, nameDest AS vendor_id, nameDest LIKE 'M%' AS is_merchant_dest FROM txn""")
    add("balance_inconsistency", RAW, """
        SELECT row_id, CASE WHEN abs((oldbalanceOrg - amount) - newbalanceOrig) > 1 THEN 1 ELSE 0 END
                   AS is_balance_inconsistent FROM txn""")
    add("exact_duplicates_raw", CLEAN, "SELECT row_id, is_exact_duplicate FROM clean")
    add("near_duplicates_clean", CLEAN, "SELECT row_id, is_near_duplicate FROM clean")
    add("clean_transactions", CLEAN, f"SELECT {FLAGGED_LIST} FROM clean")
    add("clean_transactions_view", _view(), "SELECT * FROM view_rows")
    add("exact_dupe_all_copies", _view(), "SELECT row_id, flag_exact_duplicate FROM view_rows")

    for name in ("flag_large_transaction", "flag_unusual_timing", "flag_vendor_spike", "flag_velocity"):
        add(name, SIGNAL, f"SELECT row_id, {name} FROM signals")
    add("exact_duplicates", SIGNAL, "SELECT row_id, flag_exact_duplicate FROM signals")
    add("near_duplicates", SIGNAL, "SELECT row_id, flag_near_duplicate FROM signals")
    add("flag_duplicate", SIGNAL,
        "SELECT row_id, flag_exact_duplicate, flag_near_duplicate, flag_duplicate FROM signals")
    add("category_cutoffs", SIGNAL, """
        SELECT category, n, round(q25, 6) AS q25, round(q75, 6) AS q75, round(cutoff, 6) AS cutoff FROM cutoffs""")
    add("active_vendors_semi", SIGNAL, "SELECT row_id, vendor_id FROM clean SEMI JOIN hours USING (vendor_id)")
    add("vendor_hour_profile", SIGNAL,
        "SELECT vendor_id, n, round(p05, 4) AS p05, round(p95, 4) AS p95 FROM hours")
    add("vendor_hours_join", SIGNAL, """
        SELECT row_id, hour_of_day, round(p05, 4) AS p05, round(p95, 4) AS p95
        FROM clean LEFT JOIN hours USING (vendor_id)""")
    add("vendor_daily", SIGNAL, "SELECT vendor_id, day_bucket, daily_count, daily_volume FROM daily")
    add("vendor_rolling_baseline", SIGNAL, """
        SELECT vendor_id, day_bucket, daily_count, round(rolling_count_mean, 6) AS rolling_count_mean,
               round(rolling_count_std, 6) AS rolling_count_std, is_vendor_spike_day FROM baseline""")
    add("vendor_spike", SIGNAL,
        "SELECT vendor_id, day_bucket, daily_count FROM baseline WHERE is_vendor_spike_day")
    add("velocity", SIGNAL, "SELECT row_id, nameOrig, step FROM signals WHERE flag_velocity")
    add("user_vendor_share", SIGNAL, """
        SELECT nameOrig, vendor_id, vendor_amount, round(share, 6) AS share FROM shares""")
    add("user_hhi", SIGNAL, """
        SELECT nameOrig, txn_count, total_user_amount, round(hhi, 6) AS hhi, concentrated FROM hhi""")
    add("concentration", SIGNAL, "SELECT row_id, nameOrig, user_hhi FROM signals WHERE flag_concentration")
    add("flag_concentration", SIGNAL, "SELECT row_id, user_hhi, flag_concentration FROM signals")
    out["robust_scale"] = "WITH " + _scaled().strip()
    for name in ("anomaly_score", "flag_reasons", "is_flagged", "risk_level"):
        add(name, FLAGGED, f"SELECT row_id, {name} FROM flagged")
    every_column = f"SELECT {FLAGGED_LIST}, {SIGNAL_LIST}, flag_reasons, is_flagged, risk_level FROM flagged"
    add("anomaly_pipeline_rules", FLAGGED, every_column)
    add("anomaly_pipeline", FLAGGED_ALL, every_column)
    add("flag_multivariate_outlier", FLAGGED_ALL, "SELECT row_id, flag_multivariate_outlier FROM flagged")
    summary = f"""
        SELECT count(*) AS total_transactions, {_FLAG} AS flagged_transactions,
               100.0 * {_FLAG} / count(*) AS flagged_pct,
               count(*) FILTER (risk_level IN ('HIGH', 'CRITICAL')) AS high_critical_transactions FROM flagged"""
    add("pipeline_summary", FLAGGED, summary)
    add("pipeline_summary_with_forest", FLAGGED_ALL, summary)

    add("dim_category", STAR, "SELECT * FROM dim_category")
    add("dim_vendor", STAR,
        "SELECT * REPLACE (round(avg_transaction_amount, 6) AS avg_transaction_amount) FROM dim_vendor")
    add("vendor_names", STAR, "SELECT vendor_id, vendor_name FROM dim_vendor")
    add("dim_date", STAR, "SELECT * FROM dim_date")
    add("fact_transactions", STAR, "SELECT * FROM fact")
    add("transaction_ids", FLAGGED, """
        SELECT row_id, row_number, 'TXN_' || CASE WHEN row_number < 10000000
                   THEN right('0000000' || row_number, 8) ELSE CAST(row_number AS VARCHAR) END AS transaction_id
        FROM flagged""")
    add("star_join", STAR, """
        SELECT transaction_id, amount, full_date, day_name, category_name, category_risk_profile, vendor_name,
               vendor_risk_tier
        FROM fact LEFT JOIN dim_date USING (date_key) LEFT JOIN dim_category ON category = category_id
             LEFT JOIN dim_vendor USING (vendor_id)""")

    for name, ctes in (("suspicious_transactions", STAR), ("suspicious_transactions_with_forest", STAR_ALL)):
        add(name, ctes, "SELECT * FROM v_suspicious ORDER BY anomaly_score DESC, transaction_id")
    vendor_risk = """
        SELECT vendor_id, vendor_name, vendor_risk_tier, total_transactions, total_volume,
               avg_transaction_amount AS avg_transaction_size, flagged_count AS flagged_transaction_count,
               flagged_rate_pct AS flagged_ratio_pct
        FROM dim_vendor ORDER BY flagged_count DESC, total_volume DESC, vendor_id"""
    add("vendor_risk_summary", STAR, vendor_risk)
    add("daily_audit_trend", STAR, f"""
        SELECT d.date_key, d.full_date, d.day_name, d.is_weekend, count(*) AS total_txns,
               CAST(sum(m) AS DOUBLE) AS total_value, {_FLAG} AS flagged_txns, {_FLAG_VALUE} AS flagged_value,
               {_PCT} AS anomaly_pct
        FROM dim_date d JOIN money f ON d.date_key = f.date_key GROUP BY ALL ORDER BY d.date_key""")
    category_risk = f"""
        SELECT category_id, category_name, category_risk_profile, count(*) AS txn_count,
               CAST(sum(m) AS DOUBLE) AS total_amount, round(CAST(sum(m) AS DOUBLE) / count(*), 2) AS avg_amount,
               max(amount) AS max_amount, {_FLAG} AS flagged_count, {_PCT} AS flagged_rate_pct
        FROM dim_category JOIN money ON category_id = category GROUP BY ALL"""
    add("category_risk_breakdown", STAR, category_risk + " ORDER BY total_amount DESC, category_id")
    add("top_suspicious_vendors", STAR, f"""
        SELECT vendor_name, vendor_risk_tier, count(*) AS total_txns, round(CAST(sum(m) AS DOUBLE), 2) AS total_volume,
               {_FLAG} AS flagged_count, {_PCT} AS flagged_pct
        FROM dim_vendor JOIN money USING (vendor_id) GROUP BY ALL HAVING count(*) >= 10
        ORDER BY flagged_count DESC, flagged_pct DESC, vendor_name, vendor_risk_tier LIMIT 10""")
    add("daily_trend", STAR, f"""
        SELECT full_date, count(*) AS total_txns, {_FLAG} AS flagged_txns, round({_FLAG_VALUE}, 2) AS flagged_volume
        FROM dim_date JOIN money USING (date_key) GROUP BY full_date ORDER BY full_date""")
    add("suspicious_top5", STAR, """
        SELECT transaction_id, vendor_name, amount, anomaly_score, risk_level, flag_reasons
        FROM v_suspicious ORDER BY anomaly_score DESC, transaction_id LIMIT 5""")
    add("vendors_top5", STAR, f"""
        SELECT vendor_name, total_transactions, total_volume, flagged_transaction_count, flagged_ratio_pct
        FROM ({vendor_risk} LIMIT 5)""")
    add("categories_smoke", STAR, f"""
        SELECT category_name, txn_count, total_amount, flagged_count, flagged_rate_pct FROM ({category_risk})""")
    add("drill_through", STAR, """
        SELECT transaction_id, timestamp, vendor_name, category, amount, anomaly_score, risk_level, flag_reasons
        FROM v_suspicious""")
    add("top15_vendors_flagged_value", STAR, f"""
        SELECT vendor_id, vendor_name, {_FLAG_VALUE} AS flagged_value, CAST({_FLAG} AS DOUBLE) / count(*) AS anomaly_ratio
        FROM dim_vendor JOIN money USING (vendor_id) GROUP BY ALL ORDER BY flagged_value DESC, vendor_id LIMIT 15""")
    add("duplicate_detail", STAR, """
        SELECT user_orig_id, vendor_id, amount, timestamp, flag_exact_duplicate, flag_near_duplicate
        FROM fact WHERE flag_duplicate""")
    add("outlier_scatter", STAR, "SELECT timestamp, amount, is_flagged, anomaly_score FROM fact")
    add("vendor_scatter", STAR, """
        SELECT vendor_id, total_transactions, flagged_rate_pct, total_volume, vendor_risk_tier FROM dim_vendor""")
    add("hourly_profile", STAR, f"""
        SELECT hour_of_day, count(*) AS total_transactions, {_FLAG} AS flagged_transactions,
               hour_of_day BETWEEN 1 AND 5 AS off_hours FROM fact GROUP BY hour_of_day""")
    add("risk_distribution", STAR, f"""
        SELECT risk_level, count(*) AS transactions, {_FLAG_VALUE} AS flagged_value FROM money GROUP BY risk_level""")
    add("daily_overlay", STAR, f"""
        SELECT full_date, count(*) AS total_transactions, CAST({_FLAG} AS DOUBLE) / count(*) AS anomaly_ratio,
               {_FLAG_VALUE} AS flagged_value,
               CAST(coalesce(sum(m) FILTER (risk_level = 'CRITICAL'), 0) AS DOUBLE) AS critical_risk_value
        FROM dim_date JOIN money USING (date_key) GROUP BY full_date""")
    add("category_treemap", STAR, """
        SELECT category_name, category_risk_profile, CAST(sum(m) AS DOUBLE) AS total_amount, count(*) AS txn_count
        FROM dim_category JOIN money ON category_id = category GROUP BY ALL""")
    add("slicer_filters", STAR, """
        SELECT transaction_id, amount, category, risk_level, hour_of_day
        FROM fact JOIN dim_date d USING (date_key) JOIN dim_category ON category = category_id
             JOIN dim_vendor USING (vendor_id)
        WHERE full_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
          AND category_name IN ('Wire & P2P Transfer', 'Cash Withdrawal')
          AND risk_level IN ('HIGH', 'CRITICAL', 'MEDIUM')
          AND vendor_risk_tier IN ('MEDIUM_RISK', 'HIGH_RISK', 'STANDARD') AND lower(vendor_name) LIKE '%a%'
          AND hour_of_day BETWEEN 0 AND 20 AND NOT d.is_weekend""")
    add("saved_weekend_days", STAR, f"""
        SELECT date_key, count(*) AS transactions, {_FLAG} AS flagged FROM fact JOIN dim_date d USING (date_key)
        WHERE full_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' AND d.is_weekend GROUP BY date_key""")
    add("risk_color", STAR, f"SELECT transaction_id, {_color()} AS risk_color FROM fact")
    add("vendor_risk_status", STAR, """
        SELECT 'Vendor Risk Profile: ' || CASE WHEN count(DISTINCT vendor_risk_tier) = 1 THEN max(vendor_risk_tier)
                   ELSE 'Multiple Vendors' END AS vendor_risk_status FROM dim_vendor""")
    add("kpi_cards", STAR, _measures())
    add("measures_in_one_pass", STAR + """,
        tiered AS (SELECT * FROM money JOIN (SELECT vendor_id, vendor_risk_tier FROM dim_vendor) USING (vendor_id)),
        cards AS (""" + _measures() + "), " + ", ".join(
            f"{cte} AS ({_measures(by, 'tiered')})" for cte, by in (
                ("by_category", "category"), ("by_level", "risk_level"), ("by_tier", "vendor_risk_tier"),
                ("by_both", "category, risk_level"))), """
        SELECT 'all' AS "grouping", NULL::VARCHAR AS category, NULL::VARCHAR AS risk_level, NULL::VARCHAR AS vendor_risk_tier, *
        FROM cards
        UNION ALL BY NAME SELECT 'category' AS "grouping", * FROM by_category
        UNION ALL BY NAME SELECT 'risk_level' AS "grouping", * FROM by_level
        UNION ALL BY NAME SELECT 'vendor_risk_tier' AS "grouping", * FROM by_tier
        UNION ALL BY NAME SELECT 'category and risk_level' AS "grouping", * FROM by_both""")
    add("kpi_cards_with_forest", STAR_ALL, _measures())
    add("measures_by_category", STAR, _measures("category"))
    add("measures_by_risk_level", STAR, _measures("risk_level"))
    add("measures_by_risk_tier", STAR, _measures(
        "vendor_risk_tier", "money JOIN (SELECT vendor_id, vendor_risk_tier FROM dim_vendor) USING (vendor_id)"))

    for name, ctes in (("signal_breakdown", STAR), ("signal_breakdown_with_forest", STAR_ALL)):
        add(name, ctes, " UNION ALL ".join(
            f"SELECT '{c}' AS signal, count(*) FILTER ({c}) AS incidents FROM fact" for c in SIGNALS))
    for name, ctes in (("score_histogram", STAR), ("honest_score_histogram", HONEST)):
        out[name] = f"WITH {ctes.strip()}, " + _bins("fact", "anomaly_score", 30, "risk_level").strip()
    out["hhi_histogram"] = f"WITH {SIGNAL.strip()}, " + _bins("hhi", "hhi", 20, name="users").strip()

    def cells(source, label):
        return " UNION ALL ".join(
            f"""SELECT 'Actual {a}' AS actual, 'Predicted {p}' AS predicted,
                count(*) FILTER ({'' if a == 'Fraud' else 'NOT '}({label} = 1)
                    AND {'' if p == 'Flagged' else 'NOT '}is_flagged) AS transactions FROM {source}"""
            for a in ("Clean", "Fraud") for p in ("Clean", "Flagged"))

    add("confusion_matrix", STAR, cells("fact", "is_fraud_ground_truth"))
    add("honest_confusion_matrix", SIGNAL + """,
        blind AS (
            SELECT isFraud, flag_duplicate OR 25 * CAST(flag_duplicate AS INTEGER)
                + 20 * CAST(flag_large_transaction AS INTEGER) + 20 * CAST(flag_vendor_spike AS INTEGER)
                + 15 * CAST(flag_velocity AS INTEGER) + 10 * CAST(flag_unusual_timing AS INTEGER)
                + 10 * CAST(flag_concentration AS INTEGER) >= 35 AS is_flagged FROM signals)""",
        cells("blind", "isFraud"))
    add("classification_report", STAR + f""",
        n AS (SELECT CAST(count(*) FILTER (NOT {_FRAUD} AND NOT is_flagged) AS DOUBLE) AS tn,
                     CAST(count(*) FILTER (NOT {_FRAUD} AND is_flagged) AS DOUBLE) AS fp,
                     CAST(count(*) FILTER ({_FRAUD} AND NOT is_flagged) AS DOUBLE) AS fn,
                     CAST(count(*) FILTER ({_FRAUD} AND is_flagged) AS DOUBLE) AS tp FROM fact),
        s AS (SELECT *, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fn + fp) AS f0,
                     tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fp + fn) AS f1,
                     tn + fp AS c0, tp + fn AS c1, tn + fp + fn + tp AS c FROM n)""", """
        SELECT class, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
               CAST(support AS BIGINT) AS support
        FROM (SELECT 'Normal' AS class, p0 AS "precision", r0 AS recall, f0 AS f1_score, c0 AS support FROM s
              UNION ALL SELECT 'Fraud / Anomaly', p1, r1, f1, c1 FROM s
              UNION ALL SELECT 'accuracy', NULL, NULL, (tn + tp) / c, c FROM s
              UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, c FROM s
              UNION ALL SELECT 'weighted avg', (p0 * c0 + p1 * c1) / c, (r0 * c0 + r1 * c1) / c,
                               (f0 * c0 + f1 * c1) / c, c FROM s)""")
    add("total_cost", STAR, f"""
        SELECT false_negatives, false_positives, missed_amount, missed_amount AS cost_fn,
               false_positives * 25.0::DOUBLE AS cost_fp, missed_amount + false_positives * 25.0::DOUBLE AS total_cost
        FROM (SELECT count(*) FILTER ({_FRAUD} AND NOT is_flagged) AS false_negatives,
                     count(*) FILTER (NOT {_FRAUD} AND is_flagged) AS false_positives,
                     CAST(coalesce(sum(m) FILTER ({_FRAUD} AND NOT is_flagged), 0) AS DOUBLE) AS missed_amount
              FROM money)""")
    both("threshold_sweep", _SWEEP, """
        SELECT threshold, true_positives, false_positives, false_negatives,
               missed + false_positives * 25.0::DOUBLE AS total_cost FROM sweep""")
    both("precision_recall_curve", _SWEEP, f"""
        SELECT threshold,
               round({_ratio("true_positives", "(true_positives + false_positives)")}, 6) AS "precision",
               round({_ratio("true_positives", "(true_positives + false_negatives)")}, 6) AS recall FROM sweep""")
    add("action_tier", STAR, f"""
        SELECT {_action()} AS action, count(*) AS transactions, CAST(sum(m) AS DOUBLE) AS value
        FROM money GROUP BY action""")
    both("roc_auc", f""",
        s AS (SELECT anomaly_score, count(*) FILTER ({_FRAUD}) AS p, count(*) FILTER (NOT {_FRAUD}) AS n
              FROM fact GROUP BY anomaly_score)""", """
        SELECT round(sum(a.p * b.n * CASE WHEN a.anomaly_score > b.anomaly_score THEN 1.0::DOUBLE
                     WHEN a.anomaly_score = b.anomaly_score THEN 0.5 ELSE 0 END)
               / (CAST((SELECT sum(p) FROM s) AS DOUBLE) * (SELECT sum(n) FROM s)), 6) AS roc_auc,
               CAST((SELECT sum(p) FROM s) AS BIGINT) AS fraud, CAST((SELECT sum(n) FROM s) AS BIGINT) AS clean
        FROM s a, s b""")
    add("log_zscore", CLEAN + """,
        logs AS (SELECT row_id, category, ln(amount) AS l FROM clean WHERE amount > 0),
        spread AS (SELECT category, avg(l) AS mean, stddev_samp(l) AS std FROM logs GROUP BY category)""", """
        SELECT row_id, round((l - mean) / std, 6) AS log_z, coalesce((l - mean) / std > 3, FALSE) AS flag_log_outlier
        FROM logs JOIN spread USING (category)""")
    return out


ORACLE = _texts()
