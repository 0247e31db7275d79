"""The registered queries as DuckDB SQL, written from the rule definitions.

Windows and look-aheads are spelled out as self-joins here, so that they share nothing with the
way the Spark jobs find the same rows.
"""

from __future__ import annotations

_MAPPING = """
nations AS (
    SELECT n_nationkey, r_name FROM nation JOIN region ON r_regionkey = n_regionkey
),
raw_agents AS (
    SELECT 'AGT' || lpad(s_suppkey::VARCHAR, 5, '0') AS agent_id,
           s_name AS agent_name,
           r_name AS region,
           CASE WHEN s_acctbal >= 7500 THEN 'super_agent' ELSE 'standard' END AS tier,
           CAST(DATE '2024-01-01' - CAST(30 + s_suppkey % 871 AS INTEGER) AS DATE) AS registration_date,
           CAST(abs(s_acctbal) * 10 AS DECIMAL(14,2)) AS opening_cash_float,
           TIMESTAMP '2024-01-01 00:00:00' AS loaded_at
    FROM supplier JOIN nations ON n_nationkey = s_nationkey
),
raw_customers AS (
    SELECT 'CUS' || lpad(c_custkey::VARCHAR, 7, '0') AS customer_id,
           CASE WHEN c_custkey % 20 < 11 THEN 'tier_1' WHEN c_custkey % 20 < 18 THEN 'tier_2' ELSE 'tier_3' END AS kyc_tier,
           r_name AS home_region,
           CAST(DATE '2024-01-01' - CAST(1 + c_custkey % 1200 AS INTEGER) AS DATE) AS registration_date,
           TIMESTAMP '2024-01-01 00:00:00' AS loaded_at
    FROM customer JOIN nations ON n_nationkey = c_nationkey
),
sized AS (
    SELECT *,
           CASE WHEN user_id % 20 < 11 THEN 1000 WHEN user_id % 20 < 18 THEN 10000 ELSE 100000 END AS lim,
           CASE event_type WHEN 'click' THEN 'cash_in' WHEN 'purchase' THEN 'cash_out' WHEN 'view' THEN 'p2p_transfer'
                           WHEN 'signup' THEN 'bill_pay' WHEN 'error' THEN 'airtime_topup' END AS txn_type,
           CAST(json_extract_string(props, '$.k') AS INTEGER) >= 95 AS is_fraud
    FROM events
),
keyed AS (
    SELECT event_id,
           'TXN_' || lpad(event_id::VARCHAR, 10, '0') AS transaction_id,
           ts AS txn_timestamp,
           'CUS' || lpad(user_id::VARCHAR, 7, '0') AS customer_id,
           CASE WHEN txn_type IN ('cash_in', 'cash_out')
                THEN 'AGT' || lpad(((event_id * 31 + user_id) % (SELECT count(*) FROM supplier))::VARCHAR, 5, '0') END AS agent_id,
           CASE WHEN txn_type = 'p2p_transfer'
                THEN 'CUS' || lpad(((user_id + 1 + event_id) % (SELECT count(*) FROM customer))::VARCHAR, 7, '0') END AS counterparty_customer_id,
           txn_type,
           CAST(least(CAST(value AS DECIMAL(14,2)) * lim * CAST(0.02 AS DECIMAL(4,2)), lim) AS DECIMAL(14,2)) AS amount,
           is_fraud,
           CASE WHEN is_fraud
                THEN (['cycling', 'structuring', 'takeover', 'agent_imbalance', 'geo_impossible'])[CAST(event_id % 5 + 1 AS INTEGER)] END AS fraud_pattern
    FROM sized
),
labelled AS (
    SELECT keyed.*, coalesce(raw_agents.region, home_region) AS region
    FROM keyed LEFT JOIN raw_agents USING (agent_id) LEFT JOIN raw_customers USING (customer_id)
),
truth AS (SELECT transaction_id, is_fraud, fraud_pattern FROM labelled),
raw_transactions AS (
    SELECT transaction_id, txn_timestamp, customer_id, agent_id, counterparty_customer_id, txn_type, amount, region,
           txn_timestamp + INTERVAL 1 DAY AS loaded_at
    FROM labelled
    UNION ALL
    SELECT transaction_id, txn_timestamp, customer_id, agent_id, counterparty_customer_id, txn_type,
           CAST(0 AS DECIMAL(14,2)), region, txn_timestamp + INTERVAL 1 HOUR
    FROM labelled WHERE event_id % 50 = 0
),
agents_s AS (
    SELECT agent_id, agent_name, trim(region) AS region, tier, registration_date, opening_cash_float,
           CAST(DATE '2024-02-01' - registration_date AS INTEGER) AS agent_tenure_days
    FROM raw_agents
),
customers_s AS (
    SELECT customer_id, kyc_tier, trim(home_region) AS home_region, registration_date,
           CAST(DATE '2024-02-01' - registration_date AS INTEGER) AS account_age_days
    FROM raw_customers
),
txns AS MATERIALIZED (
    SELECT r.transaction_id, r.txn_timestamp, CAST(r.txn_timestamp AS DATE) AS txn_date,
           CAST(hour(r.txn_timestamp) AS INTEGER) AS txn_hour, r.customer_id, r.agent_id, r.counterparty_customer_id,
           r.txn_type, r.amount, r.region, CAST(floor(epoch(r.txn_timestamp)) AS BIGINT) AS sec
    FROM raw_transactions r
    JOIN (SELECT transaction_id, max(loaded_at) AS loaded_at FROM raw_transactions GROUP BY transaction_id) newest
      USING (transaction_id, loaded_at)
)"""


def _grade(metric: str, threshold: int) -> str:
    return f"CASE WHEN {metric} >= {2 * threshold} THEN 'high' WHEN {metric} >= {threshold} THEN 'medium' END"


def _window(name: str, source: str, pattern: str, inside: str, threshold: int) -> str:
    """Rows with at least `threshold` rows of the same customer in the window they open."""
    return f"""
{name} AS (
    SELECT a.transaction_id, a.customer_id, a.txn_timestamp, '{pattern}' AS fraud_pattern,
           count(*) AS rule_metric, {threshold} AS rule_threshold, {_grade('count(*)', threshold)} AS severity,
           CAST(sum(b.amount) AS DOUBLE) AS total_amount_in_window
    FROM {source} a JOIN {source} b ON b.customer_id = a.customer_id AND {inside}
    GROUP BY a.transaction_id, a.customer_id, a.txn_timestamp
    HAVING count(*) >= {threshold}
)"""


_SECONDS = "b.sec BETWEEN a.sec AND a.sec + {} * 60"
_MICROS = "b.txn_timestamp BETWEEN a.txn_timestamp AND a.txn_timestamp + INTERVAL {} MINUTE"

_VELOCITY = _window("velocity", "txns", "velocity_cycling", _SECONDS.format(720), 4)
_VELOCITY_US = _window("velocity", "txns", "velocity_cycling", _MICROS.format(720), 4)

_NEAR = """
near AS (
    SELECT transaction_id, customer_id, txn_timestamp, sec, amount, lim
    FROM txns
    JOIN (SELECT customer_id, CASE kyc_tier WHEN 'tier_1' THEN 1000 WHEN 'tier_2' THEN 10000 WHEN 'tier_3' THEN 100000 END AS lim
          FROM customers_s) USING (customer_id)
    WHERE txn_type = 'p2p_transfer' AND amount BETWEEN lim * CAST(0.80 AS DECIMAL(3,2)) AND lim
)"""
_STRUCTURING = _NEAR + "," + _window("structuring", "near", "structuring", _SECONDS.format(2880), 3)
_STRUCTURING_US = _NEAR + "," + _window("structuring", "near", "structuring", _MICROS.format(2880), 3)
_STRUCTURING_ANY = _NEAR + "," + _window("structuring", "near", "structuring", _MICROS.format(2880), 1)


def _geo(comes_after: str, order: str, condition: str, metric: str, high: str) -> str:
    return f"""
at_agents AS (SELECT * FROM txns WHERE agent_id IS NOT NULL),
moves AS (
    SELECT a.transaction_id AS from_id, a.customer_id, a.txn_timestamp AS from_ts, min({order}) AS nxt
    FROM at_agents a JOIN at_agents b ON b.customer_id = a.customer_id AND b.region <> a.region AND {comes_after}
    GROUP BY a.transaction_id, a.customer_id, a.txn_timestamp
),
gaps AS (
    SELECT nxt.id AS transaction_id, customer_id, nxt.ts AS txn_timestamp,
           epoch_us(nxt.ts) - epoch_us(from_ts) AS us
    FROM moves
),
geo AS (
    SELECT transaction_id, customer_id, txn_timestamp, 'geo_impossible' AS fraud_pattern, {metric} AS rule_metric,
           45 AS rule_threshold, CASE WHEN {high} THEN 'high' ELSE 'medium' END AS severity
    FROM gaps WHERE {condition}
)"""


_GEO = _geo(
    "b.txn_timestamp > a.txn_timestamp",
    "struct_pack(ts := b.txn_timestamp, id := b.transaction_id)",
    "us // 60000000 <= 45",
    "us // 60000000",
    "us // 60000000 <= 22",
)
_GEO_EXACT = _geo(
    "(b.txn_timestamp > a.txn_timestamp OR (b.txn_timestamp = a.txn_timestamp AND b.region > a.region))",
    "struct_pack(ts := b.txn_timestamp, region := b.region, id := b.transaction_id)",
    "us <= 45 * 60000000::BIGINT",
    "CAST(printf('%.1f', us / 60000000.0::DOUBLE) AS DOUBLE)",
    "us * 2 <= 45 * 60000000::BIGINT",
)

_DORMANT = """
gapped AS (
    SELECT transaction_id, customer_id, txn_timestamp,
           CAST(txn_date - lag(txn_date) OVER (PARTITION BY customer_id ORDER BY txn_timestamp, transaction_id) AS INTEGER) AS silent
    FROM txns
),
bursts AS (
    SELECT g.transaction_id, g.customer_id, g.txn_timestamp, g.silent, t.transaction_id AS member
    FROM gapped g JOIN txns t ON t.customer_id = g.customer_id
     AND t.txn_timestamp BETWEEN g.txn_timestamp AND g.txn_timestamp + INTERVAL 24 HOUR
    WHERE g.silent >= 2
),
dormant AS (
    SELECT transaction_id, customer_id, txn_timestamp, 'dormant_reactivation' AS fraud_pattern, silent AS rule_metric,
           2 AS rule_threshold, CASE WHEN silent >= 4 THEN 'high' ELSE 'medium' END AS severity
    FROM bursts
    JOIN (SELECT transaction_id FROM bursts GROUP BY transaction_id HAVING count(*) >= 5) USING (transaction_id)
)"""

_FLAG = "transaction_id, customer_id, txn_timestamp, fraud_pattern, severity"
_UNION = f"""
flags AS (
    SELECT {_FLAG} FROM velocity UNION ALL SELECT {_FLAG} FROM structuring
    UNION ALL SELECT {_FLAG} FROM geo UNION ALL SELECT {_FLAG} FROM dormant
)"""
_UNION_EXACT = f"""
flags AS (
    SELECT {_FLAG} FROM velocity UNION ALL SELECT {_FLAG} FROM structuring UNION ALL SELECT {_FLAG} FROM geo
)"""
_ALERTS = """
alerts AS (
    SELECT f.transaction_id, f.customer_id, f.txn_timestamp, f.fraud_pattern, f.severity, t.txn_type,
           CAST(t.amount AS DOUBLE) AS amount, t.region, t.agent_id, c.kyc_tier, c.account_age_days,
           'open' AS review_status, TIMESTAMP '2024-02-01 00:00:00' AS alert_created_at
    FROM flags f JOIN txns t ON t.transaction_id = f.transaction_id JOIN customers_s c ON c.customer_id = f.customer_id
)"""
_SUMMARY = """
summary AS (
    SELECT transaction_id, any_value(customer_id) AS customer_id, any_value(txn_timestamp) AS txn_timestamp,
           any_value(txn_type) AS txn_type, any_value(amount) AS amount, any_value(region) AS region,
           any_value(kyc_tier) AS kyc_tier, count(DISTINCT fraud_pattern) AS rules_tripped,
           array_to_string(list_sort(list_distinct(list(fraud_pattern))), ', ') AS fraud_patterns,
           CAST(CASE WHEN bool_or(severity = 'high') THEN 2 WHEN bool_or(severity = 'medium') THEN 1 ELSE 0 END AS INTEGER) AS max_severity_rank,
           CASE WHEN bool_or(severity = 'high') THEN 'high' WHEN bool_or(severity = 'medium') THEN 'medium' ELSE 'low' END AS max_severity,
           min(review_status) AS review_status
    FROM alerts GROUP BY transaction_id
)"""
_RULES = (_VELOCITY, _STRUCTURING, _GEO, _DORMANT, _UNION)
_QUEUE = (*_RULES, _ALERTS, _SUMMARY)
_ALERTS_EXACT = """
alerts AS (
    SELECT f.transaction_id, f.customer_id, f.txn_timestamp, f.fraud_pattern, f.severity, t.txn_type,
           CAST(t.amount AS DOUBLE) AS amount, t.region, NULL AS kyc_tier, 'open' AS review_status
    FROM flags f LEFT JOIN txns t ON t.transaction_id = f.transaction_id
)"""
_RULES_EXACT = (_VELOCITY_US, _STRUCTURING_US, _GEO_EXACT, _UNION_EXACT)
_QUEUE_EXACT = (*_RULES_EXACT, _ALERTS_EXACT, _SUMMARY)

_SCORED = """
scored AS (
    SELECT transaction_id, is_fraud, fraud_pattern, transaction_id IN (SELECT transaction_id FROM summary) AS hit FROM truth
),
totals AS (
    SELECT count(*) AS total_transactions, count(*) FILTER (is_fraud) AS total_actual_fraud,
           count(*) FILTER (hit) AS total_flagged, count(*) FILTER (is_fraud AND hit) AS true_positives,
           count(*) FILTER (NOT is_fraud AND hit) AS false_positives, count(*) FILTER (is_fraud AND NOT hit) AS false_negatives
    FROM scored
),
evaluation AS (
    SELECT *, round(true_positives / nullif(total_actual_fraud, 0), 4) AS recall,
           round(true_positives / nullif(total_flagged, 0), 4) AS "precision"
    FROM totals
)"""
_ZERO = """
evaluation_zero AS (
    SELECT * REPLACE (coalesce(recall, 0) AS recall, coalesce("precision", 0) AS "precision") FROM evaluation
)"""

# Cash per agent-day in whole cents, so that ratios can be rounded and compared exactly.
_CENTS = """
cents AS (
    SELECT agent_id, txn_date,
           CAST(coalesce(sum(amount) FILTER (txn_type = 'cash_in'), 0) * 100 AS HUGEINT) AS cin,
           CAST(coalesce(sum(amount) FILTER (txn_type = 'cash_out'), 0) * 100 AS HUGEINT) AS cout,
           count(*) AS total_txns,
           count(*) FILTER (txn_type IN ('cash_in', 'cash_out')) AS cash_txns,
           count(DISTINCT customer_id) AS unique_customers_served
    FROM txns WHERE agent_id IS NOT NULL GROUP BY agent_id, txn_date
)"""
_UNITS = "CAST({} AS DOUBLE) / 100"
_RATIO2 = "CASE WHEN cin <> 0 THEN CAST((200 * cout + cin) // (2 * cin) AS DOUBLE) / 100 END"
_RATIO = "(CAST(cout AS DOUBLE) / 100) / nullif(CAST(cin AS DOUBLE) / 100, 0)"
_GRADE = "CASE WHEN cin = 0 THEN {zero} WHEN cout >= 6 * cin THEN 'high' WHEN cout >= 3 * cin THEN 'medium' END"
_TILTED = "(cin = 0 OR cout >= 3 * cin)"


def _imbalance(zero: str) -> str:
    return f"""SELECT agent_id, txn_date, {_UNITS.format('cin')} AS cash_in_amount, {_UNITS.format('cout')} AS cash_out_amount,
       cash_txns AS total_txns, 'agent_imbalance' AS fraud_pattern, {_RATIO2} AS rule_metric,
       CAST(3 AS DOUBLE) AS rule_threshold, {_GRADE.format(zero=zero)} AS severity
FROM cents WHERE cash_txns > 0 AND {_TILTED}"""


_PIVOT = f"""SELECT agent_id, region, tier, txn_date, {_UNITS.format('cin')} AS cash_in, {_UNITS.format('cout')} AS cash_out,
       {_RATIO} AS ratio, {_GRADE.format(zero="'medium'")} AS severity
FROM cents LEFT JOIN (SELECT agent_id, region, tier FROM agents_s) USING (agent_id) WHERE {_TILTED}"""

_STG_TXN = """transaction_id, txn_timestamp, txn_date, txn_hour, customer_id, agent_id, counterparty_customer_id, txn_type,
       CAST(amount AS DOUBLE) AS amount, region"""
_AGENT = """agent_id, agent_name, region, tier, registration_date, CAST(opening_cash_float AS DOUBLE) AS opening_cash_float,
       agent_tenure_days"""
_FLAGGED = "transaction_id, customer_id, txn_timestamp, fraud_pattern, rule_metric, rule_threshold, severity"
_FCT = """
fct AS (
    SELECT t.transaction_id, t.txn_timestamp, t.txn_date, t.txn_hour, t.txn_type, CAST(t.amount AS DOUBLE) AS amount, t.region,
           t.customer_id, c.kyc_tier, c.account_age_days, t.agent_id, a.tier AS agent_tier, t.counterparty_customer_id
    FROM txns t LEFT JOIN customers_s c ON c.customer_id = t.customer_id LEFT JOIN agents_s a ON a.agent_id = t.agent_id
)"""

# Checked columns: relation as reported, CTE, key, other mandatory columns.
_CHECKED = (
    ("raw.agents", "raw_agents", "agent_id",
     ("agent_name", "region", "tier", "registration_date", "opening_cash_float", "loaded_at")),
    ("raw.customers", "raw_customers", "customer_id", ("kyc_tier", "home_region", "registration_date", "loaded_at")),
    ("raw.transactions", "raw_transactions", "transaction_id",
     ("txn_timestamp", "customer_id", "txn_type", "amount", "region", "loaded_at")),
    ("eval.fraud_ground_truth", "truth", "transaction_id", ("is_fraud",)),
    ("stg_agents", "agents_s", "agent_id", ()),
    ("stg_customers", "customers_s", "customer_id", ()),
    ("stg_transactions", "txns", "transaction_id", ("amount",)),
    ("dim_agents", "agents_s", "agent_id", ()),
    ("dim_customers", "customers_s", "customer_id", ()),
    ("fct_transactions", "fct", "transaction_id", ()),
)
_ACCEPTED = (
    ("stg_customers", "customers_s", "kyc_tier", "'tier_1', 'tier_2', 'tier_3'"),
    ("stg_transactions", "txns", "txn_type", "'cash_in', 'cash_out', 'p2p_transfer', 'bill_pay', 'airtime_topup'"),
)
_PARENTS = (
    ("customer_id", "raw_customers", "customer_id"),
    ("agent_id", "raw_agents", "agent_id"),
    ("counterparty_customer_id", "raw_customers", "customer_id"),
)


def _per_check(template: str, checks) -> str:
    return " UNION ALL ".join(template.format(*check) for check in checks)


_UNIQUE = _per_check(
    "SELECT '{0}' AS relation, '{2}' AS column_name, count(*) AS violations "
    "FROM (SELECT {2} FROM {1} WHERE {2} IS NOT NULL GROUP BY {2} HAVING count(*) > 1)",
    _CHECKED,
)
_NOT_NULL = _per_check(
    "SELECT '{0}' AS relation, '{2}' AS column_name, count(*) FILTER ({2} IS NULL) AS violations FROM {1}",
    [(r, t, c) for r, t, key, more in _CHECKED for c in (key, *more)],
)
_ACCEPTED_SQL = _per_check(
    "SELECT '{0}' AS relation, '{2}' AS column_name, count(*) FILTER ({2} NOT IN ({3})) AS violations FROM {1}",
    _ACCEPTED,
)
_FOREIGN = _per_check(
    "SELECT 'raw.transactions' AS relation, '{0}' AS column_name, count(*) AS violations FROM raw_transactions t "
    "WHERE t.{0} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {1} p WHERE p.{2} = t.{0})",
    _PARENTS,
)
_OFFENCE = "SELECT '{check}' AS check_name, {relation} AS relation, '{column}' AS column_name, CAST({column} AS VARCHAR) AS offending_value, count(*) AS row_count FROM {table} t WHERE {where} GROUP BY {column}{having}"


def _offences() -> str:
    parts = []
    for relation, table, key, more in _CHECKED:
        line = dict(relation=f"'{relation}'", table=table)
        parts.append(_OFFENCE.format(check="unique", column=key, where=f"{key} IS NOT NULL", having=" HAVING count(*) > 1", **line))
        for c in (key, *more):
            parts.append(_OFFENCE.format(check="not_null", column=c, where=f"{c} IS NULL", having="", **line))
    for relation, table, column, accepted in _ACCEPTED:
        parts.append(_OFFENCE.format(check="accepted_values", relation=f"'{relation}'", column=column, table=table,
                                     where=f"{column} NOT IN ({accepted})", having=""))
    for column, parent, key in _PARENTS:
        parts.append(_OFFENCE.format(check="foreign_key", relation="'raw.transactions'", column=column, table="raw_transactions",
                                     where=f"t.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = t.{column})", having=""))
    return " UNION ALL ".join(parts)


def _with(select: str, *steps: str) -> str:
    return "WITH " + ",".join((_MAPPING, *steps)) + "\n" + select


def _dashboard(rules: tuple, queue: tuple, order: str, suffix: str = "") -> dict[str, str]:
    found = {
        "fraud_rule_evaluation_zero": _with("SELECT * FROM evaluation_zero", *queue, _SCORED, _ZERO),
        "validation_metrics": _with(
            'SELECT recall, "precision", false_positives FROM evaluation_zero', *queue, _SCORED, _ZERO
        ),
        "recall_by_pattern": _with(
            """SELECT fraud_pattern, count(*) AS actual, count(*) FILTER (hit) AS caught,
       count(*) FILTER (hit) / CAST(count(*) AS DOUBLE) AS recall
FROM scored WHERE is_fraud GROUP BY fraud_pattern""",
            *queue, _SCORED,
        ),
        "kpis": _with(
            f"""SELECT (SELECT count(*) FROM txns) AS total_transactions, (SELECT count(*) FROM summary) AS flagged_transactions,
       (SELECT count(*) FROM summary) / CAST((SELECT count(*) FROM txns) AS DOUBLE) AS flag_rate,
       (SELECT count(*) FROM cents WHERE {_TILTED}) AS agent_imbalance_alerts""",
            *queue, _CENTS,
        ),
        "alert_queue_top200": _with(
            f"""SELECT transaction_id, txn_timestamp, customer_id, txn_type, amount, region, rules_tripped, fraud_patterns
FROM summary ORDER BY {order}, transaction_id LIMIT 200""",
            *queue,
        ),
        "alerts_by_rule": _with("SELECT fraud_pattern, count(*) AS alert_count FROM flags GROUP BY fraud_pattern", *rules),
    }
    return {f"{name}{suffix}": sql for name, sql in found.items()}


def statements() -> dict[str, str]:
    return {
        "stg_agents": _with(f"SELECT {_AGENT} FROM agents_s"),
        "stg_customers": _with("SELECT * FROM customers_s"),
        "stg_transactions": _with(f"SELECT {_STG_TXN} FROM txns"),
        "load_agents": _with(
            "SELECT * REPLACE (CAST(opening_cash_float AS DOUBLE) AS opening_cash_float, "
            "TIMESTAMP '2024-02-01 00:00:00' AS loaded_at) FROM raw_agents"
        ),
        "load_customers": _with("SELECT * REPLACE (TIMESTAMP '2024-02-01 00:00:00' AS loaded_at) FROM raw_customers"),
        "load_transactions": _with(
            "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at) "
            "FROM raw_transactions"
        ),
        "load_ground_truth": _with("SELECT * FROM truth"),
        "load_transactions_that_fit": _with(
            "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at) "
            "FROM raw_transactions WHERE CAST(substr(transaction_id, 5) AS BIGINT) % 97 > 0"
        ),
        "load_rejected_lines": _with(
            "SELECT 'raw.transactions' AS relation, concat(transaction_id, ',', "
            "CASE WHEN CAST(substr(transaction_id, 5) AS BIGINT) % 194 = 97 THEN 'about ' END, "
            "strftime(txn_timestamp, '%Y-%m-%dT%H:%M:%S.%f'), ',', customer_id, ',', agent_id, ',', "
            "counterparty_customer_id, ',', txn_type, ',', CAST(amount AS VARCHAR), "
            "CASE WHEN CAST(substr(transaction_id, 5) AS BIGINT) % 194 = 0 THEN ' F' END, ',', region) AS line "
            "FROM raw_transactions WHERE CAST(substr(transaction_id, 5) AS BIGINT) % 97 = 0"
        ),
        "stg_agents_view": _with(f"SELECT {_AGENT} FROM agents_s"),
        "label_split_feed": _with(
            "SELECT transaction_id, txn_timestamp, customer_id, agent_id, counterparty_customer_id, txn_type, "
            "CAST(amount AS DOUBLE) AS amount, region FROM labelled"
        ),
        "label_split_truth": _with("SELECT * FROM truth"),
        "time_sorted_feed": _with(
            "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM raw_transactions ORDER BY txn_timestamp, transaction_id"
        ),
        "fact_store": _with("SELECT * FROM fct", _FCT),
        "dim_agents": _with(f"SELECT {_AGENT} FROM agents_s"),
        "dim_customers": _with("SELECT * FROM customers_s"),
        "fct_transactions": _with("SELECT * FROM fct", _FCT),
        "agent_daily_health": _with(
            f"""SELECT c.agent_id, a.region, a.tier, c.txn_date, {_UNITS.format('cin')} AS cash_in_amount,
       {_UNITS.format('cout')} AS cash_out_amount, c.total_txns, unique_customers_served,
       {_RATIO2} AS cash_out_to_in_ratio, coalesce(f.severity, 'none') AS imbalance_flag
FROM cents c JOIN agents_s a ON a.agent_id = c.agent_id
LEFT JOIN ({_imbalance('NULL')}) f ON f.agent_id = c.agent_id AND f.txn_date = c.txn_date""",
            _CENTS,
        ),
        "transaction_velocity_daily": _with(
            """SELECT txn_date, region, txn_type, txn_count, CAST(total AS DOUBLE) AS total_amount,
       CAST((200 * CAST(total * 100 AS HUGEINT) + 100 * txn_count) // (200 * txn_count) AS DOUBLE) / 100 AS avg_amount, unique_customers
FROM (SELECT txn_date, region, txn_type, count(*) AS txn_count, sum(amount) AS total, count(DISTINCT customer_id) AS unique_customers
      FROM txns GROUP BY ALL)"""
        ),
        "fr_velocity_flags": _with(f"SELECT {_FLAGGED} FROM velocity", _VELOCITY),
        "fr_velocity_flags_us": _with(f"SELECT {_FLAGGED} FROM velocity", _VELOCITY_US),
        "fr_structuring_flags": _with(f"SELECT {_FLAGGED} FROM structuring", _STRUCTURING),
        "fr_structuring_with_totals": _with(f"SELECT {_FLAGGED}, total_amount_in_window FROM structuring", _STRUCTURING),
        "fr_structuring_over_limit": _with(
            f"SELECT {_FLAGGED}, total_amount_in_window FROM structuring "
            "JOIN (SELECT transaction_id, lim FROM near) USING (transaction_id) WHERE total_amount_in_window > lim",
            _STRUCTURING_ANY,
        ),
        "fr_agent_imbalance_flags": _with(_imbalance("NULL"), _CENTS),
        "fr_agent_imbalance_graded": _with(_imbalance("'medium'"), _CENTS),
        "fr_agent_imbalance_pivot": _with(_PIVOT, _CENTS),
        "fr_geo_impossible_flags": _with(f"SELECT {_FLAGGED} FROM geo", _GEO),
        "fr_geo_impossible_exact": _with(f"SELECT {_FLAGGED} FROM geo", _GEO_EXACT),
        "fr_dormant_reactivation_flags": _with(f"SELECT {_FLAGGED} FROM dormant", _DORMANT),
        "fraud_alerts": _with("SELECT * FROM alerts", *_RULES, _ALERTS),
        "fraud_alerts_deduped": _with(
            """SELECT transaction_id, customer_id, txn_timestamp, fraud_pattern,
       CASE WHEN bool_or(severity = 'high') THEN 'high' ELSE 'medium' END AS severity, txn_type, amount, region, agent_id,
       kyc_tier, account_age_days, review_status, alert_created_at
FROM alerts
GROUP BY transaction_id, customer_id, txn_timestamp, fraud_pattern, txn_type, amount, region, agent_id, kyc_tier,
         account_age_days, review_status, alert_created_at""",
            *_RULES, _ALERTS,
        ),
        "fraud_alert_summary": _with("SELECT * FROM summary", *_QUEUE),
        "combined_flags_exact": _with(
            " UNION ALL ".join(
                f"SELECT transaction_id, fraud_pattern, severity, CAST(rule_metric AS DOUBLE) AS rule_metric FROM {rule}"
                for rule in ("velocity", "structuring", "geo")
            ),
            _VELOCITY_US, _STRUCTURING_US, _GEO_EXACT,
        ),
        "alert_summary_exact": _with(
            "SELECT transaction_id, txn_timestamp, customer_id, txn_type, amount, region, rules_tripped, fraud_patterns FROM summary",
            *_QUEUE_EXACT,
        ),
        "fraud_rule_evaluation": _with("SELECT * FROM evaluation", *_QUEUE, _SCORED),
        **_dashboard(_RULES_EXACT, _QUEUE_EXACT, "rules_tripped DESC"),
        **_dashboard(_RULES, _QUEUE, "rules_tripped DESC, max_severity_rank DESC", "_all_rules"),
        "daily_volume_by_type": _with("SELECT txn_date, txn_type, count(*) AS txn_count FROM txns GROUP BY ALL"),
        "value_by_region": _with("SELECT region, CAST(sum(amount) AS DOUBLE) AS total_amount FROM txns GROUP BY region"),
        "imbalance_list": _with(_PIVOT + " ORDER BY ratio DESC NULLS LAST, agent_id, txn_date", _CENTS),
        "top20_agents": _with(
            """SELECT agent_id, count(*) AS txn_count FROM txns WHERE agent_id IS NOT NULL
GROUP BY agent_id ORDER BY txn_count DESC, agent_id LIMIT 20"""
        ),
        "dq_unique": _with(_UNIQUE, _FCT),
        "dq_not_null": _with(_NOT_NULL, _FCT),
        "dq_accepted_values": _with(_ACCEPTED_SQL),
        "dq_foreign_keys": _with(_FOREIGN),
        "dq_violations": _with(_offences(), _FCT),
    }
