"""Independent DuckDB SQL for every registered query.

Written from the operator definitions, not generated from the Spark
plans.  The fixture views of FIXTURES.md part 2 become CTEs, so each
string runs on the bare driver tables.
"""

from __future__ import annotations

from vaultline.config import AS_OF_1, AS_OF_2, FIXTURE, SOURCE, RiskConfig
from vaultline.sources.fixtures import CITIES


def rnd(expr: str, n: int) -> str:
    """Spark's ``round`` on a double: HALF_UP on the shortest decimal text."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def exact_mean_sql(col: str) -> str:
    """Mean of a 2-decimal column, HALF_UP to 4 places, in integer units."""
    su = f"sum(CAST(round({col} * 100) AS HUGEINT))"
    n = f"CAST(count({col}) AS HUGEINT)"
    return f"CASE WHEN count({col}) = 0 THEN NULL ELSE CAST(({su} * 20000 + {n} * 100) // ({n} * 200) AS DOUBLE) / 10000.0 END"


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


FX = {
    "fx_location_map": """
SELECT n_name AS location, r_name AS country
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 20""",
    "fx_transactions": """
SELECT event_id AS transaction_id, user_id AS account_id, value AS amount,
       'USD' AS currency, event_type AS transaction_type,
       'M' || (json_extract(props, '$.k')::INT % 10) AS merchant,
       'NATION_' || (json_extract(props, '$.k')::INT % 25) AS location, ts
FROM events""",
    "fx_transactions_raw": """
SELECT CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_id END AS transaction_id,
       user_id AS account_id,
       CASE WHEN event_id % 103 = 0 THEN -value WHEN event_id % 109 = 0 THEN 0.0::DOUBLE
            WHEN event_id % 113 = 0 THEN NULL ELSE value END AS amount,
       'USD' AS currency, event_type AS transaction_type,
       'M' || (json_extract(props, '$.k')::INT % 10) AS merchant,
       CASE WHEN event_id % 107 = 0 THEN NULL
            ELSE 'NATION_' || (json_extract(props, '$.k')::INT % 25) END AS location,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp",
       {'device': 'd' || (json_extract(props, '$.k')::INT % 3),
        'ip_address': '10.0.0.' || json_extract(props, '$.k')::INT,
        'channel': event_type} AS metadata
FROM events""",
    "fx_accounts": """
SELECT o_orderkey AS account_id, o_custkey AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'P' THEN 'Dormant' ELSE 'Active' END AS status
FROM orders""",
    "fx_customers": """
SELECT c_custkey AS customer_id, c_name AS name, r_name AS country, c_mktsegment AS customer_type,
       CASE WHEN c_acctbal < 0 THEN 'High' WHEN c_acctbal < 5000 THEN 'Medium' ELSE 'Low' END AS risk_category
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "fx_credit": """
SELECT c_custkey AS customer_id, CAST(floor(300 + (c_acctbal + 1000) * 0.05::DOUBLE) AS INT) AS credit_score,
       CAST(coalesce(n_open, 0) AS INT) AS open_loans, last_f AS last_default_date
FROM customer LEFT JOIN (
  SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_open,
         CAST(max(o_orderdate) FILTER (WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2000-06-01') AS DATE) AS last_f
  FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
    "fx_credit_nulls": """
SELECT customer_id, CASE WHEN customer_id % 50 = 0 THEN NULL ELSE credit_score END AS credit_score,
       CASE WHEN customer_id % 70 = 0 THEN NULL ELSE open_loans END AS open_loans, last_default_date
FROM fx_credit""",
    "fx_customers_b2": """
SELECT customer_id, name, country,
       CASE WHEN customer_id % 7 <> 0 THEN customer_type
            ELSE CASE customer_type WHEN 'AUTOMOBILE' THEN 'BUILDING' WHEN 'BUILDING' THEN 'FURNITURE'
                 WHEN 'FURNITURE' THEN 'HOUSEHOLD' WHEN 'HOUSEHOLD' THEN 'MACHINERY' ELSE 'AUTOMOBILE' END
       END AS customer_type, risk_category
FROM fx_customers WHERE customer_id % 11 <> 0
UNION ALL
SELECT customer_id + 1000000, name, country, customer_type, risk_category
FROM fx_customers WHERE customer_id % 50 = 0""",
    "fx_accounts_b1": """
SELECT account_id, customer_id, status, 1 AS load_seq FROM fx_accounts WHERE account_id % 10 <> 9""",
    "fx_accounts_b2": """
SELECT account_id, customer_id, 'Closed' AS status, 1 AS load_seq FROM fx_accounts WHERE account_id % 10 >= 7
UNION ALL
SELECT account_id, customer_id, 'Dormant', 2 FROM fx_accounts WHERE account_id % 20 = 19""",
}

_FX_DEPS = {
    "fx_credit_nulls": ["fx_credit"],
    "fx_customers_b2": ["fx_customers"],
    "fx_accounts_b1": ["fx_accounts"],
    "fx_accounts_b2": ["fx_accounts"],
}


def with_fx(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` the fixture views named (and their dependencies), then
    ``extra`` CTEs in order, then ``body``."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _FX_DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [f"{n} AS ({FX[n]}\n)" for n in order] + [f"{n} AS (\n{s}\n)" for n, s in (extra or [])]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def ts(literal: str) -> str:
    return f"TIMESTAMP '{literal}'"


# ---------------------------------------------------------------------------
# Transaction chain (D5) as CTEs
# ---------------------------------------------------------------------------

def txn_ctes(src: str, cfg: RiskConfig, time_col: str, raw: bool) -> list[tuple[str, str]]:
    """CTEs t_flat -> t_clean -> t_time -> t_rapid -> t_dim -> t_silver."""
    if raw:
        flat = (
            f"SELECT transaction_id, account_id, amount, currency, transaction_type, merchant, location, "
            f'"timestamp", metadata.device AS device, metadata.ip_address AS ip_address, '
            f"metadata.channel AS channel FROM {src}"
        )
        tsx = f'CAST(TRY_CAST("{time_col}" AS TIMESTAMP) AS TIMESTAMP)'
    else:
        flat = f"SELECT * FROM {src}"
        tsx = f"CAST({time_col} AS TIMESTAMP)"
    w = int(cfg.rapid_window_s)
    return [
        ("t_flat", flat),
        ("t_clean", "SELECT * FROM t_flat WHERE transaction_id IS NOT NULL AND amount > 0"),
        (
            "t_time",
            f"SELECT *, CAST(hour(txn_timestamp) AS INTEGER) AS transaction_hour, "
            f"CAST(txn_timestamp AS DATE) AS txn_date, "
            f"CASE WHEN amount > {dbl(cfg.high_amount)} THEN 1 ELSE 0 END AS high_amount_flag, "
            f"epoch_us(txn_timestamp) // 1000000 AS txn_unix "
            f"FROM (SELECT *, {tsx} AS txn_timestamp FROM t_clean)",
        ),
        (
            "t_rapid",
            f"SELECT *, CASE WHEN txn_window_count > {int(cfg.rapid_limit)} THEN 1 ELSE 0 END AS rapid_txn_flag "
            f"FROM (SELECT *, CASE WHEN account_id IS NULL OR txn_unix IS NULL THEN NULL ELSE "
            f"count(transaction_id) OVER (PARTITION BY account_id ORDER BY txn_unix "
            f"RANGE BETWEEN {w} PRECEDING AND CURRENT ROW) END AS txn_window_count FROM t_time)",
        ),
        (
            "t_dim",
            "SELECT a.account_id AS d_account_id, a.customer_id, c.country AS home_country "
            "FROM fx_accounts a LEFT JOIN fx_customers c ON a.customer_id = c.customer_id",
        ),
        (
            "t_enriched",
            "SELECT r.*, d.customer_id, d.home_country, coalesce(m.country, 'Unknown') AS txn_country "
            "FROM t_rapid r LEFT JOIN t_dim d ON r.account_id = d.d_account_id "
            "LEFT JOIN fx_location_map m ON r.location = m.location",
        ),
        (
            "t_silver",
            "SELECT transaction_id, account_id, customer_id, amount, currency, transaction_type, merchant, "
            "location, txn_country, home_country, txn_timestamp, transaction_hour, txn_date, high_amount_flag, "
            "rapid_txn_flag, CASE WHEN txn_country <> home_country AND txn_country <> 'Unknown' "
            "AND home_country IS NOT NULL THEN 1 ELSE 0 END AS geo_mismatch_flag, "
            f"{ts(AS_OF_1)} AS created_timestamp, 'transactions.json' AS source_table FROM t_enriched",
        ),
    ]


def fraud_ctes(cfg: RiskConfig) -> list[tuple[str, str]]:
    wh, wg, wr = cfg.fraud_weights
    score = f"high_amount_flag * {dbl(wh)} + geo_mismatch_flag * {dbl(wg)} + rapid_txn_flag * {dbl(wr)}"
    return [
        ("t_scored", f"SELECT *, {rnd(score, 2)} AS fraud_score FROM t_silver"),
        (
            "t_fact",
            "SELECT transaction_id, account_id, customer_id, amount, currency, transaction_type, merchant, "
            "location, txn_timestamp, transaction_hour, txn_date, high_amount_flag, rapid_txn_flag, "
            f"geo_mismatch_flag, fraud_score, CASE WHEN fraud_score < {dbl(cfg.fraud_low)} THEN 'Low' "
            f"WHEN fraud_score < {dbl(cfg.fraud_medium)} THEN 'Medium' ELSE 'High' END AS fraud_risk_category "
            "FROM t_scored",
        ),
    ]


_TXN_FX = ("fx_location_map", "fx_accounts", "fx_customers")


def raw_chain(body: str, cfg: RiskConfig = FIXTURE, more: list[tuple[str, str]] | None = None) -> str:
    return with_fx(
        body,
        "fx_transactions_raw",
        *_TXN_FX,
        extra=txn_ctes("fx_transactions_raw", cfg, "timestamp", True) + (more or []),
    )


def clean_chain(body: str, cfg: RiskConfig = FIXTURE) -> str:
    return with_fx(
        body, "fx_transactions", *_TXN_FX, extra=txn_ctes("fx_transactions", cfg, "ts", False) + fraud_ctes(cfg)
    )


ORACLE: dict[str, str] = {}

# --- transaction steps (dirty input) ----------------------------------------
ORACLE["txn_flatten"] = raw_chain("SELECT * FROM t_flat")
ORACLE["txn_clean"] = raw_chain("SELECT * FROM t_clean")
ORACLE["txn_time_parts"] = raw_chain(
    'SELECT transaction_id, "timestamp", txn_timestamp, transaction_hour, txn_date FROM t_time'
)
ORACLE["txn_high_amount"] = raw_chain("SELECT transaction_id, amount, high_amount_flag FROM t_time")
ORACLE["txn_high_amount_default"] = raw_chain(
    "SELECT transaction_id, amount, high_amount_flag FROM t_time", SOURCE
)
ORACLE["txn_rolling_count"] = raw_chain(
    "SELECT transaction_id, account_id, txn_timestamp, txn_window_count FROM t_rapid"
)
ORACLE["txn_rapid_flag"] = raw_chain(
    "SELECT transaction_id, account_id, txn_timestamp, txn_window_count, rapid_txn_flag FROM t_rapid"
)
ORACLE["txn_rapid_flag_default"] = raw_chain(
    "SELECT transaction_id, account_id, txn_timestamp, txn_window_count, rapid_txn_flag FROM t_rapid", SOURCE
)
ORACLE["txn_join_accounts"] = raw_chain(
    "SELECT r.transaction_id, r.account_id, a.customer_id FROM t_clean r "
    "LEFT JOIN fx_accounts a ON r.account_id = a.account_id"
)
ORACLE["txn_join_customers"] = raw_chain(
    "SELECT r.transaction_id, r.account_id, a.customer_id, c.country AS home_country FROM t_clean r "
    "LEFT JOIN fx_accounts a ON r.account_id = a.account_id "
    "LEFT JOIN fx_customers c ON a.customer_id = c.customer_id"
)


def over_raw(sql: str, name: str, body: str) -> str:
    """A query of the raw chain with its input replaced by ``body``, a SELECT
    over fx_transactions_raw."""
    head, rest = sql.split("t_flat AS (", 1)
    flat, rest = rest.split("FROM fx_transactions_raw", 1)
    return f"{head}{name} AS (\n{body}\n),\nt_flat AS ({flat}FROM {name}{rest}"


_NO_ACCOUNT = (
    "SELECT * REPLACE (CASE WHEN coalesce(transaction_id, 0) % 97 = 0 THEN -1 WHEN coalesce(transaction_id, 0) % 89 = 0 THEN NULL "
    "ELSE account_id END AS account_id, CASE WHEN coalesce(transaction_id, 0) % 83 = 0 THEN 'no time' ELSE \"timestamp\" END AS \"timestamp\") "
    "FROM fx_transactions_raw"
)
ORACLE["join_coverage"] = over_raw(
    raw_chain(
        "SELECT count(*) FILTER (WHERE a.customer_id IS NOT NULL) AS matched, "
        "count(*) FILTER (WHERE a.customer_id IS NULL) AS unmatched FROM t_clean r "
        "LEFT JOIN fx_accounts a ON r.account_id = a.account_id"
    ),
    "no_account",
    _NO_ACCOUNT,
)
ORACLE["silver_without_account"] = over_raw(raw_chain("SELECT * FROM t_silver"), "no_account", _NO_ACCOUNT)
ORACLE["txn_country"] = raw_chain("SELECT transaction_id, location, txn_country FROM t_enriched")
ORACLE["txn_geo_mismatch"] = raw_chain(
    "SELECT transaction_id, txn_country, home_country, geo_mismatch_flag FROM t_silver"
)
ORACLE["silver_transactions"] = raw_chain("SELECT * FROM t_silver")

# --- fraud (clean input, fixture thresholds) --------------------------------
ORACLE["fraud_score"] = clean_chain(
    "SELECT transaction_id, high_amount_flag, geo_mismatch_flag, rapid_txn_flag, fraud_score FROM t_fact"
)
ORACLE["fraud_class"] = clean_chain("SELECT transaction_id, fraud_score, fraud_risk_category FROM t_fact")
ORACLE["fact_fraud_risk"] = clean_chain("SELECT * FROM t_fact")
ORACLE["fraud_distribution"] = clean_chain(
    'SELECT fraud_risk_category, count(*) AS "count" FROM t_fact GROUP BY fraud_risk_category'
)
ORACLE["high_risk_count"] = clean_chain(
    "SELECT count(*) FILTER (WHERE fraud_risk_category = 'High') AS high_risk_count FROM t_fact"
)
ORACLE["alert_top10_accounts"] = clean_chain(
    "SELECT account_id, high_risk_txn_count, total_amount, avg_fraud_score FROM ("
    f"SELECT account_id, count(transaction_id) AS high_risk_txn_count, {rnd('sum(amount)', 2)} AS total_amount, "
    f"{exact_mean_sql('fraud_score')} AS avg_fraud_score FROM t_fact WHERE fraud_risk_category = 'High' "
    "GROUP BY account_id) ORDER BY high_risk_txn_count DESC, total_amount DESC, account_id ASC LIMIT 10"
)
ORACLE["kpi_daily_fraud"] = clean_chain(
    "SELECT txn_date, fraud_risk_category, count(transaction_id) AS transaction_count, "
    f"{rnd('sum(amount)', 2)} AS total_amount, {exact_mean_sql('fraud_score')} AS avg_fraud_score "
    "FROM t_fact GROUP BY txn_date, fraud_risk_category"
)


# ---------------------------------------------------------------------------
# SCD2 customers / SCD1 accounts
# ---------------------------------------------------------------------------
_CUST = "customer_id, name, country, customer_type, risk_category"
_SCD = "effective_start, effective_end, is_current"


def dedupe_sql(src: str, key: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS _rn "
        f"FROM {src}) WHERE _rn = 1"
    )


def scd2_step_sql(prev: str, stg: str, as_of: str, insert_new: bool = True) -> str:
    """Apply staging ``stg`` to SCD2 table ``prev`` as one UNION ALL of the
    five kinds of output row."""
    a = ts(as_of)
    parts = [
        f"SELECT * FROM {prev} WHERE NOT is_current",
        f"SELECT p.* FROM {prev} p WHERE p.is_current AND NOT EXISTS (SELECT 1 FROM {stg} s "
        f"WHERE s.customer_id = p.customer_id AND s.customer_type IS DISTINCT FROM p.customer_type)",
        f"SELECT p.customer_id, p.name, p.country, p.customer_type, p.risk_category, p.effective_start, "
        f"{a} AS effective_end, FALSE AS is_current FROM {prev} p JOIN {stg} s ON s.customer_id = p.customer_id "
        f"WHERE p.is_current AND s.customer_type IS DISTINCT FROM p.customer_type",
        f"SELECT s.customer_id, s.name, s.country, s.customer_type, s.risk_category, {a} AS effective_start, "
        f"CAST(NULL AS TIMESTAMP) AS effective_end, TRUE AS is_current FROM {stg} s JOIN {prev} p "
        f"ON s.customer_id = p.customer_id WHERE p.is_current AND s.customer_type IS DISTINCT FROM p.customer_type",
    ]
    if insert_new:
        parts.append(
            f"SELECT s.customer_id, s.name, s.country, s.customer_type, s.risk_category, {a} AS effective_start, "
            f"CAST(NULL AS TIMESTAMP) AS effective_end, TRUE AS is_current FROM {stg} s WHERE NOT EXISTS "
            f"(SELECT 1 FROM {prev} p WHERE p.is_current AND p.customer_id = s.customer_id)"
        )
    return "\nUNION ALL\n".join(parts)


_CUST_ORDER = "name DESC NULLS LAST, country DESC NULLS LAST, customer_type DESC NULLS LAST, risk_category DESC NULLS LAST"
SCD_BASE = [
    ("s_init", f"SELECT {_CUST}, {ts(AS_OF_1)} AS effective_start, CAST(NULL AS TIMESTAMP) AS effective_end, "
               f"TRUE AS is_current FROM ({dedupe_sql('fx_customers', 'customer_id', _CUST_ORDER)})"),
    ("s_stg2", dedupe_sql("fx_customers_b2", "customer_id", _CUST_ORDER)),
    ("s_b2", scd2_step_sql("s_init", "s_stg2", AS_OF_2)),
]


def scd_chain(body: str, *extra_fx: str, extra: list[tuple[str, str]] | None = None) -> str:
    return with_fx(body, "fx_customers", "fx_customers_b2", *extra_fx, extra=SCD_BASE + (extra or []))


ORACLE["scd2_initial"] = scd_chain("SELECT * FROM s_init")
ORACLE["scd2_apply"] = scd_chain("SELECT * FROM s_b2")
ORACLE["scd2_apply_existing_only"] = scd_chain(
    "SELECT * FROM s_b2x", extra=[("s_b2x", scd2_step_sql("s_init", "s_stg2", AS_OF_2, insert_new=False))]
)
ORACLE["scd2_reapply_noop"] = scd_chain("SELECT * FROM s_b2")
ORACLE["scd2_current"] = scd_chain("SELECT * FROM s_b2 WHERE is_current")
ORACLE["scd2_expired"] = scd_chain("SELECT * FROM s_b2 WHERE NOT is_current")
ORACLE["scd2_totals"] = scd_chain(
    "SELECT count(*) AS total, count(*) FILTER (WHERE is_current) AS current, "
    "count(*) FILTER (WHERE NOT is_current) AS expired FROM s_b2"
)
ORACLE["scd2_invariants"] = scd_chain(
    "SELECT count(*) AS keys, count(*) FILTER (WHERE nc = 1) AS keys_one_current, "
    "CAST(coalesce(sum(ov), 0) AS BIGINT) AS overlapping, CAST(coalesce(sum(oe), 0) AS BIGINT) AS expired_open "
    "FROM (SELECT customer_id, count(*) FILTER (WHERE is_current) AS nc, sum(ov) AS ov, sum(oe) AS oe FROM ("
    "SELECT customer_id, is_current, CASE WHEN lag(effective_start) OVER w IS NOT NULL AND "
    "(lag(effective_end) OVER w IS NULL OR lag(effective_end) OVER w > effective_start) THEN 1 ELSE 0 END AS ov, "
    "CASE WHEN NOT is_current AND effective_end IS NULL THEN 1 ELSE 0 END AS oe FROM s_b2 "
    "WINDOW w AS (PARTITION BY customer_id ORDER BY effective_start, effective_end)) GROUP BY customer_id)"
)
_EXPIRE = (
    "s_exp",
    "SELECT * FROM s_init WHERE NOT is_current UNION ALL "
    "SELECT p.customer_id, p.name, p.country, p.customer_type, p.risk_category, p.effective_start, "
    f"CASE WHEN s.customer_id IS NOT NULL AND s.customer_type IS DISTINCT FROM p.customer_type THEN {ts(AS_OF_2)} "
    "ELSE p.effective_end END AS effective_end, "
    "CASE WHEN s.customer_id IS NOT NULL AND s.customer_type IS DISTINCT FROM p.customer_type THEN FALSE "
    "ELSE p.is_current END AS is_current FROM s_init p LEFT JOIN s_stg2 s ON p.customer_id = s.customer_id "
    "WHERE p.is_current",
)
ORACLE["scd2_expire"] = scd_chain("SELECT * FROM s_exp", extra=[_EXPIRE])
ORACLE["scd2_changed_keys"] = scd_chain(
    "SELECT * FROM fx_customers_b2 b WHERE b.customer_id IN (SELECT customer_id FROM s_exp WHERE NOT is_current)",
    extra=[_EXPIRE],
)

_ACC_ORDER = "load_seq DESC NULLS LAST, customer_id DESC NULLS LAST, status DESC NULLS LAST"
ACC_CTES = [
    ("a_b1", dedupe_sql("fx_accounts_b1", "account_id", _ACC_ORDER)),
    ("a_b2", dedupe_sql("fx_accounts_b2", "account_id", _ACC_ORDER)),
    (
        "a_silver",
        "SELECT * FROM a_b1 WHERE NOT EXISTS (SELECT 1 FROM a_b2 WHERE a_b2.account_id = a_b1.account_id) "
        "UNION ALL SELECT * FROM a_b2",
    ),
    (
        "a_churn",
        "SELECT *, CASE WHEN status = 'Closed' THEN 'Churned' WHEN status = 'Dormant' THEN 'High' "
        "ELSE 'Low' END AS churn_risk FROM a_silver",
    ),
]


def acc_chain(body: str) -> str:
    return with_fx(body, "fx_accounts_b1", "fx_accounts_b2", extra=ACC_CTES)


ORACLE["accounts_dedupe"] = acc_chain(
    "SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY load_seq DESC, customer_id DESC, "
    "status DESC) AS _rn FROM (SELECT * FROM fx_accounts_b1 UNION ALL SELECT * FROM fx_accounts_b2)) WHERE _rn = 1"
)
ORACLE["scd1_upsert"] = acc_chain("SELECT * FROM a_silver")
ORACLE["dim_accounts"] = acc_chain("SELECT * FROM a_silver")
ORACLE["churn_risk"] = acc_chain("SELECT * FROM a_churn")
ORACLE["churn_distribution"] = acc_chain('SELECT churn_risk, count(*) AS "count" FROM a_churn GROUP BY churn_risk')
ORACLE["dim_customer"] = scd_chain("SELECT * FROM s_b2")


# ---------------------------------------------------------------------------
# credit risk
# ---------------------------------------------------------------------------

def credit_ctes(src: str, cfg: RiskConfig = SOURCE) -> list[tuple[str, str]]:
    ws, wl, wd = cfg.credit_weights
    cap = dbl(cfg.loans_cap)
    score = (
        f"(CAST(1.0 AS DOUBLE) - credit_score / {dbl(cfg.max_credit_score)}) * {dbl(ws)} "
        f"+ open_loans_norm * {dbl(wl)} + recent_defaults * {dbl(wd)}"
    )
    return [
        (
            "c_join",
            f"SELECT cr.*, c.name, c.country, c.customer_type, c.risk_category FROM {src} cr "
            "JOIN (SELECT * FROM s_b2 WHERE is_current) c ON cr.customer_id = c.customer_id",
        ),
        (
            "c_feat",
            "SELECT *, CASE WHEN last_default_date IS NOT NULL THEN 1 ELSE 0 END AS recent_defaults, "
            f"CASE WHEN open_loans / {cap} > CAST(1.0 AS DOUBLE) THEN CAST(1.0 AS DOUBLE) "
            f"ELSE {rnd(f'open_loans / {cap}', 2)} END AS open_loans_norm FROM c_join",
        ),
        ("c_score", f"SELECT *, {rnd(score, 2)} AS credit_risk_score FROM c_feat"),
        (
            "c_fact",
            "SELECT customer_id, name, country, customer_type, risk_category, credit_score, open_loans, "
            "open_loans_norm, last_default_date, recent_defaults, credit_risk_score, "
            "CASE WHEN credit_risk_score IS NULL THEN 'Unknown' "
            f"WHEN credit_risk_score < {dbl(cfg.credit_low)} THEN 'Low' "
            f"WHEN credit_risk_score < {dbl(cfg.credit_medium)} THEN 'Medium' ELSE 'High' END "
            "AS credit_risk_category FROM c_score",
        ),
    ]


def credit_chain(body: str, src: str = "fx_credit_nulls") -> str:
    return scd_chain(body, src, extra=credit_ctes(src))


ORACLE["credit_join"] = credit_chain("SELECT * FROM c_join", "fx_credit")
ORACLE["credit_defaults"] = credit_chain("SELECT customer_id, last_default_date, recent_defaults FROM c_feat")
ORACLE["credit_loans_norm"] = credit_chain("SELECT customer_id, open_loans, open_loans_norm FROM c_feat")
ORACLE["credit_score"] = credit_chain(
    "SELECT customer_id, credit_score, open_loans_norm, recent_defaults, credit_risk_score FROM c_score"
)
ORACLE["credit_class"] = credit_chain("SELECT customer_id, credit_risk_score, credit_risk_category FROM c_fact")
ORACLE["fact_credit_risk"] = credit_chain("SELECT * FROM c_fact", "fx_credit")
ORACLE["credit_distribution"] = credit_chain(
    'SELECT credit_risk_category, count(*) AS "count" FROM c_fact GROUP BY credit_risk_category'
)


# ---------------------------------------------------------------------------
# dimensions over silver transactions (dirty input, fixture thresholds)
# ---------------------------------------------------------------------------
_REGION = (
    "CASE WHEN country = 'India' THEN 'Asia' WHEN country = 'UK' THEN 'Europe' "
    "WHEN country IN ('USA', 'Canada') THEN 'Americas' ELSE 'Other' END"
)
_FIXED_COUNTRY = (
    "CASE location WHEN 'Mumbai' THEN 'India' WHEN 'Delhi' THEN 'India' WHEN 'London' THEN 'UK' "
    "WHEN 'New York' THEN 'USA' WHEN 'Toronto' THEN 'Canada' ELSE 'Unknown' END"
)
_LOC_ROWS = (
    "SELECT l.location, coalesce(m.country, 'Unknown') AS country FROM "
    "(SELECT DISTINCT location FROM {src} WHERE location IS NOT NULL) l "
    "LEFT JOIN fx_location_map m ON l.location = m.location"
)

ORACLE["distinct_locations"] = raw_chain("SELECT DISTINCT location FROM t_silver")
_CITY = "CASE location " + " ".join(f"WHEN 'NATION_{k}' THEN '{c}'" for k, c in enumerate(CITIES)) + " ELSE location END"
ORACLE["location_country_map"] = raw_chain(
    f"SELECT location, country, {_REGION} AS region FROM (SELECT location, {_FIXED_COUNTRY} AS country "
    f"FROM (SELECT DISTINCT {_CITY} AS location FROM t_silver WHERE location IS NOT NULL))"
)
ORACLE["location_country_join"] = raw_chain(
    f"SELECT location, country, {_REGION} AS region FROM ({_LOC_ROWS.format(src='t_silver')})"
)
ORACLE["dim_location"] = raw_chain(
    "SELECT CAST(row_number() OVER (ORDER BY location) AS INTEGER) AS location_key, location, country, "
    f"{_REGION} AS region FROM ({_LOC_ROWS.format(src='t_silver')})"
)
ORACLE["dim_location_extend"] = raw_chain(
    "SELECT location_key, location, country, region FROM first_load UNION ALL "
    "SELECT CAST((SELECT max(location_key) FROM first_load) + row_number() OVER (ORDER BY location) AS INTEGER), "
    f"location, country, {_REGION} FROM ({_LOC_ROWS.format(src='t_silver')}) n "
    "WHERE n.location NOT IN (SELECT location FROM first_load)",
    more=[
        ("early", "SELECT * FROM t_silver WHERE txn_country <> 'Unknown'"),
        (
            "first_load",
            "SELECT CAST(row_number() OVER (ORDER BY location) AS INTEGER) AS location_key, location, country, "
            f"{_REGION} AS region FROM ({_LOC_ROWS.format(src='early')})",
        ),
    ],
)
ORACLE["dim_date"] = raw_chain(
    "SELECT full_date, CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, "
    "CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month, "
    "CAST(day(full_date) AS INTEGER) AS day, CAST(quarter(full_date) AS INTEGER) AS quarter, "
    "dayname(full_date) AS day_name, monthname(full_date) AS month_name, "
    "CASE WHEN dayofweek(full_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend FROM ("
    "SELECT CAST(g AS DATE) AS full_date FROM (SELECT make_date(CAST(year(min(txn_date)) AS INTEGER), 1, 1) AS lo, "
    "make_date(CAST(year(max(txn_date)) AS INTEGER), 12, 31) AS hi FROM t_silver) b, "
    "generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) AS gs(g))"
)
ORACLE["assign_key_two_phase"] = with_fx(
    "SELECT customer_id, name, CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS customer_key FROM fx_customers",
    "fx_customers",
)


# ---------------------------------------------------------------------------
# ingestion, storage layout, incremental loads, quality counts
# ---------------------------------------------------------------------------
ORACLE["audit_columns"] = with_fx(
    f"SELECT *, {ts(AS_OF_1)} AS created_timestamp, 'customers.csv' AS source_table FROM fx_customers",
    "fx_customers",
)
ORACLE["bronze_customers"] = with_fx(
    "SELECT CAST(customer_id AS VARCHAR) AS customer_id, name, country, customer_type, risk_category, upper(name) AS email, "
    f"CAST(NULL AS VARCHAR) AS _corrupt_record, {ts(AS_OF_1)} AS created_timestamp, 'customers.csv' AS source_table FROM fx_customers",
    "fx_customers",
)
ORACLE["bronze_credit"] = with_fx(
    "SELECT CAST(customer_id AS VARCHAR) AS customer_id, CASE WHEN customer_id % 10 <> 3 THEN credit_score END AS credit_score, open_loans, "
    "CASE WHEN customer_id % 10 <> 7 THEN last_default_date END AS last_default_date, "
    "CASE customer_id % 10 WHEN 3 THEN 'credit_score=' || CAST(credit_score AS VARCHAR) || 'x' "
    "WHEN 7 THEN 'last_default_date=notadate' END AS _corrupt_record, "
    f"{ts(AS_OF_1)} AS created_timestamp, 'credit_history.csv' AS source_table FROM fx_credit",
    "fx_credit",
)
ORACLE["bronze_transactions"] = with_fx(
    "SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(account_id AS VARCHAR) AS account_id, amount, "
    'currency, transaction_type, merchant, location, "timestamp", CAST(to_json(metadata) AS VARCHAR) AS metadata, '
    f"CAST(NULL AS VARCHAR) AS _corrupt_record, {ts(AS_OF_1)} AS created_timestamp, 'transactions.json' AS source_table FROM fx_transactions_raw",
    "fx_transactions_raw",
)
ORACLE["bronze_transactions_multiline"] = ORACLE["bronze_transactions"]
ORACLE["bronze_rejected"] = with_fx(
    "SELECT CAST(customer_id AS VARCHAR) AS customer_id, 'credit_score=' || CAST(credit_score AS VARCHAR) || 'x' AS reason, "
    "'raw-rejected' AS folder, 'credit_history.csv' AS source_table FROM fx_credit WHERE customer_id % 10 = 3 AND credit_score IS NOT NULL",
    "fx_credit",
)
ORACLE["bronze_transactions_split"] = ORACLE["bronze_transactions"]
ORACLE["fact_transactions"] = ORACLE["silver_transactions"]
ORACLE["cluster_silver"] = ORACLE["scd2_apply"]
ORACLE["silver_txn_append"] = ORACLE["silver_transactions"]
ORACLE["silver_txn_dup_ids"] = ORACLE["silver_transactions"]
ORACLE["silver_txn_resend"] = over_raw(
    ORACLE["silver_transactions"],
    "resent",
    "SELECT * REPLACE (CASE WHEN transaction_id % 40 = 0 THEN strftime(CAST(\"timestamp\" AS TIMESTAMP) + INTERVAL 3 DAY, '%Y-%m-%d %H:%M:%S') "
    "ELSE \"timestamp\" END AS \"timestamp\", CASE WHEN transaction_id % 40 = 20 THEN account_id + 1 ELSE account_id END AS account_id) "
    "FROM fx_transactions_raw",
)
ORACLE["silver_txn_moved_day"] = over_raw(
    ORACLE["silver_transactions"],
    "moved",
    "SELECT * REPLACE (CASE WHEN day(TRY_CAST(\"timestamp\" AS TIMESTAMP)) = 3 THEN strftime(TRY_CAST(\"timestamp\" AS TIMESTAMP) + INTERVAL 400 DAY, "
    "'%Y-%m-%d %H:%M:%S') ELSE \"timestamp\" END AS \"timestamp\") FROM fx_transactions_raw",
)
ORACLE["alert_top10_incremental"] = ORACLE["alert_top10_accounts"]
ORACLE["fact_transactions_rewrite"] = raw_chain("SELECT * FROM t_silver WHERE day(txn_date) > 5")
ORACLE["publish_table"] = ORACLE["scd2_apply"]
ORACLE["publish_new_table"] = ORACLE["scd2_initial"]
ORACLE["scd1_stored_loads"] = ORACLE["scd1_upsert"]
ORACLE["audit_load_time"] = with_fx(
    "SELECT 'customers.csv' AS source_table, count(*) AS rows, CAST(1 AS BIGINT) AS load_times, TRUE AS fresh FROM fx_customers",
    "fx_customers",
)
ORACLE["snapshot_append"] = with_fx(
    "SELECT *, CASE WHEN customer_id % 3 = 2 THEN 'late' END AS note FROM fx_customers", "fx_customers"
)
ORACLE["snapshot_evolve"] = with_fx("SELECT *, CAST(length(name) AS INTEGER) AS name_length FROM fx_customers", "fx_customers")
ORACLE["snapshot_widen"] = with_fx(
    "SELECT customer_id, CAST(length(name) AS BIGINT) + CASE WHEN customer_id % 2 = 1 THEN 3000000000 ELSE 0 END AS n, "
    "CAST(customer_id AS DOUBLE) + CASE WHEN customer_id % 2 = 1 THEN 0.5 ELSE 0 END AS v, CAST(5000000001 AS BIGINT) AS k FROM fx_customers",
    "fx_customers",
)
ORACLE["scd2_stored_loads"] = scd_chain(
    "SELECT * FROM s_b3",
    extra=[
        ("s_stg3", "SELECT customer_id, name, country, customer_type, risk_category FROM s_init"),
        ("s_b3", scd2_step_sql("s_b2", "s_stg3", AS_OF_2)),
    ],
)
ORACLE["txn_quality_counts"] = raw_chain(
    "SELECT (SELECT count(*) FROM fx_transactions_raw) AS raw_rows, count(*) AS kept_rows, "
    "(SELECT count(*) FROM fx_transactions_raw) - count(*) AS dropped_rows, "
    "count(*) FILTER (WHERE high_amount_flag = 1) AS high_amount_rows, "
    "count(*) FILTER (WHERE rapid_txn_flag = 1) AS rapid_rows, "
    "count(*) FILTER (WHERE geo_mismatch_flag = 1) AS geo_mismatch_rows, "
    "count(*) FILTER (WHERE customer_id IS NOT NULL) AS matched_rows, "
    "count(*) FILTER (WHERE customer_id IS NULL) AS unmatched_rows FROM t_silver"
)
ORACLE["silver_txn_stream"] = ORACLE["silver_transactions"]
ORACLE["scd1_invariants"] = acc_chain(
    "SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows, count(*) AS keys, "
    "count(*) FILTER (WHERE n > 1) AS duplicate_keys FROM (SELECT account_id, count(*) AS n FROM a_silver GROUP BY account_id)"
)
