"""The queries of :mod:`checks.queries` as DuckDB SQL over the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

AS_OF = "TIMESTAMP '2001-09-01 12:00:00'"
TODAY = "DATE '2001-09-01'"
EVENTS_NOW = "TIMESTAMP '2024-01-31 00:00:00'"

ATTRIBUTES = (
    "customer_name, email, phone, address, city, state, zip_code, country, date_of_birth, gender, income_bracket, "
    "customer_segment, account_open_date"
)


def _people(prefix: str, source: str, key: str, sk: str, name: str, nation: str, balance: str, segment: str) -> str:
    return f"""
    SELECT CAST({sk} AS BIGINT) AS customer_sk, '{prefix}' || {key} AS customer_id, {name} AS customer_name,
           'customer' || {key} || '@example.com' AS email,
           CASE WHEN {balance} >= 0 THEN '+1-555-' || {key} END AS phone, {key} || ' Main St' AS address, city, state,
           CASE WHEN {balance} >= 0 THEN lpad(CAST({key} % 100000 AS VARCHAR), 5, '0') ELSE 'Z' || {key} END AS zip_code,
           'US' AS country, DATE '1950-01-01' + CAST(({key} % 7000) * 3 AS INTEGER) AS date_of_birth,
           CASE WHEN {balance} < 2500 THEN 'Female' WHEN {balance} < 5000 THEN 'Male'
                WHEN {balance} < 7500 THEN 'Non-binary' END AS gender,
           CASE WHEN {balance} < 0 THEN '<30k' WHEN {balance} < 3000 THEN '30k-60k' WHEN {balance} < 6000 THEN '60k-100k'
                WHEN {balance} < 9000 THEN '100k-200k' ELSE '>200k' END AS income_bracket,
           {segment} AS customer_segment, DATE '1985-01-01' + CAST({key} % 3650 AS INTEGER) AS account_open_date
    FROM {source} LEFT JOIN places ON {nation} = n_nationkey"""


def _calendar(source: str, column: str) -> str:
    return f"""
    SELECT CAST(d AS DATE) AS full_date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key
    FROM (SELECT unnest(generate_series(CAST(min({column}) AS DATE), CAST(max({column}) AS DATE), INTERVAL 1 DAY)) AS d
          FROM {source})"""


PRELUDE = f"""WITH places AS (
    SELECT n_nationkey, n_name AS state, r_name AS city FROM nation JOIN region ON n_regionkey = r_regionkey),
retail AS ({_people('C', 'customer', 'c_custkey', 'c_custkey * 2', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment')}),
business AS ({_people('S', 'supplier', 's_suppkey', 's_suppkey * 2 + 1', 's_name', 's_nationkey', 's_acctbal', "'BUSINESS'")}),
customers AS (SELECT * FROM retail UNION ALL SELECT * FROM business),
products AS (
    SELECT p_partkey AS product_sk, 'P' || p_partkey AS product_id, p_name AS product_name, p_type AS product_category,
           p_brand AS product_type, CAST(p_size / 10.0 AS DECIMAL(5,2)) AS interest_rate,
           CAST(p_retailprice AS DECIMAL(10,2)) AS annual_fee, p_size <= 45 AS is_active FROM part),
branches AS (
    SELECT CAST(n_nationkey AS BIGINT) AS branch_sk, 'BR' || n_nationkey AS branch_id, 'Branch ' || n_name AS branch_name,
           n_name AS city, n_name AS state, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey),
days AS ({_calendar('lineitem', 'l_shipdate')}),
order_days AS ({_calendar('orders', 'o_orderdate')}),
event_days AS ({_calendar('events', 'ts')}),
dates AS (
    SELECT date_key, full_date, strftime(full_date, '%A') AS day_of_week, CAST(day(full_date) AS INTEGER) AS day_of_month,
           CAST(month(full_date) AS INTEGER) AS month, strftime(full_date, '%B') AS month_name,
           CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(year(full_date) AS INTEGER) AS year,
           isodow(full_date) >= 6 AS is_weekend, false AS is_holiday,
           CAST(CASE WHEN month(full_date) >= 4 THEN year(full_date) ELSE year(full_date) - 1 END AS INTEGER) AS fiscal_year,
           CAST(quarter(full_date) AS INTEGER) AS fiscal_quarter, CAST(week(full_date) AS INTEGER) AS week_of_year
    FROM days),
lines AS (
    SELECT *, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
              || strftime(l_shipdate, '%Y%m%d') || '-' || CAST(l_quantity AS INTEGER) AS transaction_id,
           CAST(l_shipdate AS DATE) AS ship_day
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
facts AS (
    SELECT transaction_id, ship_day AS transaction_date, CAST(strftime(ship_day, '%Y%m%d') AS INTEGER) AS date_key,
           o_custkey * 2 AS customer_sk, 'C' || o_custkey AS customer_id, l_partkey AS product_sk,
           'P' || l_partkey AS product_id, 'BR' || (l_suppkey % 30) AS branch_id,
           CAST(l_extendedprice AS DECIMAL(15,2)) AS amount,
           CAST(round(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(15,2)) AS fee,
           CAST(l_quantity * 100 AS DECIMAL(15,2)) AS balance_after,
           CASE WHEN l_linestatus = 'O' THEN 'Credit' ELSE 'Debit' END AS transaction_type,
           CASE l_returnflag WHEN 'A' THEN 'Withdrawal' WHEN 'N' THEN 'Purchase' WHEN 'R' THEN 'Deposit' END AS transaction_category,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'Online' WHEN '2-HIGH' THEN 'Mobile' WHEN '3-MEDIUM' THEN 'ATM'
                WHEN '4-NOT SPECIFIED' THEN 'Branch' WHEN '5-LOW' THEN 'POS' END AS channel,
           CASE o_orderstatus WHEN 'O' THEN 'Pending' WHEN 'F' THEN 'Completed' WHEN 'P' THEN 'Failed' END AS status
    FROM lines),
held AS (SELECT DISTINCT customer_sk, product_sk FROM facts WHERE product_sk IS NOT NULL),
held_owners AS (SELECT product_sk, count(*) AS owners FROM held GROUP BY product_sk),
held_pairs AS (
    SELECT a.product_sk AS item_a, b.product_sk AS item_b, count(*) AS n_together
    FROM held a JOIN held b ON a.customer_sk = b.customer_sk AND a.product_sk < b.product_sk GROUP BY 1, 2),
held_support AS (
    SELECT item_a, item_b, n_together, a.owners AS owners_a, b.owners AS owners_b,
           CAST(n_together AS DOUBLE) / a.owners AS support_a, CAST(n_together AS DOUBLE) / b.owners AS support_b
    FROM held_pairs JOIN held_owners a ON item_a = a.product_sk JOIN held_owners b ON item_b = b.product_sk),
sold AS (SELECT f.*, p.product_category FROM facts f JOIN products p ON f.product_sk = p.product_sk),
owned AS (SELECT DISTINCT customer_sk, product_category FROM sold),
affinity AS (
    SELECT a.product_category AS item_a, c.product_category AS item_b,
           CAST((SELECT count(*) FROM owned x JOIN owned y ON x.customer_sk = y.customer_sk
                 WHERE x.product_category = a.product_category AND y.product_category = c.product_category) AS DOUBLE)
           / a.n AS affinity
    FROM (SELECT product_category, count(*) AS n FROM owned GROUP BY 1) a
    JOIN (SELECT DISTINCT product_category FROM owned) c ON true),
raw_tx AS (
    SELECT transaction_id, CASE WHEN l_discount = 0 THEN 'X' ELSE 'C' END || o_custkey AS customer_id,
           CASE WHEN l_tax <> 0 THEN 'P' || l_partkey END AS product_id,
           CASE WHEN l_quantity = 1 THEN DATE '1850-01-01' ELSE ship_day END AS transaction_date,
           CAST(l_extendedprice AS DECIMAL(15,2)) AS amount
    FROM lines),
raw_keyed AS (
    SELECT r.*, CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_key, c.customer_sk, p.product_sk
    FROM raw_tx r LEFT JOIN customers c ON r.customer_id = c.customer_id LEFT JOIN products p ON r.product_id = p.product_id),
loaded AS (
    SELECT * FROM raw_keyed WHERE customer_sk IS NOT NULL AND product_sk IS NOT NULL
    AND date_key BETWEEN 19000101 AND 29991231),
ev AS (
    SELECT event_id AS transaction_sk, user_id * 2 AS customer_sk, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key,
           ts AS created_at, CAST(value AS DECIMAL(15,2)) AS amount, event_type AS merchant_category,
           CASE event_type WHEN 'view' THEN 'debit' WHEN 'click' THEN 'credit' WHEN 'error' THEN 'transfer'
                WHEN 'purchase' THEN 'atm_withdrawal' WHEN 'signup' THEN 'other' END AS transaction_type,
           CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS INTEGER) AS k, props
    FROM events),
ev_stats AS (
    SELECT customer_sk, CAST(sum(amount) AS DOUBLE) / count(amount) AS mean_amount, stddev_samp(CAST(amount AS DOUBLE)) AS stddev_amount
    FROM ev GROUP BY 1),
ev_risk AS (
    SELECT merchant_category, avg(CASE WHEN k < 5 THEN 1.0 ELSE 0.0 END) AS fraud_rate FROM ev GROUP BY 1),
ev_velocity AS (
    SELECT customer_sk, CAST(hour(created_at) AS INTEGER) AS tx_hour, count(*) AS tx_count,
           count(*) / nullif((epoch_us(max(created_at)) - epoch_us(min(created_at))) / 1e6 / 3600, 0) AS tx_per_hour
    FROM ev GROUP BY 1, 2),
batch AS (
    SELECT customer_id, customer_name, email, phone, address, city, state, zip_code, country, date_of_birth, gender,
           income_bracket, CASE WHEN income_bracket = '<30k' THEN customer_segment || ' [upd]' ELSE customer_segment END
           AS customer_segment, account_open_date, 1 AS seq FROM retail
    UNION ALL
    SELECT customer_id, customer_name, email, phone, address, city || ' (moved)', state, zip_code, country, date_of_birth,
           gender, income_bracket, customer_segment, account_open_date, 2 FROM retail WHERE income_bracket = '>200k'
    UNION ALL SELECT customer_id, {ATTRIBUTES}, 1 FROM business),
last_batch AS (
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY seq DESC) AS rn FROM batch)
    WHERE rn = 1),
compared AS (
    SELECT b.*, CASE WHEN r.customer_id IS NOT NULL THEN 1 END AS old_version,
           r.customer_id IS NOT NULL AND (b.customer_segment IS DISTINCT FROM r.customer_segment
               OR b.city IS DISTINCT FROM r.city) AS is_changed,
           r.customer_id IS NOT NULL AND b.customer_segment IS DISTINCT FROM r.customer_segment AS segment_changed
    FROM last_batch b LEFT JOIN retail r ON b.customer_id = r.customer_id),
changes AS (
    SELECT customer_id, {ATTRIBUTES}, CAST(coalesce(old_version, 0) + 1 AS INTEGER) AS version
    FROM compared WHERE old_version IS NULL OR is_changed),
applied AS (
    SELECT r.customer_id, {', '.join('r.' + a.strip() for a in ATTRIBUTES.split(','))},
           DATE '2000-01-01' AS effective_date, CASE WHEN c.customer_id IS NOT NULL THEN {TODAY} END AS expiry_date,
           c.customer_id IS NULL AS is_current, CAST(1 AS INTEGER) AS version
    FROM retail r LEFT JOIN changes c ON r.customer_id = c.customer_id AND c.version > 1
    UNION ALL SELECT customer_id, {ATTRIBUTES}, {TODAY}, CAST(NULL AS DATE), true, version FROM changes)
"""


def add(name: str, sql: str) -> None:
    ORACLE[name] = PRELUDE + sql


def rounded(expression: str, name: str) -> str:
    """For results that depend on the order of floating-point additions."""
    return f"round(CAST({expression} AS DOUBLE), 4) AS {name}"


def exact(expression: str, name: str) -> str:
    """For decimals, and for doubles that take the same arithmetic on exact inputs."""
    return f"CAST({expression} AS DOUBLE) AS {name}"


ALL_ATTRIBUTES = "customer_id, " + ATTRIBUTES
REVENUE = f"""SELECT year, month, product_category, channel, count(*) AS transaction_count,
    {exact('sum(amount)', 'total_amount')}, {exact('sum(fee)', 'total_fees')}
    FROM sold JOIN dates USING (date_key) {{where}} GROUP BY year, month, product_category, channel"""

# --- sources ----------------------------------------------------------------------------------------------
add("src_transactions_csv", f"""SELECT transaction_id, customer_id, product_id, CAST(transaction_date AS TIMESTAMP) AS transaction_date,
    {exact('amount', 'amount')}, CAST(NULL AS BOOLEAN) AS is_fraudulent FROM raw_tx""")
add("src_customers_csv", f"SELECT {ALL_ATTRIBUTES} FROM customers")
add("src_products_csv", f"""SELECT product_id, product_name, product_category, product_type,
    {exact('interest_rate', 'interest_rate')}, {exact('annual_fee', 'annual_fee')}, is_active FROM products""")
add("src_missing_is_empty", f"SELECT transaction_date AS day, count(*) AS n, {exact('sum(amount)', 'amount')} FROM raw_tx GROUP BY 1")
add("src_param_query", """SELECT o_orderpriority, count(*) AS n, round(max(o_totalprice), 4) AS top FROM orders
    WHERE o_orderdate >= DATE '1998-01-01' AND o_totalprice > 1000 GROUP BY 1""")

# --- sinks and contracts ----------------------------------------------------------------------------------
for _name in ("sink_materialize_roundtrip", "sink_csv_roundtrip", "v_monthly_revenue"):
    add(_name, REVENUE.format(where=""))
REGIONS = f"""SELECT state, city, count(*) AS transaction_count, count(DISTINCT customer_sk) AS customer_count,
    {exact('sum(amount)', 'total_revenue')}, CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_transaction_amount,
    CAST(sum(balance_after) AS DOUBLE) / count(balance_after) AS avg_balance
    FROM facts JOIN customers USING (customer_sk) GROUP BY state, city"""
add("view_registered", REGIONS)
add("regional_analysis", REGIONS)
add("load_dim_date_new", "SELECT * FROM dates WHERE date_key NOT IN (SELECT date_key FROM order_days)")
PRODUCT_COLUMNS = f"""product_sk, product_id, product_name, product_category, product_type,
    {exact('interest_rate', 'interest_rate')}, {exact('annual_fee', 'annual_fee')}, is_active"""
add("load_dim_product_new", f"SELECT {PRODUCT_COLUMNS} FROM products WHERE NOT is_active")
add("load_facts_new", f"""SELECT transaction_id, date_key, customer_sk, product_sk, {exact('amount', 'amount')}, channel
    FROM facts WHERE transaction_id NOT IN (SELECT transaction_id FROM facts WHERE date_key < 20000101)""")
add("contract_schema", f"""SELECT customer_sk, {ALL_ATTRIBUTES}, DATE '2000-01-01' AS effective_date,
    CAST(NULL AS DATE) AS expiry_date, true AS is_current, CAST(1 AS INTEGER) AS version FROM customers""")


def _null_rule(table: str, source: str, column: str) -> str:
    return f"SELECT '{table}' AS table_name, 'not_null' AS check_type, '{column}' AS columns, count(*) - count({column}) AS violations FROM {source}"


def _unique_rule(table: str, source: str, column: str) -> str:
    distinct = f"count(DISTINCT {column}) + CAST(count(*) > count({column}) AS INTEGER)"
    return f"SELECT '{table}', 'unique', '{column}', count(*) - ({distinct}) FROM {source}"


def _reference_rule(table: str, source: str, column: str, parent: str, parent_column: str) -> str:
    return f"""SELECT '{table}', 'referential_integrity', '{column}', count(DISTINCT {column}) FROM {source}
        WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {parent_column} FROM {parent})"""


def _rules(parts: list[str]) -> str:
    body = " UNION ALL ".join(parts)
    return f"SELECT table_name, check_type, columns, violations = 0 AS passed, violations FROM ({body})"


_DIM_CUSTOMER = "(SELECT *, DATE '2000-01-01' AS effective_date, true AS is_current FROM customers)"
add("contract_violations", _rules(
    [_null_rule("dim_customer", _DIM_CUSTOMER, c) for c in ("customer_sk", "customer_id", "effective_date", "is_current")]
    + [_unique_rule("dim_customer", "customers", "customer_sk")]
    + [r("dim_product", "products", c) for c in ("product_sk", "product_id") for r in (_null_rule, _unique_rule)]
    + [r("dim_branch", "branches", c) for c in ("branch_sk", "branch_id") for r in (_null_rule, _unique_rule)]
    + [r("dim_date", "dates", c) for c in ("date_key", "full_date") for r in (_null_rule, _unique_rule)]
    + [_null_rule("fact_transactions", "raw_keyed", c)
       for c in ("transaction_id", "date_key", "customer_sk", "product_sk", "amount")]
    + [_reference_rule("fact_transactions", "raw_keyed", "date_key", "dates", "date_key"),
       _reference_rule("fact_transactions", "raw_keyed", "customer_sk", "customers", "customer_sk"),
       _reference_rule("fact_transactions", "raw_keyed", "product_sk", "products", "product_sk")]
))
add("contract_defaults", f"""SELECT transaction_id, {exact('amount', 'amount')}, CAST(0 AS DOUBLE) AS fee,
    false AS is_fraudulent, CAST(NULL AS DOUBLE) AS balance_after FROM raw_tx""")

# --- dimension builders and keys --------------------------------------------------------------------------
add("dim_date_full", "SELECT * FROM dates")
add("dim_date_basic", """SELECT date_key AS date_sk, full_date, day_of_month AS day, month, year, quarter,
    CAST(isodow(full_date) - 1 AS INTEGER) AS day_of_week, CAST(is_weekend AS INTEGER) AS is_weekend FROM dates""")
add("dim_product_dedup", """SELECT product_id, CASE WHEN is_active THEN product_name ELSE upper(product_name) END AS product_name,
    product_type FROM products""")
add("surrogate_keys", """SELECT count(*) AS n, count(*) AS n_keys, (SELECT max(p_partkey) FROM part) + 1 AS first_key,
    (SELECT max(p_partkey) FROM part) + count(*) AS last_key FROM orders""")
add("dim_customer_initial", f"""SELECT {ALL_ATTRIBUTES}, {TODAY} AS effective_date, CAST(NULL AS DATE) AS expiry_date,
    true AS is_current, CAST(1 AS INTEGER) AS version FROM customers""")

# --- projections and derived columns ----------------------------------------------------------------------
add("customers_current", "SELECT customer_id, customer_segment, city, version FROM applied WHERE is_current")
RAW_COLUMNS = f"transaction_id, customer_id, product_id, transaction_date, {exact('amount', 'amount')}, date_key"
add("facts_required_not_null", f"SELECT {RAW_COLUMNS} FROM raw_keyed WHERE product_id IS NOT NULL")
add("facts_valid_dates", f"SELECT {RAW_COLUMNS} FROM raw_keyed WHERE date_key BETWEEN 19000101 AND 29991231")
ZSCORE = "CASE WHEN stddev_amount > 0 THEN (CAST(amount AS DOUBLE) - mean_amount) / stddev_amount ELSE 0.0 END"
add("amount_zscore", f"""SELECT transaction_sk, customer_sk, {rounded(ZSCORE, 'amount_zscore')}
    FROM ev LEFT JOIN ev_stats USING (customer_sk)""")
add("numeric_coerce_zero", "SELECT customer_id, coalesce(TRY_CAST(zip_code AS DOUBLE), 0.0) AS zip_code FROM customers")
AGE = f"CAST(date_sub('year', date_of_birth, {TODAY}) AS INTEGER)"
BAND = f"""CASE WHEN {AGE} < 0 OR {AGE} >= 100 THEN NULL WHEN {AGE} < 25 THEN '18-25' WHEN {AGE} < 35 THEN '26-35'
    WHEN {AGE} < 45 THEN '36-45' WHEN {AGE} < 55 THEN '46-55' WHEN {AGE} < 65 THEN '56-65' ELSE '65+' END"""
add("age_group", f"SELECT customer_id, {AGE} AS age, {BAND} AS age_group FROM customers")
add("risk_category", """SELECT c_custkey, credit_score, CASE WHEN credit_score >= 750 THEN 'low' WHEN credit_score >= 650 THEN 'medium'
    WHEN credit_score >= 550 THEN 'high' ELSE 'very_high' END AS risk_category
    FROM (SELECT c_custkey, CAST(floor(c_acctbal / 25) + 400 AS INTEGER) AS credit_score FROM customer)""")
add("txn_description", """SELECT transaction_sk, CASE transaction_type WHEN 'debit' THEN 'Purchase at' WHEN 'credit' THEN 'Refund from'
    WHEN 'transfer' THEN 'Transfer to/from' WHEN 'atm_withdrawal' THEN 'ATM withdrawal at'
    WHEN 'direct_deposit' THEN 'Direct deposit from' ELSE transaction_type END || ' ' || merchant_category AS description FROM ev""")
add("weekend_payday_flags", """SELECT o_orderkey, isodow(o_orderdate) >= 6 AS is_weekend, day(o_orderdate) IN (1, 15) AS is_payday
    FROM orders""")
add("empty_in_empty_out", REVENUE.format(where="WHERE amount < 0"))

# --- joins ------------------------------------------------------------------------------------------------
add("facts_key_lookup_left", """SELECT transaction_id, c.customer_sk, p.product_sk, b.branch_sk FROM facts f
    LEFT JOIN customers c USING (customer_id) LEFT JOIN products p USING (product_id) LEFT JOIN branches b USING (branch_id)""")
add("facts_bound_as_of", """SELECT transaction_id, (
        SELECT arg_max(v.o_orderkey, (v.since, v.o_orderkey)) FROM (
            SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, CASE WHEN row_number() OVER (PARTITION BY o_custkey
                ORDER BY CAST(o_orderdate AS DATE), o_orderkey) = 1 THEN DATE '0001-01-01' ELSE CAST(o_orderdate AS DATE) END AS since
            FROM orders) v
        WHERE 'C' || v.o_custkey = r.customer_id AND v.since <= r.transaction_date) AS customer_sk, product_sk
    FROM raw_keyed r""")
add("facts_key_lookup_strict", """SELECT transaction_id, customer_sk, product_sk FROM raw_keyed
    WHERE customer_sk IS NOT NULL AND product_sk IS NOT NULL""")
add("customers_left_facts", """SELECT c.customer_id, count(f.transaction_id) AS n, max(full_date) AS last_date FROM customers c
    LEFT JOIN facts f ON c.customer_sk = f.customer_sk LEFT JOIN dates d ON f.date_key = d.date_key
    GROUP BY c.customer_sk, c.customer_id""")
add("product_pairs", """SELECT item_a, item_b, n_together, owners_a, owners_b, round(support_a, 4) AS support_a,
    round(support_b, 4) AS support_b FROM held_support""")
add("scd2_detect", "SELECT customer_id, CAST(old_version AS INTEGER) AS old_version, is_changed FROM compared")

# --- aggregations -----------------------------------------------------------------------------------------
add("agg_basic_by_customer", f"""SELECT customer_sk, count(*) AS n, {exact('sum(amount)', 'total')},
    CAST(sum(amount) AS DOUBLE) / count(amount) AS mean, {exact('min(amount)', 'low')}, {exact('max(amount)', 'high')}
    FROM facts GROUP BY 1""")
add("agg_distinct_products", "SELECT customer_sk, count(DISTINCT product_sk) AS product_count FROM facts GROUP BY 1")
CHANNEL_COUNTS = ", ".join(
    f"count(DISTINCT CASE WHEN channel = '{c}' THEN transaction_id END) AS {c.lower()}_tx_count"
    for c in ("Online", "Mobile", "ATM", "Branch")
)
add("agg_channel_counts", f"SELECT customer_sk, {CHANNEL_COUNTS} FROM facts GROUP BY 1")
CREDIT_DEBIT = ", ".join(
    exact(f"sum(CASE WHEN transaction_type = '{k}' THEN amount ELSE 0 END)", f"total_{k.lower()}s") for k in ("Credit", "Debit")
)
add("agg_credit_debit", f"SELECT customer_sk, {CREDIT_DEBIT} FROM facts GROUP BY 1")
add("agg_stddev", """SELECT customer_sk, CAST(sum(amount) AS DOUBLE) / count(amount) AS mean_amount,
    round(stddev_samp(CAST(amount AS DOUBLE)), 4) AS stddev_amount FROM facts GROUP BY 1""")


def lookback(day: str, prefix: str) -> str:
    return ", ".join(
        f"CAST(sum(CASE WHEN {day} >= {TODAY} - {w} THEN 1 ELSE 0 END) AS BIGINT) AS {prefix}{w}d" for w in (30, 60, 90)
    )


add("agg_lookback_counts", f"SELECT customer_sk, {lookback('transaction_date', 'txn_last_')} FROM facts GROUP BY 1")
RECENT = f"transaction_date >= {TODAY} - 30"
PRIOR = f"transaction_date >= {TODAY} - 60 AND transaction_date < {TODAY} - 30"
PERIODS = f"""sum(CASE WHEN {RECENT} THEN amount ELSE 0 END) AS amount_last_30d,
    sum(CASE WHEN {PRIOR} THEN amount ELSE 0 END) AS amount_prev_30d,
    CAST(sum(balance_after) FILTER (WHERE {RECENT}) AS DOUBLE) / count(balance_after) FILTER (WHERE {RECENT}) AS avg_balance_last_30d,
    CAST(sum(balance_after) FILTER (WHERE {PRIOR}) AS DOUBLE) / count(balance_after) FILTER (WHERE {PRIOR}) AS avg_balance_prev_30d"""
PERIOD_NAMES = ("amount_last_30d", "amount_prev_30d", "avg_balance_last_30d", "avg_balance_prev_30d")
add("agg_period_compare", f"""SELECT customer_sk, {', '.join(exact(n, n) for n in PERIOD_NAMES)}
    FROM (SELECT customer_sk, {PERIODS} FROM facts GROUP BY 1)""")
add("customer_products", "SELECT customer_sk, product_sk FROM held")
add("product_owner_counts", "SELECT product_sk, owners FROM held_owners")
add("product_pair_counts", "SELECT item_a, item_b, n_together FROM held_pairs")
add("merchant_risk", f"SELECT merchant_category, {rounded('fraud_rate', 'fraud_rate')} FROM ev_risk")
add("hourly_velocity", f"SELECT customer_sk, tx_hour, tx_count, {rounded('tx_per_hour', 'tx_per_hour')} FROM ev_velocity")

PRODUCT_CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
CATEGORIES = ("Withdrawal", "Purchase", "Deposit")
CHANNELS = ("Online", "Mobile", "ATM", "Branch", "POS")
PIVOT_COUNTS = ", ".join(
    f"count(amount) FILTER (WHERE product_category = '{c}') AS prod_count_{c}" for c in PRODUCT_CATEGORIES
)
PIVOT_CATEGORIES = ", ".join(
    exact(f"sum(CASE WHEN transaction_category = '{c}' THEN amount ELSE 0 END)", f"cat_spend_{c}") for c in CATEGORIES
)
PIVOT_CHANNELS = ", ".join(exact(f"sum(CASE WHEN channel = '{c}' THEN amount ELSE 0 END)", f"chan_spend_{c}") for c in CHANNELS)
add("pivot_product_counts", f"SELECT customer_sk, {PIVOT_COUNTS} FROM sold GROUP BY 1")
add("pivot_category_spend", f"SELECT customer_sk, {PIVOT_CATEGORIES} FROM facts GROUP BY 1")
add("pivot_channel_spend", f"SELECT customer_sk, {PIVOT_CHANNELS} FROM facts GROUP BY 1")
OWNS = ", ".join(f"max(CASE WHEN product_category = '{c}' THEN 1 ELSE 0 END) AS {c}" for c in PRODUCT_CATEGORIES)
add("ownership_matrix", f"SELECT customer_sk, {OWNS} FROM owned GROUP BY 1")
add("owned_categories", "SELECT customer_sk, string_agg(product_category, ',' ORDER BY product_category) AS product_category_set FROM owned GROUP BY 1")
add("affinity_matrix", "SELECT item_a, item_b, round(affinity, 4) AS affinity FROM affinity")
add("avg_affinity", """SELECT customer_sk, round(coalesce(avg(affinity), 0.0), 4) AS avg_affinity FROM owned a
    LEFT JOIN owned b USING (customer_sk)
    LEFT JOIN affinity ON item_a = a.product_category AND item_b = b.product_category AND item_a <> item_b GROUP BY 1""")

# --- windows and deduplication ----------------------------------------------------------------------------
add("lag_prev_tx", """SELECT transaction_sk, customer_sk, created_at,
    lag(created_at) OVER (PARTITION BY customer_sk ORDER BY created_at, transaction_sk) AS prev_tx_time FROM ev""")
add("running_balance", f"""SELECT transaction_sk, customer_sk, {exact('''sum(CASE WHEN transaction_type IN
    ('credit', 'direct_deposit', 'transfer') THEN amount ELSE -amount END)
    OVER (PARTITION BY customer_sk ORDER BY created_at, transaction_sk ROWS UNBOUNDED PRECEDING)''', 'balance')} FROM ev""")
add("dedup_keep_last", """SELECT user_id, event_id, ts, event_type, round(value, 4) AS value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
add("dedup_distinct", "SELECT DISTINCT customer_id, channel FROM facts")
add("customer_latest_version", """SELECT customer_id, customer_segment, city, effective_date, version FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY version DESC) AS rn FROM applied) WHERE rn = 1""")

# --- SCD2 -------------------------------------------------------------------------------------------------
add("scd2_changes", f"""SELECT {ALL_ATTRIBUTES}, {TODAY} AS effective_date, CAST(NULL AS DATE) AS expiry_date,
    true AS is_current, version FROM changes""")
add("scd2_tracked_subset", """SELECT customer_id, customer_segment, city, CAST(coalesce(old_version, 0) + 1 AS INTEGER) AS version
    FROM compared WHERE old_version IS NULL OR segment_changed""")
add("scd2_apply", "SELECT * FROM applied")
add("scd2_apply_next_day", f"""SELECT * REPLACE (CASE WHEN effective_date = {TODAY} THEN {TODAY} + 1 ELSE effective_date END AS effective_date)
    FROM applied""")

# --- data quality -----------------------------------------------------------------------------------------


def check(check_type: str, column: str, violations: str, message: str, source: str) -> str:
    return f"""SELECT '{check_type}' AS check_type, '{column}' AS columns, n = 0 AS passed, n AS violations,
        {message} AS message FROM (SELECT CAST({violations} AS BIGINT) AS n FROM {source})"""


def null_check(column: str) -> str:
    return check("not_null", column, f"count(*) - count({column})", f"'Column ''{column}'': ' || n || ' null(s) found.'", "customers")


def unique_check(column: str, source: str) -> str:
    distinct = f"count(DISTINCT {column}) + CAST(count(*) > count({column}) AS INTEGER)"
    return check("unique", column, f"count(*) - ({distinct})", f"'Column ''{column}'': ' || n || ' duplicate(s) found.'", source)


def set_check(column: str, allowed: str, source: str) -> str:
    return check("values_in_set", column, f"count(DISTINCT {column}) FILTER (WHERE {column} NOT IN ({allowed}))",
                 f"'Column ''{column}'': ' || n || ' invalid value(s).'", source)


MISSING_COLUMN = """SELECT 'not_null', 'no_such', false, CAST(NULL AS BIGINT), 'Column ''no_such'' does not exist.'"""
add("dq_not_null", " UNION ALL ".join([null_check(c) for c in ("customer_id", "phone", "gender")] + [MISSING_COLUMN]))
add("dq_unique", " UNION ALL ".join(
    [unique_check(c, "customers") for c in ("customer_id", "phone", "state")] + [unique_check("l_orderkey", "lineitem")]))
add("dq_values_in_set", set_check("o_orderstatus", "'O', 'F'", "orders") + " UNION ALL " + set_check(
    "o_orderpriority", "'1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'", "orders"))
add("dq_invalid_values", "SELECT DISTINCT o_orderstatus AS value FROM orders WHERE o_orderstatus NOT IN ('O', 'F')")
add("dq_range", """SELECT 'range' AS check_type, 'c_acctbal' AS columns, below + above = 0 AS passed, below + above AS violations,
    'Column ''c_acctbal'': ' || CASE WHEN below + above = 0 THEN 'all values in range.' ELSE concat_ws('; ',
        CASE WHEN below > 0 THEN below || ' value(s) below ' || lo END,
        CASE WHEN above > 0 THEN above || ' value(s) above ' || hi END) END AS message
    FROM (SELECT lo, hi, count(*) FILTER (WHERE c_acctbal < lo) AS below, count(*) FILTER (WHERE c_acctbal > hi) AS above
          FROM customer, (VALUES (0, 9000), (-1000, NULL), (NULL, 5000)) b(lo, hi) GROUP BY lo, hi)""")
REGEX = "count(*) FILTER (WHERE NOT regexp_matches(zip_code, '^\\d{5}$'))"
add("dq_regex", check("regex", "zip_code", REGEX, r"'Column ''zip_code'': ' || n || ' value(s) did not match pattern ''^\d{5}$''.'", "customers"))
add("dq_date_format", check(
    "date_format", "seen_at", "count(*) FILTER (WHERE event_type = 'error')",
    "'Column ''seen_at'': ' || n || ' value(s) failed to parse with format ''%Y-%m-%d %H:%M:%S.%f''.'", "events"))
ORPHANS = "SELECT DISTINCT customer_id AS value FROM raw_tx WHERE customer_id NOT IN (SELECT customer_id FROM customers)"
add("dq_referential", check("referential_integrity", "customer_id", "count(*)",
                            "'Column ''customer_id'': ' || n || ' orphaned value(s).'", f"({ORPHANS})"))
add("dq_orphans", ORPHANS)
add("dq_orphans_top20", ORPHANS + " ORDER BY value LIMIT 20")


def freshness(column: str, source: str, now: str) -> str:
    age = f"CAST(floor((epoch_us({now}) - epoch_us(max({column}))) / 86400000000.0) AS BIGINT)"
    return f"""SELECT 'freshness' AS check_type, '{column}' AS columns, ok AS passed, CAST(CASE WHEN ok THEN 0 ELSE 1 END AS BIGINT) AS violations,
        'Column ''{column}'': most recent date is ' || age || ' day(s) old (max allowed: 30).' AS message
        FROM (SELECT max({column}) >= {now} - INTERVAL 30 DAY AS ok, {age} AS age FROM {source})"""


add("dq_freshness", f"""{freshness('o_orderdate', 'orders', AS_OF)} UNION ALL {freshness('ts', 'events', EVENTS_NOW)}
    UNION ALL SELECT 'freshness', 'props', false, CAST(1 AS BIGINT), 'Column ''props'' has no parseable dates.'""")


def _set_rule(table: str, source: str, column: str, allowed: str) -> str:
    return f"""SELECT '{table}', 'values_in_set', '{column}', count(DISTINCT {column}) FROM {source}
        WHERE {column} NOT IN ({allowed})"""


add("dq_config_run", _rules(
    [_null_rule("dim_customer", "customers", c) for c in ("customer_id", "customer_name", "email")]
    + [_unique_rule("dim_customer", "customers", "customer_id"),
       _set_rule("dim_customer", "customers", "gender", "'Male', 'Female', 'Non-binary'"),
       _set_rule("dim_customer", "customers", "customer_segment", "'Premium', 'Regular', 'Basic'")]
    + [_null_rule("fact_transactions", "raw_keyed", c)
       for c in ("transaction_id", "customer_sk", "product_sk", "amount", "date_key")]
    + [_unique_rule("fact_transactions", "raw_keyed", "transaction_id"),
       "SELECT 'fact_transactions', 'range', 'amount', count(*) FILTER (WHERE amount < 0.01 OR amount > 1000000) FROM raw_keyed"]
    + [_null_rule("dim_product", "products", c) for c in ("product_id", "product_name")]
    + [_unique_rule("dim_product", "products", "product_id")]
) + " UNION ALL SELECT 'no_such_table', 'readable', '', false, CAST(NULL AS BIGINT)")


def report(part: str, details: str) -> str:
    return f"SELECT check_type, columns, passed, message, {details} AS details FROM ({part})"


MIXED = " UNION ALL ".join(
    [report(null_check(c), "'null_count=' || violations") for c in ("customer_id", "phone")]
    + [report(unique_check(c, "customers"), "'duplicate_count=' || violations") for c in ("customer_id", "email")]
    + [
        report(set_check("gender", "'Male', 'Female'", "customers"), "'invalid_value_count=' || violations"),
        report(
            check("regex", "zip_code", "count(*) FILTER (WHERE NOT regexp_matches(zip_code, '^\\d{5}$'))",
                  r"'Column ''zip_code'': ' || n || ' value(s) did not match pattern ''\d{5}$''.'", "customers"),
            r"'mismatch_count=' || violations || ';pattern=\d{5}$'",
        ),
        report(
            check("referential_integrity", "state", "count(*)", "'Column ''state'': ' || n || ' orphaned value(s).'",
                  "(SELECT DISTINCT state FROM customers WHERE state NOT IN (SELECT n_name FROM nation))"),
            "'orphan_count=' || violations",
        ),
        f"""SELECT 'freshness', 'effective_date', false,
            'Column ''effective_date'': most recent date is ' || age || ' day(s) old (max allowed: 30).',
            'age_days=' || age || ';max_age_days=30;most_recent=2000-01-01 00:00:00'
            FROM (SELECT date_diff('day', DATE '2000-01-01', {TODAY}) AS age FROM customers LIMIT 1)""",
        "SELECT 'range', '', false, 'Check raised an exception.', ''",
    ]
)
add("dq_report", MIXED)
add("dq_summary", f"""SELECT count(*) AS total, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed
    FROM ({MIXED})""")

# --- analytical tables ------------------------------------------------------------------------------------
JOINED = "customers c LEFT JOIN facts f ON c.customer_sk = f.customer_sk LEFT JOIN dates d ON f.date_key = d.date_key"
ELAPSED = f"(epoch_us({AS_OF}) - epoch_us(CAST(max(full_date) AS TIMESTAMP))) / 86400000000.0"
STATUS = "CASE WHEN days > 60 THEN 'Churned' WHEN days > 30 THEN 'At Risk' ELSE 'Active' END"
add("v_churn_risk", f"""SELECT customer_sk, customer_id, customer_name, customer_segment, total_transactions, last_transaction_date,
    CAST(trunc(days) AS INTEGER) AS days_since_last_txn, txn_last_30d, txn_last_60d, txn_last_90d, {STATUS} AS churn_status
    FROM (SELECT c.customer_sk, c.customer_id, customer_name, customer_segment, count(f.transaction_id) AS total_transactions,
                 max(full_date) AS last_transaction_date, {ELAPSED} AS days, {lookback('full_date', 'txn_last_')}
          FROM {JOINED} GROUP BY c.customer_sk, c.customer_id, customer_name, customer_segment)""")
add("v_cross_sell_affinity", """SELECT a.product_id AS product_a_id, a.product_name AS product_a_name,
    b.product_id AS product_b_id, b.product_name AS product_b_name, n_together,
    round(support_a, 4) AS support_a, round(support_b, 4) AS support_b,
    CAST(support_a > 0.1 OR support_b > 0.1 AS INTEGER) AS strong_affinity,
    round(support_a * (SELECT count(DISTINCT customer_sk) FROM held) / owners_b, 4) AS lift
    FROM held_support JOIN products a ON item_a = a.product_sk JOIN products b ON item_b = b.product_sk
    WHERE support_a >= 0.01 OR support_b >= 0.01""")
DESCRIBED = """c.customer_sk, c.customer_id, customer_name, gender, income_bracket, customer_segment, city, state,
    account_open_date, date_of_birth"""
FEATURES = f"""coalesce({AGE}, 0) AS age,
    round(date_diff('day', account_open_date, {TODAY}) / 30.0, 4) AS tenure_months, count(f.transaction_id) AS total_transactions,
    {CREDIT_DEBIT}, coalesce(CAST(sum(amount) AS DOUBLE) / count(amount), 0.0) AS avg_transaction_amount,
    round(coalesce(stddev_samp(CAST(amount AS DOUBLE)), 0.0), 4) AS stddev_transaction_amount,
    max(full_date) AS last_transaction_date,
    CAST(coalesce(date_diff('day', max(full_date), {TODAY}), 0) AS INTEGER) AS days_since_last_transaction,
    count(DISTINCT product_sk) AS product_count, {CHANNEL_COUNTS},
    coalesce(CAST(sum(balance_after) AS DOUBLE) / count(balance_after), 0.0) AS avg_balance FROM {JOINED} GROUP BY ALL"""
add("customer_features", f"SELECT {DESCRIBED}, {FEATURES}")
add("materialized_incremental", f"SELECT {DESCRIBED.removeprefix('c.customer_sk, ')}, {FEATURES}")
add("churn_features", f""", s AS (
    SELECT customer_sk, max(transaction_date) AS last_date, count(*) AS n, {lookback('transaction_date', 'tx_count_last_')},
           {PERIODS}, count(DISTINCT product_sk) AS products FROM facts GROUP BY 1)
    SELECT c.customer_sk, customer_id, income_bracket, customer_segment,
           round(date_diff('day', account_open_date, {TODAY}) / 30.0, 4) AS tenure_months,
           CAST(coalesce(date_diff('day', last_date, {TODAY}), 0) AS INTEGER) AS days_since_last_transaction,
           coalesce(tx_count_last_30d, 0) AS tx_count_last_30d, coalesce(tx_count_last_60d, 0) AS tx_count_last_60d,
           coalesce(tx_count_last_90d, 0) AS tx_count_last_90d, coalesce(n, 0) AS lifetime_tx_count,
           {', '.join(exact(f'coalesce({n}, 0)', n) for n in PERIOD_NAMES)},
           {rounded('''coalesce(CASE WHEN amount_prev_30d > 0 THEN (CAST(amount_last_30d AS DOUBLE) - CAST(amount_prev_30d AS DOUBLE))
               / CAST(amount_prev_30d AS DOUBLE) ELSE 0 END, 0)''', 'amount_trend')},
           {rounded('''coalesce(CASE WHEN avg_balance_prev_30d > 0 THEN (avg_balance_last_30d - avg_balance_prev_30d)
               / avg_balance_prev_30d ELSE 0 END, 0)''', 'balance_trend')},
           coalesce(products, 0) AS product_count,
           CAST(coalesce(date_diff('day', last_date, {TODAY}) >= 60, false) AS INTEGER) AS is_inactive
    FROM customers c LEFT JOIN s ON c.customer_sk = s.customer_sk""")
add("cross_sell_features", f"""SELECT sold.customer_sk, string_agg(DISTINCT product_category, ',' ORDER BY product_category) AS current_products,
    {PIVOT_COUNTS}, {PIVOT_CATEGORIES}, {PIVOT_CHANNELS}, income_bracket, {BAND} AS age_group
    FROM sold JOIN customers ON sold.customer_sk = customers.customer_sk GROUP BY sold.customer_sk, income_bracket, date_of_birth""")
SNAP = "DATE '1999-06-30'"
add("customer_snapshot", f"""SELECT CAST(19990630 AS INTEGER) AS date_key, c.customer_sk, count(f.transaction_id) AS total_transactions,
    {exact('coalesce(sum(amount), 0)', 'total_amount')},
    coalesce(CAST(sum(amount) AS DOUBLE) / count(amount), 0.0) AS avg_transaction_amount,
    {exact('coalesce(max(balance_after), 0)', 'account_balance')}, count(DISTINCT product_sk) AS num_products,
    CAST(coalesce(date_diff('day', max(transaction_date), {SNAP}), 0) AS INTEGER) AS days_since_last_transaction,
    coalesce(max(transaction_date) >= {SNAP} - 30, false) AS is_active
    FROM customers c LEFT JOIN facts f ON c.customer_sk = f.customer_sk AND transaction_date <= {SNAP} GROUP BY c.customer_sk""")
add("product_performance", f"""SELECT p.product_sk, p.product_id, product_name, product_category, product_type,
    count(f.transaction_id) AS transaction_count, count(DISTINCT customer_sk) AS customer_count,
    {exact('coalesce(sum(amount), 0)', 'total_revenue')},
    coalesce(CAST(sum(amount) AS DOUBLE) / count(amount), 0.0) AS avg_transaction_amount,
    coalesce(CAST(sum(balance_after) AS DOUBLE) / count(balance_after), 0.0) AS avg_balance,
    min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date
    FROM products p LEFT JOIN facts f ON p.product_sk = f.product_sk WHERE is_active GROUP BY ALL""")
GAP = """coalesce((epoch_us(created_at) - epoch_us(lag(created_at)
    OVER (PARTITION BY customer_sk ORDER BY created_at, transaction_sk))) / 1e6, 0.0)"""
add("fraud_features", f"""SELECT transaction_sk, customer_sk, {exact('amount', 'amount')}, merchant_category,
    CASE WHEN k < 25 THEN 'Online' WHEN k < 50 THEN 'Mobile' WHEN k < 75 THEN 'ATM' ELSE 'Branch' END AS channel, created_at,
    CAST(hour(created_at) AS INTEGER) AS tx_hour, {rounded(ZSCORE, 'amount_zscore')}, {GAP} AS time_since_last_tx,
    {rounded('coalesce(fraud_rate, 0)', 'merchant_risk_score')}, CAST(hour(created_at) < 6 AS INTEGER) AS unusual_hour_flag,
    {rounded('coalesce(tx_per_hour, 0)', 'hourly_velocity')}
    FROM ev LEFT JOIN ev_stats USING (customer_sk) LEFT JOIN ev_risk USING (merchant_category)
    LEFT JOIN ev_velocity v USING (customer_sk) WHERE v.tx_hour = hour(created_at)""")
add("materialized_row_counts", """SELECT 'vw_customer_features' AS table_name, count(*) AS n FROM customers
    UNION ALL SELECT 'vw_churn_features', count(*) FROM customers
    UNION ALL SELECT 'vw_cross_sell_features', count(DISTINCT customer_sk) FROM ev JOIN customers USING (customer_sk) JOIN products ON k = product_sk
    UNION ALL SELECT 'vw_product_performance', count(*) FROM products WHERE is_active
    UNION ALL SELECT 'vw_regional_analysis', count(DISTINCT (state, city)) FROM ev JOIN customers USING (customer_sk)
    UNION ALL SELECT 'vw_fraud_detection_features', count(*) FROM ev""")

# --- loads ------------------------------------------------------------------------------------------------
add("load_initial_facts", f"""SELECT transaction_id, date_key, customer_id, CAST(1 AS INTEGER) AS version, product_id,
    {exact('amount', 'amount')}, b.branch_id, {exact('fee', 'fee')}, status FROM facts LEFT JOIN branches b USING (branch_id)""")
add("facts_transform", f"""SELECT transaction_id, transaction_date, date_key, customer_sk, product_sk, {exact('amount', 'amount')}
    FROM loaded""")
add("load_full", f"""SELECT transaction_id, date_key, customer_id, CAST(1 AS INTEGER) AS version, product_id, {exact('amount', 'amount')}
    FROM loaded""")
for _name in ("load_incremental", "load_stream_facts"):
    _version = "CASE WHEN date_key >= 19990101 AND is_changed THEN 2 ELSE 1 END" if _name == "load_incremental" else "1"
    add(_name, f"""SELECT transaction_id, date_key, l.customer_id, CAST({_version} AS INTEGER) AS version, product_id,
        {exact('amount', 'amount')} FROM loaded l JOIN compared c ON l.customer_id = c.customer_id""")
add("warehouse_end_to_end", f"""SELECT customer_id, customer_name, customer_segment, total_transactions, last_transaction_date,
    CAST(trunc(days) AS INTEGER) AS days_since_last_txn, txn_last_30d, txn_last_60d, txn_last_90d, {STATUS} AS churn_status,
    version, effective_date
    FROM (SELECT c.customer_id, c.customer_name, c.customer_segment, count(f.transaction_id) AS total_transactions,
                 max(full_date) AS last_transaction_date, {ELAPSED} AS days, {lookback('full_date', 'txn_last_')},
                 CAST(CASE WHEN is_changed THEN 2 ELSE 1 END AS INTEGER) AS version,
                 CASE WHEN is_changed THEN {TODAY} + 1 ELSE {TODAY} END AS effective_date
          FROM compared c LEFT JOIN facts f ON c.customer_id = f.customer_id AND NOT is_changed
          LEFT JOIN dates d ON f.date_key = d.date_key
          GROUP BY c.customer_id, c.customer_name, c.customer_segment, is_changed)""")

add("src_csv_quoted_text", r"""SELECT CAST(doc_id AS VARCHAR) AS customer_id,
    md5(' "' || translate(text, chr(10) || chr(13), '  ') || '", ') AS name FROM documents""")
add("src_csv_mixed_headers", "SELECT doc_id, lang, source FROM documents")
add("sink_csv_text_roundtrip", """SELECT doc_id, md5('  "' || text || '" ,""' || chr(10) || ' x ') AS text FROM documents""")
add("load_null_keys_twice", "SELECT 'P' || p_partkey AS product_id, p_name AS product_name FROM part WHERE p_size > 5")
add("load_rejected_rows", """SELECT DISTINCT 'fact_transactions' AS table_name, 'amount' AS columns, transaction_id
    FROM facts WHERE fee = 0""")
add("load_customer_snapshot", f"""SELECT c.customer_id, CAST(19990630 AS INTEGER) AS date_key, CAST(count(f.transaction_id) AS INTEGER) AS total_transactions,
    {exact('coalesce(sum(amount), 0)', 'total_amount')}, CAST(count(DISTINCT product_sk) AS INTEGER) AS num_products,
    CAST(coalesce(date_diff('day', max(transaction_date), {SNAP}), 0) AS INTEGER) AS days_since_last_transaction,
    coalesce(max(transaction_date) >= {SNAP} - 30, false) AS is_active
    FROM customers c LEFT JOIN facts f ON c.customer_sk = f.customer_sk AND transaction_date <= {SNAP} GROUP BY c.customer_id""")
add("stored_views", "SELECT 'all' AS warehouse, * FROM (" + REVENUE.format(where="") + """)
    UNION ALL SELECT 'early' AS warehouse, * FROM (""" + REVENUE.format(where="WHERE transaction_date < DATE '1996-01-01'") + ")")
add("dq_isolated_failures", """SELECT 'not_null' AS check_type, 'p_brand' AS columns, count(*) FILTER (p_brand IS NULL) = 0 AS passed,
        count(*) FILTER (p_brand IS NULL) AS violations FROM part
    UNION ALL SELECT 'regex', '', false, NULL
    UNION ALL SELECT 'values_in_set', 'p_brand', count(DISTINCT p_brand) = 0, count(DISTINCT p_brand) FROM part WHERE p_brand <> 'Brand#11'
    UNION ALL SELECT 'values_in_set', 'p_name', count(DISTINCT p_name) = 0, count(DISTINCT p_name) FROM part""")
add("dq_offending_values", """SELECT DISTINCT 'values_in_set' AS check_type, 'p_brand' AS columns, p_brand AS value FROM part WHERE p_brand <> 'Brand#11'
    UNION ALL SELECT DISTINCT 'referential_integrity', 'p_size', CAST(p_size AS VARCHAR) FROM part
    WHERE p_size NOT IN (SELECT n_nationkey FROM nation)""")
