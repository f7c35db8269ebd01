"""DuckDB oracle SQL for every registered query.

Each oracle is one statement: the fixture views as CTEs (the DuckDB text of
``riskview.fixtures``) followed by the query.  Column names and types are
aliased to match the Spark result exactly.
"""

from __future__ import annotations

RUN = "TIMESTAMP '2024-01-31 00:00:00'"
RUN2 = "TIMESTAMP '2024-02-29 00:00:00'"
OPEN_END = "TIMESTAMP '9999-12-31 00:00:00'"

PRELUDE = """WITH customers AS (
  SELECT c_custkey AS customer_id, c_name AS full_name,
         DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS date_of_birth,
         lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0')
           || '-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS ssn,
         CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN 'no-at-sign'
              ELSE 'user' || CAST(c_custkey AS VARCHAR) || '@mail' || CAST(c_custkey % 3 AS VARCHAR) || '.example' END AS email,
         CASE WHEN c_custkey % 4 = 1 THEN NULL ELSE 'PH-' || CAST(c_custkey AS VARCHAR) END AS phone,
         n_name AS country, c_mktsegment AS customer_segment,
         CASE WHEN c_custkey % 5 = 0 THEN 'Y' ELSE 'N' END AS pep_flag, c_nationkey
  FROM customer JOIN nation ON c_nationkey = n_nationkey
), beneficiary AS (
  SELECT l_orderkey, min(s_nationkey) AS beneficiary_nation
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey
), transactions AS (
  SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, o_orderdate AS txn_date, o_totalprice AS amount,
         o_orderpriority AS txn_type, CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'PENDING' ELSE 'FAILED' END AS status,
         CASE WHEN beneficiary_nation <> c_nationkey THEN 'Y' ELSE 'N' END AS cross_border_flag
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN beneficiary ON l_orderkey = o_orderkey
), kyc_documents AS (
  SELECT o_orderkey AS doc_id, o_custkey AS customer_id, o_orderpriority AS doc_type,
         CASE o_orderstatus WHEN 'F' THEN 'VERIFIED' WHEN 'P' THEN 'PENDING' ELSE 'EXPIRED' END AS doc_status,
         CAST(o_orderdate AS DATE) AS verification_date,
         CAST(CAST(o_orderdate AS DATE) + INTERVAL 365 DAY AS DATE) AS expiry_date
  FROM orders
), watchlist AS (
  SELECT s_suppkey AS watchlist_id, replace(s_name, 'Supplier', 'Customer') AS entity_name,
         CASE WHEN s_suppkey % 2 = 0 THEN 'OFAC' ELSE 'UN' END AS list_type,
         'entity of nation ' || CAST(s_nationkey AS VARCHAR) AS designation FROM supplier
), activity AS (
  SELECT c_custkey AS account_id, c_custkey AS customer_id, c_acctbal AS balance,
         CASE WHEN c_acctbal >= 7000 THEN 'HIGH' WHEN c_acctbal >= 3000 THEN 'MID' ELSE 'LOW' END AS balance_tier,
         CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-08-01') AS BIGINT) AS days_since_activity,
         CASE WHEN date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2001-08-01') > 365 THEN 'Y' ELSE 'N' END AS dormant_flag
  FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_acctbal
), customers_v2 AS (
  SELECT customer_id, full_name,
         CASE WHEN customer_id % 10 = 0 THEN 'CHANGED' ELSE customer_segment END AS customer_segment,
         CASE WHEN customer_id % 10 = 3 THEN 'NATION_X' ELSE country END AS country,
         CASE WHEN customer_id % 20 = 1 THEN 'PH-NEW' ELSE phone END AS phone, pep_flag
  FROM customers WHERE customer_id % 10 <> 7
  UNION ALL
  SELECT customer_id + 1000000, full_name, customer_segment, country, phone, pep_flag
  FROM customers WHERE customer_id % 50 = 0
)"""

# Derived views shared by several oracles (DuckDB ignores unreferenced CTEs).
DERIVED = f"""
, velocity AS (
  SELECT customer_id, count(transaction_id) AS txn_count,
         CAST(round(sum(CAST(amount AS DECIMAL(18,2))), 2) AS DOUBLE) AS txn_total_amt,
         CAST(count_if(cross_border_flag = 'Y') AS BIGINT) AS cross_border_count
  FROM transactions WHERE status = 'SUCCESS' GROUP BY customer_id
), velocity_risk AS (
  SELECT *, CASE WHEN txn_count > 20 OR txn_total_amt > 1000000 THEN 'HIGH'
                 WHEN txn_count > 10 OR txn_total_amt > 500000 THEN 'MEDIUM' ELSE 'LOW' END AS velocity_risk
  FROM velocity
), latest_doc AS (
  SELECT * FROM kyc_documents
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY verification_date DESC, doc_id DESC) = 1
), latest_acct AS (
  SELECT * FROM activity
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY days_since_activity ASC, account_id ASC) = 1
), wl_names AS (
  SELECT DISTINCT entity_name FROM watchlist WHERE entity_name IS NOT NULL
), scd2_first AS (
  SELECT customer_id, full_name, customer_segment, country, phone, pep_flag,
         {RUN} AS effective_from, {OPEN_END} AS effective_to, TRUE AS is_current
  FROM customers
), scd2_pair AS (
  SELECT o.customer_id, o.full_name AS o_full_name, o.customer_segment AS o_customer_segment,
         o.country AS o_country, o.phone AS o_phone, o.pep_flag AS o_pep_flag, o.effective_from AS o_effective_from,
         n.full_name AS n_full_name, n.customer_segment AS n_customer_segment, n.country AS n_country,
         n.phone AS n_phone, n.pep_flag AS n_pep_flag
  FROM scd2_first o JOIN customers_v2 n ON o.customer_id = n.customer_id
  WHERE o.is_current AND (o.customer_segment IS DISTINCT FROM n.customer_segment
        OR o.country IS DISTINCT FROM n.country OR o.phone IS DISTINCT FROM n.phone)
), scd2_all AS (
  SELECT * FROM scd2_first WHERE NOT is_current
  UNION ALL
  SELECT * FROM scd2_first f WHERE is_current
    AND NOT EXISTS (SELECT 1 FROM scd2_pair p WHERE p.customer_id = f.customer_id)
  UNION ALL
  SELECT customer_id, o_full_name, o_customer_segment, o_country, o_phone, o_pep_flag,
         o_effective_from, {RUN2}, FALSE FROM scd2_pair
  UNION ALL
  SELECT customer_id, n_full_name, n_customer_segment, n_country, n_phone, n_pep_flag,
         {RUN2}, {OPEN_END}, TRUE FROM scd2_pair
  UNION ALL
  SELECT n.customer_id, n.full_name, n.customer_segment, n.country, n.phone, n.pep_flag,
         {RUN2}, {OPEN_END}, TRUE
  FROM customers_v2 n WHERE NOT EXISTS (SELECT 1 FROM scd2_first f WHERE f.customer_id = n.customer_id)
), current_customers AS (
  SELECT customer_id, full_name, country, customer_segment, pep_flag, effective_from, effective_to, is_current
  FROM scd2_first WHERE is_current
), screened AS (
  SELECT c.*, (w.entity_name IS NOT NULL) AS aml_flag
  FROM current_customers c LEFT JOIN wl_names w ON c.full_name = w.entity_name
), signals AS (
  SELECT s.*, v.txn_count, v.txn_total_amt, v.cross_border_count, v.velocity_risk,
         d.doc_status, d.expiry_date, a.dormant_flag, a.days_since_activity, a.balance_tier
  FROM screened s
  LEFT JOIN velocity_risk v ON v.customer_id = s.customer_id
  LEFT JOIN latest_doc d ON d.customer_id = s.customer_id
  LEFT JOIN latest_acct a ON a.customer_id = s.customer_id
), scored0 AS (
  SELECT *, (CASE velocity_risk WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 0 END
           + CASE doc_status WHEN 'EXPIRED' THEN 3 WHEN 'PENDING' THEN 2 ELSE 0 END
           + CASE WHEN dormant_flag = 'Y' THEN 2 ELSE 0 END
           + CASE WHEN pep_flag = 'Y' THEN 3 ELSE 0 END) AS risk_score
  FROM signals
), scored AS (
  SELECT *, CASE WHEN risk_score >= 6 THEN 'HIGH' WHEN risk_score >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS kyc_risk_level,
         coalesce(dormant_flag = 'Y' AND doc_status = 'EXPIRED', FALSE) AS dormancy_alert,
         coalesce(pep_flag = 'Y' AND cross_border_count > 0 AND aml_flag, FALSE) AS high_risk_profile
  FROM scored0
), customer_360 AS (
  SELECT customer_id, full_name, country, customer_segment, pep_flag, doc_status, expiry_date,
         txn_count, txn_total_amt, cross_border_count, velocity_risk, dormant_flag, days_since_activity,
         balance_tier, risk_score, kyc_risk_level, aml_flag, dormancy_alert, high_risk_profile,
         effective_from, effective_to, is_current, {RUN} AS gold_timestamp
  FROM scored
)"""

WITH = PRELUDE + DERIVED + "\n"

LINEITEM_ORDER = ("l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, "
                  "l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, "
                  "l_linestatus DESC")

_BODIES: dict[str, str] = {
    "ingest_metadata": f"""SELECT *, {RUN} AS ingestion_timestamp, 'customer.parquet' AS source_file,
        'batch' AS pipeline, CAST(year({RUN}) AS INTEGER) AS ingest_year,
        CAST(month({RUN}) AS INTEGER) AS ingest_month, CAST(day({RUN}) AS INTEGER) AS ingest_day
        FROM customer""",
    "silver_metadata": f"""SELECT *, {RUN} AS silver_timestamp, CAST(year({RUN}) AS INTEGER) AS silver_year,
        CAST(month({RUN}) AS INTEGER) AS silver_month, CAST(day({RUN}) AS INTEGER) AS silver_day
        FROM transactions""",
    "mask_ssn": "SELECT customer_id, '***-**-' || substring(ssn, 8, 4) AS ssn FROM customers",
    "mask_dob_year": "SELECT customer_id, substring(CAST(date_of_birth AS VARCHAR), 1, 4) AS date_of_birth FROM customers",
    "mask_email": """SELECT customer_id, substring(email, 1, 1) || '***@' || str_split(email, '@')[2] AS email
        FROM customers""",
    "mask_customer_pii": """SELECT customer_id, full_name,
        substring(CAST(date_of_birth AS VARCHAR), 1, 4) AS date_of_birth, '***-**-' || substring(ssn, 8, 4) AS ssn,
        substring(email, 1, 1) || '***@' || str_split(email, '@')[2] AS email,
        phone, country, customer_segment, pep_flag, c_nationkey FROM customers""",
    "dedup_latest": "SELECT * FROM latest_doc",
    "latest_document_per_customer": "SELECT customer_id, doc_status, expiry_date FROM latest_doc",
    "dedup_lineitem": f"""SELECT * FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINEITEM_ORDER}) = 1""",
    "scd2_first_load": "SELECT * FROM scd2_first",
    "scd2_changed_keys": "SELECT customer_id FROM scd2_pair",
    "scd2_apply_all": "SELECT * FROM scd2_all",
    "scd2_current": "SELECT * FROM scd2_all WHERE is_current",
    "scd2_history": "SELECT * FROM scd2_all WHERE NOT is_current",
    "scd2_summary": """SELECT count(*) AS total, count_if(is_current) AS current,
        count_if(NOT is_current) AS expired FROM scd2_all""",
    "watchlist_names": "SELECT entity_name FROM wl_names",
    "watchlist_screen": """SELECT c.customer_id, c.full_name, c.country, c.pep_flag,
        (w.entity_name IS NOT NULL) AS aml_flag
        FROM customers c LEFT JOIN wl_names w ON c.full_name = w.entity_name""",
    "screen_summary": """SELECT count(*) AS screened, count_if(w.entity_name IS NOT NULL) AS hits,
        count_if(w.entity_name IS NULL) AS clean
        FROM customers c LEFT JOIN wl_names w ON c.full_name = w.entity_name""",
    "fuzzy_screen": """SELECT customer_id, entity_name, distance FROM (
        SELECT c.customer_id, w.entity_name, CAST(levenshtein(c.full_name, w.entity_name) AS INTEGER) AS distance
        FROM customers c JOIN wl_names w ON levenshtein(c.full_name, w.entity_name) <= 1
        WHERE c.full_name IS NOT NULL)
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY distance, entity_name) = 1""",
    "velocity_profile": "SELECT * FROM velocity",
    "velocity_profile_30d": """SELECT customer_id, count(transaction_id) AS txn_count,
        CAST(round(sum(CAST(amount AS DECIMAL(18,2))), 2) AS DOUBLE) AS txn_total_amt,
        CAST(count_if(cross_border_flag = 'Y') AS BIGINT) AS cross_border_count
        FROM transactions WHERE status = 'SUCCESS'
          AND txn_date > TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 30 DAY
          AND txn_date <= TIMESTAMP '2001-08-01 00:00:00'
        GROUP BY customer_id""",
    "velocity_risk": "SELECT * FROM velocity_risk",
    "velocity_distribution": "SELECT velocity_risk, count(*) AS count FROM velocity_risk GROUP BY velocity_risk",
    "customer_signals": "SELECT * FROM signals",
    "risk_score": "SELECT customer_id, risk_score FROM scored",
    "risk_level": "SELECT customer_id, kyc_risk_level FROM scored",
    "dormancy_alert": "SELECT customer_id, dormancy_alert FROM scored",
    "high_risk_profile": "SELECT customer_id, high_risk_profile FROM scored",
    "customer_360": "SELECT * FROM customer_360",
    "external_view_customer_360": """SELECT CAST(customer_id AS VARCHAR) AS customer_id, full_name, country,
        customer_segment, pep_flag, doc_status, CAST(expiry_date AS VARCHAR) AS expiry_date, txn_count,
        txn_total_amt, cross_border_count, velocity_risk, dormant_flag, days_since_activity, balance_tier,
        CAST(risk_score AS BIGINT) AS risk_score, kyc_risk_level, aml_flag, dormancy_alert, high_risk_profile
        FROM customer_360""",
    "risk_distribution": """SELECT kyc_risk_level, count(*) AS count FROM customer_360
        GROUP BY kyc_risk_level ORDER BY kyc_risk_level""",
    "gold_summary": """SELECT count(*) AS total, count_if(kyc_risk_level = 'HIGH') AS high,
        count_if(kyc_risk_level = 'MEDIUM') AS medium, count_if(kyc_risk_level = 'LOW') AS low,
        count_if(aml_flag) AS aml, count_if(dormancy_alert) AS dormancy,
        count_if(high_risk_profile) AS high_risk FROM customer_360""",
    "alert_list": """SELECT 'aml' AS alert_type, customer_id FROM customer_360 WHERE aml_flag
        UNION ALL SELECT 'dormancy', customer_id FROM customer_360 WHERE dormancy_alert
        UNION ALL SELECT 'high_risk_profile', customer_id FROM customer_360 WHERE high_risk_profile""",
    "preview_top_n": "SELECT * FROM customer_360 ORDER BY customer_id LIMIT 10",
}

_TABLE_COLUMNS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6,
                  "orders": 6, "lineitem": 11, "events": 6, "documents": 5,
                  "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3,
                  "conversations": 4}

_SILVER_VIEWS = {
    "customer_onboarding": ("customers", ("customer_id", "full_name", "ssn", "date_of_birth",
                            "email", "phone", "country", "pep_flag"), ("effective_from",
                            "effective_to", "is_current"), ()),
    "transaction_feed": ("transactions", ("transaction_id", "customer_id", "amount",
                         "cross_border_flag", "txn_type", "status"), (), ()),
    "kyc_documents": ("latest_doc", ("doc_id", "customer_id", "doc_status", "doc_type",
                      "expiry_date"), (), ()),
    "watchlist_sanctions": ("watchlist", ("watchlist_id", "entity_name", "list_type",
                            "designation"), (), ()),
    "account_activity": ("activity", ("account_id", "customer_id", "dormant_flag",
                         "days_since_activity", "balance_tier"), (), ()),
}
def _schema_report_sql() -> str:
    parts = []
    for t, (view, present, constant, missing) in _SILVER_VIEWS.items():
        passed = "FALSE" if missing else "TRUE"
        for c in present:
            # masked columns keep the NULLs of their source (a NULL e-mail
            # stays NULL, and so does an address without '@')
            expr = c
            if t == "customer_onboarding" and c == "email":
                expr = "substring(email, 1, 1) || '***@' || str_split(email, '@')[2]"
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, TRUE AS present, "
                         f"count_if(({expr}) IS NULL) AS null_count, {passed} AS table_passed FROM {view}")
        for c in constant:
            parts.append(f"SELECT '{t}', '{c}', TRUE, CAST(0 AS BIGINT), {passed}")
        for c in missing:
            parts.append(f"SELECT '{t}', '{c}', FALSE, CAST(NULL AS BIGINT), {passed}")
    return "\nUNION ALL ".join(parts)


_BODIES.update({
    "dim_customer": """SELECT row_number() OVER (ORDER BY customer_id, effective_from) AS customer_key, *
        FROM (SELECT DISTINCT customer_id, full_name, country, customer_segment, pep_flag,
              effective_from, effective_to, is_current FROM scd2_all)""",
    "dim_document_status": """SELECT row_number() OVER (ORDER BY customer_id) AS kyc_key, customer_id,
        doc_status, doc_type, CAST(expiry_date AS VARCHAR) AS expiry_date, 'unknown' AS verified_by
        FROM latest_doc""",
    "dim_date": """SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key,
        d AS full_date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
        CAST(day(d) AS INTEGER) AS day, CAST(quarter(d) AS INTEGER) AS quarter, monthname(d) AS month_name
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders))""",
    "fact_customer_risk": f"""SELECT row_number() OVER (ORDER BY customer_id) AS risk_key, customer_id,
        CAST(year({RUN}) * 10000 + month({RUN}) * 100 + day({RUN}) AS INTEGER) AS date_key,
        txn_count, txn_total_amt, cross_border_count, risk_score, kyc_risk_level,
        coalesce(aml_flag, FALSE) AS aml_flag, coalesce(dormancy_alert, FALSE) AS dormancy_alert,
        coalesce(high_risk_profile, FALSE) AS high_risk_profile, velocity_risk,
        days_since_activity, balance_tier FROM customer_360""",
    "fact_two_runs": f"""SELECT row_number() OVER (ORDER BY date_key, customer_id) AS risk_key, customer_id, date_key,
        txn_count, txn_total_amt, cross_border_count, risk_score, kyc_risk_level, aml_flag, dormancy_alert,
        high_risk_profile, velocity_risk, days_since_activity, balance_tier
        FROM customer_360 CROSS JOIN (VALUES (20240131), (20240229)) AS days(date_key)""",
    "dim_customer_reload": """SELECT CAST(CASE WHEN run = 1 THEN k ELSE k + (SELECT count(*) FROM scd2_first) END AS BIGINT)
        AS customer_key, * EXCLUDE (run, k) FROM (
          SELECT *, row_number() OVER (PARTITION BY run ORDER BY customer_id, effective_from) AS k FROM (
            SELECT customer_id, full_name, country, customer_segment, pep_flag, effective_from, effective_to, is_current,
                   CASE WHEN effective_from = (SELECT min(effective_from) FROM scd2_all) THEN 1 ELSE 2 END AS run
            FROM scd2_all))""",
    "dim_document_status_reload": """SELECT CAST(CASE WHEN customer_id % 2 = 0 THEN k
          ELSE k + (SELECT count(*) FROM latest_doc WHERE customer_id % 2 = 0) END AS BIGINT) AS kyc_key,
        customer_id, doc_status, doc_type, CAST(expiry_date AS VARCHAR) AS expiry_date, 'unknown' AS verified_by
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id % 2 ORDER BY customer_id) AS k FROM latest_doc)""",
    "star_rollup": f"""SELECT d.customer_segment, d.country, k.doc_status, CAST(year({RUN}) AS INTEGER) AS year,
        CAST(month({RUN}) AS INTEGER) AS month, f.kyc_risk_level, count(*) AS customers,
        CAST(round(sum(CAST(f.txn_total_amt AS DECIMAL(18,2))), 2) AS DOUBLE) AS total_amount,
        avg(f.risk_score) AS avg_score
        FROM customer_360 f JOIN scd2_all d ON d.customer_id = f.customer_id AND d.is_current
        LEFT JOIN latest_doc k ON k.customer_id = f.customer_id
        GROUP BY d.customer_segment, d.country, k.doc_status, f.kyc_risk_level""",
    "dim_key_returns": """SELECT CAST(CASE WHEN customer_id % 3 <> 1 THEN k
          ELSE k + (SELECT count(*) FROM latest_doc WHERE customer_id % 3 <> 1) END AS BIGINT) AS kyc_key,
        customer_id, doc_status, doc_type, CAST(expiry_date AS VARCHAR) AS expiry_date, 'unknown' AS verified_by
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id % 3 = 1 ORDER BY customer_id) AS k FROM latest_doc)""",
    "star_as_of": f"""SELECT d.customer_segment, d.country, k.doc_status, CAST(year(r.ts) AS INTEGER) AS year,
        CAST(month(r.ts) AS INTEGER) AS month, f.kyc_risk_level, count(*) AS customers,
        CAST(round(sum(CAST(f.txn_total_amt AS DECIMAL(18,2))), 2) AS DOUBLE) AS total_amount,
        avg(f.risk_score) AS avg_score
        FROM customer_360 f CROSS JOIN (VALUES ({RUN}), ({RUN2})) r(ts)
        LEFT JOIN scd2_all d ON d.customer_id = f.customer_id
          AND d.effective_from < r.ts + INTERVAL 1 DAY AND d.effective_to >= r.ts + INTERVAL 1 DAY
        LEFT JOIN latest_doc k ON k.customer_id = f.customer_id
        GROUP BY d.customer_segment, d.country, k.doc_status, r.ts, f.kyc_risk_level""",
    "layer_row_counts_total": "SELECT * FROM (" + "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, {n} AS columns, "
        f"CAST(NULL AS VARCHAR) AS error FROM {t}" for t, n in _TABLE_COLUMNS.items())
        + ") UNION ALL SELECT 'TOTAL', CAST((" + " + ".join(
            f"(SELECT count(*) FROM {t})" for t in _TABLE_COLUMNS) + ") AS BIGINT), NULL, NULL",
    "layer_row_counts": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, {n} AS columns, "
        f"CAST(NULL AS VARCHAR) AS error FROM {t}"
        for t, n in _TABLE_COLUMNS.items()),
    "schema_report": _schema_report_sql(),
})

_META = (f"{RUN} AS ingestion_timestamp, CAST(year({RUN}) AS INTEGER) AS ingest_year, "
         f"CAST(month({RUN}) AS INTEGER) AS ingest_month, CAST(day({RUN}) AS INTEGER) AS ingest_day")

_BODIES.update({
    "bronze_partitioned_roundtrip": f"""SELECT *, 'orders.parquet' AS source_file, 'batch' AS pipeline, {_META}
        FROM orders""",
    "source_csv_customers": "SELECT * FROM customers",
    "source_ndjson_transactions": "SELECT * FROM transactions",
    "source_json_array_documents": "SELECT * FROM kyc_documents",
    "stream_ingest_events": f"SELECT *, 'stream' AS pipeline, {_META} FROM events",
    "stream_dedup_transactions": f"SELECT *, 'stream' AS pipeline, {_META} FROM transactions",
    "pipeline_customer_360": "SELECT * FROM customer_360",
    "pipeline_reference_files": """SELECT account_id, customer_id, balance, balance_tier,
        CAST(DATE '2001-08-01' - CAST(days_since_activity AS INTEGER) AS DATE) AS last_activity_date,
        days_since_activity, dormant_flag, TIMESTAMP '2024-01-30 10:00:00' AS batch_hour
        FROM (SELECT CAST(account_id AS VARCHAR) AS account_id, CAST(customer_id AS VARCHAR) AS customer_id,
              * EXCLUDE (account_id, customer_id) FROM activity)""",
    "source_nested_landing": "SELECT * FROM transactions",
    "source_corrupt_records": """SELECT 'transaction_feed' AS table_name, (SELECT count(*) FROM transactions) AS good,
        CAST(2 AS BIGINT) AS corrupt""",
    "silver_quarantine": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS rows, count(*) FILTER (NOT {bad}) AS good, "
        f"count(*) FILTER ({bad}) AS bad FROM {v}" for t, c, bad, v in (
            ("transaction_feed", "_corrupt_record", "(transaction_id % 7 = 3)", "transactions"),
            ("account_activity", "last_activity_date", "(customer_id % 7 = 3)", "activity"),
            ("account_activity", "batch_hour", "(customer_id % 11 = 5)", "activity"))),
    "scd2_stored_two_runs": "SELECT * FROM scd2_all",
    "scd2_corrected_rerun": "SELECT * FROM scd2_all",
    "fuzzy_screen_all_hits": """SELECT customer_id, w.entity_name,
        CAST(levenshtein(c.full_name, w.entity_name) AS INTEGER) AS distance
        FROM customers c JOIN wl_names w ON levenshtein(c.full_name, w.entity_name) <= 1
        WHERE c.full_name IS NOT NULL""",
})


def oracle_sql() -> dict[str, str]:
    return {k: WITH + v for k, v in _BODIES.items()}
