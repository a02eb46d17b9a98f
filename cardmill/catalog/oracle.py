"""DuckDB SQL that states the expected result of the queries, over the given tables only."""

from __future__ import annotations

VIEWS = {
    "transactions_data": """
SELECT o_orderkey AS id, cast(o_orderdate AS timestamp) AS date, o_custkey AS client_id,
       o_orderkey % (SELECT count(*) FROM supplier) AS card_id,
       concat('$', cast(cast(o_totalprice AS decimal(15,2)) AS varchar)) AS amount,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Online Transaction'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'Chip Transaction' ELSE 'Swipe Transaction' END AS use_chip,
       o_orderkey % 5000 AS merchant_id,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'ONLINE'
            ELSE concat('City ', cast(o_custkey % 97 AS varchar)) END AS merchant_city,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL
            WHEN o_custkey % 3 = 0 THEN 'CA' WHEN o_custkey % 3 = 1 THEN 'TX' ELSE 'NY' END AS merchant_state,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL
            ELSE cast(10000 + o_custkey % 89999 AS double) END AS zip,
       o_orderkey % (SELECT count(*) FROM part) AS mcc,
       CASE WHEN o_orderkey % 50 = 7 THEN 'Insufficient Balance' END AS errors
FROM orders""",
    "users_data": """
SELECT c_custkey AS id, cast(18 + c_custkey % 60 AS int) AS current_age, 66 AS retirement_age,
       cast(2020 - (18 + c_custkey % 60) AS int) AS birth_year, cast(1 + c_custkey % 12 AS int) AS birth_month,
       CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
       concat(cast(c_custkey AS varchar), ' Main Street') AS address,
       cast(30 + c_custkey % 15 AS double) AS latitude, cast(c_custkey % 45 - 120 AS double) AS longitude,
       concat('$', cast(cast(c_acctbal + 1000 AS decimal(15,2)) AS varchar)) AS per_capita_income,
       concat('$', cast(cast(c_acctbal + 2000 AS decimal(15,2)) AS varchar)) AS yearly_income,
       concat('$', cast(cast(c_acctbal AS decimal(15,2)) AS varchar)) AS total_debt,
       cast(500 + c_custkey % 350 AS int) AS credit_score, cast(1 + c_custkey % 6 AS int) AS num_credit_cards
FROM customer""",
    "cards_data": """
SELECT s_suppkey AS id, s_suppkey % (SELECT count(*) FROM customer) AS client_id,
       CASE s_suppkey % 4 WHEN 0 THEN 'Visa' WHEN 1 THEN 'Mastercard' WHEN 2 THEN 'Amex'
            ELSE 'Discover' END AS card_brand,
       CASE WHEN s_suppkey % 3 = 0 THEN 'Credit' ELSE 'Debit' END AS card_type,
       concat(cast(3 + s_suppkey % 4 AS varchar), cast(100000000000000 + s_suppkey * 7919 AS varchar)) AS card_number,
       concat(lpad(cast(1 + s_suppkey % 12 AS varchar), 2, '0'), '/',
              cast(2025 + s_suppkey % 5 AS varchar)) AS expires,
       cast(100 + s_suppkey % 900 AS int) AS cvv,
       CASE WHEN s_suppkey % 5 = 0 THEN 'NO' ELSE 'YES' END AS has_chip,
       cast(1 + s_suppkey % 3 AS int) AS num_cards_issued,
       concat('$', cast(cast(s_acctbal AS decimal(15,2)) AS varchar)) AS credit_limit,
       concat(lpad(cast(1 + s_suppkey % 11 AS varchar), 2, '0'), '/',
              cast(1998 + s_suppkey % 20 AS varchar)) AS acct_open_date,
       cast(2008 + s_suppkey % 12 AS int) AS year_pin_last_changed, 'No' AS card_on_dark_web
FROM supplier""",
    "mcc_codes": """
SELECT cast(p_partkey AS varchar) AS id, p_type AS item FROM part WHERE p_type <> 'PROMO'""",
    "train_fraud_labels": """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS info
FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
    "cards_cleaned": """
SELECT * REPLACE (cast(replace(credit_limit, '$', '') AS float) AS credit_limit) FROM cards_data""",
    "users_cleaned": """
SELECT * REPLACE (cast(replace(per_capita_income, '$', '') AS float) AS per_capita_income,
                  cast(replace(yearly_income, '$', '') AS float) AS yearly_income,
                  cast(replace(total_debt, '$', '') AS float) AS total_debt) FROM users_data""",
    "transactions_cleaned": """
SELECT * REPLACE (cast(client_id AS varchar) AS client_id, cast(mcc AS varchar) AS mcc,
                  cast(replace(amount, '$', '') AS float) AS amount) FROM transactions_data""",
    "p": """
SELECT t.* REPLACE (cast(replace(t.amount, '$', '') AS float) AS amount),
       cast(replace(t.amount, '$', '') AS decimal(30,6)) AS amount_exact, date '2025-05-22' AS ingestion_date, m.item, u.* EXCLUDE (id), c.* EXCLUDE (id, client_id), f.info
FROM transactions_data t
JOIN train_fraud_labels f ON t.id = f.id
JOIN users_cleaned u ON t.client_id = u.id
JOIN cards_cleaned c ON t.card_id = c.id
LEFT JOIN mcc_codes m ON cast(t.mcc AS varchar) = m.id""",
    "spending": """
SELECT id AS transaction_id, date AS transaction_date, client_id,
       cast(replace(amount, '$', '') AS decimal(30,6)) AS amount, use_chip AS transaction_type, mcc
FROM transactions_data""",
    "flagged": """
SELECT s.*, f.info = 'Yes' AS is_fraud FROM spending s JOIN train_fraud_labels f ON s.transaction_id = f.id""",
    "year_spending": """
SELECT *, cast(month(transaction_date) AS int) AS month FROM spending
WHERE transaction_date >= timestamp '1996-01-01 00:00:00' AND transaction_date < timestamp '1997-01-01 00:00:00'""",
    "month_totals": """
SELECT month, client_id, cast(sum(amount) AS double) AS total_spent
FROM year_spending GROUP BY month, client_id""",
    "best": """
SELECT client_id, month AS best_month FROM (
  SELECT client_id, month, row_number() OVER (PARTITION BY client_id ORDER BY total_spent DESC, month) AS rnk
  FROM month_totals) WHERE rnk = 1""",
    "metrics": """
SELECT m.*, b.best_month FROM (
  SELECT client_id, 1996 AS year, count(*) AS nb_transactions, cast(sum(amount) AS double) / count(amount) AS avg_spent,
         cast(max(amount) AS double) AS max_spent, max(transaction_date) AS last_transaction_date FROM year_spending GROUP BY client_id) m
JOIN best b ON m.client_id = b.client_id""",
}

# Name -> the names it selects from; only what a statement needs becomes a CTE.
NEEDS = {
    "cards_cleaned": ["cards_data"],
    "users_cleaned": ["users_data"],
    "transactions_cleaned": ["transactions_data"],
    "p": ["transactions_data", "train_fraud_labels", "users_cleaned", "cards_cleaned", "mcc_codes"],
    "spending": ["transactions_data"],
    "flagged": ["spending", "train_fraud_labels"],
    "year_spending": ["spending"],
    "month_totals": ["year_spending"],
    "best": ["month_totals"],
    "metrics": ["year_spending", "best"],
}


def _with(names: str, body: str) -> str:
    """``body`` preceded by the CTEs named, and those they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in order)
    return f"WITH {ctes}\n{body.strip()}"


KPI = _with("p", """
SELECT client_id, current_age, gender, count(amount) AS total_amount, count(*) AS transaction_count,
       cast(sum(amount_exact) AS double) / count(amount_exact) AS avg_spent, max(amount) AS max_spent FROM p GROUP BY client_id, current_age, gender""")

STAMP = "date '2025-05-22' AS ingestion_date, 2025 AS year, 5 AS month, 22 AS day"

HASH = "cast(('0x' || substr(md5(concat('42:', cast(id AS varchar))), 1, 8)) AS bigint) % 100"


def _split_body(percent: int) -> str:
    return f"SELECT id, info, CASE WHEN {HASH} < {percent} THEN 'train' ELSE 'test' END AS subset FROM train_fraud_labels"


def _split(percent: int) -> str:
    return _with("train_fraud_labels", _split_body(percent))


ORACLE: dict[str, str] = {
    # Scans
    "csv_scan_schema": _with("transactions_data", "SELECT * FROM transactions_data"),
    "csv_scan_inferred": _with("users_data", "SELECT * FROM users_data"),
    "json_scan_schema": _with("mcc_codes", "SELECT * FROM mcc_codes"),
    "json_lines_scan": _with("train_fraud_labels", "SELECT * FROM train_fraud_labels"),
    "json_map_to_rows": _with("mcc_codes", "SELECT * FROM mcc_codes"),
    "parquet_scan_schema": _with("train_fraud_labels", "SELECT * FROM train_fraud_labels"),
    "latest_partition": _with("transactions_data", """
SELECT *, date '2025-05-22' AS ingestion_date FROM transactions_data WHERE use_chip = 'Chip Transaction'"""),
    "sql_scan": _with("users_data", """
SELECT gender, current_age, count(*) AS n_clients, max(credit_score) AS best_score FROM users_data
WHERE num_credit_cards >= 3 GROUP BY gender, current_age"""),
    "ingest_directory": _with("cards_data users_data mcc_codes train_fraud_labels", """
SELECT table_name, id, detail, date '2025-05-22' AS ingestion_date FROM (
  SELECT 'cards_data' AS table_name, cast(id AS varchar) AS id, card_number AS detail FROM cards_data
  UNION ALL SELECT 'users_data', cast(id AS varchar), address FROM users_data
  UNION ALL SELECT 'mcc_codes', id, item FROM mcc_codes
  UNION ALL SELECT 'train_fraud_labels', cast(id AS varchar), info FROM train_fraud_labels)"""),
    "split_csv_parts": _with("transactions_data", """
SELECT *, cast(ntile(4) OVER (ORDER BY id) AS int) AS part FROM transactions_data"""),
    "split_two_files": _with("train_fraud_labels", """
SELECT *, cast(ntile(5) OVER (ORDER BY id) AS int) AS part FROM train_fraud_labels"""),
    "wide_key_run": _with("train_fraud_labels", """
SELECT id + 3000000000 AS id, info, date '2025-05-22' AS ingestion_date FROM train_fraud_labels"""),
    "row_positions": _with("transactions_data", """
SELECT id, client_id, row_number() OVER (ORDER BY client_id, id) - 1 AS row_index FROM transactions_data"""),
    # Cleaning
    "clean_transactions": _with("transactions_cleaned", "SELECT * FROM transactions_cleaned"),
    "clean_cards": _with("cards_cleaned", "SELECT * FROM cards_cleaned"),
    "clean_users": _with("users_cleaned", "SELECT * FROM users_cleaned"),
    # Joins
    "enrich_transactions": _with("p", "SELECT * FROM p"),
    "enrich_mcc_left": _with("transactions_data mcc_codes", """
SELECT t.id, t.mcc, m.item FROM transactions_data t LEFT JOIN mcc_codes m ON cast(t.mcc AS varchar) = m.id"""),
    "enrich_inner_users": _with("transactions_data users_data", """
SELECT t.id, t.client_id, u.current_age, u.gender FROM transactions_data t
JOIN users_data u ON t.client_id = u.id"""),
    "enrich_inner_cards": _with("transactions_data cards_data", """
SELECT t.id, t.client_id, t.card_id, c.card_brand, c.card_number FROM transactions_data t
JOIN cards_data c ON t.card_id = c.id"""),
    "enrich_inner_labels": _with("transactions_data train_fraud_labels", """
SELECT t.id, t.amount, f.info FROM transactions_data t JOIN train_fraud_labels f ON t.id = f.id"""),
    # Marts
    "mart_validated": _with("p", "SELECT * EXCLUDE (amount_exact) FROM p WHERE info = 'Yes'"),
    "mart_refused": _with("p", "SELECT * EXCLUDE (amount_exact) FROM p WHERE info = 'No'"),
    "mart_top10": _with("p", """
SELECT client_id, current_age, gender, count(amount) AS total_amount FROM p GROUP BY client_id, current_age, gender
ORDER BY total_amount DESC, client_id, current_age, gender LIMIT 10"""),
    "mart_kpi": KPI,
    "mart_passthrough_cards": _with("cards_cleaned", "SELECT * FROM cards_cleaned"),
    "mart_passthrough_mcc": _with("mcc_codes", "SELECT * FROM mcc_codes"),
    "mart_passthrough_labels": _with("train_fraud_labels", "SELECT * FROM train_fraud_labels"),
    "mart_passthrough_transactions": _with("transactions_cleaned", "SELECT * FROM transactions_cleaned"),
    "mart_passthrough_processed": _with("p", "SELECT * EXCLUDE (amount_exact) FROM p"),
    "mart_passthrough_users": _with("users_cleaned", "SELECT * FROM users_cleaned"),
    # Served reads
    "page_fraud": _with("train_fraud_labels", "SELECT * FROM train_fraud_labels ORDER BY id LIMIT 20 OFFSET 20"),
    "page_legit": _with("p", """
SELECT * EXCLUDE (amount_exact) FROM p WHERE info = 'Yes' ORDER BY id LIMIT 20 OFFSET 40"""),
    "page_clients": _with("users_cleaned", "SELECT * FROM users_cleaned ORDER BY id LIMIT 20 OFFSET 40"),
    "page_deep": _with("train_fraud_labels", """
SELECT * FROM train_fraud_labels ORDER BY id DESC LIMIT 300 OFFSET 900"""),
    "page_ties": _with("transactions_data", """
SELECT client_id, use_chip, id, amount FROM (
  SELECT *, row_number() OVER (ORDER BY use_chip, client_id DESC, id, amount) - 1 AS pos FROM transactions_data)
WHERE pos // 250 IN (0, 2, 5)"""),
    "page_keyset": _with("train_fraud_labels", """
SELECT * FROM train_fraud_labels WHERE id > 500 ORDER BY id LIMIT 50"""),
    "page_records": _with("train_fraud_labels", """
SELECT concat('{"id":', cast(id AS varchar), ',"info":"', info, '"}') AS record
FROM (SELECT * FROM train_fraud_labels ORDER BY id LIMIT 20)"""),
    # Analytics
    "q1_last_90_days": _with("spending", """
SELECT count(*) AS n FROM spending
WHERE transaction_date >= cast((SELECT max(transaction_date) FROM spending) AS date) - INTERVAL 90 DAY"""),
    "q1_cache_comparison": _with("spending", """
SELECT variant, count(*) AS n_rows FROM spending, (VALUES ('no_cache'), ('cache')) v(variant)
WHERE transaction_date >= cast((SELECT max(transaction_date) FROM spending) AS date) - INTERVAL 90 DAY
GROUP BY variant"""),
    "q2_join_clients": _with("transactions_data users_data", """
SELECT t.*, u.* EXCLUDE (id) FROM transactions_data t JOIN users_data u ON t.client_id = u.id"""),
    "q2_compare_variants": _with("transactions_data users_data", """
SELECT variant, count(*) AS n_rows FROM transactions_data t JOIN users_data u ON t.client_id = u.id,
(VALUES ('no_optimization'), ('broadcast_optimization')) v(variant) GROUP BY variant"""),
    "q3_mcc_labels": _with("transactions_data mcc_codes", """
SELECT t.*, m.item FROM transactions_data t LEFT JOIN mcc_codes m ON cast(t.mcc AS varchar) = m.id"""),
    "q4_fraud_view": _with("flagged", "SELECT * FROM flagged WHERE is_fraud"),
    "q4_non_fraud_view": _with("flagged", "SELECT * FROM flagged WHERE NOT is_fraud"),
    "q5_enrich_save": _with("transactions_data users_data train_fraud_labels", """
SELECT t.* RENAME (id AS transaction_id, date AS transaction_date), u.* EXCLUDE (id), f.info = 'Yes' AS is_fraud
FROM transactions_data t LEFT JOIN users_data u ON t.client_id = u.id
LEFT JOIN train_fraud_labels f ON t.id = f.id"""),
    "q6_top10_year": _with("year_spending", """
SELECT client_id, cast(sum(amount) AS double) AS total_spent FROM year_spending
GROUP BY client_id ORDER BY total_spent DESC, client_id LIMIT 10"""),
    "q7_top3_per_month": _with("month_totals", """
SELECT month, client_id, total_spent, rnk FROM (
  SELECT *, cast(row_number() OVER (PARTITION BY month ORDER BY total_spent DESC, client_id) AS int) AS rnk
  FROM month_totals)
WHERE rnk <= 3 ORDER BY month, rnk"""),
    "q8_client_metrics": _with("metrics", "SELECT * FROM metrics"),
    "q8_best_month": _with("best", "SELECT * FROM best"),
    "monthly_totals": _with("month_totals", "SELECT * FROM month_totals"),
    "q10_by_month": _with("spending", """
SELECT *, cast(month(transaction_date) AS int) AS month FROM spending"""),
    "q11_avg_by_type": _with("spending", """
SELECT transaction_type, cast(sum(amount) AS double) / count(amount) AS avg_amount FROM spending GROUP BY transaction_type"""),
    "q12_five_files": _with("metrics", "SELECT *, cast(5 AS bigint) AS n_files FROM metrics"),
    # Partitioning
    "partitions_for": """
SELECT source, cast(sum(strlen(text)) AS bigint) AS n_bytes,
       greatest(1, cast(ceil(sum(strlen(text)) / 1048576.0) AS int)) AS n_partitions
FROM documents GROUP BY source""",
    "size_repartition": "SELECT *, true AS as_promised FROM orders",
    "split_rows_input_order": _with("train_fraud_labels", """
SELECT part, count(*) AS n_rows FROM (
  SELECT cast(ntile(7) OVER (ORDER BY id) AS int) AS part FROM train_fraud_labels) GROUP BY part"""),
    # Machine learning
    "hash_split_80_20": _split(80),
    "hash_split_70_30": _split(70),
    "random_split_sizes": _with("train_fraud_labels", "SELECT *, true AS near_80_percent FROM train_fraud_labels"),
    "nonempty_guard": _with("train_fraud_labels", f"SELECT *, true AS empty_is_stopped FROM ({_split_body(80)})"),
    "ml_calendar_features": _with("p", """
SELECT id, coalesce(amount, cast(0 AS float)) AS amount, cast(year(date) AS int) AS year,
       cast(month(date) AS int) AS month, cast(day(date) AS int) AS day,
       cast(dayofweek(date) + 1 AS int) AS day_of_week FROM p"""),
    "ml_amount_features": _with("p", """
SELECT id, amount, cast(credit_score AS float) AS credit_score, num_credit_cards, yearly_income, total_debt,
       credit_limit, per_capita_income, CASE WHEN upper(has_chip) = 'YES' THEN 1 ELSE 0 END AS has_chip,
       CASE WHEN upper(card_on_dark_web) = 'YES' THEN 1 ELSE 0 END AS card_on_dark_web, gender, card_brand, card_type
FROM p"""),
    "ml_brand_features": _with("cards_data", """
SELECT id, cast(substring(card_number, 1, 1) AS int) AS prefix1, cast(substring(card_number, 1, 2) AS int) AS prefix2,
       cast(substring(card_number, 1, 4) AS int) AS prefix4, cast(length(card_number) AS int) AS length
FROM cards_data WHERE card_brand IN ('Visa', 'Mastercard', 'Discover', 'Amex')"""),
    "ml_index_mapping": _with("cards_data", """
SELECT card_brand, cast(row_number() OVER (ORDER BY n DESC, card_brand) - 1 AS double) AS idx
FROM (SELECT card_brand, count(*) AS n FROM cards_data GROUP BY card_brand)"""),
    "ml_rmse": _with("p", """
SELECT sqrt(cast(sum(error * error) AS double) / cast(count(error) AS double)) AS rmse FROM (
  SELECT cast(amount_exact AS decimal(15,2)) - cast(credit_score * 400 AS decimal(15,2)) AS error FROM p)"""),
    "ml_accuracy": _with("cards_data", """
SELECT cast(count(CASE WHEN card_brand = guess THEN 1 END) AS double) / cast(count(*) AS double) AS accuracy FROM (
  SELECT card_brand, CASE substring(card_number, 1, 1) WHEN '3' THEN 'Visa' WHEN '5' THEN 'Amex'
         ELSE 'Discover' END AS guess FROM cards_data
  WHERE card_brand IN ('Visa', 'Mastercard', 'Discover', 'Amex'))"""),
    "ml_auc": _with("p", """
SELECT (2 * sum(CASE WHEN label THEN rnk END) - count_if(label) * (count_if(label) + 1))
       / (2.0 * count_if(label) * count_if(NOT label)) AS auc FROM (
  SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rnk
  FROM (SELECT info = 'Yes' AS label, credit_score AS score FROM p))"""),
    "ml_calendar_gbt": _with("p", f"SELECT id, true AS predicted, true AS fits FROM p WHERE {HASH} >= 80"),
    "ml_amount_gbt": _with("p", f"SELECT id, true AS predicted, true AS fits FROM p WHERE {HASH} >= 80"),
    "ml_brand_rf": _with("cards_data", f"""
SELECT id, card_brand, card_brand AS predicted_brand FROM cards_data WHERE {HASH.replace("42:", "12345:")} >= 80"""),
    "ml_training_run": _with("p", f"""
SELECT count(*) AS n_rows, count(amount) AS n_amounts, count_if({HASH} >= 80)::BIGINT AS n_test, true AS error_agrees FROM p"""),
    "q9_fraud_models": _with("p", f"""
SELECT model, count_if({HASH} >= 70)::BIGINT AS n_test, true AS auc_agrees
FROM p, (VALUES ('LogisticRegression'), ('RandomForest'), ('GBT')) m(model) GROUP BY model"""),
    # Layer runs
    "parquet_round_trip": _with("cards_cleaned", "SELECT * FROM cards_cleaned"),
    "table_round_trip": _with("users_cleaned", """
SELECT *, date '2025-05-22' AS ingestion_date FROM users_cleaned"""),
    "bronze_incremental": _with("train_fraud_labels", """
SELECT *, CASE WHEN info = 'No' THEN date '2025-05-21' ELSE date '2025-05-22' END AS ingestion_date,
       2025 AS year, 5 AS month, CASE WHEN info = 'No' THEN 21 ELSE 22 END AS day FROM train_fraud_labels"""),
    "bronze_new_files": _with("train_fraud_labels", f"SELECT *, {STAMP} FROM train_fraud_labels"),
    "bronze_silver_gold": KPI,
    "files_to_tables": _with("users_data cards_data", """
SELECT u.id, u.yearly_income, c.n_cards, c.limits FROM users_data u LEFT JOIN (
  SELECT client_id, count(*) AS n_cards,
         cast(sum(cast(replace(credit_limit, '$', '') AS decimal(30,6))) AS double) AS limits
  FROM cards_data GROUP BY client_id) c ON u.id = c.client_id"""),
}
ORACLE["q2_join_broadcast"] = ORACLE["q2_join_clients"]
ORACLE |= {
    # Upkeep
    "kpi_incremental": _with("spending", """
SELECT client_id, count(amount) AS total_amount, count(*) AS transaction_count,
       cast(sum(amount) AS double) / count(amount) AS avg_spent, cast(max(amount) AS float) AS max_spent
FROM spending GROUP BY client_id"""),
    "metrics_incremental": ORACLE["q8_client_metrics"],
    "months_incremental": ORACLE["monthly_totals"],
    "merge_corrections": _with("train_fraud_labels", """
SELECT id, CASE WHEN NOT low THEN info WHEN id % 194 = 3 THEN 'Withdrawn' WHEN id % 97 = 3 THEN 'Checked' ELSE info END AS info,
       CASE WHEN NOT low THEN 0 WHEN id % 194 = 3 THEN 2 WHEN id % 97 = 3 THEN 1 ELSE 0 END AS seen
FROM (SELECT *, id <= (SELECT max(id) / 4 FROM train_fraud_labels) AS low FROM train_fraud_labels)"""),
    "compact_days": _with("train_fraud_labels", """
SELECT id, info, CASE id % 3 WHEN 0 THEN date '2025-04-30' WHEN 1 THEN date '2025-05-01' ELSE date '2025-05-22' END
       AS ingestion_date, cast(CASE id % 3 WHEN 0 THEN 6 ELSE 1 END AS bigint) AS n_files
FROM train_fraud_labels"""),
    "page_by_directory": _with("transactions_data", """
SELECT client_id, use_chip, id, amount FROM (
  SELECT *, row_number() OVER (ORDER BY use_chip, client_id DESC, id, amount) - 1 AS pos FROM transactions_data)
WHERE pos // 250 IN (0, 2)"""),
    "json_array_split": _with("transactions_data", """
SELECT id, amount, errors, concat('say "', use_chip, '" }, {[ \\', id::VARCHAR, ']', chr(9), '\\') AS note, merchant_city, mcc
FROM transactions_data"""),
    "clustered_read": _with("spending", """
SELECT *, 'client' AS "by" FROM spending WHERE client_id BETWEEN 40 AND 90
UNION ALL
SELECT *, 'date' AS "by" FROM spending
WHERE transaction_date >= timestamp '1996-03-01 00:00:00' AND transaction_date < timestamp '1996-05-01 00:00:00'"""),
    "silver_bucketed_join": _with("transactions_cleaned train_fraud_labels", """
SELECT t.*, date '2025-05-22' AS ingestion_date, f.info FROM transactions_cleaned t JOIN train_fraud_labels f ON t.id = f.id"""),
    "join_heavy_clients": _with("transactions_data users_data", """
SELECT t.*, u.* EXCLUDE (id)
FROM (SELECT * REPLACE (CASE WHEN id % 3 = 0 THEN 1 ELSE client_id END AS client_id) FROM transactions_data) t
JOIN users_data u ON t.client_id = u.id"""),
    "infer_lattice": _with("transactions_data", """
SELECT id, CASE WHEN wide THEN date ELSE date_trunc('day', date) END AS seen,
       client_id + CASE WHEN wide THEN 3000000000 ELSE 0 END AS account,
       merchant_id + CASE WHEN wide THEN 0.5::DOUBLE ELSE 0 END AS share,
       CASE WHEN id % 4 = 0 THEN 'true' WHEN wide THEN 'x' ELSE 'FALSE' END AS flag, NULL::VARCHAR AS nothing,
       'timestamp, bigint, double, string, string' AS types
FROM (SELECT *, id % 2 = 1 AS wide FROM transactions_data)"""),
    "ingest_with_rejects": _with("transactions_data", """
SELECT * FROM (
  SELECT id, 'date' AS "column", '2024-13-45 00:00:00' AS text, 'no such day or time' AS reason FROM transactions_data WHERE id % 37 = 5
  UNION ALL
  SELECT id, 'client_id', '99999999999999999999', 'out of range' FROM transactions_data WHERE id % 41 = 2
  UNION ALL
  SELECT id, 'mcc', 'x' || mcc, 'not a whole number' FROM transactions_data WHERE id % 31 = 3
  UNION ALL
  SELECT id, 'zip', 'here', 'not double' FROM transactions_data WHERE id % 59 = 4)
UNION ALL
SELECT id, NULL, client_id::VARCHAR, 'accepted' FROM transactions_data
WHERE id % 37 <> 5 AND id % 41 <> 2 AND id % 31 <> 3 AND id % 59 <> 4"""),
}
