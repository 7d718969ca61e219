${views}
SELECT 'agent_transactions' AS table_name, true AS table_exists, count(*) AS row_count, 48 AS column_count, 0 AS n_missing, '' AS missing_columns FROM agent_transactions_raw
