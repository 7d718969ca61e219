${views}
SELECT 'agent_transactions' AS table_name, count(*) AS row_count, 48 AS column_count FROM agent_transactions_raw
