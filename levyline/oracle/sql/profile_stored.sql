${views}
SELECT 'agent_transactions' AS table_name, count(*) AS row_count, 48 AS column_count,
       min(idagent_transactions) AS min_idagent_transactions, max(idagent_transactions) AS max_idagent_transactions
FROM agent_transactions_raw
