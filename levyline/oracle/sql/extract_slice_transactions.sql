SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM (${views}
SELECT * FROM agent_transactions_raw WHERE trans_date > TIMESTAMP '2024-01-27 00:00:00') presented
