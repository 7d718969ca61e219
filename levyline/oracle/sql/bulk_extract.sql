SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM (${views}
SELECT * FROM agent_transactions_raw WHERE payment_date >= TIMESTAMP '2024-01-28 00:00:00') presented
