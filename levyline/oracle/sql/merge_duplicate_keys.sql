${views}
SELECT idagent_transactions,
       agency,
       CASE WHEN idagent_transactions % 5 = 0 THEN 'Reversed' ELSE status END AS status,
       CAST(amount AS DOUBLE) AS amount,
       trans_date
FROM agent_transactions_raw
WHERE trans_date IS NOT NULL
