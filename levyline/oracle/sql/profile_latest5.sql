SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM (${views}
SELECT idagent_transactions, agency, state_id, agent_user, trans_date, amount, status, trans_type, lga, taxpayer_name, payment_date FROM agent_transactions_raw ORDER BY trans_date DESC NULLS LAST, idagent_transactions DESC LIMIT 5) presented
