${views}
SELECT status, count(*) AS cnt FROM agent_transactions_raw GROUP BY status ORDER BY cnt DESC, status LIMIT 10
