${views}
SELECT min(trans_date) AS trans_date_earliest, max(trans_date) AS trans_date_latest, min(payment_date) AS payment_date_earliest, max(payment_date) AS payment_date_latest FROM agent_transactions_raw
