${views}
SELECT * FROM merchant_user_raw WHERE create_time > TIMESTAMP '2024-01-17 00:00:00' OR update_time > TIMESTAMP '2024-01-17 00:00:00'
