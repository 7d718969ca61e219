${views}
SELECT 'agent_transactions' AS table_name, CASE WHEN count(*) > 0 THEN greatest(TIMESTAMP '2024-03-01 00:00:00', max(trans_date)) ELSE TIMESTAMP '2024-03-01 00:00:00' END AS last_loaded_at, TIMESTAMP '2024-02-03 06:00:00' AS last_run_at, count(*) AS rows_loaded FROM agent_transactions_raw WHERE trans_date > TIMESTAMP '2024-02-27 00:00:00' UNION ALL SELECT 'rev_sub_newcode' AS table_name, TIMESTAMP '2024-02-03 06:00:00' AS last_loaded_at, TIMESTAMP '2024-02-03 06:00:00' AS last_run_at, count(*) AS rows_loaded FROM rev_sub_newcode_raw UNION ALL SELECT 'bus_ticketing_transaction' AS table_name, CASE WHEN count(*) > 0 THEN greatest(TIMESTAMP '2024-03-01 00:00:00', max(trans_date)) ELSE TIMESTAMP '2024-03-01 00:00:00' END AS last_loaded_at, TIMESTAMP '2024-02-03 06:00:00' AS last_run_at, count(*) AS rows_loaded FROM bus_ticketing_transaction_raw WHERE trans_date > TIMESTAMP '2024-02-27 00:00:00' UNION ALL SELECT 'concession_permit' AS table_name, TIMESTAMP '2024-02-03 06:00:00' AS last_loaded_at, TIMESTAMP '2024-02-03 06:00:00' AS last_run_at, count(*) AS rows_loaded FROM concession_permit_raw UNION ALL SELECT 'enumeration' AS table_name, CASE WHEN count(*) > 0 THEN greatest(TIMESTAMP '2024-03-01 00:00:00', max(create_time)) ELSE TIMESTAMP '2024-03-01 00:00:00' END AS last_loaded_at, TIMESTAMP '2024-02-03 06:00:00' AS last_run_at, count(*) AS rows_loaded FROM enumeration_raw WHERE create_time > TIMESTAMP '2024-02-27 00:00:00' UNION ALL SELECT 'merchant_user' AS table_name, CASE WHEN count(*) > 0 THEN greatest(TIMESTAMP '2024-03-01 00:00:00', max(greatest(create_time, update_time))) ELSE TIMESTAMP '2024-03-01 00:00:00' END AS last_loaded_at, TIMESTAMP '2024-02-03 06:00:00' AS last_run_at, count(*) AS rows_loaded FROM merchant_user_raw WHERE create_time > TIMESTAMP '2024-02-27 00:00:00' OR update_time > TIMESTAMP '2024-02-27 00:00:00'
