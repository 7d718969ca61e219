${views}
SELECT 'agent_transactions' AS table_name, 'idagent_transactions' AS column_name, count(*) FILTER (WHERE idagent_transactions IS NULL) AS null_rows FROM agent_transactions_raw UNION ALL SELECT 'rev_sub_newcode' AS table_name, 'id' AS column_name, count(*) FILTER (WHERE id IS NULL) AS null_rows FROM rev_sub_newcode_raw UNION ALL SELECT 'bus_ticketing_transaction' AS table_name, 'id' AS column_name, count(*) FILTER (WHERE id IS NULL) AS null_rows FROM bus_ticketing_transaction_raw UNION ALL SELECT 'concession_permit' AS table_name, 'id' AS column_name, count(*) FILTER (WHERE id IS NULL) AS null_rows FROM concession_permit_raw UNION ALL SELECT 'enumeration' AS table_name, 'id' AS column_name, count(*) FILTER (WHERE id IS NULL) AS null_rows FROM enumeration_raw UNION ALL SELECT 'merchant_user' AS table_name, 'user_id' AS column_name, count(*) FILTER (WHERE user_id IS NULL) AS null_rows FROM merchant_user_raw
