${views}
SELECT *, failures = 0 AS passed FROM (SELECT 'agent_transactions' AS table_name, 'idagent_transactions' AS column_name, 'unique' AS test_name, count(*) AS failures FROM (SELECT idagent_transactions FROM agent_transactions_raw WHERE idagent_transactions IS NOT NULL GROUP BY idagent_transactions HAVING count(*) > 1) UNION ALL SELECT 'rev_sub_newcode' AS table_name, 'id' AS column_name, 'unique' AS test_name, count(*) AS failures FROM (SELECT id FROM rev_sub_newcode_raw WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1) UNION ALL SELECT 'rev_sub_newcode' AS table_name, 'rev_code' AS column_name, 'unique' AS test_name, count(*) AS failures FROM (SELECT rev_code FROM rev_sub_newcode_raw WHERE rev_code IS NOT NULL GROUP BY rev_code HAVING count(*) > 1) UNION ALL SELECT 'bus_ticketing_transaction' AS table_name, 'id' AS column_name, 'unique' AS test_name, count(*) AS failures FROM (SELECT id FROM bus_ticketing_transaction_raw WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1) UNION ALL SELECT 'concession_permit' AS table_name, 'id' AS column_name, 'unique' AS test_name, count(*) AS failures FROM (SELECT id FROM concession_permit_raw WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1) UNION ALL SELECT 'enumeration' AS table_name, 'id' AS column_name, 'unique' AS test_name, count(*) AS failures FROM (SELECT id FROM enumeration_raw WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1) UNION ALL SELECT 'merchant_user' AS table_name, 'user_id' AS column_name, 'unique' AS test_name, count(*) AS failures FROM (SELECT user_id FROM merchant_user_raw WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1) UNION ALL SELECT 'agent_transactions', 'idagent_transactions', 'not_null', count(*) FILTER (WHERE idagent_transactions IS NULL) FROM agent_transactions_raw UNION ALL SELECT 'rev_sub_newcode', 'id', 'not_null', count(*) FILTER (WHERE id IS NULL) FROM rev_sub_newcode_raw UNION ALL SELECT 'bus_ticketing_transaction', 'id', 'not_null', count(*) FILTER (WHERE id IS NULL) FROM bus_ticketing_transaction_raw UNION ALL SELECT 'concession_permit', 'id', 'not_null', count(*) FILTER (WHERE id IS NULL) FROM concession_permit_raw UNION ALL SELECT 'enumeration', 'id', 'not_null', count(*) FILTER (WHERE id IS NULL) FROM enumeration_raw UNION ALL SELECT 'merchant_user', 'user_id', 'not_null', count(*) FILTER (WHERE user_id IS NULL) FROM merchant_user_raw) s
