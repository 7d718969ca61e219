${views}
SELECT 'agent_transactions' AS table_name, 'idagent_transactions' AS column_name, CAST(idagent_transactions AS VARCHAR) AS value, count(*) AS n_records FROM agent_transactions_raw WHERE idagent_transactions IS NOT NULL GROUP BY idagent_transactions HAVING count(*) > 1 UNION ALL SELECT 'rev_sub_newcode' AS table_name, 'id' AS column_name, CAST(id AS VARCHAR) AS value, count(*) AS n_records FROM rev_sub_newcode_raw WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'rev_sub_newcode' AS table_name, 'rev_code' AS column_name, CAST(rev_code AS VARCHAR) AS value, count(*) AS n_records FROM rev_sub_newcode_raw WHERE rev_code IS NOT NULL GROUP BY rev_code HAVING count(*) > 1 UNION ALL SELECT 'bus_ticketing_transaction' AS table_name, 'id' AS column_name, CAST(id AS VARCHAR) AS value, count(*) AS n_records FROM bus_ticketing_transaction_raw WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'concession_permit' AS table_name, 'id' AS column_name, CAST(id AS VARCHAR) AS value, count(*) AS n_records FROM concession_permit_raw WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'enumeration' AS table_name, 'id' AS column_name, CAST(id AS VARCHAR) AS value, count(*) AS n_records FROM enumeration_raw WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'merchant_user' AS table_name, 'user_id' AS column_name, CAST(user_id AS VARCHAR) AS value, count(*) AS n_records FROM merchant_user_raw WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1 UNION ALL SELECT 'merchant_user' AS table_name, 'email' AS column_name, CAST(email AS VARCHAR) AS value, count(*) AS n_records FROM merchant_user_raw WHERE email IS NOT NULL GROUP BY email HAVING count(*) > 1 UNION ALL SELECT 'concession_permit' AS table_name, 'product_code' AS column_name, CAST(product_code AS VARCHAR) AS value, count(*) AS n_records FROM concession_permit_raw WHERE product_code IS NOT NULL GROUP BY product_code HAVING count(*) > 1
