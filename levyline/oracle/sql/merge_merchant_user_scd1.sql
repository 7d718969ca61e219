${views},
tgt AS (SELECT * REPLACE (CAST('Old' AS VARCHAR) AS status, CAST('Old Bank' AS VARCHAR) AS bank) FROM merchant_user_raw WHERE create_time <= TIMESTAMP '2024-01-20 00:00:00'),
src AS (SELECT * FROM merchant_user_raw WHERE create_time > TIMESTAMP '2024-01-17 00:00:00' OR update_time > TIMESTAMP '2024-01-17 00:00:00')
SELECT coalesce(s.user_id, t.user_id) AS user_id, CASE WHEN s.user_id IS NOT NULL THEN s.abssin ELSE t.abssin END AS abssin, CASE WHEN s.user_id IS NOT NULL THEN s.user_cat ELSE t.user_cat END AS user_cat, CASE WHEN s.user_id IS NOT NULL THEN s.first_name ELSE t.first_name END AS first_name, CASE WHEN s.user_id IS NOT NULL THEN s.last_name ELSE t.last_name END AS last_name, CASE WHEN s.user_id IS NOT NULL THEN s.company ELSE t.company END AS company, CASE WHEN s.user_id IS NOT NULL THEN s.merchant_id ELSE t.merchant_id END AS merchant_id, CASE WHEN s.user_id IS NOT NULL THEN s.agent_code ELSE t.agent_code END AS agent_code, CASE WHEN s.user_id IS NOT NULL THEN s.collection_type ELSE t.collection_type END AS collection_type, CASE WHEN s.user_id IS NOT NULL THEN s.phone_no ELSE t.phone_no END AS phone_no, CASE WHEN s.user_id IS NOT NULL THEN s.email ELSE t.email END AS email, CASE WHEN s.user_id IS NOT NULL THEN s.status ELSE t.status END AS status, CASE WHEN s.user_id IS NOT NULL THEN s.create_by ELSE t.create_by END AS create_by, CASE WHEN s.user_id IS NOT NULL THEN s.lga ELSE t.lga END AS lga, CASE WHEN s.user_id IS NOT NULL THEN s.lga_zone ELSE t.lga_zone END AS lga_zone, CASE WHEN s.user_id IS NOT NULL THEN s.bank ELSE t.bank END AS bank, CASE WHEN s.user_id IS NOT NULL THEN s.bank_account ELSE t.bank_account END AS bank_account, CASE WHEN s.user_id IS NOT NULL THEN s.balance ELSE t.balance END AS balance, CASE WHEN s.user_id IS NOT NULL THEN s.create_time ELSE t.create_time END AS create_time, CASE WHEN s.user_id IS NOT NULL THEN s.createdate ELSE t.createdate END AS createdate, CASE WHEN s.user_id IS NOT NULL THEN s.update_by ELSE t.update_by END AS update_by, CASE WHEN s.user_id IS NOT NULL THEN s.update_time ELSE t.update_time END AS update_time FROM tgt t FULL OUTER JOIN src s ON t.user_id = s.user_id
