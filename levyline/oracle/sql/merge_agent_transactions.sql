SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM (${views},
tgt AS (SELECT * REPLACE (CAST('Processing' AS VARCHAR) AS status, CAST(0 AS DECIMAL(19,2)) AS amount, CAST('loaded earlier' AS VARCHAR) AS comment) FROM agent_transactions_raw WHERE trans_date <= TIMESTAMP '2024-01-30 00:00:00'),
src AS (SELECT * FROM agent_transactions_raw WHERE trans_date > TIMESTAMP '2024-01-27 00:00:00')
SELECT coalesce(s.idagent_transactions, t.idagent_transactions) AS idagent_transactions, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.agency ELSE s.agency END AS agency, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.state_id ELSE s.state_id END AS state_id, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.agent_user ELSE s.agent_user END AS agent_user, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.agent_code ELSE s.agent_code END AS agent_code, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.trans_date ELSE s.trans_date END AS trans_date, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.trans_ref ELSE s.trans_ref END AS trans_ref, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.payment_ref ELSE s.payment_ref END AS payment_ref, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.rev_head ELSE s.rev_head END AS rev_head, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.rev_code ELSE s.rev_code END AS rev_code, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.refcode ELSE s.refcode END AS refcode, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.reference ELSE s.reference END AS reference, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.initialize_url ELSE s.initialize_url END AS initialize_url, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.payment_token ELSE s.payment_token END AS payment_token, CASE WHEN s.idagent_transactions IS NOT NULL THEN s.amount ELSE t.amount END AS amount, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.payment_period ELSE s.payment_period END AS payment_period, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.next_date ELSE s.next_date END AS next_date, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.no_of_days ELSE s.no_of_days END AS no_of_days, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.trans_channel ELSE s.trans_channel END AS trans_channel, CASE WHEN s.idagent_transactions IS NOT NULL THEN s.status ELSE t.status END AS status, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.trans_type ELSE s.trans_type END AS trans_type, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.lga ELSE s.lga END AS lga, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.createtime ELSE s.createtime END AS createtime, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.vehicle_type ELSE s.vehicle_type END AS vehicle_type, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.vehicle_tonnage ELSE s.vehicle_tonnage END AS vehicle_tonnage, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.vehicle_content ELSE s.vehicle_content END AS vehicle_content, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.take_off_point ELSE s.take_off_point END AS take_off_point, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.drop_off_destination ELSE s.drop_off_destination END AS drop_off_destination, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.taxpayer_type ELSE s.taxpayer_type END AS taxpayer_type, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.taxpayer_name ELSE s.taxpayer_name END AS taxpayer_name, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.taxpayer_email ELSE s.taxpayer_email END AS taxpayer_email, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.taxpayer_phone ELSE s.taxpayer_phone END AS taxpayer_phone, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.market ELSE s.market END AS market, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.zone_line ELSE s.zone_line END AS zone_line, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.shop_number ELSE s.shop_number END AS shop_number, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.revenue_item ELSE s.revenue_item END AS revenue_item, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.payment_method ELSE s.payment_method END AS payment_method, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.plate_number ELSE s.plate_number END AS plate_number, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.enumeration_id ELSE s.enumeration_id END AS enumeration_id, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.comment ELSE s.comment END AS comment, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.taxoffice ELSE s.taxoffice END AS taxoffice, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.notice_number ELSE s.notice_number END AS notice_number, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.notice_number_fiscal_year ELSE s.notice_number_fiscal_year END AS notice_number_fiscal_year, CASE WHEN s.idagent_transactions IS NOT NULL THEN s.payment_date ELSE t.payment_date END AS payment_date, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.valid_date ELSE s.valid_date END AS valid_date, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.terminalid ELSE s.terminalid END AS terminalid, CASE WHEN t.idagent_transactions IS NOT NULL THEN t.terminal_serial_number ELSE s.terminal_serial_number END AS terminal_serial_number, CASE WHEN s.idagent_transactions IS NOT NULL THEN s.updated_at ELSE t.updated_at END AS updated_at FROM tgt t FULL OUTER JOIN src s ON t.idagent_transactions = s.idagent_transactions) presented
