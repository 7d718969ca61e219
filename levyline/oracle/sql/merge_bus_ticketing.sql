SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM (${views},
tgt AS (SELECT * REPLACE (CAST(0 AS DECIMAL(10,2)) AS amount, CAST('old route' AS VARCHAR) AS route_name) FROM bus_ticketing_transaction_raw WHERE trans_date <= TIMESTAMP '2024-01-30 00:00:00'),
src AS (SELECT * FROM bus_ticketing_transaction_raw WHERE trans_date > TIMESTAMP '2024-01-27 00:00:00')
SELECT coalesce(s.id, t.id) AS id, CASE WHEN t.id IS NOT NULL THEN t.event ELSE s.event END AS event, CASE WHEN t.id IS NOT NULL THEN t.event_name ELSE s.event_name END AS event_name, CASE WHEN t.id IS NOT NULL THEN t.trans_id ELSE s.trans_id END AS trans_id, CASE WHEN s.id IS NOT NULL THEN s.amount ELSE t.amount END AS amount, CASE WHEN t.id IS NOT NULL THEN t.card_serial ELSE s.card_serial END AS card_serial, CASE WHEN t.id IS NOT NULL THEN t.phone ELSE s.phone END AS phone, CASE WHEN t.id IS NOT NULL THEN t.trans_date ELSE s.trans_date END AS trans_date, CASE WHEN s.id IS NOT NULL THEN s.checkout ELSE t.checkout END AS checkout, CASE WHEN t.id IS NOT NULL THEN t.bus_id ELSE s.bus_id END AS bus_id, CASE WHEN t.id IS NOT NULL THEN t.route_name ELSE s.route_name END AS route_name, CASE WHEN t.id IS NOT NULL THEN t.entry_point ELSE s.entry_point END AS entry_point, CASE WHEN t.id IS NOT NULL THEN t.exit_point ELSE s.exit_point END AS exit_point, CASE WHEN t.id IS NOT NULL THEN t.i_type ELSE s.i_type END AS i_type, CASE WHEN t.id IS NOT NULL THEN t.issuer_id ELSE s.issuer_id END AS issuer_id, CASE WHEN t.id IS NOT NULL THEN t.issuer_name ELSE s.issuer_name END AS issuer_name, CASE WHEN t.id IS NOT NULL THEN t.created_at ELSE s.created_at END AS created_at, CASE WHEN s.id IS NOT NULL THEN s.updated_at ELSE t.updated_at END AS updated_at FROM tgt t FULL OUTER JOIN src s ON t.id = s.id) presented
