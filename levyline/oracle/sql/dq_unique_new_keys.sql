${views},
late AS (SELECT id FROM bus_ticketing_transaction_raw WHERE trans_date > TIMESTAMP '2024-01-20 00:00:00'),
slice AS (SELECT id FROM late UNION ALL SELECT id FROM late WHERE id % 5 = 0),
held AS (SELECT id FROM bus_ticketing_transaction_raw WHERE trans_date > TIMESTAMP '2023-12-29 00:00:00' AND trans_date <= TIMESTAMP '2024-01-20 12:00:00')
SELECT 'bus_ticketing_transaction' AS table_name, 'id' AS column_name, CAST(s.id AS VARCHAR) AS value, count(*) AS in_slice, s.id IN (SELECT id FROM held) AS stored
FROM slice s
GROUP BY s.id
HAVING count(*) > 1 OR s.id IN (SELECT id FROM held)
