${views},
first_run AS (
    SELECT max(trans_date) AS mark FROM bus_ticketing_transaction_raw WHERE trans_date <= TIMESTAMP '2024-01-20 12:00:00'
),
second_run AS (
    SELECT b.trans_date FROM bus_ticketing_transaction_raw b, first_run WHERE b.trans_date > mark - INTERVAL '3' DAY
)
SELECT b.id,
       b.trans_date,
       CAST(CASE WHEN b.trans_date > f.mark - INTERVAL '3' DAY THEN b.amount ELSE 0 END AS DOUBLE) AS amount,
       'bus_ticketing_transaction' AS table_name,
       (SELECT max(trans_date) FROM second_run) AS last_loaded_at,
       (SELECT count(*) FROM second_run) AS rows_loaded
FROM bus_ticketing_transaction_raw b, first_run f
WHERE b.trans_date > TIMESTAMP '2023-12-29 00:00:00'
