${views}
SELECT bus_id, count(ticket_id) AS trips, CAST(sum(amount) AS DOUBLE) AS revenue
FROM stg_bus_ticketing_transaction
WHERE transaction_day >= DATE '2024-01-27' AND transaction_day < DATE '2024-02-03'
GROUP BY bus_id
