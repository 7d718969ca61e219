${views}
SELECT revenue_item AS "Ticket type", count(*) AS "Ticket sold", CAST(sum(amount) AS DOUBLE) AS "Revenue"
FROM fct_transactions
WHERE is_completed AND length(payment_period) > 0 AND payment_day >= DATE '2024-01-27' AND payment_day < DATE '2024-02-03'
GROUP BY revenue_item
