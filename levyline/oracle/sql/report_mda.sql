${views}
SELECT mda, CAST(sum(transaction_count) AS BIGINT) AS transaction_count, CAST(sum(total_amount) AS DOUBLE) AS total_amount
FROM agg_revenue_daily
WHERE payment_day >= DATE '2024-01-27' AND payment_day < DATE '2024-02-03'
GROUP BY mda
