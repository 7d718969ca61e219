SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount, CAST(min_amount AS DOUBLE) AS min_amount, CAST(max_amount AS DOUBLE) AS max_amount) FROM (${views}
SELECT * FROM agg_revenue_daily) presented
