SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount, CAST(min_amount AS DOUBLE) AS min_amount, CAST(max_amount AS DOUBLE) AS max_amount, CAST(expected_amount AS DOUBLE) AS expected_amount, CAST(total_shortfall AS DOUBLE) AS total_shortfall) FROM (${views}
SELECT * FROM agg_bus_daily) presented
