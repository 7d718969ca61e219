SELECT * REPLACE (CAST(total_paid_amount AS DOUBLE) AS total_paid_amount, CAST(min_paid_amount AS DOUBLE) AS min_paid_amount, CAST(max_paid_amount AS DOUBLE) AS max_paid_amount, CAST(expected_amount AS DOUBLE) AS expected_amount, CAST(previous_expected_amount AS DOUBLE) AS previous_expected_amount, CAST(total_shortfall AS DOUBLE) AS total_shortfall) FROM (${views}
SELECT * FROM agg_concession_by_plancode) presented
