SELECT * REPLACE (CAST(paid_amount AS DOUBLE) AS paid_amount, CAST(expected_amount AS DOUBLE) AS expected_amount, CAST(previous_expected_amount AS DOUBLE) AS previous_expected_amount, CAST(variance_amount AS DOUBLE) AS variance_amount) FROM (${views}
SELECT * FROM fct_concession_permits) presented
