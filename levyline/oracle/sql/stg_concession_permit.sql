SELECT * REPLACE (CAST(expected_amount AS DOUBLE) AS expected_amount, CAST(previous_expected_amount AS DOUBLE) AS previous_expected_amount) FROM (${views}
SELECT * FROM stg_concession_permit) presented
