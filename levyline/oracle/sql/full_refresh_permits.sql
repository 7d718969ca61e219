SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CAST(p_amount AS DOUBLE) AS p_amount) FROM (${views}
SELECT * FROM concession_permit_raw) presented
