SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM (${views}
SELECT * FROM fct_transactions) presented
