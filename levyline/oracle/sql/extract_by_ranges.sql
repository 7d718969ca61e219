SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM (${views}
SELECT *, (SELECT count(*) FROM bus_ticketing_transaction_raw) AS rows_read, 100.0::DOUBLE AS percent FROM bus_ticketing_transaction_raw) presented
