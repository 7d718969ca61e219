${views}
SELECT CAST(min_a AS DOUBLE) AS min_amt, CAST(max_a AS DOUBLE) AS max_amt,
       CAST(sign(m) * ((abs(m) + 5000) // 10000) AS DOUBLE) / 100.0 AS avg_amt,
       CAST(s AS DOUBLE) / 100.0 AS total_amt
FROM (SELECT *, sign(s) * ((abs(s) * 20000 // c + 1) // 2) AS m
      FROM (SELECT CAST(sum(amount) * 100 AS HUGEINT) AS s, count(amount) AS c, min(amount) AS min_a,
                   max(amount) AS max_a
            FROM agent_transactions_raw WHERE amount IS NOT NULL) agg) x
