${views}
SELECT * REPLACE (CAST(CAST(id * 10 AS INTEGER) AS VARCHAR) AS rev_head) FROM rev_sub_newcode_raw
