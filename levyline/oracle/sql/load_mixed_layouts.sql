${views}
SELECT * REPLACE (
    CASE WHEN id >= 20 THEN 'H' || CAST(id AS VARCHAR) ELSE CAST(id * 10 AS VARCHAR) END AS rev_head,
    CASE WHEN id >= 20 THEN 'later' END AS enter_by
)
FROM rev_sub_newcode_raw
