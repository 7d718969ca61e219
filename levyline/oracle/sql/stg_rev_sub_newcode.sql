${views}
SELECT * FROM stg_rev_sub_newcode
