${views}
SELECT * FROM rev_sub_newcode_raw
