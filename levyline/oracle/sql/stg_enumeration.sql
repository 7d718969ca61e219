${views}
SELECT * FROM stg_enumeration
