${views}
SELECT * FROM stg_merchant_user
