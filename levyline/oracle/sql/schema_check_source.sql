SELECT 'orders' AS table_name, true AS table_exists, count(*) AS row_count, 6 AS column_count, 18 AS n_missing,
       'agency|state_id|agent_user|agent_code|trans_date|trans_ref|payment_ref|rev_head|rev_code|trans_type|lga|trans_channel|taxpayer_name|taxpayer_email|taxpayer_phone|plate_number|payment_date|updated_at' AS missing_columns
FROM orders
UNION ALL
SELECT 'no_such_table', false, 0, 1, 21, 'idagent_transactions|agency|state_id|agent_user|agent_code|trans_date|trans_ref|payment_ref|rev_head|rev_code|amount|status|trans_type|lga|trans_channel|taxpayer_name|taxpayer_email|taxpayer_phone|plate_number|payment_date|updated_at'
