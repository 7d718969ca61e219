${views}
SELECT agent_email, first_name, last_name, bank, bank_account, CAST(sum(enumeration_count) AS BIGINT) AS total_enumeration_count
FROM fct_agent_enumeration
WHERE create_day >= DATE '2024-01-27' AND create_day < DATE '2024-02-03' AND agent_status = 'Verified'
GROUP BY ALL
