${views},
report_mda AS (SELECT mda, CAST(sum(transaction_count) AS BIGINT) AS transaction_count, sum(total_amount) AS total_amount
FROM agg_revenue_daily WHERE payment_day BETWEEN DATE '2024-01-27' AND DATE '2024-02-02' GROUP BY mda),
report_eticket AS (SELECT revenue_item AS "Ticket type", count(*) AS "Ticket sold", sum(amount) AS "Revenue"
FROM fct_transactions WHERE payment_day BETWEEN DATE '2024-01-27' AND DATE '2024-02-02' AND is_completed AND payment_period IS NOT NULL
AND payment_period <> '' GROUP BY revenue_item),
report_bus AS (SELECT bus_id, count(ticket_id) AS trips, sum(amount) AS revenue
FROM stg_bus_ticketing_transaction WHERE transaction_day BETWEEN DATE '2024-01-27' AND DATE '2024-02-02' GROUP BY bus_id),
report_agents AS (SELECT agent_email, first_name, last_name, bank, bank_account,
CAST(sum(enumeration_count) AS BIGINT) AS total_enumeration_count
FROM fct_agent_enumeration WHERE agent_status = 'Verified' AND create_day BETWEEN DATE '2024-01-27' AND DATE '2024-02-02'
GROUP BY agent_email, first_name, last_name, bank, bank_account)
SELECT 'mda' AS report, 'mda,transaction_count,total_amount' AS header, count(*) + 1 AS lines, count(*) AS data_rows FROM report_mda UNION ALL SELECT 'eticket' AS report, 'Ticket type,Ticket sold,Revenue' AS header, count(*) + 1 AS lines, count(*) AS data_rows FROM report_eticket UNION ALL SELECT 'bus' AS report, 'bus_id,trips,revenue' AS header, count(*) + 1 AS lines, count(*) AS data_rows FROM report_bus UNION ALL SELECT 'agents' AS report, 'agent_email,first_name,last_name,bank,bank_account,total_enumeration_count' AS header, count(*) + 1 AS lines, count(*) AS data_rows FROM report_agents
