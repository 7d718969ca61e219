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
SELECT 'mda_collections_2024-01-27_to_2024-02-02.csv' AS file_name, 'mda,transaction_count,total_amount' AS line UNION ALL
SELECT 'mda_collections_2024-01-27_to_2024-02-02.csv', coalesce(CAST(mda AS VARCHAR), '') || ',' || coalesce(CAST(transaction_count AS VARCHAR), '') || ',' || coalesce(CAST(total_amount AS VARCHAR), '') FROM report_mda UNION ALL
SELECT 'eticket_type_breakdown_2024-01-27_to_2024-02-02.csv' AS file_name, 'Ticket type,Ticket sold,Revenue' AS line UNION ALL
SELECT 'eticket_type_breakdown_2024-01-27_to_2024-02-02.csv', coalesce(CAST("Ticket type" AS VARCHAR), '') || ',' || coalesce(CAST("Ticket sold" AS VARCHAR), '') || ',' || coalesce(CAST("Revenue" AS VARCHAR), '') FROM report_eticket UNION ALL
SELECT 'bus_performance_summary_2024-01-27_to_2024-02-02.csv' AS file_name, 'bus_id,trips,revenue' AS line UNION ALL
SELECT 'bus_performance_summary_2024-01-27_to_2024-02-02.csv', coalesce(CAST(bus_id AS VARCHAR), '') || ',' || coalesce(CAST(trips AS VARCHAR), '') || ',' || coalesce(CAST(revenue AS VARCHAR), '') FROM report_bus UNION ALL
SELECT 'agent_enumeration_2024-01-27_to_2024-02-02.csv' AS file_name, 'agent_email,first_name,last_name,bank,bank_account,total_enumeration_count' AS line UNION ALL
SELECT 'agent_enumeration_2024-01-27_to_2024-02-02.csv', coalesce(CAST(agent_email AS VARCHAR), '') || ',' || coalesce(CAST(first_name AS VARCHAR), '') || ',' || coalesce(CAST(last_name AS VARCHAR), '') || ',' || coalesce(CAST(bank AS VARCHAR), '') || ',' || coalesce(CAST(bank_account AS VARCHAR), '') || ',' || coalesce(CAST(total_enumeration_count AS VARCHAR), '') FROM report_agents
