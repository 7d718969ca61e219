WITH agent_transactions_raw AS (SELECT CAST(o_orderkey AS BIGINT) AS idagent_transactions,
       CAST('AGENCY-' || CAST(o_orderkey % 4 AS VARCHAR) AS VARCHAR) AS agency,
       CAST(CASE WHEN o_orderkey % 19 = 3 THEN NULL ELSE 'state_id-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS state_id,
       CAST(CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'agent' || CAST(o_orderkey % 40 AS VARCHAR) END AS VARCHAR) AS agent_user,
       CAST(CASE WHEN o_orderkey % 19 = 5 THEN NULL ELSE 'agent_code-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS agent_code,
       CAST(CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE (TIMESTAMP '2024-01-25' + CAST(o_orderkey % 7 AS INTEGER) * INTERVAL '1' DAY + CAST(o_orderkey % 24 AS INTEGER) * INTERVAL '1' HOUR) END AS TIMESTAMP) AS trans_date,
       CAST(CASE WHEN o_orderkey % 19 = 7 THEN NULL ELSE 'trans_ref-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS trans_ref,
       CAST(CASE WHEN o_orderkey % 19 = 8 THEN NULL ELSE 'payment_ref-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS payment_ref,
       CAST(CASE WHEN o_orderkey % 19 = 9 THEN NULL ELSE 'rev_head-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS rev_head,
       CAST('Brand#' || CAST(o_custkey % 30 AS VARCHAR) AS VARCHAR) AS rev_code,
       CAST(CASE WHEN o_orderkey % 19 = 11 THEN NULL ELSE 'refcode-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS refcode,
       CAST(CASE WHEN o_orderkey % 19 = 12 THEN NULL ELSE 'reference-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS reference,
       CAST(CASE WHEN o_orderkey % 19 = 13 THEN NULL ELSE 'initialize_url-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS initialize_url,
       CAST(CASE WHEN o_orderkey % 19 = 14 THEN NULL ELSE 'payment_token-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS payment_token,
       CAST(CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 41 = 0 THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(19,2)) AS amount,
       CAST(CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '2024' END AS VARCHAR) AS payment_period,
       CAST(CASE WHEN o_orderkey % 19 = 17 THEN NULL ELSE 'next_date-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS next_date,
       CAST(CASE WHEN o_orderkey % 19 = 18 THEN NULL ELSE 'no_of_days-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS no_of_days,
       CAST(CASE o_custkey % 4 WHEN 0 THEN 'POS' WHEN 1 THEN 'Web' WHEN 2 THEN 'Mobile' END AS VARCHAR) AS trans_channel,
       CAST(CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'P' THEN (CASE WHEN o_orderkey % 2 = 0 THEN 'Completed' ELSE 'Processing' END) WHEN 'O' THEN (CASE o_orderkey % 3 WHEN 0 THEN 'Reversed' WHEN 1 THEN 'Failed' ELSE 'Cancelled' END) END AS VARCHAR) AS status,
       CAST(CASE WHEN o_orderkey % 19 = 2 THEN NULL ELSE 'trans_type-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS trans_type,
       CAST('LGA-' || CAST(o_custkey % 5 AS VARCHAR) AS VARCHAR) AS lga,
       CAST(CASE WHEN o_orderkey % 19 = 4 THEN NULL ELSE 'createtime-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS createtime,
       CAST(CASE WHEN o_orderkey % 19 = 5 THEN NULL ELSE 'vehicle_type-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS vehicle_type,
       CAST(CASE WHEN o_orderkey % 19 = 6 THEN NULL ELSE 'vehicle_tonnage-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS vehicle_tonnage,
       CAST(CASE WHEN o_orderkey % 19 = 7 THEN NULL ELSE 'vehicle_content-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS vehicle_content,
       CAST(CASE WHEN o_orderkey % 19 = 8 THEN NULL ELSE 'take_off_point-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS take_off_point,
       CAST(CASE WHEN o_orderkey % 19 = 9 THEN NULL ELSE 'drop_off_destination-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS drop_off_destination,
       CAST(CASE WHEN o_orderkey % 19 = 10 THEN NULL ELSE 'taxpayer_type-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS taxpayer_type,
       CAST('Customer-' || CAST(o_custkey AS VARCHAR) AS VARCHAR) AS taxpayer_name,
       CAST(CASE WHEN o_orderkey % 19 = 12 THEN NULL ELSE 'taxpayer_email-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS taxpayer_email,
       CAST(CASE WHEN o_orderkey % 19 = 13 THEN NULL ELSE 'taxpayer_phone-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS taxpayer_phone,
       CAST(CASE WHEN o_orderkey % 19 = 14 THEN NULL ELSE 'market-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS market,
       CAST(CASE WHEN o_orderkey % 19 = 15 THEN NULL ELSE 'zone_line-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS zone_line,
       CAST(CASE WHEN o_orderkey % 19 = 16 THEN NULL ELSE 'shop_number-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS shop_number,
       CAST('P-' || CAST(o_custkey % 20 AS VARCHAR) AS VARCHAR) AS revenue_item,
       CAST(CASE o_orderpriority WHEN '1-URGENT' THEN (CASE WHEN o_orderkey % 2 = 0 THEN 'card' ELSE 'Card' END) WHEN '2-HIGH' THEN (CASE o_orderkey % 3 WHEN 0 THEN 'Bank' WHEN 1 THEN 'bank' ELSE 'Bank Transfer' END) WHEN '3-MEDIUM' THEN (CASE WHEN o_orderkey % 2 = 0 THEN 'USSD' ELSE 'ussd' END) WHEN '5-LOW' THEN (CASE o_orderkey % 3 WHEN 0 THEN 'Cash' WHEN 1 THEN 'cash' ELSE 'Wallet' END) END AS VARCHAR) AS payment_method,
       CAST(CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE 'plate_number-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS plate_number,
       CAST(CASE WHEN o_orderkey % 19 = 1 THEN NULL ELSE 'enumeration_id-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS enumeration_id,
       CAST(CASE WHEN o_orderkey % 19 = 2 THEN NULL ELSE 'comment-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS comment,
       CAST(CASE WHEN o_orderkey % 19 = 3 THEN NULL ELSE 'taxoffice-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS taxoffice,
       CAST(CASE WHEN o_orderkey % 19 = 4 THEN NULL ELSE 'notice_number-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS notice_number,
       CAST(CASE WHEN o_orderkey % 19 = 5 THEN NULL ELSE 'notice_number_fiscal_year-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS notice_number_fiscal_year,
       CAST(CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE (TIMESTAMP '2024-01-25' + CAST(o_orderkey % 7 + o_orderkey % 3 AS INTEGER) * INTERVAL '1' DAY + CAST(o_orderkey % 24 AS INTEGER) * INTERVAL '1' HOUR) END AS TIMESTAMP) AS payment_date,
       CAST(CASE WHEN o_orderkey % 19 = 7 THEN NULL ELSE TIMESTAMP '2024-03-01 00:00:00' + INTERVAL '45' DAY + CAST(o_orderkey % 24 AS INTEGER) * INTERVAL '1' HOUR END AS TIMESTAMP) AS valid_date,
       CAST(CASE WHEN o_orderkey % 19 = 8 THEN NULL ELSE 'terminalid-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS terminalid,
       CAST(CASE WHEN o_orderkey % 19 = 9 THEN NULL ELSE 'terminal_serial_number-' || CAST(o_orderkey AS VARCHAR) END AS VARCHAR) AS terminal_serial_number,
       CAST(CASE WHEN o_orderkey % 19 = 10 THEN NULL ELSE TIMESTAMP '2024-03-01 00:00:00' + INTERVAL '48' DAY + CAST(o_orderkey % 24 AS INTEGER) * INTERVAL '1' HOUR END AS TIMESTAMP) AS updated_at FROM orders),
rev_sub_newcode_raw AS (SELECT CAST(n AS INTEGER) AS id,
       CAST('MDA-' || CAST(n % 5 AS VARCHAR) AS VARCHAR) AS mda,
       CAST(CASE WHEN n % 19 = 3 THEN NULL ELSE 'rev_head-' || CAST(n AS VARCHAR) END AS VARCHAR) AS rev_head,
       CAST(p_brand AS VARCHAR) AS rev_code,
       CAST(CASE WHEN n % 19 = 5 THEN NULL ELSE 'item-' || CAST(n AS VARCHAR) END AS VARCHAR) AS item,
       CAST(CASE WHEN n % 19 = 6 THEN NULL ELSE 'receipt-' || CAST(n AS VARCHAR) END AS VARCHAR) AS receipt,
       CAST(CASE WHEN n % 19 = 7 THEN NULL ELSE n % 1000 + 7000 END AS INTEGER) AS idrev_sub,
       CAST(CASE WHEN n % 6 = 0 THEN NULL ELSE 'Item for ' || p_brand END AS VARCHAR) AS revenue_item,
       CAST(CASE WHEN n % 19 = 9 THEN NULL ELSE 'enter_by-' || CAST(n AS VARCHAR) END AS VARCHAR) AS enter_by,
       CAST(TIMESTAMP '2024-01-01 00:00:00' AS TIMESTAMP) AS created_at
  FROM (SELECT p_brand,
       CAST(split_part(p_brand, '#', 2) AS INTEGER) AS n
  FROM (SELECT DISTINCT p_brand FROM part))),
bus_ticketing_transaction_raw AS (SELECT CAST(event_id AS INTEGER) AS id,
       CAST(event_type AS VARCHAR) AS event,
       CAST(CASE WHEN event_id % 19 = 3 THEN NULL ELSE 'event_name-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS event_name,
       CAST(CASE WHEN event_id % 19 = 4 THEN NULL ELSE 'trans_id-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS trans_id,
       CAST(value AS DECIMAL(10,2)) AS amount,
       CAST(CASE WHEN event_id % 19 = 6 THEN NULL ELSE 'card_serial-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS card_serial,
       CAST('080' || CAST(user_id AS VARCHAR) AS VARCHAR) AS phone,
       CAST(CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS TIMESTAMP) AS trans_date,
       CAST(CASE WHEN event_id % 19 = 9 THEN NULL ELSE TIMESTAMP '2024-03-01 00:00:00' + INTERVAL '9' DAY + CAST(event_id % 24 AS INTEGER) * INTERVAL '1' HOUR END AS TIMESTAMP) AS checkout,
       CAST('BUS-' || CAST(user_id % 20 AS VARCHAR) AS VARCHAR) AS bus_id,
       CAST(CASE WHEN event_id % 19 = 11 THEN NULL ELSE 'route_name-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS route_name,
       CAST(CASE WHEN event_id % 19 = 12 THEN NULL ELSE 'entry_point-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS entry_point,
       CAST(CASE WHEN event_id % 19 = 13 THEN NULL ELSE 'exit_point-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS exit_point,
       CAST(CASE WHEN event_id % 19 = 14 THEN NULL ELSE 'i_type-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS i_type,
       CAST('ISS-' || CAST(event_id % 7 AS VARCHAR) AS VARCHAR) AS issuer_id,
       CAST(CASE WHEN event_id % 19 = 16 THEN NULL ELSE 'issuer_name-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS issuer_name,
       CAST(TIMESTAMP '2024-01-01 00:00:00' AS TIMESTAMP) AS created_at,
       CAST(CASE WHEN event_id % 19 = 18 THEN NULL ELSE TIMESTAMP '2024-03-01 00:00:00' + INTERVAL '18' DAY + CAST(event_id % 24 AS INTEGER) * INTERVAL '1' HOUR END AS TIMESTAMP) AS updated_at FROM events),
concession_permit_raw AS (SELECT CAST(p_partkey AS INTEGER) AS id,
       CAST(CASE WHEN p_partkey % 19 = 2 THEN NULL ELSE 'merchant_id-' || CAST(p_partkey AS VARCHAR) END AS VARCHAR) AS merchant_id,
       CAST(p_type AS VARCHAR) AS category,
       CAST(CASE WHEN p_partkey % 19 = 4 THEN NULL ELSE 'product_tag-' || CAST(p_partkey AS VARCHAR) END AS VARCHAR) AS product_tag,
       CAST('P-' || CAST(CASE WHEN p_partkey BETWEEN 20 AND 23 THEN p_partkey - 20 ELSE p_partkey END AS VARCHAR) AS VARCHAR) AS product_code,
       CAST(p_name AS VARCHAR) AS product_name,
       CAST(p_retailprice * 200 AS DECIMAL(10,2)) AS amount,
       CAST(p_retailprice * 150 AS DECIMAL(10,2)) AS p_amount,
       CAST(CASE p_partkey % 5 WHEN 0 THEN 'Vehicle' WHEN 1 THEN 'Trader' WHEN 2 THEN 'Vehicle' WHEN 3 THEN 'Trader' ELSE 'Other' END AS VARCHAR) AS plan_code,
       CAST(CASE WHEN p_partkey % 7 = 6 THEN 'Inactive' ELSE 'Active' END AS VARCHAR) AS status FROM part),
enumeration_raw AS (SELECT CAST(event_id AS INTEGER) AS id,
       CAST(CASE WHEN event_id % 19 = 2 THEN NULL ELSE 'site_id-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS site_id,
       CAST(CASE WHEN event_id % 19 = 3 THEN NULL ELSE 'enumeration_id-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS enumeration_id,
       CAST(CASE WHEN event_id % 19 = 4 THEN NULL ELSE 'park-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS park,
       CAST(CASE WHEN event_id % 19 = 5 THEN NULL ELSE 'taxpayer_id-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS taxpayer_id,
       CAST(CASE WHEN event_id % 19 = 6 THEN NULL ELSE 'taxpayer_name-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS taxpayer_name,
       CAST(CASE WHEN event_id % 19 = 7 THEN NULL ELSE 'revenue_year-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS revenue_year,
       CAST(CASE WHEN event_id % 19 = 8 THEN NULL ELSE 'location-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS location,
       CAST(CASE event_type WHEN 'signup' THEN 'MarketEnumeration' WHEN 'click' THEN 'TransportEnumeration' WHEN 'error' THEN 'OtherEnumeration' END AS VARCHAR) AS revenue_item,
       CAST(CASE WHEN event_id % 4 = 0 THEN 'Corporate' ELSE 'Individual' END AS VARCHAR) AS category,
       CAST(CASE WHEN event_id % 19 = 11 THEN NULL ELSE 'union_name-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS union_name,
       CAST(CASE WHEN event_id % 19 = 12 THEN NULL ELSE 'plate_number-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS plate_number,
       CAST(CASE WHEN event_id % 19 = 13 THEN NULL ELSE 'market-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS market,
       CAST(CASE WHEN event_id % 19 = 14 THEN NULL ELSE 'market_id-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS market_id,
       CAST(CASE WHEN event_id % 19 = 15 THEN NULL ELSE 'zone_line-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS zone_line,
       CAST(CASE WHEN event_id % 19 = 16 THEN NULL ELSE 'shop_number-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS shop_number,
       CAST(CASE WHEN event_id % 19 = 17 THEN NULL ELSE 'have_abssin-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS have_abssin,
       CAST(CASE WHEN event_id % 19 = 18 THEN NULL ELSE 'taxpayer_phone-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS taxpayer_phone,
       CAST(CASE WHEN event_id % 19 = 0 THEN NULL ELSE 'shop_occupants-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS shop_occupants,
       CAST(CASE WHEN event_id % 19 = 1 THEN NULL ELSE 'income_category-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS income_category,
       CAST(CASE WHEN event_id % 19 = 2 THEN NULL ELSE 'monthly_income-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS monthly_income,
       CAST(CASE WHEN event_id % 19 = 3 THEN NULL ELSE 'income_amount-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS income_amount,
       CAST(CASE WHEN event_id % 19 = 4 THEN NULL ELSE 'shop_category-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS shop_category,
       CAST(CASE WHEN event_id % 19 = 5 THEN NULL ELSE 'occupant_income_amount-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS occupant_income_amount,
       CAST(CASE WHEN event_id % 19 = 6 THEN NULL ELSE 'payment_method-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS payment_method,
       CAST(CASE WHEN event_id % 19 = 7 THEN NULL ELSE 'enumeration_plan-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS enumeration_plan,
       CAST(CASE WHEN event_id % 19 = 8 THEN NULL ELSE 'enumeration_fee-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS enumeration_fee,
       CAST(CASE WHEN event_id % 19 = 9 THEN NULL ELSE 'status-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS status,
       CAST(CASE WHEN event_id % 19 = 10 THEN NULL ELSE 'enumeration_status-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS enumeration_status,
       CAST(CASE WHEN event_id % 19 = 11 THEN NULL ELSE 'asset_code-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS asset_code,
       CAST(CASE WHEN event_id % 19 = 12 THEN NULL ELSE 'enumeration_type-' || CAST(event_id AS VARCHAR) END AS VARCHAR) AS enumeration_type,
       CAST(CASE WHEN event_id % 19 = 13 THEN NULL ELSE event_id % 1000 + 32000 END AS INTEGER) AS notice_generated,
       CAST('user' || CAST(user_id AS VARCHAR) || '@example.org' AS VARCHAR) AS created_by,
       CAST(ts AS TIMESTAMP) AS create_time
  FROM events),
merchant_user_raw AS (SELECT CAST(c_custkey AS INTEGER) AS user_id,
       CAST(CASE WHEN c_custkey % 19 = 2 THEN NULL ELSE 'abssin-' || CAST(c_custkey AS VARCHAR) END AS VARCHAR) AS abssin,
       CAST(c_mktsegment AS VARCHAR) AS user_cat,
       CAST(c_name AS VARCHAR) AS first_name,
       CAST(CASE WHEN c_custkey % 19 = 5 THEN NULL ELSE 'last_name-' || CAST(c_custkey AS VARCHAR) END AS VARCHAR) AS last_name,
       CAST(CASE WHEN c_custkey % 19 = 6 THEN NULL ELSE 'company-' || CAST(c_custkey AS VARCHAR) END AS VARCHAR) AS company,
       CAST(CASE WHEN c_custkey % 19 = 7 THEN NULL ELSE 'merchant_id-' || CAST(c_custkey AS VARCHAR) END AS VARCHAR) AS merchant_id,
       CAST(CASE WHEN c_custkey % 19 = 8 THEN NULL ELSE 'agent_code-' || CAST(c_custkey AS VARCHAR) END AS VARCHAR) AS agent_code,
       CAST(CASE WHEN c_custkey % 19 = 9 THEN NULL ELSE 'collection_type-' || CAST(c_custkey AS VARCHAR) END AS VARCHAR) AS collection_type,
       CAST(CASE WHEN c_custkey % 19 = 10 THEN NULL ELSE 'phone_no-' || CAST(c_custkey AS VARCHAR) END AS VARCHAR) AS phone_no,
       CAST(CASE WHEN c_custkey % 50 = 49 THEN NULL ELSE 'user' || CAST(CASE WHEN c_custkey >= 100 AND c_custkey % 100 < 10 THEN c_custkey - 100 ELSE c_custkey + 5 END AS VARCHAR) || '@example.org' END AS VARCHAR) AS email,
       CAST(CASE WHEN c_acctbal > 0 THEN 'Verified' ELSE 'Pending' END AS VARCHAR) AS status,
       CAST(CASE WHEN c_custkey % 19 = 13 THEN NULL ELSE 'create_by-' || CAST(c_custkey AS VARCHAR) END AS VARCHAR) AS create_by,
       CAST('LGA-' || CAST(c_custkey % 5 AS VARCHAR) AS VARCHAR) AS lga,
       CAST(CASE WHEN c_custkey % 19 = 15 THEN NULL ELSE 'lga_zone-' || CAST(c_custkey AS VARCHAR) END AS VARCHAR) AS lga_zone,
       CAST(CASE WHEN c_custkey % 19 = 16 THEN NULL ELSE 'bank-' || CAST(c_custkey AS VARCHAR) END AS VARCHAR) AS bank,
       CAST(CASE WHEN c_custkey % 19 = 17 THEN NULL ELSE 'bank_account-' || CAST(c_custkey AS VARCHAR) END AS VARCHAR) AS bank_account,
       CAST(CASE WHEN c_custkey % 19 = 18 THEN NULL ELSE 'balance-' || CAST(c_custkey AS VARCHAR) END AS VARCHAR) AS balance,
       CAST((TIMESTAMP '2024-01-01' + CAST(c_custkey % 28 AS INTEGER) * INTERVAL '1' DAY + CAST(0 AS INTEGER) * INTERVAL '1' HOUR) AS TIMESTAMP) AS create_time,
       CAST(CASE WHEN c_custkey % 19 = 1 THEN NULL ELSE TIMESTAMP '2024-03-01 00:00:00' + INTERVAL '20' DAY + CAST(c_custkey % 24 AS INTEGER) * INTERVAL '1' HOUR END AS TIMESTAMP) AS createdate,
       CAST(CASE WHEN c_custkey % 19 = 2 THEN NULL ELSE 'update_by-' || CAST(c_custkey AS VARCHAR) END AS VARCHAR) AS update_by,
       CAST(CASE WHEN c_custkey % 3 = 0 THEN (TIMESTAMP '2024-01-15' + CAST(c_custkey % 14 AS INTEGER) * INTERVAL '1' DAY + CAST(0 AS INTEGER) * INTERVAL '1' HOUR) END AS TIMESTAMP) AS update_time FROM customer),
stg_agent_transactions AS (SELECT idagent_transactions AS transaction_id, agency, state_id, agent_user, agent_code, trans_date AS transaction_date, trans_ref AS transaction_ref, payment_ref, rev_head AS revenue_head, rev_code AS revenue_code, refcode, reference, amount, payment_period, trans_channel AS transaction_channel, status, trans_type AS transaction_type, lga, taxpayer_type, taxpayer_name, taxpayer_email, taxpayer_phone, market, zone_line, shop_number, revenue_item, payment_method, plate_number, enumeration_id, vehicle_type, vehicle_tonnage, vehicle_content, take_off_point, drop_off_destination, taxoffice AS tax_office, notice_number, notice_number_fiscal_year, payment_date, valid_date, terminalid AS terminal_id, terminal_serial_number, updated_at,
       CAST(payment_date AS DATE) AS payment_day,
       CAST(date_trunc('month', payment_date) AS TIMESTAMP) AS payment_month,
       CAST(extract(year FROM payment_date) AS INTEGER) AS payment_year FROM agent_transactions_raw WHERE payment_date IS NOT NULL),
stg_bus_ticketing_transaction AS (SELECT id AS ticket_id, event, event_name, trans_id AS transaction_ref, amount, card_serial, phone, trans_date AS transaction_date, checkout, bus_id, route_name, entry_point, exit_point, i_type AS instrument_type, issuer_id, issuer_name, created_at, updated_at,
       CAST(trans_date AS DATE) AS transaction_day,
       CAST(date_trunc('month', trans_date) AS TIMESTAMP) AS transaction_month,
       CAST(extract(year FROM trans_date) AS INTEGER) AS transaction_year FROM bus_ticketing_transaction_raw WHERE trans_date IS NOT NULL),
stg_concession_permit AS (SELECT id AS permit_id, merchant_id, category, product_tag, product_code, product_name, amount AS expected_amount, p_amount AS previous_expected_amount, plan_code, status FROM concession_permit_raw WHERE status = 'Active' AND plan_code IN ('Vehicle', 'Trader')),
stg_enumeration AS (SELECT id AS enumeration_pk, site_id, enumeration_id, park, taxpayer_id, taxpayer_name, revenue_year, location, revenue_item, category, union_name, plate_number, market, market_id, zone_line, shop_number, have_abssin, taxpayer_phone, shop_occupants, income_category, monthly_income, income_amount, shop_category, occupant_income_amount, payment_method, enumeration_plan, enumeration_fee, status, enumeration_status, asset_code, enumeration_type, notice_generated, created_by, create_time FROM enumeration_raw),
stg_merchant_user AS (SELECT user_id, abssin, user_cat, first_name, last_name, company, merchant_id, agent_code, collection_type, phone_no, email, status AS agent_status, create_by, lga, lga_zone, bank, bank_account, balance, create_time, createdate, update_by, update_time FROM merchant_user_raw),
stg_rev_sub_newcode AS (SELECT id AS rev_sub_id, mda, rev_head, rev_code, item AS revenue_item_name, receipt, idrev_sub AS rev_sub_ref_id, revenue_item AS revenue_item_full, enter_by, created_at FROM rev_sub_newcode_raw),
fct_transactions AS (SELECT t.transaction_id, t.transaction_ref, t.payment_ref, t.payment_date, t.payment_day, t.payment_month, t.payment_year, t.transaction_date, t.agent_user, t.agent_code, t.agency, t.transaction_channel, t.terminal_id, t.lga, t.state_id, t.tax_office, coalesce(r.mda, 'Unknown') AS mda, t.revenue_item, coalesce(r.revenue_item_full, t.revenue_item) AS revenue_item_name, t.revenue_head, t.revenue_code, t.taxpayer_name, t.taxpayer_email, t.taxpayer_phone, t.taxpayer_type, t.plate_number, t.enumeration_id, t.amount, t.status, t.transaction_type, t.payment_method, t.payment_period, t.notice_number, t.notice_number_fiscal_year, t.vehicle_type, t.vehicle_tonnage, t.take_off_point, t.drop_off_destination, t.market, t.zone_line, t.shop_number, t.valid_date, t.updated_at, CASE WHEN t.status = 'Completed' THEN true ELSE false END AS is_completed, CASE WHEN t.status = 'Reversed' THEN true ELSE false END AS is_reversed, CASE WHEN t.amount < 0 THEN true ELSE false END AS is_negative_amount, CASE WHEN t.payment_method IN ('Card', 'card') THEN 'Card' WHEN t.payment_method IN ('Bank', 'bank', 'Bank Transfer') THEN 'Bank Transfer' WHEN t.payment_method IN ('Cash', 'cash') THEN 'Cash' WHEN t.payment_method IN ('USSD', 'ussd') THEN 'USSD' ELSE coalesce(t.payment_method, 'Unknown') END AS payment_method_clean FROM stg_agent_transactions t LEFT JOIN stg_rev_sub_newcode r ON t.revenue_code = r.rev_code WHERE t.amount IS NOT NULL),
fct_concession_permits AS (SELECT t.transaction_id, t.transaction_ref, t.payment_ref, p.permit_id, p.plan_code, p.category, p.product_code, p.product_name, p.product_tag, p.merchant_id, t.payment_date, t.payment_day, t.payment_month, t.payment_year, t.transaction_date, t.agent_user, t.agent_code, t.agency, t.transaction_channel, t.terminal_id, t.lga, t.state_id, t.tax_office, t.mda, t.revenue_item, t.revenue_item_name, t.revenue_head, t.revenue_code, t.taxpayer_name, t.taxpayer_email, t.taxpayer_phone, t.taxpayer_type, t.plate_number, t.enumeration_id, t.amount AS paid_amount, p.expected_amount, p.previous_expected_amount,
       CAST(t.amount - p.expected_amount AS DECIMAL(20,2)) AS variance_amount, t.status, t.transaction_type, t.payment_method, t.payment_method_clean, t.payment_period, t.notice_number, t.notice_number_fiscal_year, t.vehicle_type, t.vehicle_tonnage, t.take_off_point, t.drop_off_destination, t.market, t.zone_line, t.shop_number, t.is_completed, t.is_reversed, t.is_negative_amount, CASE WHEN t.amount >= p.expected_amount THEN true ELSE false END AS is_fully_paid, t.valid_date, t.updated_at
  FROM (SELECT s.transaction_id AS pt_id, c.* FROM stg_agent_transactions s  JOIN stg_concession_permit c ON s.revenue_item = c.product_code) p JOIN fct_transactions t ON p.pt_id = t.transaction_id),
fct_agent_enumeration AS (
SELECT m.user_id, m.email AS agent_email, m.first_name, m.last_name, m.phone_no, m.lga, m.user_cat, m.bank,
       m.bank_account, m.agent_status, m.agent_code, e.revenue_item,
       CASE e.revenue_item WHEN 'MarketEnumeration' THEN 'Market' WHEN 'TransportEnumeration' THEN 'Transport' END AS revenue_type,
       e.category,
       CAST(e.create_time AS DATE) AS create_day, strftime(e.create_time, '%Y-%m') AS create_month,
       CAST(extract(year FROM e.create_time) AS INTEGER) AS create_year,
       count(e.enumeration_pk) AS enumeration_count
FROM stg_enumeration e LEFT JOIN stg_merchant_user m ON e.created_by = m.email
GROUP BY ALL
),
agg_revenue_daily AS (
SELECT payment_day, payment_month, payment_year, lga, mda, revenue_item, transaction_channel, payment_method_clean,
       count(*) AS transaction_count, count(DISTINCT agent_user) AS unique_agents,
       count(DISTINCT taxpayer_name) AS unique_taxpayers, sum(amount) AS total_amount,
       CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_amount, min(amount) AS min_amount,
       max(amount) AS max_amount, count(*) FILTER (WHERE is_reversed) AS reversed_count,
       count(*) FILTER (WHERE is_negative_amount) AS negative_amount_count
FROM fct_transactions WHERE is_completed
GROUP BY payment_day, payment_month, payment_year, lga, mda, revenue_item, transaction_channel, payment_method_clean
),
agg_concession_by_plancode AS (
SELECT payment_day, payment_month, payment_year, plan_code, category, product_code, product_name, lga,
       transaction_channel, payment_method_clean,
       count(DISTINCT transaction_id) AS transaction_count, count(DISTINCT taxpayer_name) AS unique_taxpayers,
       count(DISTINCT agent_user) AS unique_agents, sum(paid_amount) AS total_paid_amount,
       CAST(sum(paid_amount) AS DOUBLE) / count(paid_amount) AS avg_paid_amount,
       min(paid_amount) AS min_paid_amount, max(paid_amount) AS max_paid_amount,
       max(expected_amount) AS expected_amount, max(previous_expected_amount) AS previous_expected_amount,
       max(expected_amount) * count(DISTINCT transaction_id) - sum(paid_amount) AS total_shortfall,
       count(*) FILTER (WHERE is_reversed) AS reversed_count,
       count(*) FILTER (WHERE is_fully_paid) AS fully_paid_count
FROM fct_concession_permits WHERE is_completed
GROUP BY payment_day, payment_month, payment_year, plan_code, category, product_code, product_name, lga,
         transaction_channel, payment_method_clean
),
agg_bus_daily AS (
SELECT 'Bus Ticket' AS revenue_source, transaction_day AS revenue_date, transaction_month AS revenue_month,
       transaction_year AS revenue_year,
       CAST(NULL AS VARCHAR) AS lga,
       CAST(NULL AS VARCHAR) AS transaction_channel,
       CAST(NULL AS VARCHAR) AS payment_method_clean,
       CAST(NULL AS VARCHAR) AS category,
       CAST(NULL AS VARCHAR) AS product_code,
       CAST(NULL AS VARCHAR) AS product_name,
       count(DISTINCT ticket_id) AS transaction_count, count(DISTINCT phone) AS unique_payers,
       count(DISTINCT issuer_id) AS unique_agents,
       CAST(sum(amount) AS DECIMAL(29,2)) AS total_amount,
       CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_amount,
       CAST(min(amount) AS DECIMAL(19,2)) AS min_amount,
       CAST(max(amount) AS DECIMAL(19,2)) AS max_amount,
       CAST(NULL AS DECIMAL(10,2)) AS expected_amount,
       CAST(NULL AS DECIMAL(32,2)) AS total_shortfall,
       CAST(NULL AS BIGINT) AS reversed_count,
       CAST(NULL AS BIGINT) AS fully_paid_count
FROM stg_bus_ticketing_transaction
GROUP BY transaction_day, transaction_month, transaction_year
),
agg_combined_revenue_daily AS (
SELECT * FROM agg_bus_daily
UNION ALL
SELECT CASE plan_code WHEN 'Trader' THEN 'Market Ticket' WHEN 'Vehicle' THEN 'Vehicle Ticket' END,
       payment_day, payment_month, payment_year, lga, transaction_channel, payment_method_clean, category,
       product_code, product_name, transaction_count, unique_taxpayers, unique_agents,
       CAST(total_paid_amount AS DECIMAL(29,2)), avg_paid_amount, min_paid_amount, max_paid_amount,
       expected_amount,
       CAST(total_shortfall AS DECIMAL(32,2)), reversed_count, fully_paid_count
FROM agg_concession_by_plancode
)
