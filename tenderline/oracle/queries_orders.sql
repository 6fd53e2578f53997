-- name: r01_full_prepay_orders
totals AS (
  SELECT created_when, order_number, order_day, customer_name, surname, first_name, mail, supplier_name, supplier_inn,
         state, pre_payment_percent, sum(val) AS amount
  FROM named_deal JOIN item_value USING (order_id) JOIN last_state USING (order_id) JOIN staff USING (created_by)
  WHERE customer_id NOT IN (7, 77, 777) AND coalesce(pre_payment_percent, 100) = 100 AND pay_delay_days IS NULL
    AND order_day BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'
  GROUP BY ALL),
picked AS (
  SELECT * FROM totals
  QUALIFY row_number() OVER (
    PARTITION BY order_number, customer_name
    ORDER BY order_day, surname NULLS FIRST, first_name NULLS FIRST, mail NULLS FIRST, supplier_name NULLS FIRST,
             supplier_inn NULLS FIRST, amount NULLS FIRST, state NULLS FIRST, pre_payment_percent NULLS FIRST) = 1)
SELECT order_number, order_day::VARCHAR AS order_date, customer_name, surname, first_name, mail, supplier_name,
       supplier_inn, amount::DOUBLE AS amount, coalesce(txt, state) AS state, pre_payment_percent
FROM picked LEFT JOIN order_text ON code = state

-- name: r02_partial_prepay_orders
paid AS (
  SELECT entity AS order_id, sum(replace(replace(entered, chr(160), ''), ',', '.')::DECIMAL(18, 2)) AS paid_sum,
         max(moment) AS paid_at
  FROM d_log WHERE kind = 'ORDER_PARAM_CHANGE' AND word = 'customerPaymentSum' GROUP BY 1),
totals AS (
  SELECT created_when, order_day, customer_name, customer_inn, supplier_name, supplier_inn, order_number, contract_number,
         count(DISTINCT item_value.id) AS item_count, payment_type, sum(val) AS amount, paid_sum, paid_at, state,
         last_state.moment AS state_at, pre_payment_percent, pay_delay_days
  FROM named_deal JOIN item_value USING (order_id) JOIN last_state USING (order_id) LEFT JOIN paid USING (order_id)
  WHERE customer_id NOT IN (7, 77, 777) AND payment_type = 'PARTIAL' AND pre_payment_percent IS NOT NULL
    AND order_day BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'
  GROUP BY ALL),
picked AS (
  SELECT * FROM totals
  QUALIFY row_number() OVER (
    PARTITION BY order_number, customer_name
    ORDER BY order_day, customer_inn NULLS FIRST, supplier_name NULLS FIRST, supplier_inn NULLS FIRST,
             contract_number NULLS FIRST, item_count, payment_type, amount NULLS FIRST, paid_sum NULLS FIRST,
             paid_at NULLS FIRST, state NULLS FIRST, state_at, pre_payment_percent, pay_delay_days NULLS FIRST) = 1)
SELECT order_day::VARCHAR AS order_date, customer_name, customer_inn, supplier_name, supplier_inn, order_number,
       contract_number, item_count, CASE payment_type WHEN 'PARTIAL' THEN 'Частичная' END AS payment_type,
       amount::DOUBLE AS amount, paid_sum::DOUBLE AS paid_sum, strftime(paid_at, '%Y-%m-%d %H:%M:%S') AS paid_changed_at,
       coalesce(txt, state) AS state, strftime(state_at, '%Y-%m-%d %H:%M:%S') AS state_at, pre_payment_percent,
       pay_delay_days
FROM picked LEFT JOIN order_text ON code = state

-- name: r03_payment_vs_delay
pair AS (
  SELECT a.order_id, a.moment AS asked_at, b.moment AS got_at, date_diff('day', a.moment::DATE, b.moment::DATE) AS gap_days
  FROM order_state a JOIN order_state b USING (order_id)
  WHERE a.state IN ('PAYMENT', 'PAYMENT_POSTFACTUM', 'PARTIAL_POST_PAYMENT') AND contains(b.state, 'PAYMENT_RECEIVED')),
totals AS (
  SELECT created_when, order_number, contract_number, order_day, customer_name, surname, first_name, mail, supplier_name,
         supplier_inn, sum(val) AS amount, state, pay_delay_days, gap_days, asked_at, got_at
  FROM named_deal JOIN pair USING (order_id) JOIN item_value USING (order_id) JOIN last_state USING (order_id)
       JOIN staff USING (created_by)
  WHERE customer_id NOT IN (7, 77, 777) AND gap_days <> pay_delay_days
    AND order_day BETWEEN DATE '2001-01-01' AND DATE '2001-06-30'
  GROUP BY ALL),
picked AS (
  SELECT * FROM totals
  QUALIFY row_number() OVER (
    PARTITION BY order_number, customer_name
    ORDER BY asked_at, got_at, contract_number, order_day, surname NULLS FIRST, first_name NULLS FIRST,
             mail NULLS FIRST, supplier_name NULLS FIRST, supplier_inn NULLS FIRST, amount NULLS FIRST,
             state NULLS FIRST) = 1)
SELECT order_number, contract_number, order_day::VARCHAR AS order_date, customer_name, surname, first_name, mail,
       supplier_name, supplier_inn, amount::DOUBLE AS amount, coalesce(txt, state) AS state, pay_delay_days,
       gap_days::INT AS gap_days
FROM picked LEFT JOIN order_text ON code = state

-- name: r04_stale_orders
SELECT order_number, order_day::VARCHAR AS order_date, customer_name, surname, first_name, mail, supplier_name,
       supplier_inn, sum(val)::DOUBLE AS amount, coalesce(txt, state) AS state,
       strftime(moment, '%Y-%m-%d %H:%M:%S') AS state_at
FROM named_deal JOIN item_value USING (order_id) JOIN last_state USING (order_id) JOIN staff USING (created_by)
     LEFT JOIN order_text ON code = state
WHERE customer_id NOT IN (7, 77, 777) AND state NOT IN ('ORDER_CLOSED', 'ORDER_CANCELED')
  AND date_diff('day', moment::DATE, DATE '2001-08-02') >= 90
GROUP BY order_number, created_when, order_day, customer_name, surname, first_name, mail, supplier_name, supplier_inn,
         state, txt, moment
ORDER BY order_number, moment

-- name: r16_1_unclosed_detail
SELECT order_number, contract_number, order_day::VARCHAR AS order_date, customer_name, surname, first_name, mail,
       supplier_name, supplier_inn, sum(val)::DOUBLE AS amount, coalesce(txt, state) AS state,
       strftime(moment, '%Y-%m-%d %H:%M:%S') AS state_at
FROM named_deal JOIN item_value USING (order_id) JOIN last_state USING (order_id) JOIN person USING (created_by)
     LEFT JOIN order_text ON code = state
WHERE customer_id NOT IN (7, 77, 777)
  AND state NOT IN ('ORDER_CANCELED', 'ORDER_CLOSED', 'ORDER_CLOSED_POSTFACTUM')
GROUP BY order_number, contract_number, created_when, order_day, customer_name, surname, first_name, mail,
         supplier_name, supplier_inn, state, txt, moment

-- name: r16_1_by_customer
SELECT customer_id, order_number, contract_number, order_day::VARCHAR AS order_date, customer_name, surname,
       first_name, mail, supplier_name, supplier_inn, sum(val)::DOUBLE AS amount, coalesce(txt, state) AS state,
       strftime(moment, '%Y-%m-%d %H:%M:%S') AS state_at
FROM named_deal JOIN item_value USING (order_id) JOIN last_state USING (order_id) JOIN person USING (created_by)
     LEFT JOIN order_text ON code = state
WHERE state NOT IN ('ORDER_CANCELED', 'ORDER_CLOSED', 'ORDER_CLOSED_POSTFACTUM')
GROUP BY customer_id, order_number, contract_number, created_when, order_day, customer_name, surname, first_name,
         mail, supplier_name, supplier_inn, state, txt, moment

-- name: r11_dual_role_agents
SELECT order_number, order_day::VARCHAR AS order_date, customer_name, surname, first_name, mail, supplier_name,
       supplier_inn, sum(val)::DOUBLE AS amount, state, strftime(max(moment), '%Y-%m-%d %H:%M:%S') AS state_at
FROM named_deal JOIN item_value USING (order_id) JOIN last_state USING (order_id) JOIN staff USING (created_by)
WHERE customer_id NOT IN (7, 77, 777) AND order_day BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'
  AND EXISTS (SELECT 1 FROM buyer b WHERE b.customer_inn = named_deal.supplier_inn)
GROUP BY order_number, created_when, order_day, customer_name, surname, first_name, mail, supplier_name, supplier_inn,
         state, moment

-- name: r05_zero_vat_lines
SELECT order_number, contract_number, order_day::VARCHAR AS order_date, customer_name, surname, first_name, mail,
       supplier_name, supplier_inn, price::DOUBLE AS price, quantity::DOUBLE AS quantity, sum(val)::DOUBLE AS amount,
       tax_percent::VARCHAR AS tax_percent, product_name, category, coalesce(txt, state) AS state
FROM named_deal JOIN category_line USING (order_id) JOIN last_state USING (order_id) JOIN staff USING (created_by)
     LEFT JOIN order_text ON code = state
WHERE customer_id NOT IN (7, 77, 777) AND tax_percent = 0
  AND order_day BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'
GROUP BY order_number, contract_number, contract_id, created_when, order_day, customer_name, surname, first_name, mail,
         supplier_name, supplier_inn, price, quantity, tax_percent, product_name, category, state, txt

-- name: r05_by_customer
SELECT customer_id, order_number, contract_number, order_day::VARCHAR AS order_date, customer_name, surname,
       first_name, mail, supplier_name, supplier_inn, price::DOUBLE AS price, quantity::DOUBLE AS quantity,
       sum(val)::DOUBLE AS amount, tax_percent::VARCHAR AS tax_percent, product_name, category,
       coalesce(txt, state) AS state
FROM named_deal JOIN category_line USING (order_id) JOIN last_state USING (order_id) JOIN staff USING (created_by)
     LEFT JOIN order_text ON code = state
WHERE tax_percent = 0 AND order_day BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'
GROUP BY customer_id, order_number, contract_number, contract_id, created_when, order_day, customer_name, surname,
         first_name, mail, supplier_name, supplier_inn, price, quantity, tax_percent, product_name, category, state, txt

-- name: r08_lines_by_directorate
SELECT directorate, order_number::BIGINT AS order_number, contract_number, contract_id,
       order_day::VARCHAR AS order_date, customer_name, surname, first_name, mail, supplier_name, supplier_inn,
       price::DOUBLE AS price, quantity::DOUBLE AS quantity, sum(val)::DOUBLE AS amount,
       CASE WHEN tax_percent = -1 THEN 'Без НДС' ELSE tax_percent::VARCHAR END AS tax_percent, product_name, category,
       coalesce(txt, state) AS state
FROM named_deal JOIN d_directorate USING (customer_id) JOIN category_line USING (order_id)
     JOIN last_state USING (order_id) JOIN staff USING (created_by) LEFT JOIN order_text ON code = state
WHERE order_day BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'
GROUP BY directorate, order_number, contract_number, contract_id, created_when, order_day, customer_name, surname,
         first_name, mail, supplier_name, supplier_inn, price, quantity, tax_percent, product_name, category, state, txt

-- name: r09_duplicate_suppliers
sizes AS (SELECT supplier_inn, count(DISTINCT agent_id) AS n FROM seller GROUP BY 1),
people AS (
  SELECT staff.created_by, surname, first_name, mail, a.name AS company
  FROM staff LEFT JOIN d_agent a ON a.customer_id = own_customer OR a.supplier_id = own_supplier
  WHERE mail NOT IN ('user3@example.org', 'user41@example.org'))
SELECT supplier_name, strftime(s.created_when, '%Y-%m-%d %H:%M:%S') AS registered_at, supplier_inn, supplier_kpp,
       ls.state AS supplier_state, surname, first_name, mail, company AS creator_company,
       count(DISTINCT o.id) AS orders, count(DISTINCT c.id) AS contracts,
       strftime(max(o.created_when), '%Y-%m-%d %H:%M:%S') AS last_order_at,
       CASE stage WHEN 'ACTIVE' THEN 'Рабочая' WHEN 'BLOCKED' THEN 'Блокирована'
                  WHEN 'REGISTERED' THEN 'Зарегистрирована'
                  WHEN 'CONFIRMED_BY_ADMIN' THEN 'Подтверждена администрацией'
                  WHEN 'CONFIRMED_BY_USER' THEN 'Подтверждена пользователем'
                  WHEN 'DISABLED' THEN 'Удалена' ELSE stage END AS stage
FROM seller JOIN sizes USING (supplier_inn) JOIN d_supplier s ON s.id = seller.supplier_id
     JOIN last_supplier ls ON ls.supplier_id = seller.supplier_id
     JOIN last_stage st ON st.supplier_id = seller.supplier_id
     JOIN people p ON p.created_by = s.created_by
     LEFT JOIN d_contract c ON c.supplier_id = seller.supplier_id LEFT JOIN d_order o ON o.contract_id = c.id
WHERE n > 1 AND n < 10
GROUP BY supplier_name, s.created_when, supplier_inn, supplier_kpp, ls.state, surname, first_name, mail, company, stage

-- name: r09_orders_duplicate_suppliers
sizes AS (SELECT supplier_inn, count(DISTINCT agent_id) AS n FROM seller GROUP BY 1)
SELECT order_number, order_day::VARCHAR AS order_date, customer_name, surname, first_name, mail, supplier_name,
       supplier_inn, supplier_kpp, sum(val)::DOUBLE AS amount, coalesce(txt, state) AS state,
       strftime(moment, '%Y-%m-%d %H:%M:%S') AS state_at
FROM named_deal JOIN sizes USING (supplier_inn) JOIN item_value USING (order_id) JOIN last_state USING (order_id)
     JOIN staff USING (created_by) LEFT JOIN order_text ON code = state
WHERE customer_id NOT IN (7, 77, 777) AND order_day BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'
  AND n BETWEEN 2 AND 9 AND supplier_id IN (SELECT supplier_id FROM last_supplier)
GROUP BY order_number, created_when, order_day, customer_name, surname, first_name, mail, supplier_name, supplier_inn,
         supplier_kpp, state, txt, moment

-- name: r09_orders_by_customer
sizes AS (SELECT supplier_inn, count(DISTINCT agent_id) AS n FROM seller GROUP BY 1)
SELECT customer_id, order_number, order_day::VARCHAR AS order_date, customer_name, surname, first_name, mail,
       supplier_name, supplier_inn, supplier_kpp, sum(val)::DOUBLE AS amount, coalesce(txt, state) AS state,
       strftime(moment, '%Y-%m-%d %H:%M:%S') AS state_at
FROM named_deal JOIN sizes USING (supplier_inn) JOIN item_value USING (order_id) JOIN last_state USING (order_id)
     JOIN staff USING (created_by) LEFT JOIN order_text ON code = state
WHERE order_day BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'
  AND n BETWEEN 2 AND 9 AND supplier_id IN (SELECT supplier_id FROM last_supplier)
GROUP BY customer_id, order_number, created_when, order_day, customer_name, surname, first_name, mail, supplier_name,
         supplier_inn, supplier_kpp, state, txt, moment
