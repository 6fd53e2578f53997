-- name: r15_advance_contracts
partial AS (
  SELECT c.*, g.name AS category
  FROM d_contract c LEFT JOIN d_supplier_group sg USING (supplier_id) LEFT JOIN d_group g ON g.id = sg.group_id
  WHERE payment_type = 'PARTIAL'),
active AS (
  SELECT customer_id, pre_payment_percent, category, count(DISTINCT id) AS n_active
  FROM partial WHERE to_date IS NULL OR to_date >= DATE '2001-08-02' GROUP BY 1, 2, 3)
SELECT customer_name, count(DISTINCT p.id) AS contracts, n_active AS active_contracts,
       'Частичная предоплата' AS payment_type, p.pre_payment_percent,
       string_agg(DISTINCT p.category, ' / ' ORDER BY p.category) AS categories
FROM partial p JOIN active a ON a.customer_id = p.customer_id AND a.pre_payment_percent = p.pre_payment_percent
                             AND a.category IS NOT DISTINCT FROM p.category
     JOIN buyer b ON b.customer_id = p.customer_id
WHERE p.customer_id NOT IN (7, 77, 777)
GROUP BY p.customer_id, customer_name, p.pre_payment_percent, n_active

-- name: r15_by_customer
partial AS (
  SELECT c.*, g.name AS category
  FROM d_contract c LEFT JOIN d_supplier_group sg USING (supplier_id) LEFT JOIN d_group g ON g.id = sg.group_id
  WHERE payment_type = 'PARTIAL'),
active AS (
  SELECT customer_id, pre_payment_percent, category, count(DISTINCT id) AS n_active
  FROM partial WHERE to_date IS NULL OR to_date >= DATE '2001-08-02' GROUP BY 1, 2, 3)
SELECT p.customer_id, customer_name, count(DISTINCT p.id) AS contracts, n_active AS active_contracts,
       'Частичная предоплата' AS payment_type, p.pre_payment_percent,
       string_agg(DISTINCT p.category, ' / ' ORDER BY p.category) AS categories
FROM partial p JOIN active a ON a.customer_id = p.customer_id AND a.pre_payment_percent = p.pre_payment_percent
                             AND a.category IS NOT DISTINCT FROM p.category
     JOIN buyer b ON b.customer_id = p.customer_id
GROUP BY p.customer_id, customer_name, p.pre_payment_percent, n_active

-- name: r15_1_advance_contract_detail
SELECT customer_name, supplier_name, contract_number, from_date::VARCHAR AS from_date, to_date::VARCHAR AS to_date,
       'Частичная предоплата' AS payment_type, pre_payment_percent,
       string_agg(DISTINCT g.name, ' / ' ORDER BY g.name) AS categories
FROM d_contract c JOIN buyer USING (customer_id) JOIN seller USING (supplier_id)
     JOIN d_supplier_group sg USING (supplier_id) JOIN d_group g ON g.id = sg.group_id
WHERE payment_type = 'PARTIAL' AND customer_id NOT IN (7, 77, 777)
  AND (to_date >= DATE '2001-08-02' OR to_date IS NULL)
GROUP BY customer_name, supplier_name, contract_number, c.from_date, c.to_date, pre_payment_percent

-- name: r15_1_by_customer
SELECT customer_id, customer_name, supplier_name, contract_number, from_date::VARCHAR AS from_date,
       to_date::VARCHAR AS to_date, 'Частичная предоплата' AS payment_type, pre_payment_percent,
       string_agg(DISTINCT g.name, ' / ' ORDER BY g.name) AS categories
FROM d_contract c JOIN buyer USING (customer_id) JOIN seller USING (supplier_id)
     JOIN d_supplier_group sg USING (supplier_id) JOIN d_group g ON g.id = sg.group_id
WHERE payment_type = 'PARTIAL' AND (to_date >= DATE '2001-08-02' OR to_date IS NULL)
GROUP BY customer_id, customer_name, supplier_name, contract_number, c.from_date, c.to_date, pre_payment_percent

-- name: r17_long_contracts
made AS (
  SELECT DISTINCT s.id AS supplier_id, a.name AS supplier_name, a.inn, a.kpp, a.created_when, ls.state, surname,
         first_name, mail, co.name AS company, g.name AS category
  FROM d_supplier s JOIN d_agent a ON a.supplier_id = s.id JOIN last_supplier ls ON ls.supplier_id = s.id
       JOIN staff p ON p.created_by = a.created_by
       JOIN d_agent co ON co.customer_id = own_customer OR co.supplier_id = own_supplier
       LEFT JOIN d_supplier_group sg ON sg.supplier_id = s.id LEFT JOIN d_group g ON g.id = sg.group_id),
stage AS (
  SELECT contract_id, contract_state FROM d_contract_event
  QUALIFY created_when = max(created_when) OVER (PARTITION BY contract_id))
SELECT customer_name, contract_number, from_date::VARCHAR AS from_date, to_date::VARCHAR AS to_date,
       CASE contract_state WHEN 'NEW' THEN 'Новый' WHEN 'NOT_ACTIVE' THEN 'Неактивный' WHEN 'ACTIVE' THEN 'Активный'
            WHEN 'AGREED' THEN 'Согласован' WHEN 'REJECTED' THEN 'Отклонен' ELSE contract_state END AS contract_state,
       m.supplier_name, m.inn AS supplier_inn, m.kpp AS supplier_kpp,
       strftime(m.created_when, '%Y-%m-%d %H:%M:%S') AS registered_at,
       CASE m.state WHEN 'OPERATIVE' THEN 'Рабочий' WHEN 'POSTFACTUM' THEN 'Постфактум' ELSE m.state END AS supplier_state,
       string_agg(m.category, ' / ' ORDER BY m.category) AS categories
FROM d_contract c JOIN buyer USING (customer_id) JOIN stage ON stage.contract_id = c.id
     JOIN made m ON m.supplier_id = c.supplier_id
WHERE customer_id NOT IN (7, 77, 777) AND contract_state <> 'DELETED'
  AND (to_date IS NULL OR (to_date - from_date > 366 AND to_date > DATE '2001-07-01'))
GROUP BY customer_name, contract_number, c.from_date, c.to_date, contract_state, m.supplier_name, m.inn, m.kpp,
         m.created_when, m.state

-- name: r17_by_customer
made AS (
  SELECT DISTINCT s.id AS supplier_id, a.name AS supplier_name, a.inn, a.kpp, a.created_when, ls.state, surname,
         first_name, mail, co.name AS company, g.name AS category
  FROM d_supplier s JOIN d_agent a ON a.supplier_id = s.id JOIN last_supplier ls ON ls.supplier_id = s.id
       JOIN staff p ON p.created_by = a.created_by
       JOIN d_agent co ON co.customer_id = own_customer OR co.supplier_id = own_supplier
       LEFT JOIN d_supplier_group sg ON sg.supplier_id = s.id LEFT JOIN d_group g ON g.id = sg.group_id),
stage AS (
  SELECT contract_id, contract_state FROM d_contract_event
  QUALIFY created_when = max(created_when) OVER (PARTITION BY contract_id))
SELECT customer_id, customer_name, contract_number, from_date::VARCHAR AS from_date, to_date::VARCHAR AS to_date,
       CASE contract_state WHEN 'NEW' THEN 'Новый' WHEN 'NOT_ACTIVE' THEN 'Неактивный' WHEN 'ACTIVE' THEN 'Активный'
            WHEN 'AGREED' THEN 'Согласован' WHEN 'REJECTED' THEN 'Отклонен' ELSE contract_state END AS contract_state,
       m.supplier_name, m.inn AS supplier_inn, m.kpp AS supplier_kpp,
       strftime(m.created_when, '%Y-%m-%d %H:%M:%S') AS registered_at,
       CASE m.state WHEN 'OPERATIVE' THEN 'Рабочий' WHEN 'POSTFACTUM' THEN 'Постфактум' ELSE m.state END AS supplier_state,
       string_agg(m.category, ' / ' ORDER BY m.category) AS categories
FROM d_contract c JOIN buyer USING (customer_id) JOIN stage ON stage.contract_id = c.id
     JOIN made m ON m.supplier_id = c.supplier_id
WHERE contract_state <> 'DELETED'
  AND (to_date IS NULL OR (to_date - from_date > 366 AND to_date > DATE '2001-07-01'))
GROUP BY customer_id, customer_name, contract_number, c.from_date, c.to_date, contract_state, m.supplier_name, m.inn,
         m.kpp, m.created_when, m.state
