order_text AS (SELECT unnest(codes) AS code, unnest(texts) AS txt FROM order_words),
order_state AS (SELECT id, entity AS order_id, moment, word AS state FROM d_log WHERE kind = 'ORDER_STATE'),
last_state AS (
  SELECT order_id, moment, state FROM order_state QUALIFY moment = max(moment) OVER (PARTITION BY order_id)),
last_any AS (
  SELECT entity AS order_id, moment, word AS state
  FROM (SELECT * FROM d_log QUALIFY moment = max(moment) OVER (PARTITION BY entity)) WHERE kind = 'ORDER_STATE'),
last_supplier AS (
  SELECT entity AS supplier_id, word AS state FROM d_log WHERE kind = 'SUPPLIER_STATE'
  QUALIFY moment = max(moment) OVER (PARTITION BY entity)),
last_stage AS (
  SELECT entity AS supplier_id, word AS stage FROM d_log WHERE kind = 'REGISTRATION'
  QUALIFY moment = max(moment) OVER (PARTITION BY entity)),
buyer AS (SELECT customer_id, name AS customer_name, inn AS customer_inn FROM d_agent WHERE customer_id IS NOT NULL),
seller AS (
  SELECT id AS agent_id, supplier_id, name AS supplier_name, inn AS supplier_inn, kpp AS supplier_kpp
  FROM d_agent WHERE supplier_id IS NOT NULL),
person AS (
  SELECT user_name AS created_by, e.user_id, surname, first_name, mail, e.customer_id AS own_customer, e.supplier_id AS own_supplier
  FROM d_user LEFT JOIN d_employee e ON e.user_id = d_user.id),
staff AS (SELECT * FROM person WHERE user_id IS NOT NULL),
item_value AS (SELECT *, price * quantity AS val FROM d_item),
deal AS (
  SELECT o.id AS order_id, o.order_number, o.created_when, o.created_when::DATE AS order_day, o.created_by,
         c.id AS contract_id, c.contract_number, c.customer_id, c.supplier_id, c.payment_type,
         c.pre_payment_percent, c.pay_delay_days
  FROM d_order o JOIN d_contract c ON c.id = o.contract_id),
named_deal AS (SELECT * FROM deal JOIN buyer USING (customer_id) JOIN seller USING (supplier_id)),
category_line AS (
  SELECT v.order_id, v.product_name, v.price, v.quantity, v.val, e.tax_percent, e.category
  FROM item_value v LEFT JOIN d_entry e ON e.id = v.entry_id),
live_line AS (
  SELECT d.customer_id, d.supplier_id, d.order_id, l.category, l.val
  FROM category_line l JOIN deal d USING (order_id) JOIN last_state s USING (order_id)
  WHERE s.state <> 'ORDER_CANCELED' AND (l.price <> 0 OR l.quantity <> 0)),
