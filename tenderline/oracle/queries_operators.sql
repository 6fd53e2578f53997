-- name: op_latest_state
SELECT order_id, strftime(moment, '%Y-%m-%d %H:%M:%S') AS state_at, state FROM last_state

-- name: op_latest_any_type
SELECT order_id, strftime(moment, '%Y-%m-%d %H:%M:%S') AS "at", state FROM last_any

-- name: op_dedup_first
SELECT id, order_id AS fk_order_id, price::DOUBLE AS price, quantity::DOUBLE AS quantity, product_name,
       entry_id AS fk_supplier_product_id
FROM d_item
QUALIFY row_number() OVER (PARTITION BY id ORDER BY price, quantity, order_id, product_name, entry_id NULLS FIRST) = 1

-- name: op_previous_month
SELECT order_id, order_number, strftime(created_when, '%Y-%m-%d %H:%M:%S') AS created_when
FROM deal WHERE date_trunc('month', created_when) = DATE '2001-06-01'

-- name: op_weekly_matrix
week AS (
  SELECT n, DATE '2001-08-01' - (7 * (5 - n))::INT AS lo, DATE '2001-08-01' - (7 * (4 - n))::INT AS hi
  FROM range(1, 5) r(n)),
order_sum AS (SELECT order_id, sum(val) AS total FROM item_value GROUP BY 1),
bought AS (SELECT customer_id, created_when, total FROM deal JOIN order_sum USING (order_id)),
long_form AS (
  SELECT customer_id, n, count(*) AS cnt, sum(total) AS val
  FROM bought JOIN week ON created_when BETWEEN lo AND hi GROUP BY 1, 2)
SELECT customer_id,
       coalesce(max(cnt) FILTER (n = 1), 0) AS orders_w1, coalesce(max(cnt) FILTER (n = 2), 0) AS orders_w2,
       coalesce(max(cnt) FILTER (n = 3), 0) AS orders_w3, coalesce(max(cnt) FILTER (n = 4), 0) AS orders_w4,
       (max(val) FILTER (n = 1))::DOUBLE AS amount_w1, (max(val) FILTER (n = 2))::DOUBLE AS amount_w2,
       (max(val) FILTER (n = 3))::DOUBLE AS amount_w3, (max(val) FILTER (n = 4))::DOUBLE AS amount_w4
FROM (SELECT DISTINCT customer_id FROM bought) LEFT JOIN long_form USING (customer_id) GROUP BY 1

-- name: op_status_buckets
rows_of AS (
  SELECT customer_id, order_id, val, n_items, state, is_any FROM (
    SELECT order_id, state, false AS is_any FROM last_state UNION ALL SELECT order_id, state, true FROM last_any)
  JOIN deal USING (order_id)
  JOIN (SELECT order_id, sum(val) AS val, count(*) AS n_items FROM item_value GROUP BY 1) USING (order_id)),
tagged AS (
  SELECT *, CASE
      WHEN is_any AND state = 'ORDER_CLOSED' THEN 'closed' WHEN is_any AND state = 'ORDER_CANCELED' THEN 'canceled'
      WHEN is_any THEN NULL WHEN state = 'ORDER_CLOSED_POSTFACTUM' OR state LIKE '%\_POSTFACTUM' ESCAPE '\' THEN 'pf'
      WHEN state IN ('PAYMENT', 'PARTIAL_POST_PAYMENT', 'PARTIAL_PRE_PAYMENT') THEN 'payment'
      WHEN state LIKE '%PAYMENT\_RECEIVED' ESCAPE '\' THEN 'received' WHEN state = 'EXECUTION' THEN 'execution'
      WHEN state = 'NEW' THEN 'new' WHEN state = 'RECEPTION' THEN 'reception'
      WHEN state = 'ORDER_RESULTS' THEN 'editing' WHEN state = 'AGREED_BY_SUPPLIER' THEN 'agreeing' END AS b
  FROM rows_of),
base AS (SELECT DISTINCT customer_id FROM deal JOIN item_value USING (order_id))
SELECT customer_id,
       count(DISTINCT order_id) FILTER (b = 'pf') AS pf_orders, count(*) FILTER (b = 'pf') AS pf_rows,
       (sum(val) FILTER (b = 'pf'))::DOUBLE AS pf_amount,
       count(DISTINCT order_id) FILTER (b = 'closed') AS closed_orders, count(*) FILTER (b = 'closed') AS closed_rows,
       (sum(val) FILTER (b = 'closed'))::DOUBLE AS closed_amount,
       count(DISTINCT order_id) FILTER (b = 'canceled') AS canceled_orders, count(*) FILTER (b = 'canceled') AS canceled_rows,
       (sum(val) FILTER (b = 'canceled'))::DOUBLE AS canceled_amount,
       count(DISTINCT order_id) FILTER (b = 'payment') AS payment_orders, count(*) FILTER (b = 'payment') AS payment_rows,
       (sum(val) FILTER (b = 'payment'))::DOUBLE AS payment_amount,
       count(DISTINCT order_id) FILTER (b = 'execution') AS execution_orders, count(*) FILTER (b = 'execution') AS execution_rows,
       (sum(val) FILTER (b = 'execution'))::DOUBLE AS execution_amount,
       count(DISTINCT order_id) FILTER (b = 'new') AS new_orders, count(*) FILTER (b = 'new') AS new_rows,
       (sum(val) FILTER (b = 'new'))::DOUBLE AS new_amount,
       count(DISTINCT order_id) FILTER (b = 'received') AS received_orders, count(*) FILTER (b = 'received') AS received_rows,
       (sum(val) FILTER (b = 'received'))::DOUBLE AS received_amount,
       count(DISTINCT order_id) FILTER (b = 'reception') AS reception_orders, count(*) FILTER (b = 'reception') AS reception_rows,
       (sum(val) FILTER (b = 'reception'))::DOUBLE AS reception_amount,
       count(DISTINCT order_id) FILTER (b = 'editing') AS editing_orders, count(*) FILTER (b = 'editing') AS editing_rows,
       (sum(val) FILTER (b = 'editing'))::DOUBLE AS editing_amount,
       count(DISTINCT order_id) FILTER (b = 'agreeing') AS agreeing_orders, count(*) FILTER (b = 'agreeing') AS agreeing_rows,
       (sum(val) FILTER (b = 'agreeing'))::DOUBLE AS agreeing_amount
FROM base LEFT JOIN tagged USING (customer_id) GROUP BY 1

-- name: op_share_of_total
fine AS (
  SELECT customer_id, category, supplier_id, count(DISTINCT order_id) AS orders, sum(val) AS amount
  FROM live_line GROUP BY 1, 2, 3),
totals AS (
  SELECT *, sum(amount) OVER (PARTITION BY customer_id, category) AS category_total,
         sum(amount) OVER (PARTITION BY customer_id) AS customer_total, sum(amount) OVER () AS network_total
  FROM fine)
SELECT customer_id, category, supplier_id, orders, amount::DOUBLE AS amount, category_total::DOUBLE AS category_total,
       ((20000 * (amount * 100)::HUGEINT + (category_total * 100)::HUGEINT)
         // nullif(2 * (category_total * 100)::HUGEINT, 0))::DOUBLE / 100 AS category_pct,
       customer_total::DOUBLE AS customer_total,
       ((20000 * (amount * 100)::HUGEINT + (customer_total * 100)::HUGEINT)
         // nullif(2 * (customer_total * 100)::HUGEINT, 0))::DOUBLE / 100 AS customer_pct,
       network_total::DOUBLE AS network_total,
       ((20000 * (amount * 100)::HUGEINT + (network_total * 100)::HUGEINT)
         // nullif(2 * (network_total * 100)::HUGEINT, 0))::DOUBLE / 100 AS network_pct
FROM totals

-- name: op_duplicate_groups
SELECT agent_id AS supplier_agent_id, supplier_inn, n AS group_size
FROM seller JOIN (SELECT supplier_inn, count(DISTINCT agent_id) AS n FROM seller GROUP BY 1) USING (supplier_inn)
WHERE n > 1 AND n < 10

-- name: op_shared_key_semi
SELECT agent_id AS supplier_agent_id, supplier_id, supplier_name, supplier_inn, supplier_kpp
FROM seller WHERE supplier_inn IN (SELECT customer_inn FROM buyer)

-- name: op_either_key_join
SELECT staff.created_by, mail, a.customer_id AS company_customer_id, a.supplier_id AS company_supplier_id,
       a.name AS company
FROM staff LEFT JOIN d_agent a ON a.customer_id = own_customer OR a.supplier_id = own_supplier

-- name: op_null_safe_join
fine AS (SELECT category, supplier_id, sum(val) AS amount FROM live_line GROUP BY 1, 2),
sizes AS (SELECT category, count(*) AS category_suppliers FROM fine GROUP BY 1)
SELECT f.category, f.supplier_id, f.amount::DOUBLE AS amount, s.category_suppliers
FROM fine f JOIN sizes s ON s.category = f.category OR (s.category IS NULL AND f.category IS NULL)

-- name: op_event_pairs
pair AS (
  SELECT d.order_id, pay_delay_days, a.moment AS start_moment, b.moment AS end_moment,
         date_diff('day', a.moment::DATE, b.moment::DATE) AS gap_days
  FROM deal d JOIN order_state a USING (order_id) JOIN order_state b USING (order_id)
  WHERE a.state IN ('PAYMENT', 'PAYMENT_POSTFACTUM', 'PARTIAL_POST_PAYMENT') AND b.state LIKE '%PAYMENT_RECEIVED%'
    AND pay_delay_days IS NOT NULL),
totals AS (
  SELECT order_id, pay_delay_days, count(*) AS pairs, count(*) FILTER (gap_days = pay_delay_days) AS kept
  FROM pair GROUP BY 1, 2),
starts AS (
  SELECT order_id, count(*) AS starts FROM order_state
  WHERE state IN ('PAYMENT', 'PAYMENT_POSTFACTUM', 'PARTIAL_POST_PAYMENT') GROUP BY 1),
ends AS (SELECT order_id, count(*) AS ends FROM order_state WHERE state LIKE '%PAYMENT_RECEIVED%' GROUP BY 1),
first_off AS (
  SELECT order_id, start_moment, end_moment, gap_days, count(*) AS weight FROM pair WHERE gap_days <> pay_delay_days
  GROUP BY 1, 2, 3, 4
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY start_moment, end_moment) = 1)
SELECT order_id, pay_delay_days, starts, ends, pairs, kept,
       strftime(start_moment, '%Y-%m-%d %H:%M:%S') AS start_at, strftime(end_moment, '%Y-%m-%d %H:%M:%S') AS end_at,
       gap_days::INT AS gap_days, weight
FROM totals JOIN starts USING (order_id) JOIN ends USING (order_id) LEFT JOIN first_off USING (order_id)

-- name: op_parse_amounts
SELECT entity AS order_id,
       (sum(translate(entered, ',' || chr(160), '')::BIGINT)::DECIMAL(38, 2) / 100)::DOUBLE AS paid_sum,
       strftime(max(moment), '%Y-%m-%d %H:%M:%S') AS paid_changed_at
FROM d_log WHERE kind = 'ORDER_PARAM_CHANGE' GROUP BY 1

-- name: op_group_concat
SELECT supplier_id, string_agg(DISTINCT g.name, ' / ' ORDER BY g.name) AS categories
FROM d_supplier_group sg LEFT JOIN d_group g ON g.id = sg.group_id GROUP BY 1

-- name: op_cycle_length
SELECT customer_id, supplier_id, strftime(min(created_when), '%Y-%m-%d %H:%M:%S') AS first_at,
       strftime(max(created_when), '%Y-%m-%d %H:%M:%S') AS last_at, count(DISTINCT order_id) AS occurrences,
       date_diff('second', min(created_when), max(created_when))::DOUBLE / count(DISTINCT order_id) AS cycle_seconds
FROM deal GROUP BY 1, 2 HAVING count(DISTINCT order_id) > 1

-- name: op_code_labels
SELECT order_id AS id, coalesce(txt, state) AS text FROM order_state LEFT JOIN order_text ON code = state
UNION ALL
SELECT id, CASE WHEN tax_percent = -1 THEN 'Без НДС' ELSE tax_percent::VARCHAR END FROM d_entry

-- name: op_partitioned_export
SELECT directorate, customer_id, order_id, amount::DOUBLE AS amount, part_name
FROM deal JOIN (SELECT order_id, sum(val) AS amount FROM item_value GROUP BY 1) USING (order_id)
     JOIN d_directorate USING (customer_id)
     LEFT JOIN (SELECT customer_id, min(customer_name) AS part_name FROM buyer GROUP BY 1) USING (customer_id)
