-- name: r06_customer_totals
order_sum AS (SELECT order_id, sum(val) AS order_total FROM item_value GROUP BY 1),
finished AS (
  SELECT customer_id, count(DISTINCT CASE WHEN state = 'ORDER_CLOSED' THEN order_id END) AS n_closed,
         count(DISTINCT CASE WHEN state = 'ORDER_CANCELED' THEN order_id END) AS n_canceled
  FROM deal JOIN last_any USING (order_id) GROUP BY 1),
late AS (
  SELECT customer_id, count(DISTINCT order_id) AS n, sum(val) AS total, count(DISTINCT supplier_id) AS sups
  FROM deal JOIN seller USING (supplier_id) JOIN item_value USING (order_id) JOIN last_supplier USING (supplier_id)
  WHERE state = 'POSTFACTUM' GROUP BY 1),
sole AS (
  SELECT customer_id, count(DISTINCT order_id) AS n, sum(val) AS total, count(DISTINCT supplier_id) AS sups
  FROM deal JOIN seller USING (supplier_id) JOIN item_value USING (order_id)
  WHERE length(supplier_inn) = 12 GROUP BY 1),
joined AS (
  SELECT customer_name, order_total, deal.supplier_id, nullif(n_closed, 0) AS closed_orders,
         nullif(n_canceled, 0) AS canceled_orders, late.n AS pf_orders, late.total AS pf_amount,
         late.sups AS pf_suppliers, sole.n AS sole_orders, sole.total AS sole_amount, sole.sups AS sole_suppliers
  FROM deal JOIN buyer USING (customer_id) JOIN order_sum USING (order_id)
       LEFT JOIN finished USING (customer_id) LEFT JOIN late USING (customer_id)
       LEFT JOIN sole USING (customer_id)
  WHERE customer_id NOT IN (7, 77, 777))
SELECT customer_name, sum(order_total)::DOUBLE AS amount, count(*) AS orders, closed_orders, canceled_orders,
       count(DISTINCT supplier_id) AS suppliers, pf_orders, pf_amount::DOUBLE AS pf_amount, pf_suppliers, sole_orders,
       sole_amount::DOUBLE AS sole_amount, sole_suppliers
FROM joined
GROUP BY customer_name, closed_orders, canceled_orders, pf_orders, pf_amount, pf_suppliers,
         sole_orders, sole_amount, sole_suppliers

-- name: r06_by_customer
order_sum AS (SELECT order_id, sum(val) AS order_total FROM item_value GROUP BY 1),
finished AS (
  SELECT customer_id, count(DISTINCT CASE WHEN state = 'ORDER_CLOSED' THEN order_id END) AS n_closed,
         count(DISTINCT CASE WHEN state = 'ORDER_CANCELED' THEN order_id END) AS n_canceled
  FROM deal JOIN last_any USING (order_id) GROUP BY 1),
late AS (
  SELECT customer_id, count(DISTINCT order_id) AS pf_n, sum(val) AS pf_total, count(DISTINCT supplier_id) AS pf_sups
  FROM deal JOIN seller USING (supplier_id) JOIN item_value USING (order_id) JOIN last_supplier USING (supplier_id)
  WHERE state = 'POSTFACTUM' GROUP BY 1),
sole AS (
  SELECT customer_id, count(DISTINCT order_id) AS sole_n, sum(val) AS sole_total,
         count(DISTINCT supplier_id) AS sole_sups
  FROM deal JOIN seller USING (supplier_id) JOIN item_value USING (order_id)
  WHERE length(supplier_inn) = 12 GROUP BY 1)
SELECT customer_id, customer_name, sum(order_total)::DOUBLE AS amount, count(*) AS orders,
       nullif(any_value(n_closed), 0) AS closed_orders, nullif(any_value(n_canceled), 0) AS canceled_orders,
       count(DISTINCT supplier_id) AS suppliers, any_value(pf_n) AS pf_orders,
       any_value(pf_total)::DOUBLE AS pf_amount, any_value(pf_sups) AS pf_suppliers, any_value(sole_n) AS sole_orders,
       any_value(sole_total)::DOUBLE AS sole_amount, any_value(sole_sups) AS sole_suppliers
FROM deal JOIN buyer USING (customer_id) JOIN order_sum USING (order_id) LEFT JOIN finished USING (customer_id)
     LEFT JOIN late USING (customer_id) LEFT JOIN sole USING (customer_id)
GROUP BY customer_id, customer_name

-- name: r07_customer_totals_period
june AS (SELECT * FROM deal WHERE order_day BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'),
order_sum AS (SELECT order_id, sum(val) AS order_total FROM item_value GROUP BY 1),
closed AS (
  SELECT customer_id, count(*) AS closed_n FROM june JOIN last_any USING (order_id)
  WHERE state = 'ORDER_CLOSED' GROUP BY 1),
canceled AS (
  SELECT customer_id, count(*) AS canceled_n FROM june JOIN last_any USING (order_id)
  WHERE state = 'ORDER_CANCELED' GROUP BY 1),
late AS (
  SELECT customer_id, count(DISTINCT order_id) AS pf_n, sum(val) AS pf_total, count(DISTINCT supplier_id) AS pf_sups
  FROM june JOIN seller USING (supplier_id) JOIN item_value USING (order_id) JOIN last_supplier USING (supplier_id)
  WHERE state = 'POSTFACTUM' GROUP BY 1),
sole AS (
  SELECT customer_id, count(*) AS sole_n, sum(val) AS sole_total, count(DISTINCT supplier_id) AS sole_sups
  FROM june JOIN seller USING (supplier_id) JOIN item_value USING (order_id)
  WHERE length(supplier_inn) = 12 GROUP BY 1)
SELECT customer_name, sum(order_total)::DOUBLE AS amount, count(*) AS orders, closed_n AS closed_orders,
       canceled_n AS canceled_orders, count(DISTINCT supplier_id) AS suppliers, pf_n AS pf_orders,
       pf_total::DOUBLE AS pf_amount, pf_sups AS pf_suppliers, sole_n AS sole_orders,
       sole_total::DOUBLE AS sole_amount, sole_sups AS sole_suppliers
FROM june JOIN buyer USING (customer_id) JOIN order_sum USING (order_id) LEFT JOIN closed USING (customer_id)
     LEFT JOIN canceled USING (customer_id) LEFT JOIN late USING (customer_id) LEFT JOIN sole USING (customer_id)
WHERE customer_id NOT IN (7, 77, 777)
GROUP BY customer_name, closed_n, canceled_n, pf_n, pf_total, pf_sups, sole_n, sole_total, sole_sups

-- name: r10_weekly_matrix
week AS (
  SELECT n, DATE '2001-08-01' - (7 * (5 - n))::INT AS lo, DATE '2001-08-01' - (7 * (4 - n))::INT AS hi
  FROM range(1, 5) r(n)),
order_sum AS (SELECT order_id, sum(val) AS total FROM item_value GROUP BY 1),
touched AS (
  SELECT customer_name, created_when, total, coalesce(is_pf, false) AS is_pf
  FROM deal JOIN order_sum USING (order_id) JOIN buyer USING (customer_id)
       JOIN (SELECT entity AS supplier_id,
                    word = 'POSTFACTUM' AND moment = max(moment) OVER (PARTITION BY entity) AS is_pf
             FROM d_log WHERE kind = 'SUPPLIER_STATE') USING (supplier_id)),
long_form AS (
  SELECT customer_name, n, count(*) AS cnt, sum(total) AS val, count(*) FILTER (is_pf) AS pf_cnt,
         sum(total) FILTER (is_pf) AS pf_val
  FROM touched JOIN week ON created_when >= lo AND created_when <= hi GROUP BY 1, 2)
SELECT customer_name,
       coalesce(max(cnt) FILTER (n = 1), 0) AS orders_w1, coalesce(max(cnt) FILTER (n = 2), 0) AS orders_w2,
       coalesce(max(cnt) FILTER (n = 3), 0) AS orders_w3, coalesce(max(cnt) FILTER (n = 4), 0) AS orders_w4,
       (max(val) FILTER (n = 1))::DOUBLE AS amount_w1, (max(val) FILTER (n = 2))::DOUBLE AS amount_w2,
       (max(val) FILTER (n = 3))::DOUBLE AS amount_w3, (max(val) FILTER (n = 4))::DOUBLE AS amount_w4,
       coalesce(max(pf_cnt) FILTER (n = 1), 0) AS pf_orders_w1, coalesce(max(pf_cnt) FILTER (n = 2), 0) AS pf_orders_w2,
       coalesce(max(pf_cnt) FILTER (n = 3), 0) AS pf_orders_w3, coalesce(max(pf_cnt) FILTER (n = 4), 0) AS pf_orders_w4,
       (max(pf_val) FILTER (n = 1))::DOUBLE AS pf_amount_w1, (max(pf_val) FILTER (n = 2))::DOUBLE AS pf_amount_w2,
       (max(pf_val) FILTER (n = 3))::DOUBLE AS pf_amount_w3, (max(pf_val) FILTER (n = 4))::DOUBLE AS pf_amount_w4
FROM (SELECT DISTINCT customer_name FROM touched) LEFT JOIN long_form USING (customer_name)
GROUP BY customer_name

-- name: r12_status_dashboard
june AS (
  SELECT * FROM deal
  WHERE order_day BETWEEN DATE '2001-06-01' AND DATE '2001-06-30' AND customer_id NOT IN (7, 77, 777)),
order_sum AS (SELECT order_id, sum(val) AS order_total FROM item_value GROUP BY 1),
tagged AS (
  SELECT customer_id, order_id, supplier_id, val, state, 'own' AS seen
  FROM june JOIN last_state USING (order_id) JOIN item_value USING (order_id)
  UNION ALL
  SELECT customer_id, order_id, supplier_id, val, state, 'any'
  FROM june JOIN last_any USING (order_id) JOIN item_value USING (order_id)),
grouped AS (
  SELECT customer_id, order_id, supplier_id, val,
         CASE WHEN seen = 'any' AND state = 'ORDER_CLOSED' THEN 'closed'
              WHEN seen = 'any' AND state = 'ORDER_CANCELED' THEN 'canceled'
              WHEN seen = 'any' THEN NULL
              WHEN state IN ('DOCUMENTS_POSTFACTUM', 'ORDER_CLOSED_POSTFACTUM', 'PAYMENT_POSTFACTUM',
                             'ORDER_RESULTS_POSTFACTUM') THEN 'pf'
              WHEN state IN ('PAYMENT', 'PARTIAL_POST_PAYMENT', 'PARTIAL_PRE_PAYMENT') THEN 'payment'
              WHEN state IN ('PAYMENT_RECEIVED', 'PARTIAL_POST_PAYMENT_RECEIVED', 'PARTIAL_PRE_PAYMENT_RECEIVED')
                THEN 'received'
              WHEN state = 'EXECUTION' THEN 'execution' WHEN state = 'NEW' THEN 'new'
              WHEN state = 'RECEPTION' THEN 'reception' WHEN state = 'ORDER_RESULTS' THEN 'editing'
              WHEN state = 'AGREED_BY_SUPPLIER' THEN 'agreeing' END AS bucket
  FROM tagged),
block AS (
  SELECT customer_id, bucket, count(DISTINCT order_id) AS n, sum(val) AS total, count(DISTINCT supplier_id) AS sups
  FROM grouped WHERE bucket IS NOT NULL GROUP BY 1, 2),
wide AS (
  SELECT customer_id,
         max(n) FILTER (bucket = 'pf') AS pf_n, max(total) FILTER (bucket = 'pf') AS pf_v, max(sups) FILTER (bucket = 'pf') AS pf_s,
         max(n) FILTER (bucket = 'closed') AS closed_n, max(total) FILTER (bucket = 'closed') AS closed_v,
         max(n) FILTER (bucket = 'canceled') AS canceled_n, max(total) FILTER (bucket = 'canceled') AS canceled_v,
         max(n) FILTER (bucket = 'payment') AS payment_n, max(total) FILTER (bucket = 'payment') AS payment_v,
         max(n) FILTER (bucket = 'execution') AS execution_n, max(total) FILTER (bucket = 'execution') AS execution_v,
         max(n) FILTER (bucket = 'new') AS new_n, max(total) FILTER (bucket = 'new') AS new_v,
         max(n) FILTER (bucket = 'received') AS received_n, max(total) FILTER (bucket = 'received') AS received_v,
         max(n) FILTER (bucket = 'reception') AS reception_n, max(total) FILTER (bucket = 'reception') AS reception_v,
         max(n) FILTER (bucket = 'editing') AS editing_n, max(total) FILTER (bucket = 'editing') AS editing_v,
         max(n) FILTER (bucket = 'agreeing') AS agreeing_n, max(total) FILTER (bucket = 'agreeing') AS agreeing_v
  FROM block GROUP BY 1),
base AS (
  SELECT customer_id, customer_name, count(*) AS orders, sum(order_total) AS amount,
         count(DISTINCT supplier_id) AS suppliers
  FROM june JOIN buyer USING (customer_id) JOIN order_sum USING (order_id) GROUP BY 1, 2)
SELECT customer_name, orders, amount::DOUBLE AS amount, suppliers, coalesce(pf_n, 0) AS pf_orders,
       coalesce(pf_v, 0)::DOUBLE AS pf_amount, coalesce(pf_s, 0) AS pf_suppliers,
       coalesce(closed_n, 0) AS closed_orders, coalesce(closed_v, 0)::DOUBLE AS closed_amount,
       coalesce(canceled_n, 0) AS canceled_orders, coalesce(canceled_v, 0)::DOUBLE AS canceled_amount,
       coalesce(payment_n, 0) AS payment_orders, coalesce(payment_v, 0)::DOUBLE AS payment_amount,
       coalesce(execution_n, 0) AS execution_orders, coalesce(execution_v, 0)::DOUBLE AS execution_amount,
       coalesce(new_n, 0) AS new_orders, coalesce(new_v, 0)::DOUBLE AS new_amount,
       coalesce(received_n, 0) AS received_orders, coalesce(received_v, 0)::DOUBLE AS received_amount,
       coalesce(reception_n, 0) AS reception_orders, coalesce(reception_v, 0)::DOUBLE AS reception_amount,
       coalesce(editing_n, 0) AS editing_orders, coalesce(editing_v, 0)::DOUBLE AS editing_amount,
       coalesce(agreeing_n, 0) AS agreeing_orders, coalesce(agreeing_v, 0)::DOUBLE AS agreeing_amount
FROM base LEFT JOIN wide USING (customer_id)

-- name: r16_unclosed_summary
order_sum AS (SELECT order_id, sum(val) AS order_total FROM item_value GROUP BY 1),
late AS (
  SELECT customer_id, count(DISTINCT order_id) AS pf_n, sum(val) AS pf_v, count(DISTINCT supplier_id) AS pf_s,
         count(DISTINCT order_id) FILTER (state <> 'ORDER_CLOSED_POSTFACTUM') AS pfo_n,
         sum(val) FILTER (state <> 'ORDER_CLOSED_POSTFACTUM') AS pfo_v
  FROM deal JOIN last_state USING (order_id) JOIN item_value USING (order_id)
  WHERE state IN ('DOCUMENTS_POSTFACTUM', 'ORDER_CLOSED_POSTFACTUM', 'PAYMENT_POSTFACTUM', 'ORDER_RESULTS_POSTFACTUM')
  GROUP BY 1),
pending AS (
  SELECT customer_id, count(DISTINCT order_id) AS open_n, sum(val) AS open_v
  FROM deal JOIN last_any USING (order_id) JOIN item_value USING (order_id)
  WHERE state NOT IN ('ORDER_CLOSED', 'ORDER_CANCELED') GROUP BY 1),
base AS (
  SELECT customer_id, customer_name, count(*) AS orders, sum(order_total) AS amount,
         count(DISTINCT supplier_id) AS suppliers
  FROM deal JOIN buyer USING (customer_id) JOIN order_sum USING (order_id)
  WHERE customer_id NOT IN (7, 77, 777) GROUP BY 1, 2)
SELECT customer_name, orders, amount::DOUBLE AS amount, suppliers, pf_n AS pf_orders, pf_v::DOUBLE AS pf_amount,
       pf_s AS pf_suppliers, open_n AS open_orders,
       (20000 * open_n + orders) // (2 * orders) / 100.0::DOUBLE AS open_pct, open_v::DOUBLE AS open_amount,
       nullif(pfo_n, 0) AS pf_open_orders,
       (20000 * nullif(pfo_n, 0) + pf_n) // (2 * pf_n) / 100.0::DOUBLE AS pf_open_pct, pfo_v::DOUBLE AS pf_open_amount
FROM base LEFT JOIN late USING (customer_id) LEFT JOIN pending USING (customer_id)

-- name: r16_by_customer
order_sum AS (SELECT order_id, sum(val) AS order_total FROM item_value GROUP BY 1),
late AS (
  SELECT customer_id, count(DISTINCT order_id) AS pf_n, sum(val) AS pf_v, count(DISTINCT supplier_id) AS pf_s,
         count(DISTINCT order_id) FILTER (state <> 'ORDER_CLOSED_POSTFACTUM') AS pfo_n,
         sum(val) FILTER (state <> 'ORDER_CLOSED_POSTFACTUM') AS pfo_v
  FROM deal JOIN last_state USING (order_id) JOIN item_value USING (order_id)
  WHERE state IN ('DOCUMENTS_POSTFACTUM', 'ORDER_CLOSED_POSTFACTUM', 'PAYMENT_POSTFACTUM', 'ORDER_RESULTS_POSTFACTUM')
  GROUP BY 1),
pending AS (
  SELECT customer_id, count(DISTINCT order_id) AS open_n, sum(val) AS open_v
  FROM deal JOIN last_any USING (order_id) JOIN item_value USING (order_id)
  WHERE state NOT IN ('ORDER_CLOSED', 'ORDER_CANCELED') GROUP BY 1),
base AS (
  SELECT customer_id, customer_name, count(*) AS orders, sum(order_total) AS amount,
         count(DISTINCT supplier_id) AS suppliers
  FROM deal JOIN buyer USING (customer_id) JOIN order_sum USING (order_id) GROUP BY 1, 2)
SELECT customer_id, customer_name, orders, amount::DOUBLE AS amount, suppliers, pf_n AS pf_orders,
       pf_v::DOUBLE AS pf_amount, pf_s AS pf_suppliers, open_n AS open_orders,
       (20000 * open_n + orders) // (2 * orders) / 100.0::DOUBLE AS open_pct, open_v::DOUBLE AS open_amount,
       nullif(pfo_n, 0) AS pf_open_orders,
       (20000 * nullif(pfo_n, 0) + pf_n) // (2 * pf_n) / 100.0::DOUBLE AS pf_open_pct, pfo_v::DOUBLE AS pf_open_amount
FROM base LEFT JOIN late USING (customer_id) LEFT JOIN pending USING (customer_id)
