-- name: r10_weekly_matrix_listed
week AS (
  SELECT n, DATE '2001-08-01' - (7 * (5 - n))::INT AS lo, DATE '2001-08-01' - (7 * (4 - n))::INT AS hi
  FROM range(1, 5) r(n)),
order_sum AS (SELECT order_id, sum(val) AS total FROM item_value GROUP BY 1),
touched AS (
  SELECT customer_name, created_when, total, coalesce(is_pf, false) AS is_pf
  FROM deal JOIN order_sum USING (order_id) JOIN buyer USING (customer_id)
       JOIN (SELECT entity AS supplier_id,
                    word = 'POSTFACTUM' AND moment = max(moment) OVER (PARTITION BY entity) AS is_pf
             FROM d_log WHERE kind = 'SUPPLIER_STATE') USING (supplier_id)
  WHERE customer_id % 10 < 5),
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

-- name: op_latest_state_log
SELECT order_id, strftime(moment, '%Y-%m-%d %H:%M:%S') AS state_at, state
FROM (SELECT id, order_id, moment, state FROM order_state QUALIFY moment = max(moment) OVER (PARTITION BY order_id))
WHERE id % 7 <> 3

-- name: op_latest_any_type_log
SELECT entity AS order_id, strftime(moment, '%Y-%m-%d %H:%M:%S') AS "at", word AS state
FROM (SELECT * FROM d_log QUALIFY moment = max(moment) OVER (PARTITION BY entity))
WHERE kind = 'ORDER_STATE' AND id % 7 <> 3
