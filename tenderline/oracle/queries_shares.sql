-- name: r14_supplier_share_by_customer
fine AS (
  SELECT customer_id, supplier_id, category, count(DISTINCT order_id) AS orders, sum(val) AS amount
  FROM live_line WHERE customer_id NOT IN (7, 77, 777) GROUP BY 1, 2, 3),
totals AS (
  SELECT *, sum(amount) OVER (PARTITION BY customer_id, category) AS category_total,
         sum(amount) OVER (PARTITION BY customer_id) AS customer_total
  FROM fine),
shown AS (
  SELECT DISTINCT category, customer_name, supplier_name, supplier_inn, supplier_kpp, orders, amount,
         category_total, customer_total
  FROM totals JOIN buyer USING (customer_id) JOIN seller USING (supplier_id))
SELECT category, customer_name, supplier_name, supplier_inn, supplier_kpp, orders, amount::DOUBLE AS amount,
       ((20000 * (amount * 100)::HUGEINT + (category_total * 100)::HUGEINT)
         // nullif(2 * (category_total * 100)::HUGEINT, 0))::DOUBLE / 100 AS pct_of_category,
       ((20000 * (amount * 100)::HUGEINT + (customer_total * 100)::HUGEINT)
         // nullif(2 * (customer_total * 100)::HUGEINT, 0))::DOUBLE / 100 AS pct_of_customer
FROM shown

-- name: r14_by_customer
fine AS (
  SELECT customer_id, supplier_id, category, count(DISTINCT order_id) AS orders, sum(val) AS amount
  FROM live_line WHERE customer_id NOT IN (7, 77, 777) GROUP BY 1, 2, 3),
totals AS (
  SELECT *, sum(amount) OVER (PARTITION BY customer_id, category) AS category_total,
         sum(amount) OVER (PARTITION BY customer_id) AS customer_total
  FROM fine),
shown AS (
  SELECT DISTINCT customer_id, category, customer_name, supplier_name, supplier_inn, supplier_kpp, orders, amount,
         category_total, customer_total
  FROM totals JOIN buyer USING (customer_id) JOIN seller USING (supplier_id))
SELECT customer_id, category, customer_name, supplier_name, supplier_inn, supplier_kpp, orders,
       amount::DOUBLE AS amount,
       ((20000 * (amount * 100)::HUGEINT + (category_total * 100)::HUGEINT)
         // nullif(2 * (category_total * 100)::HUGEINT, 0))::DOUBLE / 100 AS pct_of_category,
       ((20000 * (amount * 100)::HUGEINT + (customer_total * 100)::HUGEINT)
         // nullif(2 * (customer_total * 100)::HUGEINT, 0))::DOUBLE / 100 AS pct_of_customer
FROM shown

-- name: r19_supplier_share_network
fine AS (
  SELECT supplier_id, category, count(DISTINCT order_id) AS orders, sum(val) AS amount
  FROM live_line WHERE customer_id NOT IN (7, 77, 777) GROUP BY 1, 2),
totals AS (
  SELECT *, sum(amount) OVER (PARTITION BY category) AS category_total, sum(amount) OVER () AS network_total
  FROM fine),
shown AS (
  SELECT DISTINCT category, supplier_name, supplier_inn, supplier_kpp, orders, amount, category_total, network_total
  FROM totals JOIN seller USING (supplier_id))
SELECT category, supplier_name, supplier_inn, supplier_kpp, orders, amount::DOUBLE AS amount,
       ((20000 * (amount * 100)::HUGEINT + (category_total * 100)::HUGEINT)
         // nullif(2 * (category_total * 100)::HUGEINT, 0))::DOUBLE / 100 AS pct_of_category,
       ((20000 * (amount * 100)::HUGEINT + (network_total * 100)::HUGEINT)
         // nullif(2 * (network_total * 100)::HUGEINT, 0))::DOUBLE / 100 AS pct_of_total
FROM shown

-- name: r19_by_customer
own AS (
  SELECT customer_id, supplier_id, category, count(DISTINCT order_id) AS orders, sum(val) AS amount
  FROM live_line GROUP BY 1, 2, 3),
category_sum AS (
  SELECT category, sum(val) AS category_total FROM live_line WHERE customer_id NOT IN (7, 77, 777) GROUP BY 1),
network AS (SELECT sum(val) AS network_total FROM live_line WHERE customer_id NOT IN (7, 77, 777)),
shown AS (
  SELECT DISTINCT customer_id, own.category, supplier_name, supplier_inn, supplier_kpp, orders, amount,
         category_total, network_total
  FROM own JOIN category_sum s ON s.category IS NOT DISTINCT FROM own.category JOIN seller USING (supplier_id), network)
SELECT customer_id, category, supplier_name, supplier_inn, supplier_kpp, orders, amount::DOUBLE AS amount,
       ((20000 * (amount * 100)::HUGEINT + (category_total * 100)::HUGEINT)
         // nullif(2 * (category_total * 100)::HUGEINT, 0))::DOUBLE / 100 AS pct_of_category,
       ((20000 * (amount * 100)::HUGEINT + (network_total * 100)::HUGEINT)
         // nullif(2 * (network_total * 100)::HUGEINT, 0))::DOUBLE / 100 AS pct_of_total
FROM shown

-- name: r18_supply_cycles
bought AS (
  SELECT l.*, customer_name, supplier_name, created_when
  FROM category_line l JOIN named_deal USING (order_id) JOIN last_state USING (order_id)
  WHERE quantity <> 0 AND price <> 0 AND customer_id NOT IN (7, 77, 777) AND order_day >= DATE '1999-01-01')
SELECT customer_name, supplier_name, product_name, category,
       strftime(min(created_when), '%Y-%m-%d %H:%M:%S') AS first_order_at,
       strftime(max(created_when), '%Y-%m-%d %H:%M:%S') AS last_order_at, count(DISTINCT order_id) AS orders,
       (epoch_us(max(created_when)) - epoch_us(min(created_when)))::DOUBLE / 1e6::DOUBLE / count(DISTINCT order_id) AS cycle_seconds,
       ((2 * (sum(price) * 100)::HUGEINT + count(*)) // (2 * count(*)))::DOUBLE / 100 AS avg_price,
       ((2 * (sum(quantity) * 100)::HUGEINT + count(*)) // (2 * count(*)))::DOUBLE / 100 AS avg_quantity,
       ((2 * (sum(val) * 100)::HUGEINT + count(*)) // (2 * count(*)))::DOUBLE / 100 AS avg_amount,
       sum(quantity)::DOUBLE AS total_quantity, sum(val)::DOUBLE AS total_amount, max(price)::DOUBLE AS max_price,
       max(quantity)::DOUBLE AS max_quantity, max(val)::DOUBLE AS max_amount, min(price)::DOUBLE AS min_price,
       min(quantity)::DOUBLE AS min_quantity, min(val)::DOUBLE AS min_amount
FROM bought GROUP BY customer_name, supplier_name, product_name, category HAVING count(DISTINCT order_id) > 1

-- name: r18_by_customer
bought AS (
  SELECT l.*, customer_id, customer_name, supplier_name, created_when
  FROM category_line l JOIN named_deal USING (order_id) JOIN last_state USING (order_id)
  WHERE quantity <> 0 AND price <> 0 AND order_day >= DATE '1999-01-01')
SELECT customer_id, customer_name, supplier_name, product_name, category,
       strftime(min(created_when), '%Y-%m-%d %H:%M:%S') AS first_order_at,
       strftime(max(created_when), '%Y-%m-%d %H:%M:%S') AS last_order_at, count(DISTINCT order_id) AS orders,
       (epoch_us(max(created_when)) - epoch_us(min(created_when)))::DOUBLE / 1e6::DOUBLE / count(DISTINCT order_id) AS cycle_seconds,
       ((2 * (sum(price) * 100)::HUGEINT + count(*)) // (2 * count(*)))::DOUBLE / 100 AS avg_price,
       ((2 * (sum(quantity) * 100)::HUGEINT + count(*)) // (2 * count(*)))::DOUBLE / 100 AS avg_quantity,
       ((2 * (sum(val) * 100)::HUGEINT + count(*)) // (2 * count(*)))::DOUBLE / 100 AS avg_amount,
       sum(quantity)::DOUBLE AS total_quantity, sum(val)::DOUBLE AS total_amount, max(price)::DOUBLE AS max_price,
       max(quantity)::DOUBLE AS max_quantity, max(val)::DOUBLE AS max_amount, min(price)::DOUBLE AS min_price,
       min(quantity)::DOUBLE AS min_quantity, min(val)::DOUBLE AS min_amount
FROM bought GROUP BY customer_id, customer_name, supplier_name, product_name, category
HAVING count(DISTINCT order_id) > 1
