WITH n_sup AS (SELECT count(*) AS n FROM supplier),
three AS (SELECT unnest([0, 1, 2]) AS i),
order_words AS (
  SELECT ['NEW', 'EXECUTION', 'DOCUMENTS_POSTFACTUM', 'ORDER_CLOSED', 'ORDER_CANCELED', 'PAYMENT',
          'PAYMENT_RECEIVED', 'PARTIAL_POST_PAYMENT_RECEIVED', 'PARTIAL_PRE_PAYMENT_RECEIVED',
          'AGREED_BY_SUPPLIER', 'PARTIAL_POST_PAYMENT', 'PARTIAL_PRE_PAYMENT', 'RECEPTION', 'ORDER_RESULTS',
          'ORDER_CLOSED_POSTFACTUM', 'PAYMENT_POSTFACTUM', 'ORDER_RESULTS_POSTFACTUM'] AS codes,
         ['Новый', 'Выполнение', 'Документы (постфактум)', 'Заказ закрыт', 'Заказ отменен', 'Оплата',
          'Поступление ДС', 'Поступление ДС постоплаты', 'Поступление ДС предоплаты',
          'Согласование поставщиком', 'Частичная постоплата', 'Частичная предоплата', 'Получение',
          'Редактирование заказа', 'Заказ закрыт (постфактум)', 'Оплата (постфактум)',
          'Редактирование заказа (постфактум)'] AS texts),
d_order AS (
  SELECT o_orderkey AS id, o_orderkey::VARCHAR AS order_number, o_orderdate AS created_when,
         'user' || (o_orderkey % 50)::VARCHAR AS created_by,
         200000000 + o_custkey * 3 + o_orderkey % 3 AS contract_id
  FROM orders),
d_item AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id,
         CASE WHEN l_orderkey % 20 = 0 AND l_linenumber = 7 THEN 0 ELSE l_extendedprice END::DECIMAL(18, 2) AS price,
         l_quantity::DECIMAL(10, 0) AS quantity, p_name AS product_name,
         CASE WHEN l_partkey % 97 <> 0 THEN l_partkey END AS entry_id
  FROM lineitem JOIN part ON p_partkey = l_partkey),
d_contract AS (
  SELECT 200000000 + c_custkey * 3 + i AS id, 'C-' || (c_custkey * 3 + i)::VARCHAR AS contract_number,
         c_custkey AS customer_id, 100000000 + (c_custkey * 7 + i * 31) % n_sup.n AS supplier_id,
         ['FULL', 'PARTIAL', 'POSTPAY'][(c_custkey + i) % 3 + 1] AS payment_type,
         CASE (c_custkey + i) % 3
           WHEN 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 100 END
           WHEN 1 THEN CASE c_custkey % 4 WHEN 0 THEN 30 WHEN 1 THEN 50 WHEN 2 THEN 70 END
         END AS pre_payment_percent,
         CASE (c_custkey + i) % 3
           WHEN 1 THEN CASE WHEN c_custkey % 5 = 0 THEN 10 END
           WHEN 2 THEN CASE WHEN c_custkey % 2 = 0 THEN 14 ELSE 30 END
         END AS pay_delay_days,
         DATE '2000-01-01' + (c_custkey % 300)::INT AS from_date,
         CASE (c_custkey + i) % 5
           WHEN 0 THEN NULL
           WHEN 1 THEN DATE '2000-01-01' + (c_custkey % 300 + 730)::INT
           ELSE DATE '2000-01-01' + (c_custkey % 300 + 365)::INT
         END AS to_date
  FROM customer, three, n_sup),
d_contract_event AS (
  SELECT 200000000 + x AS contract_id,
         ['NEW', 'NOT_ACTIVE', 'ACTIVE', 'AGREED', 'REJECTED', 'DELETED'][(x + 2 * r) % 6 + 1] AS contract_state,
         TIMESTAMP '2000-01-01' + to_days((c % 300 + 15 * r)::INT) AS created_when
  FROM (SELECT c_custkey AS c, c_custkey * 3 + i AS x, unnest(range(0, (c_custkey * 3 + i) % 2 + 1)) AS r
        FROM customer, three)),
d_supplier AS (
  SELECT 100000000 + s_suppkey AS id, TIMESTAMP '1993-01-01' + to_days((s_suppkey % 365)::INT) AS created_when,
         'user' || (s_suppkey % 50)::VARCHAR AS created_by
  FROM supplier),
d_agent AS (
  SELECT c_custkey AS id, c_name AS name,
         CASE WHEN c_custkey % 50 = 0
              THEN '7' || lpad((c_custkey // 50)::VARCHAR, CASE WHEN (c_custkey // 50) % 4 = 0 THEN 11 ELSE 9 END, '0')
              ELSE '9' || lpad(c_custkey::VARCHAR, 9, '0') END AS inn,
         NULL::VARCHAR AS kpp, c_custkey AS customer_id, NULL::BIGINT AS supplier_id,
         NULL::TIMESTAMP AS created_when, 'user0' AS created_by
  FROM customer
  UNION ALL
  SELECT 300000000 + c_custkey, c_name, '8' || lpad(c_custkey::VARCHAR, 9, '0'), NULL, c_custkey, NULL, NULL, 'user0'
  FROM customer WHERE c_custkey % 200 = 1
  UNION ALL
  SELECT 100000000 + s, s_name, '7' || lpad(g::VARCHAR, CASE WHEN g % 4 = 0 THEN 11 ELSE 9 END, '0'),
         CASE WHEN s % 7 <> 0 THEN lpad(s::VARCHAR, 9, '0') END, NULL, 100000000 + s,
         TIMESTAMP '1993-01-01' + to_days((s % 365)::INT), 'user' || (s % 50)::VARCHAR
  FROM (SELECT s_suppkey AS s, s_name,
               CASE WHEN s_suppkey % 50 >= 38 THEN s_suppkey - (s_suppkey % 50 - 38)
                    WHEN s_suppkey % 10 < 6 THEN s_suppkey - (s_suppkey % 10) % 3
                    ELSE s_suppkey END AS g
        FROM supplier)),
d_user AS (SELECT u AS id, 'user' || u::VARCHAR AS user_name FROM range(50) r(u)),
d_employee AS (
  SELECT u AS user_id, 'Surname' || u::VARCHAR AS surname, 'Name' || (u % 7)::VARCHAR AS first_name,
         'user' || u::VARCHAR || '@example.org' AS mail,
         CASE WHEN u % 2 = 0 THEN u END AS customer_id,
         CASE WHEN u % 2 = 1 OR u % 10 = 0 THEN 100000000 + u % n_sup.n END AS supplier_id
  FROM range(48) r(u), n_sup),
d_log AS (
  SELECT o * 10 + i AS id, o AS entity, 'ORDER_STATE' AS kind,
         day0 + to_days((17 * CASE WHEN o % 101 = 0 AND i = o % 5 AND i <> 0 THEN i - 1 ELSE i END)::INT) AS moment,
         codes[(3 * o + 5 * CASE WHEN o % 202 = 0 AND i = o % 5 AND i <> 0 THEN i - 1 ELSE i END) % 17 + 1] AS word,
         NULL::VARCHAR AS entered
  FROM (SELECT o_orderkey AS o, o_orderdate AS day0, unnest(range(0, o_orderkey % 5 + 1)) AS i FROM orders), order_words
  UNION ALL
  SELECT o * 10 + 7 + i, o, 'ORDER_PARAM_CHANGE', day0 + to_days((20 + (o % 3) * 40 + 5 * i)::INT),
         'customerPaymentSum',
         (1 + o % 9)::VARCHAR || chr(160) || lpad((o % 1000)::VARCHAR, 3, '0') || ',' || lpad((o % 100)::VARCHAR, 2, '0')
  FROM (SELECT o_orderkey AS o, o_orderdate AS day0,
               unnest(range(0, CASE WHEN o_orderkey % 8 = 0 THEN 2 ELSE 1 END)) AS i
        FROM orders WHERE o_orderkey % 4 = 0)
  UNION ALL
  SELECT 5000000000 + s * 10 + i, 100000000 + s, 'SUPPLIER_STATE', TIMESTAMP '1994-01-01' + to_days((30 * i + s % 20)::INT),
         CASE WHEN (s + i) % 3 = 0 THEN 'POSTFACTUM' ELSE 'OPERATIVE' END, NULL
  FROM (SELECT s_suppkey AS s, unnest(range(0, s_suppkey % 3 + 1)) AS i FROM supplier)
  UNION ALL
  SELECT 6000000000 + s * 10 + i, 100000000 + s, 'REGISTRATION', TIMESTAMP '1994-01-01' + to_days((10 * i + s % 10)::INT),
         ['ACTIVE', 'BLOCKED', 'REGISTERED', 'CONFIRMED_BY_ADMIN', 'CONFIRMED_BY_USER', 'DISABLED'][(s + i) % 6 + 1], NULL
  FROM (SELECT s_suppkey AS s, unnest(range(0, s_suppkey % 2 + 1)) AS i FROM supplier)),
d_entry AS (
  SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 10 WHEN 2 THEN 20 ELSE -1 END AS tax_percent,
         p_type AS category
  FROM part),
d_supplier_group AS (
  SELECT 100000000 + s_suppkey AS supplier_id, s_suppkey % 6 + 1 AS group_id FROM supplier WHERE s_suppkey % 11 <> 0
  UNION
  SELECT 100000000 + s_suppkey, (5 * s_suppkey + 2) % 6 + 1 FROM supplier WHERE s_suppkey % 11 <> 0),
d_group AS (SELECT p_type AS name, row_number() OVER (ORDER BY p_type) AS id FROM (SELECT DISTINCT p_type FROM part)),
d_directorate AS (
  SELECT c_custkey AS customer_id, 'D' || lpad((c_custkey % 16)::VARCHAR, 2, '0') AS directorate
  FROM customer WHERE c_custkey % 17 <> 0),
