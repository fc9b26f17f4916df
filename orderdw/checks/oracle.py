"""The registered queries in DuckDB's SQL, over the raw test tables."""

from __future__ import annotations

MODEL = """
m_customers AS (
  SELECT lpad(lower(to_hex(c_custkey)), 32, '0') AS customer_id, CAST(c_custkey AS VARCHAR) AS dni,
         c_name AS surname, c_mktsegment AS names, 'Nation ' || c_nationkey AS address,
         lower(c_name) || '@example.com' AS email
  FROM customer),
m_suppliers AS (
  SELECT lpad(lower(to_hex(s_suppkey)), 32, '0') AS supplier_id, s_name AS name,
         'Nation ' || s_nationkey AS address, lower(s_name) || '@example.com' AS email
  FROM supplier),
m_sellers AS (
  SELECT lpad(lower(to_hex(s_suppkey)), 32, '0') AS seller_id, CAST(s_suppkey AS VARCHAR) AS dni,
         s_name AS surname, 'Nation ' || s_nationkey AS names,
         lower(s_name) || '@example.com' AS email,
         CAST(s_suppkey % 30 AS DECIMAL(5,2)) AS commission
  FROM supplier),
m_products AS (
  SELECT lpad(lower(to_hex(p_partkey)), 32, '0') AS product_id,
         p_name || ' ' || p_brand AS description,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, p_size * 20 AS stock,
         800 AS stock_max, 100 AS stock_min,
         lpad(lower(to_hex(p_partkey % (SELECT count(*) FROM supplier))), 32, '0') AS supplier_id,
         CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'PROMO') THEN 'nacional' ELSE 'importado' END
           AS origin
  FROM part),
m_orders AS (
  SELECT lpad(lower(to_hex(o_orderkey)), 32, '0') AS order_id, o_orderkey AS order_no,
         lpad(lower(to_hex(o_custkey % ((SELECT count(*) FROM customer) * 9 // 10))), 32, '0')
           AS customer_id,
         lpad(lower(to_hex(o_orderkey % ((SELECT count(*) FROM supplier) * 9 // 10))), 32, '0')
           AS seller_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CASE o_orderstatus WHEN 'F' THEN 'confirmado' WHEN 'O' THEN 'pendiente'
           ELSE 'anulado' END AS state
  FROM orders),
m_lines AS (
  SELECT md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                       CAST(l_quantity AS INTEGER), CAST(l_extendedprice AS DECIMAL(10,2))))
           AS line_id,
         l_orderkey AS order_no, l_linenumber AS line_no,
         lpad(lower(to_hex(l_partkey)), 32, '0') AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price,
         CAST(CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(10,2))
              AS DECIMAL(10,2)) AS total
  FROM lineitem),
later AS (
  SELECT *, CASE WHEN state = 'confirmado' AND order_date < DATE '1996-01-01' THEN 'anulado'
                 WHEN state = 'pendiente' AND year(order_date) = 1996 THEN 'anulado'
                 WHEN state = 'pendiente' AND order_date >= DATE '2000-01-01' THEN 'confirmado'
                 ELSE state END AS new_state
  FROM m_orders),
t_addresses AS (
  SELECT lpad(lower(to_hex(c_custkey)), 32, '0') AS id, c_mktsegment || ' street' AS street,
         CAST(floor(abs(c_acctbal)) AS INTEGER) AS number,
         lpad(lower(to_hex(c_nationkey)), 32, '0') AS town_id, c_nationkey, c_acctbal,
         'CAT-' || c_custkey AS cadastral_no, c_name AS surnames, c_mktsegment AS names
  FROM customer),
t_places AS (
  SELECT lpad(lower(to_hex(n_nationkey)), 32, '0') AS town_id, n_name AS town,
         lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS postcode, r_name AS province,
         'Country ' || (r_regionkey // 3) AS country, r_regionkey
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)
"""


def uuid(col: str) -> str:
    """Hex text of 32 digits as 8-4-4-4-12."""
    spans = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return "concat_ws('-', " + ", ".join(f"substr({col}, {a}, {n})" for a, n in spans) + ")"


def draw(col: str, seed: str) -> str:
    return f"CAST('0x' || substr(md5({col} || ':{seed}'), 1, 8) AS BIGINT)"


def model_sql(body: str, more: str = "", recursive: bool = False) -> str:
    extra = f",\n{more}" if more else ""
    return f"WITH {'RECURSIVE ' if recursive else ''}{MODEL.strip()}{extra}\n{body.strip()}"


def rounds(demand: str) -> str:
    """Orders taken one after the other, as rounds over ``(order_no, product_id, seq, take, need,
    stock)``: whoever fits under all open orders before it is accepted, whoever does not fit under
    the accepted ones alone is rejected. ``settled`` has the outcome of the last round.
    """
    earlier = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    queue = f"OVER (PARTITION BY product_id ORDER BY seq, order_no {earlier})"
    return f"""
demand AS ({demand}),
rounds AS (
  SELECT 0 AS i, order_no, product_id, seq, take, need, stock, 0 AS status FROM demand
  UNION ALL
  SELECT i + 1, order_no, product_id, seq, take, need, stock,
         CASE WHEN status <> 0 THEN status WHEN NOT doubtful THEN 1 WHEN hopeless THEN 2
              ELSE 0 END
  FROM (SELECT *, bool_or(doubtful AND stock - low < need) OVER (PARTITION BY order_no)
                    AS hopeless
        FROM (SELECT *, coalesce(sum(CASE WHEN status = 1 OR status = 0 AND NOT doubtful
                                          THEN take ELSE 0 END) {queue}, 0) AS low
              FROM (SELECT *, bool_or(status = 0 AND stock - most < need)
                                OVER (PARTITION BY order_no) AS doubtful
                    FROM (SELECT *, coalesce(sum(CASE WHEN status < 2 THEN take ELSE 0 END)
                                             {queue}, 0) AS most,
                                 bool_or(status = 0) OVER () AS open FROM rounds)
                    WHERE open)))),
settled AS (
  SELECT *, coalesce(sum(CASE WHEN status = 1 THEN take ELSE 0 END) {queue}, 0) AS used
  FROM rounds WHERE i = (SELECT max(i) FROM rounds))""".strip()


AS_OF = "TIMESTAMP '2025-05-01 10:00:00'"
