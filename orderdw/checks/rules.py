"""Business rules, checks and numbering (inventory P8, S, D, N)."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from orderdw.checks.derived import AS_OF, asked_numbers, later_orders, requests, tax_model
from orderdw.checks.oracle import AS_OF as AS_OF_SQL, model_sql, rounds, uuid
from orderdw.checks.registry import query
from orderdw.functions.ids import bin_to_uuid, hex_text, stable_key
from orderdw.operators import quality, stock
from orderdw.operators.allocation import allocate, explain_rejects
from orderdw.operators.deletes import delete_along_keys
from orderdw.operators.orders import cancel_orders, log_list, order_list, register_orders
from orderdw.operators.pricing import price_change_report, reprice
from orderdw.operators.running import assign_numbers
from orderdw.plans import property_tax as tax, warehouse
from orderdw.schemas import KEYS, ORIGINS

TAKES = "new_state = 'confirmado' AND state <> 'confirmado'"
GIVES = "new_state = 'anulado' AND state = 'confirmado'"


@query("p8_transitions", model_sql(f"""
SELECT order_no, {TAKES} AS takes, {GIVES} AS gives FROM later WHERE state <> new_state"""))
def p8(x):
    changed = stock.changed_states(x.m.orders, later_orders(x.m.orders))
    return changed.select("order_no", stock.takes_stock().alias("takes"),
                          stock.gives_back().alias("gives"))


@query("s1_stamp_price", model_sql("""
SELECT line_id, p.unit_price FROM m_lines l LEFT JOIN m_products p USING (product_id)"""))
def s1(x):
    return stock.stamp_price(x.m.lines, x.m.products).select("line_id", "unit_price")


DEMAND = """
SELECT order_no, product_id, order_date AS seq,
       CASE WHEN state = 'confirmado' THEN sum(quantity) ELSE 0 END AS take,
       CASE WHEN state = 'confirmado' THEN sum(quantity) ELSE max(quantity) END AS need, stock
FROM m_lines JOIN m_orders USING (order_no) JOIN m_products USING (product_id)
GROUP BY order_no, product_id, order_date, state, stock"""


@query("s2_allocation", model_sql("""
SELECT order_no, order_no NOT IN (SELECT order_no FROM settled WHERE status = 2) AS accepted
FROM m_orders""", rounds(DEMAND), recursive=True))
def s2(x):
    got = allocate(x.m.lines, x.m.orders, x.m.products, sequence=["order_date"])
    return x.m.orders.select("order_no").join(got.rejected.withColumn("r", F.lit(True)),
                                              "order_no", "left") \
        .select("order_no", F.col("r").isNull().alias("accepted"))


# Lines of rejected orders with what is left for each of them.
SHORT = """
short AS (
  SELECT l.order_no, l.product_id, l.line_no, l.line_id, l.quantity, d.stock - d.used
           - CASE WHEN d.take = 0 THEN 0 ELSE coalesce(sum(l.quantity) OVER (
               PARTITION BY l.order_no, l.product_id ORDER BY l.line_no, l.line_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS available
  FROM {lines} l JOIN settled d USING (order_no, product_id) WHERE d.status = 2),
failed AS (
  SELECT *, row_number() OVER (PARTITION BY order_no ORDER BY line_no, line_id) AS n
  FROM short WHERE available < quantity)"""
SHORT_TEXT = """'Stock insuficiente para el producto ' || description || '. Stock disponible: '
       || CAST(available AS BIGINT) || '. Cantidad requerida: ' || quantity"""


@query("s2_reject_messages", model_sql(f"""
SELECT order_no, 'short_stock' AS rule, product_id, CAST(available AS BIGINT) AS available,
       quantity AS required, {SHORT_TEXT} AS message
FROM failed JOIN m_products USING (product_id) WHERE n = 1""",
    f"{rounds(DEMAND)},{SHORT.format(lines='m_lines')}", recursive=True))
def s2_messages(x):
    got = allocate(x.m.lines, x.m.orders, x.m.products, sequence=["order_date"])
    return explain_rejects(got, x.m.lines, x.m.products)


def _stock_sql(sign: str, where: str) -> str:
    return model_sql(f"""
SELECT product_id, CAST(stock {sign} coalesce(moved, 0) AS INTEGER) AS stock FROM m_products
LEFT JOIN (SELECT product_id, sum(quantity) AS moved FROM m_lines JOIN later USING (order_no)
           WHERE {where} GROUP BY product_id) USING (product_id)""")


@query("s3_take_confirmed", _stock_sql("-", TAKES))
def s3(x):
    changed = stock.changed_states(x.m.orders, later_orders(x.m.orders))
    lines = x.m.lines.join(changed.filter(stock.takes_stock()).select("order_no"), "order_no",
                           "left_semi")
    return stock.apply_confirmed(x.m.products, lines).select("product_id", "stock")


@query("s4_restock_cancelled", _stock_sql("+", GIVES))
def s4(x):
    changed = stock.changed_states(x.m.orders, later_orders(x.m.orders))
    lines = x.m.lines.join(changed.filter(stock.gives_back()).select("order_no"), "order_no",
                           "left_semi")
    return stock.apply_cancelled(x.m.products, lines).select("product_id", "stock")


@query("s3_s4_ledger", model_sql(f"""
SELECT order_no, product_id,
       CAST(sum(CASE WHEN {TAKES} THEN -quantity ELSE quantity END) AS BIGINT) AS delta
FROM m_lines JOIN later USING (order_no) WHERE ({TAKES}) OR ({GIVES})
GROUP BY order_no, product_id"""))
def s34(x):
    return stock.stock_moves(x.m.orders, later_orders(x.m.orders), x.m.lines)


@query("s5_cancel_audit", model_sql(f"""
SELECT md5('audit|' || order_id || '|2025-05-01 10:00:00') AS audit_id, order_id,
       {AS_OF_SQL} AS cancelled_at, 'Pedido ' || order_no || ' anulado.' AS note
FROM later WHERE {GIVES}"""))
def s5(x):
    got = stock.cancel_audit(x.m.orders, later_orders(x.m.orders), AS_OF)
    return got.withColumn("cancelled_at", F.col("cancelled_at").cast("timestamp_ntz"))


LOG = f"""
SELECT md5('log|' || order_no || '|2025-05-01 10:00:00') AS log_id, order_no
FROM later WHERE new_state = 'anulado' AND state <> 'anulado'"""


@query("s6_cancel_log", model_sql(f"SELECT *, {AS_OF_SQL} AS cancelled_at FROM ({LOG})"))
def s6(x):
    got = stock.cancel_log(x.m.orders, later_orders(x.m.orders), AS_OF)
    return got.withColumn("cancelled_at", F.col("cancelled_at").cast("timestamp_ntz"))


# Requests: the lines of each order in threes; order_no is the place in the queue.
REQUESTS = """
placed AS (
  SELECT l.*, (row_number() OVER (PARTITION BY l.order_no ORDER BY line_no, line_id) - 1) AS n
  FROM m_lines l),
queue AS (
  SELECT order_no AS old_no, n // 3 AS chunk, count(*) AS lines,
         row_number() OVER (ORDER BY order_date, order_no, n // 3) AS request_no
  FROM placed JOIN m_orders USING (order_no) GROUP BY order_no, n // 3, order_date),
flawed AS (
  SELECT request_no, CASE
    WHEN kind = 1 THEN ['customer_format', 'UUID Cliente inválido: x']
    WHEN kind = 2 THEN ['seller_format', 'UUID Vendedor inválido: ']
    WHEN kind = 3 THEN ['product1_format', 'UUID Producto 1 inválido: zz']
    WHEN kind = 4 AND lines > 1 THEN ['quantity2_missing', 'Debe indicar cantidad para producto 2']
    WHEN kind = 5 AND lines > 2 THEN ['quantity3_missing', 'Debe indicarse cantidad para producto 3']
    WHEN kind = 6 AND lines > 1 THEN ['product2_format', 'UUID Producto 2 inválido: bad']
    WHEN kind = 7 THEN ['unknown_customer', 'no parent for ffffffff-ffff-ffff-ffff-ffffffffffff']
    WHEN kind = 8 THEN ['unknown_seller', 'no parent for ffffffff-ffff-ffff-ffff-ffffffffffff']
    WHEN kind = 9 THEN ['unknown_product',
                        'Producto inexistente: ffffffff-ffff-ffff-ffff-ffffffffffff']
    WHEN kind = 10 AND lines > 2 THEN ['product2_missing', 'Falta el producto 2'] END AS told
  FROM (SELECT *, request_no % 40 AS kind FROM queue)),
wanted AS (
  SELECT request_no AS order_no, CAST(n % 3 + 1 AS INTEGER) AS line_no, '' AS line_id, product_id,
         quantity
  FROM placed JOIN queue ON old_no = order_no AND chunk = n // 3 JOIN flawed USING (request_no)
  WHERE told IS NULL)"""
REQUEST_DEMAND = """
SELECT order_no, product_id, 0 AS seq, sum(quantity) AS take, sum(quantity) AS need, stock
FROM wanted JOIN m_products USING (product_id) GROUP BY order_no, product_id, stock"""


@query("s7_register_orders", model_sql("""
SELECT new_no AS order_no, line_no, product_id, quantity, unit_price
FROM wanted JOIN m_products USING (product_id) JOIN (
  SELECT order_no, row_number() OVER (ORDER BY order_no) AS new_no
  FROM settled GROUP BY order_no HAVING max(status) = 1) USING (order_no)""",
    f"{REQUESTS.strip()},\n{rounds(REQUEST_DEMAND)}", recursive=True))
def s7(x):
    got = register_orders(requests(x.m), x.m.customers, x.m.sellers, x.m.products,
                          last_order_no=0, as_of=AS_OF)
    return got.lines.select("order_no", "line_no", "product_id", "quantity", "unit_price")


@query("s7_register_rejects", model_sql(f"""
SELECT order_no AS request_no, 'short_stock' AS rule, 'Stock insuficiente (prod '
       || {uuid('product_id')} || '): dispo ' || CAST(available AS BIGINT) || ', solicitado '
       || quantity AS message FROM failed WHERE n = 1
UNION ALL SELECT request_no, told[1], told[2] FROM flawed WHERE told IS NOT NULL""",
    f"{REQUESTS.strip()},\n{rounds(REQUEST_DEMAND)},{SHORT.format(lines='wanted')}",
    recursive=True))
def s7_rejects(x):
    return register_orders(requests(x.m), x.m.customers, x.m.sellers, x.m.products,
                           last_order_no=0, as_of=AS_OF).rejects


ASKED = """
asked AS (
  SELECT order_no, count(*) AS calls FROM (
    SELECT event_id * 2 AS order_no FROM events UNION ALL SELECT user_id FROM events)
  GROUP BY order_no)"""


@query("s8_cancel_stock", model_sql("""
SELECT product_id, CAST(stock + coalesce(moved, 0) AS INTEGER) AS stock FROM m_products
LEFT JOIN (SELECT product_id, sum(quantity) AS moved FROM m_lines JOIN m_orders USING (order_no)
           WHERE state = 'confirmado' AND order_no IN (SELECT order_no FROM asked)
           GROUP BY product_id) USING (product_id)""", ASKED.strip()))
def s8(x):
    got = cancel_orders(asked_numbers(x.spark, x.folder), x.m.orders, x.m.lines, x.m.products,
                        AS_OF)
    return got.products.select("product_id", "stock")


@query("s8_cancel_states", model_sql("""
SELECT order_no, CASE WHEN state = 'confirmado' AND order_no IN (SELECT order_no FROM asked)
                      THEN 'anulado' ELSE state END AS state FROM m_orders""", ASKED.strip()))
def s8_states(x):
    return cancel_orders(asked_numbers(x.spark, x.folder), x.m.orders, x.m.lines, x.m.products,
                         AS_OF).orders.select("order_no", "state")


@query("s8_cancel_rejects", model_sql("""
SELECT order_no, calls - coalesce(CAST(state = 'confirmado' AS INTEGER), 0) AS calls,
  CASE WHEN state IS NULL THEN 'Pedido no encontrado: ' || order_no
       ELSE 'No se puede anular el pedido ' || order_no || ' porque su estado actual es "'
         || CASE state WHEN 'confirmado' THEN 'anulado' ELSE state END
         || '". Solo los pedidos en estado CONFIRMADO pueden anularse.' END AS message
FROM asked LEFT JOIN m_orders USING (order_no)
WHERE calls - coalesce(CAST(state = 'confirmado' AS INTEGER), 0) > 0""", ASKED.strip()))
def s8_rejects(x):
    return cancel_orders(asked_numbers(x.spark, x.folder), x.m.orders, x.m.lines, x.m.products,
                         AS_OF).rejects


@query("s9_reprice", model_sql("""
SELECT product_id, origin, CASE origin WHEN 'nacional'
  THEN CAST(round(unit_price * 0.85, 2) AS DECIMAL(10,2)) ELSE unit_price END AS unit_price
FROM m_products"""))
def s9(x):
    return reprice(x.m.products, "nacional", -15).select("product_id", "origin", "unit_price")


@query("s10_price_change", model_sql("""
SELECT description, unit_price AS price_before,
       CAST(round(unit_price * 1.13, 2) AS DECIMAL(10,2)) AS price_after
FROM m_products WHERE origin = 'importado'"""))
def s10(x):
    return price_change_report(x.m.products, reprice(x.m.products, "importado", Decimal(13)),
                               "importado")


@query("s11_order_list", model_sql(f"""
SELECT order_no, state, order_date, {uuid('seller_id')} AS seller_uuid FROM m_orders
ORDER BY order_no"""))
def s11(x):
    return order_list(x.m.orders)


@query("s12_log_list", model_sql(f"""
SELECT {uuid('log_id')} AS log_uuid, order_no, {AS_OF_SQL} AS cancelled_at FROM ({LOG})"""))
def s12(x):
    log = stock.cancel_log(x.m.orders, later_orders(x.m.orders), AS_OF)
    return log_list(log).withColumn("cancelled_at", F.col("cancelled_at").cast("timestamp_ntz"))


@query("d1_not_null", model_sql("""
SELECT 'not_null' AS rule, CAST(order_no AS VARCHAR) AS key, CAST(1 AS BIGINT) AS rows,
       'NULL in state' AS message FROM m_orders WHERE state = 'anulado'"""))
def d1(x):
    gaps = x.m.orders.withColumn("state", F.nullif("state", F.lit("anulado")))
    return quality.check_not_null(gaps, ["customer_id", "state"], ["order_no"])


@query("d2_unique", model_sql("""
SELECT 'unique' AS rule, order_no || '|' || line_no AS key, count(*) AS rows,
       count(*) || ' rows with this key' AS message
FROM m_lines GROUP BY order_no, line_no HAVING count(*) > 1"""))
def d2(x):
    return quality.check_unique(x.m.lines, ["order_no", "line_no"])


@query("d3_foreign_key", model_sql("""
SELECT 'foreign_key' AS rule, CAST(order_no AS VARCHAR) AS key, count(*) AS rows,
       'no parent for ' || count(*) || ' rows' AS message
FROM (SELECT event_id * 2 AS order_no FROM events UNION ALL SELECT user_id FROM events)
WHERE order_no NOT IN (SELECT order_no FROM m_orders) GROUP BY order_no"""))
def d3(x):
    return quality.check_fk(asked_numbers(x.spark, x.folder), x.m.orders, ["order_no"])


ROWS = "count(*) || ' rows with this key' AS message"
ORPHANS = "'no parent for ' || count(*) || ' rows' AS message"


@query("d_keys_orders", model_sql(f"""
SELECT 'lines' AS table_name, 'line_id' AS columns, 'unique' AS rule, line_id AS key,
       count(*) AS rows, {ROWS} FROM m_lines GROUP BY line_id HAVING count(*) > 1
UNION ALL
SELECT 'lines', 'order_no, line_no', 'unique', order_no || '|' || line_no, count(*), {ROWS}
FROM m_lines GROUP BY order_no, line_no HAVING count(*) > 1
UNION ALL
SELECT 'cancel_log', 'order_no', 'foreign_key', CAST(order_no AS VARCHAR), count(*), {ORPHANS}
FROM (SELECT event_id * 2 AS order_no FROM events UNION ALL SELECT user_id FROM events)
WHERE order_no NOT IN (SELECT order_no FROM m_orders) GROUP BY order_no"""))
def keys_orders(x):
    """The order model, with a log of all orders that someone wanted cancelled."""
    events = x.table("events")
    log = events.select(stable_key(F.lit("a"), "event_id").alias("log_id"),
                        (F.col("event_id") * 2).alias("order_no")).unionByName(
        events.select(stable_key(F.lit("b"), "event_id").alias("log_id"),
                      F.col("user_id").alias("order_no"))).withColumn(
        "cancelled_at", F.lit(AS_OF).cast("timestamp"))
    m = x.m
    tables = {"customers": m.customers, "suppliers": m.suppliers, "sellers": m.sellers,
              "products": m.products, "orders": m.orders, "lines": m.lines}
    return quality.check_model({**tables, "cancel_log": log})


@query("d_keys_warehouse", model_sql(f"""
SELECT 'fact_orders' AS table_name, 'date_key' AS columns, 'foreign_key' AS rule,
       md5('date|' || order_date) AS key, count(*) AS rows, {ORPHANS}
FROM m_lines JOIN m_orders USING (order_no) WHERE order_date NOT IN (
  SELECT CAST(l_shipdate AS DATE) FROM lineitem) GROUP BY order_date"""))
def keys_warehouse(x):
    """Facts against a date dimension of the days on which something was shipped."""
    m = x.m
    shipped = x.table("lineitem").select(F.to_date("l_shipdate").alias("order_date"))
    customers = warehouse.dim_customers(m.customers)
    products = warehouse.dim_products(m.products, m.suppliers)
    facts = warehouse.fact_orders(m.lines, m.orders, warehouse.dim_dates(m.orders), customers,
                                  products)
    return quality.check_model({"dim_dates": warehouse.dim_dates(shipped),
                                "dim_customers": customers, "dim_products": products,
                                "fact_orders": facts})


@query("d_keys_tax", model_sql("""
SELECT 'instalments' AS table_name, 'cadastral_no, year, instalment_no' AS columns,
       'unique' AS rule, cadastral_no || '|2025|' || m AS key, CAST(2 AS BIGINT) AS rows,
       '2 rows with this key' AS message
FROM t_addresses, range(1, 13) r(m) WHERE c_acctbal > 8000
UNION ALL
SELECT 'properties', 'type_id', 'foreign_key', md5('zone|' || names), count(*),
       'no parent for ' || count(*) || ' rows' FROM t_addresses GROUP BY names"""))
def keys_tax(x):
    """Instalments that were generated again for the rich, and zones given as property types."""
    t = tax_model(x.spark, x.folder)
    properties = t["properties"].withColumn("type_id", F.col("zone_id"))
    due = tax.generate_instalments(properties, 2025, "1000.00")
    again = tax.generate_instalments(properties.filter("c_acctbal > 8000"), 2025, "1000.00")
    return quality.check_model({
        "owners": t["owners"], "addresses": t["addresses"], "address_kinds": t["kinds"],
        "property_types": t["types"], "zones": t["zones"], "countries": t["countries"],
        "provinces": t["provinces"], "towns": t["towns"], "owner_addresses": t["links"],
        "properties": properties, "instalments": due.unionByName(again)})


@query("d4_allowed_values", model_sql("""
SELECT 'allowed_values' AS rule, product_id AS key, CAST(1 AS BIGINT) AS rows,
       'origin is ' || CASE WHEN stock > 500 THEN 'otro' ELSE origin END AS message
FROM m_products WHERE stock > 500"""))
def d4(x):
    odd = x.m.products.withColumn("origin", F.when(F.col("stock") > 500, "otro")
                                  .otherwise(F.col("origin")))
    return quality.check_values(odd, "origin", ORIGINS, ["product_id"])


@query("d5_stock_bounds", model_sql("""
SELECT 'stock_bounds' AS rule, product_id AS key, CAST(1 AS BIGINT) AS rows,
       'El stock (' || stock || ') debe estar entre ' || stock_min || ' y ' || stock_max || '.'
         AS message
FROM m_products WHERE stock < stock_min OR stock > stock_max"""))
def d5(x):
    return quality.check_stock_bounds(x.m.products)


@query("d6_delete_cascade", model_sql("""
SELECT line_id FROM m_lines JOIN m_orders USING (order_no)
WHERE order_date >= DATE '1996-01-01'"""))
def d6(x):
    doomed = x.m.orders.filter(F.col("order_date") < F.lit("1996-01-01").cast("timestamp_ntz"))
    return quality.delete_with_children(x.m.orders, x.m.lines, doomed, "order_no", "order_no",
                                        "cascade").child.select("line_id")


@query("d6_delete_restrict", model_sql("""
SELECT seller_id, CAST(seller_id IN (SELECT seller_id FROM m_orders) AS VARCHAR) AS blocked
FROM m_sellers"""))
def d6_restrict(x):
    got = quality.delete_with_children(x.m.sellers, x.m.orders, x.m.sellers, "seller_id",
                                       "seller_id", "restrict")
    kept = got.blocked.select("seller_id", F.lit("true").alias("blocked"))
    return x.m.sellers.select("seller_id").join(kept, "seller_id", "left").select(
        "seller_id", F.coalesce("blocked", F.lit("false")).alias("blocked"))


GRAPH = """
doomed AS (SELECT customer_id FROM m_customers WHERE names = 'BUILDING'),
held AS (SELECT customer_id, count(*) AS rows FROM m_orders
         WHERE state = 'anulado' AND customer_id IN (SELECT customer_id FROM doomed)
         GROUP BY customer_id),
going AS (SELECT customer_id FROM doomed WHERE customer_id NOT IN (SELECT customer_id FROM held))"""


@query("d6_delete_graph", model_sql("""
SELECT 'customers' AS table_name, customer_id AS key, CAST(NULL AS VARCHAR) AS by_table,
       CAST(NULL AS BIGINT) AS rows FROM going
UNION ALL SELECT 'orders', order_id, NULL, NULL FROM m_orders JOIN going USING (customer_id)
UNION ALL SELECT DISTINCT 'lines', line_id, NULL, NULL FROM m_lines JOIN m_orders USING (order_no)
  JOIN going USING (customer_id)
UNION ALL SELECT 'customers', customer_id, 'cancel_log', rows FROM held""", GRAPH.strip()))
def d6_graph(x):
    """Customers go with their orders and the lines of these, unless the log names one of the
    orders."""
    m = x.m
    log = stock.log_rows(m.orders.filter("state = 'anulado'"), AS_OF)
    got = delete_along_keys(
        {"customers": m.customers, "sellers": m.sellers, "orders": m.orders, "lines": m.lines,
         "cancel_log": log}, {"customers": m.customers.filter("names = 'BUILDING'")},
        {"orders": {"customers"}, "lines": {"orders"}})
    keys = {"customers": "customer_id", "orders": "order_id", "lines": "line_id"}
    gone = [rows.select(F.lit(name).alias("table_name"), hex_text(keys[name]).alias("key"),
                        F.lit(None).cast("string").alias("by_table"),
                        F.lit(None).cast("long").alias("rows"))
            for name, rows in got.gone.items()]
    return reduce(DataFrame.unionByName, [*gone, got.blocked])


@query("d6_delete_graph_left", model_sql("""
SELECT line_id, quantity FROM m_lines JOIN m_orders USING (order_no)
WHERE customer_id NOT IN (SELECT customer_id FROM m_customers WHERE names = 'BUILDING')""",
    ""))
def d6_graph_left(x):
    """The lines that are left when nothing holds the customers."""
    m = x.m
    got = delete_along_keys({"customers": m.customers, "orders": m.orders, "lines": m.lines},
                            {"customers": m.customers.filter("names = 'BUILDING'")},
                            {"orders": {"customers"}, "lines": {"orders"}},
                            {**KEYS, "lines": KEYS["lines"]._replace(primary=("order_no", "line_no"))})
    return got.tables["lines"].select("line_id", "quantity")


@query("d7_uuid_format", model_sql("""
SELECT 'uuid_format' AS rule, CAST(order_no AS VARCHAR) AS key, CAST(1 AS BIGINT) AS rows,
       'u is not a UUID: ' || order_id AS message FROM m_orders WHERE state = 'anulado'"""))
def d7(x):
    text = F.when(F.col("state") == "anulado", hex_text("order_id")).otherwise(
        bin_to_uuid("order_id"))
    return quality.check_uuid(x.m.orders.select("order_no", text.alias("u")), "u", ["order_no"])


@query("n1_assign_numbers", model_sql("""
SELECT order_id, row_number() OVER (ORDER BY order_date, order_id) + 99 AS new_no
FROM m_orders"""))
def n1(x):
    return assign_numbers(x.m.orders.select("order_date", "order_id"), ["order_date", "order_id"],
                          start=100, name="new_no").select("order_id", "new_no")
