"""Reports, warehouse load, property tax and the stream (inventory R, W, X, Z)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from orderdw.checks.derived import clustered_orders, state_changes, stored_model, tax_model
from orderdw.checks.oracle import draw, model_sql
from orderdw.checks.registry import ORACLE, query
from orderdw.plans import property_tax as tax, reports, warehouse
from orderdw.session import stage_path
from orderdw.streaming.state_changes import (read_changes, read_daily_moves, read_ledger,
                                             read_log, stock_now, stream_state_changes)

LO, HI = "1997-04-01", "1997-04-30"
IN_APRIL = f"order_date BETWEEN DATE '{LO}' AND DATE '{HI}'"


@query("r1_customers_between", model_sql(f"""
SELECT DISTINCT surname, names, dni, email FROM m_customers JOIN m_orders USING (customer_id)
WHERE {IN_APRIL}"""))
def r1(x):
    return reports.customers_between(x.m.customers, x.m.orders, LO, HI)


@query("r1_customers_between_clustered", ORACLE["r1_customers_between"])
def r1_clustered(x):
    """The same, where the orders lie by date."""
    return reports.customers_between(x.m.customers, clustered_orders(x.spark, x.m), LO, HI)


@query("r2_orders_per_seller", model_sql("""
SELECT surname, names, dni, email, count(order_id) AS order_count
FROM m_sellers LEFT JOIN m_orders USING (seller_id)
GROUP BY seller_id, surname, names, dni, email"""))
def r2(x):
    return reports.orders_per_seller(x.m.sellers, x.m.orders)


@query("r3_orders_over", model_sql("""
SELECT order_no, order_date, CAST(sum(total) AS DECIMAL(20,2)) AS order_total
FROM m_orders JOIN m_lines USING (order_no) GROUP BY order_no, order_date
HAVING sum(total) > 5000000.00"""))
def r3(x):
    return reports.orders_over(x.m.orders, x.m.lines, Decimal("5000000.00"))


@query("r4_product_sales_between", model_sql(f"""
SELECT description, CAST(sum(quantity) AS BIGINT) AS quantity
FROM m_orders JOIN m_lines USING (order_no) JOIN m_products USING (product_id)
WHERE {IN_APRIL} GROUP BY description"""))
def r4(x):
    return reports.product_sales_between(x.m.orders, x.m.lines, x.m.products, LO, HI)


# Every product under one of four spellings that differ in case and accents only.
@query("r4_product_sales_loose", model_sql(f"""
SELECT lower(description) AS description, CAST(sum(quantity) AS BIGINT) AS quantity
FROM m_orders JOIN m_lines USING (order_no) JOIN m_products USING (product_id)
WHERE {IN_APRIL} GROUP BY lower(description)"""))
def r4_loose(x):
    name, key = F.col("description"), F.pmod(F.xxhash64("product_id"), F.lit(4))
    spelt = x.m.products.withColumn("description", F.when(key == 0, F.upper(name)).when(
        key == 1, F.initcap(name)).when(key == 2, F.translate(name, "aeou", "áéóü")).otherwise(name))
    sold = reports.product_sales_between(x.m.orders, x.m.lines, spelt, LO, HI, loose=True)
    return sold.select(F.translate(F.lower(F.collate("description", "UTF8_BINARY")), "áéóü", "aeou")
                       .alias("description"), "quantity")


@query("r5_top_supplier", model_sql("""
SELECT s.name, CAST(sum(quantity) AS BIGINT) AS quantity
FROM m_suppliers s JOIN m_products p USING (supplier_id) JOIN m_lines l USING (product_id)
GROUP BY s.supplier_id, s.name ORDER BY quantity DESC, s.name LIMIT 1"""))
def r5(x):
    return reports.top_supplier(x.m.suppliers, x.m.products, x.m.lines)


@query("r6_customers_without_orders", model_sql("""
SELECT surname, names, email FROM m_customers
WHERE customer_id NOT IN (SELECT customer_id FROM m_orders)"""))
def r6(x):
    return reports.customers_without_orders(x.m.customers, x.m.orders)


@query("r7_customers_below", model_sql("""
SELECT surname, names, email FROM m_customers LEFT JOIN m_orders USING (customer_id)
GROUP BY customer_id, surname, names, email HAVING count(order_id) < 8"""))
def r7(x):
    return reports.customers_below(x.m.customers, x.m.orders, 8)


@query("r8_sales_by_origin", model_sql("""
SELECT origin, CAST(sum(quantity) AS BIGINT) AS quantity
FROM m_products JOIN m_lines USING (product_id) GROUP BY origin"""))
def r8(x):
    return reports.sales_by_origin(x.m.products, x.m.lines)


TYPES = """
n_types AS (SELECT md5('type|' || p_type) AS id, p_type,
                   row_number() OVER (ORDER BY md5('type|' || p_type)) - 1 AS n
            FROM (SELECT DISTINCT p_type FROM part))"""


@query("r9_instalment_report", model_sql(f"""
SELECT surnames, names, cadastral_no, t.p_type AS property_type, names AS zone, street, number,
       town, province, country, CAST(2025 AS INTEGER) AS year, CAST(m AS INTEGER) AS instalment_no,
       CAST(1000.00 AS DECIMAL(12,2)) AS value, make_date(2025, m, 15) AS due_date
FROM t_addresses a LEFT JOIN t_places USING (town_id)
JOIN n_types t ON t.n = {draw('cadastral_no', '5')} % (SELECT count(*) FROM n_types),
range(1, 13) r(m)""", TYPES.strip()))
def r9(x):
    t = tax_model(x.spark, x.folder)
    properties = tax.assign_dim(t["properties"].drop("type_id"), t["types"], 5, "type_id",
                                F.col("cadastral_no"))
    due = tax.generate_instalments(properties, 2025, "1000.00").unionByName(
        tax.generate_instalments(properties, 2024, "900.00"))
    return tax.instalment_report(t["owners"], properties, due, t["addresses"], t["towns"],
                                 t["provinces"], t["countries"], t["zones"], t["types"], 2025)


DATES = """
SELECT DISTINCT md5('date|' || order_date) AS date_key, order_date AS date,
       CAST(day(order_date) AS INTEGER) AS day, CAST(month(order_date) AS INTEGER) AS month,
       CAST(year(order_date) AS INTEGER) AS year FROM m_orders"""
CUSTOMERS = """
SELECT md5('customer|' || customer_id) AS customer_key, customer_id,
       surname || ', ' || names AS name FROM m_customers"""
PRODUCTS = """
SELECT md5('product|' || product_id) AS product_key, product_id, description,
       name AS supplier_name FROM m_products JOIN m_suppliers USING (supplier_id)"""
FACTS = """
SELECT md5('customer|' || customer_id) AS customer_key, md5('product|' || product_id)
         AS product_key, md5('date|' || order_date) AS date_key, quantity, total
FROM m_lines JOIN m_orders USING (order_no) JOIN m_customers USING (customer_id)
JOIN m_products USING (product_id)"""


@query("w1_dim_dates", model_sql(DATES))
def w1(x):
    return warehouse.dim_dates(x.m.orders)


@query("w2_dim_customers", model_sql(CUSTOMERS))
def w2(x):
    return warehouse.dim_customers(x.m.customers)


@query("w3_dim_products", model_sql(PRODUCTS))
def w3(x):
    return warehouse.dim_products(x.m.products, x.m.suppliers)


@query("w4_fact_orders", model_sql(FACTS))
def w4(x):
    m = x.m
    return warehouse.fact_orders(m.lines, m.orders, warehouse.dim_dates(m.orders),
                                 warehouse.dim_customers(m.customers),
                                 warehouse.dim_products(m.products, m.suppliers))


@query("w5_run_etl", model_sql(f"""
SELECT d.year, d.month, c.name, CAST(sum(f.quantity) AS BIGINT) AS quantity,
       CAST(sum(f.total) AS DECIMAL(20,2)) AS total, count(*) AS lines
FROM facts f JOIN dates d USING (date_key) JOIN customers c USING (customer_key)
GROUP BY d.year, d.month, c.name""",
    f"facts AS ({FACTS}), dates AS ({DATES}), customers AS ({CUSTOMERS})"))
def w5(x):
    folder, names = stored_model(x.spark, x.m)
    w = warehouse.run_etl(x.spark, folder, stage_path(x.spark, "dw"), names)
    return (w["fact_orders"].join(w["dim_dates"], "date_key")
            .join(w["dim_customers"], "customer_key").groupBy("year", "month", "name")
            .agg(F.sum("quantity").alias("quantity"), F.sum("total").alias("total"),
                 F.count("*").alias("lines")))


@query("x1_generate_instalments", """
SELECT 'CAT-' || c_custkey AS cadastral_no, CAST(2025 AS INTEGER) AS year,
       CAST(m AS INTEGER) AS instalment_no, CAST(1000.00 AS DECIMAL(12,2)) AS value,
       make_date(2025, m, 15) AS due_date, CAST(NULL AS DATE) AS paid_date, false AS paid
FROM customer, range(1, 13) r(m)""")
def x1(x):
    return tax.generate_instalments(tax_model(x.spark, x.folder)["properties"], 2025, "1000.00")


@query("x2_assign_town", model_sql(f"""
SELECT a.id, t.town_id
FROM t_addresses a JOIN (SELECT province, count(*) AS size FROM t_places GROUP BY province) s
  ON s.province = CASE WHEN c_nationkey < 10 THEN 'ASIA' ELSE 'EUROPE' END
JOIN (SELECT *, row_number() OVER (PARTITION BY province ORDER BY town_id) - 1 AS n
      FROM t_places) t ON t.province = s.province AND t.n = {draw('a.id', '3')} % s.size"""))
def x2(x):
    t = tax_model(x.spark, x.folder)
    asked = t["addresses"].withColumn("province", F.when(F.col("c_nationkey") < 10, "ASIA")
                                      .otherwise("EUROPE"))
    return tax.assign_town(asked, t["towns"], t["provinces"], 3).select("id", "town_id")


@query("x3_assign_dim", model_sql(f"""
SELECT cadastral_no, CASE WHEN c_acctbal > 0 THEN md5('zone|' || names) ELSE z.id END AS zone_id
FROM t_addresses JOIN zones z ON z.n = {draw('cadastral_no', '4')} % (SELECT count(*) FROM zones)""",
    """zones AS (SELECT md5('zone|' || names) AS id,
                 row_number() OVER (ORDER BY md5('zone|' || names)) - 1 AS n
          FROM (SELECT DISTINCT c_mktsegment AS names FROM customer))"""))
def x3(x):
    t = tax_model(x.spark, x.folder)
    asked = t["properties"].drop("zone_id").withColumn(
        "zone_name", F.when(F.col("c_acctbal") > 0, F.col("zone_name")))
    return tax.assign_dim(asked, t["zones"], 4, "zone_id", F.col("cadastral_no"),
                          fixed="zone_name").select("cadastral_no", "zone_id")


# Everyone lives at their own address; some are billed there, and the rich have a second home.
TYPED = """
typed AS (
  SELECT o.id AS owner_id, o.surnames, o.names, kind, a.id AS address_id, a.street, a.number
  FROM t_addresses o, (VALUES ('particular', 0, -1e9), ('de cobro', 0, 5000),
                              ('particular', 1, 8000)) k(kind, shift, above), t_addresses a
  WHERE o.c_acctbal > above AND a.cadastral_no = 'CAT-'
    || ((CAST(substr(o.cadastral_no, 5) AS BIGINT) + shift) % (SELECT count(*) FROM customer)))"""


@query("x4_addresses_by_kind", model_sql("SELECT * FROM typed", TYPED.strip()))
def x4(x):
    t = tax_model(x.spark, x.folder)
    return tax.addresses_by_kind(t["owners"], t["links"], t["addresses"], t["kinds"]).drop(
        "floor", "unit", "town_id")


@query("x4_addresses_side_by_side", model_sql("""
SELECT owner_id, surnames, names, position,
       max(CASE WHEN kind = 'particular' THEN told END) AS home,
       max(CASE WHEN kind = 'de cobro' THEN told END) AS billing
FROM (SELECT *, street || ' ' || number AS told, CAST(row_number() OVER (
        PARTITION BY owner_id, kind ORDER BY street || ' ' || number, address_id) AS INTEGER)
        AS position FROM typed)
GROUP BY owner_id, surnames, names, position""", TYPED.strip()))
def x4_wide(x):
    t = tax_model(x.spark, x.folder)
    by_kind = tax.addresses_by_kind(t["owners"], t["links"], t["addresses"], t["kinds"])
    return tax.addresses_side_by_side(by_kind, {"home": "particular", "billing": "de cobro"})


CHANGES = """
named AS (
  SELECT event_id, user_id AS order_no, o.state, o.order_id, ts,
         CASE event_type WHEN 'purchase' THEN 'confirmado' ELSE 'anulado' END AS new_state
  FROM events JOIN m_orders o ON o.order_no = user_id
  WHERE event_type IN ('purchase', 'error')),
changes AS (
  SELECT *, coalesce(lag(new_state) OVER (PARTITION BY order_no ORDER BY ts, event_id), state)
              AS old_state
  FROM named)"""


def _stream(x):
    """Run the stream over the changes; gives the folder of its outputs.

    Every seventh change comes again, and the changes are dealt to the files whatever their time,
    so that late ones and repeats are spread over the batches.
    """
    source, target = stage_path(x.spark, "changes"), stage_path(x.spark, "stream")
    once = state_changes(x.spark, x.folder, x.m)
    again = once.filter("event_id % 7 = 0")
    once.unionByName(again).repartition(6).write.parquet(source)
    lines = x.m.lines.select("order_no", "product_id", "quantity")
    stream_state_changes(read_changes(x.spark, source, files_per_batch=2), lines, target) \
        .awaitTermination()
    return target


@query("z1_stream_stock", model_sql("""
SELECT product_id, CAST(stock + coalesce(delta, 0) AS INTEGER) AS stock
FROM m_products LEFT JOIN (
  SELECT product_id, sum(quantity * sign) AS delta
  FROM m_lines JOIN (
    SELECT order_no, CASE WHEN new_state = 'confirmado' AND old_state <> 'confirmado' THEN -1
                          WHEN new_state = 'anulado' AND old_state = 'confirmado' THEN 1 END AS sign
    FROM changes) USING (order_no)
  WHERE sign IS NOT NULL GROUP BY product_id) USING (product_id)""", CHANGES.strip()))
def z1(x):
    daily = read_daily_moves(x.spark, _stream(x))
    return stock_now(x.m.products, daily).select("product_id", "stock")


@query("z1_stream_ledger", model_sql("""
SELECT event_id, order_no, product_id, CAST(sum(quantity * sign) AS BIGINT) AS delta
FROM m_lines JOIN (
  SELECT event_id, order_no,
         CASE WHEN new_state = 'confirmado' AND old_state <> 'confirmado' THEN -1
              WHEN new_state = 'anulado' AND old_state = 'confirmado' THEN 1 END AS sign
  FROM changes) USING (order_no)
WHERE sign IS NOT NULL GROUP BY event_id, order_no, product_id""", CHANGES.strip()))
def z1_ledger(x):
    return read_ledger(x.spark, _stream(x)).select("event_id", "order_no", "product_id", "delta")


@query("z1_stream_log", model_sql("""
SELECT order_no, ts AS cancelled_at FROM changes
WHERE new_state = 'anulado' AND old_state <> 'anulado'""", CHANGES.strip()))
def z1_log(x):
    return read_log(x.spark, _stream(x)).select("order_no", F.col("cancelled_at").cast("timestamp_ntz")
                      .alias("cancelled_at"))
