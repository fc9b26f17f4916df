"""Scans, projections, filters, joins, aggregation, sorting (inventory A, P, J, G, T)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderdw.checks.derived import clustered_orders, later_orders, stored_model, tax_model
from orderdw.checks.oracle import model_sql, uuid
from orderdw.checks.registry import query
from orderdw.functions.ids import bin_to_uuid, hex_text, is_uuid
from orderdw.functions.scalars import between_dates
from orderdw.operators.orders import find_orders
from orderdw.operators.pricing import price_listing
from orderdw.operators.sampling import lookup_key, pick_side_by_side, random_pick
from orderdw.operators.stock import apply_moves, stock_moves, with_line_total
from orderdw.plans import property_tax as tax, reports, warehouse
from orderdw.schemas import CONFIRMED
from orderdw.session import stage_path
from orderdw.sources.parts import PartTable
from orderdw.sources.publish import refresh
from orderdw.sources.tables import register_views, with_defaults, write_table


@query("a1_scan", "SELECT * FROM part")
def a1(x):
    return x.table("part")


PRICES = model_sql("SELECT product_id, description, unit_price FROM m_products")


@query("a3_insert_select", PRICES)
def a3(x):
    path = stage_path(x.spark, "insert")
    write_table(x.m.products.select("product_id", "description", "unit_price"), path, "append")
    return x.spark.read.parquet(path)


@query("a4_full_refresh", PRICES)
def a4(x):
    target = stage_path(x.spark, "refresh")
    rows = x.m.products.select("product_id", "description", "unit_price")
    refresh(rows.withColumn("unit_price", F.lit(0).cast("decimal(10,2)")), target, "prices")
    return refresh(rows, target, "prices")


@query("a5_append_log", model_sql("SELECT order_no, state FROM m_orders WHERE state <> 'pendiente'"))
def a5(x):
    rows = x.m.orders.select("order_no", "state")
    log = PartTable(x.spark, stage_path(x.spark, "append"), rows.schema)
    for state in ("confirmado", "anulado", "confirmado"):  # one of the jobs is run twice
        log.append(rows.filter(F.col("state") == state), state)
    return log.read()


@query("a5_append_compacted", model_sql("""
SELECT order_no, state, year(order_date) AS year FROM m_orders"""))
def a5_compacted(x):
    rows = x.m.orders.select("order_no", "state", F.year("order_date").cast("long").alias("year"))
    log = PartTable(x.spark, stage_path(x.spark, "append"), rows.schema, group="year")
    for state in ("confirmado", "anulado", "pendiente"):
        log.append(rows.filter(F.col("state") == state), state)
    log.compact_full(log.groups(), most=1)
    log.append(rows.filter("state = 'anulado'"), "anulado")  # again, after compaction
    return log.read()


@query("a6_views", model_sql("""
SELECT surname, count(*) AS order_count FROM m_orders JOIN m_customers USING (customer_id)
WHERE state = 'confirmado' GROUP BY surname"""))
def a6(x):
    folder, names = stored_model(x.spark, x.m)
    register_views(x.spark, folder, ["customers", "orders"], names)
    return x.spark.sql(
        "SELECT surname, count(*) AS order_count FROM orders JOIN customers USING (customer_id) "
        "WHERE state = :state GROUP BY surname", args={"state": CONFIRMED})


@query("a7_captioned_listing", model_sql("""
SELECT 0 AS section, 'before the change' AS description,
       CAST(NULL AS DECIMAL(10,2)) AS current_price
UNION ALL
SELECT 1, description, unit_price FROM m_products WHERE origin = 'nacional'"""))
def a7(x):
    return price_listing(x.m.products, "nacional", "before the change")


@query("a8_defaults", model_sql("""
SELECT order_no, CASE WHEN state = 'anulado' THEN 'pendiente' ELSE state END AS state,
       'none' AS note FROM m_orders"""))
def a8(x):
    gaps = x.m.orders.select("order_no", F.when(F.col("state") != "anulado", F.col("state"))
                             .alias("state"))
    return with_defaults(gaps, {"state": "pendiente", "note": "none"})


@query("p1_projection", model_sql(
    "SELECT surname AS apellido, names AS nombres, dni, email FROM m_sellers"))
def p1(x):
    return x.m.sellers.select(F.col("surname").alias("apellido"), F.col("names").alias("nombres"),
                              "dni", "email")


@query("p2_line_total", model_sql("SELECT line_id, quantity, unit_price, total FROM m_lines"))
def p2(x):
    return with_line_total(x.m.lines).select("line_id", "quantity", "unit_price", "total")


@query("p3_equality_filters", model_sql("""
SELECT order_no, state FROM m_orders WHERE state <> 'confirmado'"""))
def p3(x):
    return x.m.orders.filter(F.col("state") != CONFIRMED).select("order_no", "state")


@query("p4_date_range", model_sql("""
SELECT order_no, order_date FROM m_orders
WHERE order_date BETWEEN DATE '1997-04-01' AND DATE '1997-04-30'"""))
def p4(x):
    return x.m.orders.filter(between_dates(x.m.orders, "order_date", "1997-04-01", "1997-04-30")) \
        .select("order_no", F.to_date("order_date").alias("order_date"))


@query("p5_null_test", model_sql("""
SELECT order_no, nullif(state, 'anulado') IS NULL AS missing FROM m_orders"""))
def p5(x):
    return x.m.orders.select("order_no", F.nullif("state", F.lit("anulado")).isNull()
                             .alias("missing"))


@query("p6_membership", model_sql("""
SELECT order_no FROM m_orders WHERE state IN ('pendiente', 'anulado')"""))
def p6(x):
    return x.m.orders.filter(F.col("state").isin("pendiente", "anulado")).select("order_no")


@query("p7_out_of_range", model_sql("""
SELECT product_id, stock FROM m_products WHERE stock < stock_min OR stock > stock_max"""))
def p7(x):
    return x.m.products.filter((F.col("stock") < F.col("stock_min"))
                               | (F.col("stock") > F.col("stock_max"))) \
        .select("product_id", "stock")


@query("p9_regex", model_sql(f"""
SELECT order_no, regexp_matches(u, '^[0-9A-Fa-f]{{8}}(-[0-9A-Fa-f]{{4}}){{3}}-[0-9A-Fa-f]{{12}}$')
         AS well_formed
FROM (SELECT order_no, CASE state WHEN 'anulado' THEN order_id
             ELSE {uuid('order_id')} END AS u FROM m_orders)"""))
def p9(x):
    text = F.when(F.col("state") == "anulado", hex_text("order_id")).otherwise(
        bin_to_uuid("order_id"))
    return x.m.orders.select("order_no", is_uuid(text).alias("well_formed"))


@query("p10_distinct", model_sql("SELECT DISTINCT customer_id, state FROM m_orders"))
def p10(x):
    return x.m.orders.select("customer_id", "state").distinct()


@query("j1_inner", model_sql("""
SELECT order_no, surname FROM m_orders JOIN m_customers USING (customer_id)"""))
def j1(x):
    return x.m.orders.join(x.m.customers, "customer_id").select("order_no", "surname")


@query("j2_inner_chain", model_sql("""
SELECT order_no, s.name, sum(quantity)::BIGINT AS quantity
FROM m_lines JOIN m_products p USING (product_id) JOIN m_suppliers s USING (supplier_id)
GROUP BY order_no, s.name"""))
def j2(x):
    named = x.m.products.join(x.m.suppliers, "supplier_id").select("product_id", "name")
    return x.m.lines.join(named, "product_id").groupBy("order_no", "name").agg(
        F.sum("quantity").alias("quantity"))


@query("j3_star", model_sql("""
SELECT o.order_date AS date, c.surname || ', ' || c.names AS customer, p.description AS product,
       s.name AS supplier, l.quantity, l.total
FROM m_lines l JOIN m_orders o USING (order_no) JOIN m_customers c USING (customer_id)
JOIN m_products p USING (product_id) JOIN m_suppliers s USING (supplier_id)"""))
def j3(x):
    m = x.m
    dates, customers = warehouse.dim_dates(m.orders), warehouse.dim_customers(m.customers)
    products = warehouse.dim_products(m.products, m.suppliers)
    facts = warehouse.fact_orders(m.lines, m.orders, dates, customers, products)
    return (facts.join(dates, "date_key").join(customers, "customer_key")
            .join(products, "product_key")
            .select("date", F.col("name").alias("customer"), F.col("description").alias("product"),
                    F.col("supplier_name").alias("supplier"), "quantity", "total"))


@query("j4_left_outer", model_sql("""
SELECT c.customer_id, o.order_no FROM m_customers c LEFT JOIN m_orders o USING (customer_id)"""))
def j4(x):
    return x.m.customers.join(x.m.orders, "customer_id", "left").select("customer_id", "order_no")


@query("j5_anti", model_sql("""
SELECT customer_id, surname FROM m_customers
WHERE customer_id NOT IN (SELECT customer_id FROM m_orders)"""))
def j5(x):
    return x.m.customers.join(x.m.orders.select("customer_id").distinct(), "customer_id",
                              "left_anti").select("customer_id", "surname")


@query("j6_semi", model_sql("""
SELECT customer_id, surname FROM m_customers
WHERE customer_id IN (SELECT customer_id FROM m_orders)"""))
def j6(x):
    return x.m.customers.join(x.m.orders.select("customer_id").distinct(), "customer_id",
                              "left_semi").select("customer_id", "surname")


@query("j7_correlated_sum", model_sql("""
SELECT product_id, stock - (SELECT coalesce(sum(quantity), 0) FROM m_lines l
                            WHERE l.product_id = p.product_id)::BIGINT AS left_over
FROM m_products p"""))
def j7(x):
    sold = x.m.lines.groupBy("product_id").agg(F.sum("quantity").alias("sold"))
    return x.m.products.join(sold, "product_id", "left").select(
        "product_id", (F.col("stock") - F.coalesce("sold", F.lit(0))).alias("left_over"))


@query("j8_lookup_key", model_sql("""
SELECT id, (SELECT t.town_id FROM t_places t WHERE t.town = 'NATION_' || c_nationkey) AS found
FROM t_addresses"""))
def j8(x):
    t = tax_model(x.spark, x.folder)
    named = t["addresses"].withColumn("town_name", F.concat(F.lit("NATION_"), F.col("c_nationkey")))
    return lookup_key(named, t["towns"], "town_name", name="found").select("id", "found")


@query("j8_lookup_loose", model_sql("""
SELECT id, (SELECT min(t.town_id) FROM t_places t
            WHERE strip_accents(lower(t.town)) = 'nation_' || c_nationkey) AS found
FROM t_addresses"""))
def j8_loose(x):
    """Towns asked for in other letters; each also lies in a second row with a larger key."""
    t = tax_model(x.spark, x.folder)
    named = t["addresses"].withColumn("town_name", F.concat(
        F.when(F.col("c_nationkey") > 9, "NÁTION_").otherwise("nàtiön_"), F.col("c_nationkey")))
    again = t["towns"].select(F.unhex(F.lit("f" * 32)).alias("id"),
                              F.lower("description").alias("description"))
    towns = t["towns"].select("id", "description").unionByName(again)
    return lookup_key(named, towns, "town_name", name="found", loose=True).select("id", "found")


@query("j10_months", """
SELECT 'CAT-' || c_custkey AS cadastral_no, CAST(m AS INTEGER) AS instalment_no
FROM customer, range(1, 13) r(m)""")
def j10(x):
    t = tax_model(x.spark, x.folder)
    return tax.generate_instalments(t["properties"], 2025, "1000.00").select(
        "cadastral_no", "instalment_no")


@query("j11_update_from_join", model_sql("""
SELECT product_id, CAST(stock - coalesce((SELECT sum(CASE WHEN new_state = 'confirmado'
    THEN quantity ELSE -quantity END) FROM m_lines l JOIN later o USING (order_no)
  WHERE l.product_id = p.product_id AND (new_state = 'confirmado' AND state <> 'confirmado'
    OR new_state = 'anulado' AND state = 'confirmado')), 0) AS INTEGER) AS stock
FROM m_products p"""))
def j11(x):
    moves = stock_moves(x.m.orders, later_orders(x.m.orders), x.m.lines)
    return apply_moves(x.m.products, moves).select("product_id", "stock")


@query("j12_point_lookup", model_sql("""
SELECT line_id, state FROM m_lines LEFT JOIN m_orders USING (order_no)"""))
def j12(x):
    return x.m.lines.join(x.m.orders.select("order_no", "state"), "order_no", "left").select(
        "line_id", "state")


@query("j12_find_orders", model_sql("""
SELECT order_no, state, order_date FROM m_orders
WHERE order_no IN (SELECT min(user_id) FROM events UNION ALL SELECT max(user_id) FROM events)"""))
def j12_find(x):
    """Two orders out of all, stored by date with Bloom filters on their numbers."""
    first, last = x.table("events").agg(F.min("user_id"), F.max("user_id")).first()
    return find_orders(clustered_orders(x.spark, x.m), [first, last]).select(
        "order_no", "state", "order_date")


@query("j13_snowflake", model_sql("""
SELECT id, street, number, town, postcode, province, country
FROM t_addresses LEFT JOIN t_places USING (town_id)"""))
def j13(x):
    t = tax_model(x.spark, x.folder)
    return tax.with_place(t["addresses"], t["towns"], t["provinces"], t["countries"]).select(
        "id", "street", "number", "town", "postcode", "province", "country")


@query("g1_sum", model_sql("""
SELECT order_no, CAST(sum(quantity) AS BIGINT) AS quantity,
       CAST(sum(total) AS DECIMAL(20,2)) AS total FROM m_lines GROUP BY order_no"""))
def g1(x):
    return with_line_total(x.m.lines).groupBy("order_no").agg(
        F.sum("quantity").alias("quantity"), F.sum("total").alias("total"))


COUNTS = """
SELECT s.seller_id, count(o.order_id) AS order_count FROM m_sellers s
LEFT JOIN m_orders o USING (seller_id) GROUP BY s.seller_id"""


@query("g2_count_outer", model_sql(COUNTS))
def g2(x):
    counts = x.m.orders.groupBy("seller_id").agg(F.count("order_id").alias("n"))
    return x.m.sellers.join(counts, "seller_id", "left").select(
        "seller_id", F.coalesce("n", F.lit(0).cast("long")).alias("order_count"))


@query("g3_hidden_key", model_sql("""
SELECT p.description, CAST(sum(quantity) AS BIGINT) AS quantity
FROM m_lines JOIN m_products p USING (product_id) GROUP BY p.product_id, p.description"""))
def g3(x):
    sold = x.m.lines.groupBy("product_id").agg(F.sum("quantity").alias("quantity"))
    return sold.join(x.m.products, "product_id").select("description", "quantity")


@query("g4_having_sum", model_sql("""
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS quantity FROM m_lines GROUP BY product_id
HAVING sum(quantity) > 800"""))
def g4(x):
    return x.m.lines.groupBy("product_id").agg(F.sum("quantity").alias("quantity")).filter(
        "quantity > 800")


@query("g5_having_count", model_sql("""
SELECT customer_id FROM m_orders GROUP BY customer_id HAVING count(*) < 8"""))
def g5(x):
    return x.m.orders.groupBy("customer_id").agg(F.count("*").alias("n")).filter("n < 8").drop("n")


@query("g6_distinct_rows", model_sql("SELECT DISTINCT order_date, state FROM m_orders"))
def g6(x):
    return x.m.orders.select(F.to_date("order_date").alias("order_date"), "state") \
        .dropDuplicates()


@query("g7_names_per_supplier", model_sql("""
SELECT s.name, row_number() OVER (PARTITION BY p.supplier_id
         ORDER BY p.description, p.product_id) AS position, p.description
FROM m_products p JOIN m_suppliers s USING (supplier_id)"""))
def g7(x):
    return reports.names_per_supplier(x.m.suppliers, x.m.products)


@query("g7_names_per_order", model_sql("""
SELECT order_no, string_agg(description, ', ' ORDER BY line_no, line_id) AS products
FROM m_lines JOIN m_products USING (product_id) GROUP BY order_no"""))
def g7_orders(x):
    return reports.names_per_order(x.m.lines, x.m.products)


@query("t1_order_asc", model_sql("""
SELECT description, unit_price, product_id FROM m_products WHERE origin = 'importado'
ORDER BY description, product_id"""))
def t1(x):
    return x.m.products.filter("origin = 'importado'").select(
        "description", "unit_price", "product_id").orderBy("description", "product_id")


@query("t2_order_desc", model_sql("""
SELECT order_no, order_date FROM m_orders ORDER BY order_date DESC, order_no"""))
def t2(x):
    return x.m.orders.select("order_no", F.to_date("order_date").alias("order_date")).orderBy(
        F.desc("order_date"), "order_no")


TOP = """
SELECT s.name, CAST(sum(quantity) AS BIGINT) AS quantity
FROM m_suppliers s JOIN m_products p USING (supplier_id) JOIN m_lines l USING (product_id)
GROUP BY s.supplier_id, s.name ORDER BY quantity DESC, s.name, s.supplier_id LIMIT {n}"""


@query("t3_top_1", model_sql(TOP.format(n=1)))
def t3(x):
    return reports.top_supplier(x.m.suppliers, x.m.products, x.m.lines)


@query("t4_top_n_of_ordered", model_sql(TOP.format(n=10)))
def t4(x):
    return reports.top_supplier(x.m.suppliers, x.m.products, x.m.lines, n=10)


@query("t5_random_pick", model_sql("""
SELECT product_id, description FROM m_products ORDER BY md5(product_id || ':7'), product_id
LIMIT 5"""))
def t5(x):
    return random_pick(x.m.products, hex_text("product_id"), 7, 5).select(
        "product_id", "description")


def _pick(table: str, key: str, label: str, extra: str = "") -> str:
    more = f", {extra} AS {label}_{extra}" if extra else ""
    return (f"(SELECT {key} AS {label}_id{more} FROM {table} "
            f"ORDER BY md5({key} || ':7/{label}'), {key} LIMIT 1)")


PICKS = model_sql("SELECT * FROM " + ", ".join(
    [_pick("m_customers", "customer_id", "customer"), _pick("m_sellers", "seller_id", "seller")]
    + [_pick("(SELECT product_id, CAST(stock AS INTEGER) AS stock FROM m_products)", "product_id",
             f"product{i}", "stock") for i in (1, 2, 3)]))


@query("t6_picks_side_by_side", PICKS)
def t6(x):
    product = (x.m.products, "product_id", "stock")
    return pick_side_by_side({"customer": (x.m.customers, "customer_id", None),
                              "seller": (x.m.sellers, "seller_id", None),
                              "product1": product, "product2": product, "product3": product}, 7)


@query("j9_one_row_relations", model_sql("""
SELECT * FROM (SELECT count(*) AS customers FROM m_customers),
              (SELECT count(*) AS orders, max(order_date) AS last_date FROM m_orders),
              (SELECT CAST(sum(quantity) AS BIGINT) AS quantity FROM m_lines)"""))
def j9(x):
    sold = x.m.lines.agg(F.sum("quantity").alias("quantity"))
    return x.m.orders.agg(F.count("*").alias("orders"),
                          F.max(F.to_date("order_date")).alias("last_date")).select(
        x.m.customers.select(F.count("*")).scalar().alias("customers"), "orders", "last_date",
        sold.scalar().alias("quantity"))
