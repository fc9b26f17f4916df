"""Scalar functions over whole tables (inventory H)."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from orderdw.checks.oracle import draw, model_sql, uuid
from orderdw.checks.registry import query
from orderdw.functions import ids, scalars
from orderdw.functions.scalars import SHORT_STOCK
from orderdw.operators import sampling

TEXT = f"SELECT order_no, order_id, upper({uuid('order_id')}) AS t FROM m_orders"


@query("h1_uuid_to_bin", model_sql(f"""
SELECT order_no, lower(substr(t, 1, 8) || substr(t, 10, 4) || substr(t, 15, 4)
                       || substr(t, 20, 4) || substr(t, 25, 12)) AS id FROM ({TEXT})"""))
def h1(x):
    text = F.upper(ids.bin_to_uuid("order_id"))
    return x.m.orders.select("order_no", ids.uuid_to_bin(text).alias("id"))


@query("h2_uuid_to_bin_dashless", model_sql(
    f"SELECT order_no, lower(replace(t, '-', '')) AS id FROM ({TEXT})"))
def h2(x):
    text = F.upper(ids.bin_to_uuid("order_id"))
    return x.m.orders.select("order_no", ids.uuid_to_bin_dashless(text).alias("id"))


@query("h3_bin_to_uuid", model_sql(f"SELECT line_id, {uuid('line_id')} AS u FROM m_lines"))
def h3(x):
    return x.m.lines.select("line_id", ids.bin_to_uuid("line_id").alias("u"))


@query("h4_stable_key", model_sql(
    "SELECT order_no, md5('order|' || order_no) AS new_id FROM m_orders"))
def h4(x):
    return x.m.orders.select("order_no", ids.stable_key(F.lit("order"), "order_no")
                             .alias("new_id"))


@query("h5_hex", "SELECT c_custkey, c_name, hex(c_name) AS h FROM customer")
def h5(x):
    h = F.hex(F.col("c_name"))
    return x.table("customer").select("c_custkey", F.decode(F.unhex(h), "UTF-8").alias("c_name"),
                                      h.alias("h"))


@query("h6_concat", model_sql("""
SELECT customer_id, surname || nullif(names, 'MACHINERY') AS strict,
       concat(surname, nullif(names, 'MACHINERY')) AS lenient FROM m_customers"""))
def h6(x):
    names = F.nullif("names", F.lit("MACHINERY"))
    return x.m.customers.select(
        "customer_id", F.concat("surname", names).alias("strict"),
        scalars.concat_skip_null(F.col("surname"), names).alias("lenient"))


@query("h7_substring", model_sql(
    "SELECT customer_id, substr(surname, 10, 4) AS part FROM m_customers"))
def h7(x):
    return x.m.customers.select("customer_id", F.substring("surname", 10, 4).alias("part"))


@query("h8_lower", model_sql("SELECT customer_id, lower(names) AS names FROM m_customers"))
def h8(x):
    return x.m.customers.select("customer_id", F.lower("names").alias("names"))


@query("h9_replace", model_sql(
    "SELECT customer_id, replace(surname, '#', '-') AS surname FROM m_customers"))
def h9(x):
    return x.m.customers.select("customer_id", F.replace("surname", F.lit("#"), F.lit("-"))
                                .alias("surname"))


@query("h10_left_pad", model_sql(
    "SELECT order_no, lpad(CAST(month(order_date) AS VARCHAR), 2, '0') AS mm FROM m_orders"))
def h10(x):
    return x.m.orders.select("order_no", scalars.zero_pad(F.month("order_date"), 2).alias("mm"))


@query("h11_not_blank", model_sql("""
SELECT order_no, state = 'confirmado' AS given FROM m_orders"""))
def h11(x):
    text = F.when(F.col("state") == "anulado", "   ").when(F.col("state") == "confirmado", " x ")
    return x.m.orders.select("order_no", scalars.is_not_blank(text).alias("given"))


@query("h12_date_parts", model_sql("""
SELECT order_no, CAST(day(order_date) AS INTEGER) AS d, CAST(month(order_date) AS INTEGER) AS m,
       CAST(year(order_date) AS INTEGER) AS y FROM m_orders"""))
def h12(x):
    day = F.col("order_date")
    return x.m.orders.select("order_no", F.dayofmonth(day).alias("d"), F.month(day).alias("m"),
                             F.year(day).alias("y"))


@query("h13_now_as_argument", model_sql("""
SELECT order_no, date_diff('day', order_date, DATE '2025-05-01') AS age FROM m_orders"""))
def h13(x):
    now = F.lit(datetime.date(2025, 5, 1))
    return x.m.orders.select("order_no", F.date_diff(now, F.to_date("order_date"))
                             .cast("long").alias("age"))


@query("h14_build_date", model_sql("""
SELECT order_no, make_date(year(order_date), month(order_date), 15) AS due FROM m_orders"""))
def h14(x):
    day = F.col("order_date")
    return x.m.orders.select("order_no", scalars.due_date(F.year(day), F.month(day)).alias("due"))


@query("h15_date_literal", model_sql(
    "SELECT order_no, order_date > DATE '1998-07-31' AS late FROM m_orders"))
def h15(x):
    return x.m.orders.select("order_no", (F.to_date("order_date")
                                          > F.lit(datetime.date(1998, 7, 31))).alias("late"))


@query("h16_round_money", model_sql("""
SELECT product_id, CAST(round(unit_price * 0.855, 2) AS DECIMAL(10,2)) AS price
FROM m_products"""))
def h16(x):
    return x.m.products.select("product_id", scalars.as_money(
        F.col("unit_price") * scalars.percent_factor("-14.5")).alias("price"))


@query("h17_is_uuid", model_sql(f"""
SELECT order_no, regexp_full_match(substr(t, 1, 36 - CAST(state = 'anulado' AS INTEGER)),
  '[0-9A-Fa-f]{{8}}(-[0-9A-Fa-f]{{4}}){{3}}-[0-9A-Fa-f]{{12}}') AS ok
FROM ({TEXT}) JOIN m_orders USING (order_no)"""))
def h17(x):
    text = ids.bin_to_uuid("order_id")
    cut = F.when(F.col("state") == "anulado", F.substring(text, 1, 35)).otherwise(text)
    return x.m.orders.select("order_no", ids.is_uuid(cut).alias("ok"))


@query("h18_arithmetic", model_sql("""
SELECT line_id, CAST(unit_price * quantity - unit_price + 1 AS DECIMAL(24,2)) AS v
FROM m_lines"""))
def h18(x):
    price = F.col("unit_price")
    return x.m.lines.select("line_id", (price * F.col("quantity") - price + 1)
                            .cast("decimal(24,2)").alias("v"))


@query("h19_three_valued_logic", model_sql("""
SELECT order_no, NOT (s <> 'confirmado' OR order_no < 100) AS a, s = 'anulado' AND order_no > 5 AS b
FROM (SELECT order_no, nullif(state, 'pendiente') AS s FROM m_orders)"""))
def h19(x):
    s, n = F.nullif("state", F.lit("pendiente")), F.col("order_no")
    return x.m.orders.select("order_no", (~((s != "confirmado") | (n < 100))).alias("a"),
                             ((s == "anulado") & (n > 5)).alias("b"))


@query("h20_random_number", model_sql(
    f"SELECT product_id, {draw('product_id', '7')} % 1000 AS r FROM m_products"))
def h20(x):
    return x.m.products.select("product_id", sampling.draw_below(
        F.lit(1000), 7, ids.hex_text("product_id")).alias("r"))


@query("h21_casts_from_text", model_sql("""
SELECT customer_id, TRY_CAST(dni AS INTEGER) AS n, TRY_CAST(names AS INTEGER) AS none
FROM m_customers"""))
def h21(x):
    return x.m.customers.select("customer_id", scalars.safe_int(F.col("dni")).alias("n"),
                                scalars.safe_int(F.col("names")).alias("none"))


@query("h22_loose_equality", model_sql("""
SELECT lower(names) AS name, count(*) AS n FROM m_customers GROUP BY lower(names)"""))
def h22(x):
    mixed = x.m.customers.select(F.when(F.length("email") % 2 == 0, F.upper("names")).otherwise(
        F.initcap("names")).alias("name"))
    return mixed.groupBy(scalars.loose_text(F.col("name")).alias("g")).agg(
        F.count("*").alias("n")).select(
        F.lower(F.collate("g", "UTF8_BINARY")).alias("name"), "n")


@query("h23_message", model_sql("""
SELECT product_id, 'Stock insuficiente para el producto ' || description
       || '. Stock disponible: ' || stock || '. Cantidad requerida: ' || (stock + 1) AS message
FROM m_products"""))
def h23(x):
    return x.m.products.select("product_id", scalars.message(
        SHORT_STOCK, "description", "stock", F.col("stock") + 1).alias("message"))
