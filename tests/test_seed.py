"""The worked-out answers on the seed data."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from orderdw.operators.allocation import allocate, explain_rejects
from orderdw.operators.orders import cancel_orders, order_list, register_orders
from orderdw.operators.pricing import price_change_report, price_listing, reprice
from orderdw.operators.quality import (BrokenRule, check_fk, check_model, check_not_null,
                                       check_stock_bounds, check_unique, check_uuid,
                                       check_values, delete_with_children, enforce)
from orderdw.operators.stock import (apply_moves, cancel_audit, cancel_log, stamp_price,
                                     stock_moves, with_line_total)
from orderdw.plans import reports
from orderdw.schemas import Keys
from seed import ORDERS, key, number, seed, uuid_text

AFTER = {1: 1368, 2: 12465, 3: 980, 4: 818, 5: 1752, 6: 33, 7: 175, 8: 1, 9: 856, 10: 838}


@pytest.fixture(scope="module")
def m(spark):
    return seed(spark)


def stocks(products):
    return {number(r.product_id): r.stock for r in products.collect()}


@pytest.fixture(scope="module")
def sold(m):
    """Products after the seed orders, as a table of their own."""
    return apply_moves(m.products, stock_moves(m.orders.limit(0), m.orders, m.lines))


def test_customers_between(m):
    got = reports.customers_between(m.customers, m.orders, "2025-04-01", "2025-04-30")
    assert {r.surname for r in got.collect()} == {"C1", "C2", "C4"}


def test_last_day_counts_whole(m):
    late = m.orders.withColumn("order_date", F.to_timestamp(F.lit("2025-04-30 18:00:00")))
    got = reports.customers_between(m.customers, late, "2025-04-01", "2025-04-30")
    assert got.count() == 5


def test_orders_per_seller(m):
    got = reports.orders_per_seller(m.sellers, m.orders).collect()
    assert {r.surname: r.order_count for r in got} == {"V1": 2, "V2": 5, "V3": 3}


def test_orders_over(m):
    got = reports.orders_over(m.orders, m.lines, D("500000")).collect()
    assert {r.order_no: r.order_total for r in got} == {
        1: D("2132000.50"), 6: D("958812.00"), 7: D("2628668.80"), 8: D("1306984.50"),
        9: D("8701542.00"), 10: D("660370.00")}
    assert reports.orders_over(m.orders, m.lines, D("0")).count() == 10


def test_product_sales_between(m):
    got = reports.product_sales_between(m.orders, m.lines, m.products, "2025-04-01", "2025-04-30")
    assert {r.description: r.quantity for r in got.collect()} == {
        "product 1": 9, "product 2": 458, "product 4": 12, "product 10": 14}


def test_product_sales_ignoring_case_and_accents(spark, m):
    mixed = m.products.withColumn("description", F.when(F.col("product_id") == F.lit(key(1)),
                                                        "Córdoba").otherwise("cordoba"))
    got = reports.product_sales_between(m.orders, m.lines, mixed, "2025-04-01", "2025-04-30",
                                        loose=True).collect()
    assert [r.quantity for r in got] == [493]


def test_top_supplier(m):
    got = reports.top_supplier(m.suppliers, m.products, m.lines, n=3).collect()
    assert [tuple(r) for r in got] == [("S2", 995), ("S1", 932), ("S3", 210)]


def test_customers_without_orders_and_below(spark, m):
    assert reports.customers_without_orders(m.customers, m.orders).count() == 0
    assert [r.surname for r in reports.customers_below(m.customers, m.orders).collect()] == ["C5"]
    six = seed(spark, customers=6)
    assert [r.surname for r in reports.customers_without_orders(six.customers, six.orders)
            .collect()] == ["C6"]
    assert {r.surname for r in reports.customers_below(six.customers, six.orders).collect()} == {
        "C5", "C6"}


def test_sales_by_origin(m):
    got = reports.sales_by_origin(m.products, m.lines).collect()
    assert {r.origin: r.quantity for r in got} == {"nacional": 1721, "importado": 416}


def test_names(m):
    rows = reports.names_per_supplier(m.suppliers, m.products).collect()
    assert sorted((r.position, r.description) for r in rows if r["name"] == "S3") == [
        (1, "product 1"), (2, "product 5")]
    texts = {r.order_no: r.products for r in reports.names_per_order(m.lines, m.products).collect()}
    assert texts[1] == "product 1, product 2, product 3" and len(texts) == 10


def test_stock_after_seed(sold):
    assert stocks(sold) == AFTER


def test_allocate_seed_accepts_all(m):
    got = allocate(m.lines, m.orders, m.products)
    assert got.accepted.count() == 10 and got.rejected.count() == 0
    taken = got.taken.select("product_id", (-F.col("quantity")).alias("delta"))
    assert stocks(apply_moves(m.products, taken)) == AFTER


def test_allocate_boundary(spark):
    orders = [o if o[0] != 10 else (*o[:5], [(5, 15), (3, 22), (8, 212)]) for o in ORDERS]
    m = seed(spark, orders)
    got = allocate(m.lines, m.orders, m.products)
    assert [r.order_no for r in got.rejected.collect()] == [10]
    taken = got.taken.select("product_id", (-F.col("quantity")).alias("delta"))
    left = stocks(apply_moves(m.products, taken))
    assert (left[5], left[3], left[8]) == (1767, 1002, 211)
    why = explain_rejects(got, m.lines, m.products).collect()
    assert [r.message for r in why] == ["Stock insuficiente para el producto product 8. "
                                        "Stock disponible: 211. Cantidad requerida: 212"]


def test_stamp_price_and_total(m):
    bare = m.lines.drop("unit_price")
    totals = with_line_total(stamp_price(bare, m.products)).agg(F.sum("total")).first()[0]
    assert totals == D("17256220.16")


def cancelled(m, sold, *numbers):
    asked = m.orders.sparkSession.createDataFrame([(n,) for n in numbers], "order_no long")
    return cancel_orders(asked, m.orders, m.lines, sold, as_of="2025-05-01 10:00:00")


def test_cancel_confirmed(m, sold):
    got = cancelled(m, sold, 2)
    assert stocks(got.products) == {**AFTER, 5: 1788}  # once, not twice
    assert got.audit.count() == 1 and got.log.count() == 1 and got.rejects.count() == 0
    assert got.audit.first().note == "Pedido 2 anulado."
    assert {r.order_no: r.state for r in got.orders.collect()}[2] == "anulado"
    assert cancel_audit(m.orders, got.orders, "2025-05-01 10:00:00").collect() == \
        got.audit.collect()
    assert cancel_log(m.orders, got.orders, "2025-05-01 10:00:00").collect() == got.log.collect()


def test_cancel_several_products(m, sold):
    assert stocks(cancelled(m, sold, 7).products) == {**AFTER, 7: 213, 4: 870, 1: 1460}


def test_cancel_rejects(m, sold):
    got = cancelled(m, sold, 6, 999, 2, 2)
    told = {r.order_no: (r.calls, r.message) for r in got.rejects.collect()}
    assert told[6][1].startswith('No se puede anular el pedido 6 porque su estado actual es '
                                 '"pendiente"')
    assert told[999] == (1, "Pedido no encontrado: 999")
    assert told[2][0] == 1 and '"anulado"' in told[2][1]
    assert stocks(got.products) == {**AFTER, 5: 1788}


def test_cancel_log_from_any_state(m):
    new = m.orders.withColumn("state", F.when(F.col("order_no").isin(2, 6), "anulado")
                              .otherwise(F.col("state")))
    assert {r.order_no for r in cancel_log(m.orders, new).collect()} == {2, 6}
    assert cancel_audit(m.orders, new).count() == 1


def test_reprice(m):
    down = {number(r.product_id): r.unit_price
            for r in reprice(m.products, "nacional", -15).collect()}
    assert {k: down[k] for k in (1, 2, 3, 4, 6, 7, 9)} == {
        1: D("17735.25"), 2: D("16149.15"), 3: D("1264.38"), 4: D("10199.49"), 6: D("1401.63"),
        7: D("1904.00"), 9: D("8329.15")}
    up = reprice(m.products, "importado", 13)
    report = price_change_report(m.products, up, "importado").collect()
    assert [tuple(r) for r in report] == [
        ("product 10", D("7900.00"), D("8927.00")), ("product 5", D("6017.00"), D("6799.21")),
        ("product 8", D("2559.00"), D("2891.67"))]
    assert price_listing(m.products, "importado", "before").first().description == "before"


def test_quality_on_seed(m):
    assert check_stock_bounds(m.products).count() == 0
    assert check_unique(m.lines, ["order_no", "line_no"]).count() == 0
    assert check_fk(m.lines, m.products, ["product_id"]).count() == 0
    assert check_values(m.orders, "state", ["confirmado"], ["order_no"]).count() == 3
    low = m.products.withColumn("stock", F.lit(1))
    assert check_stock_bounds(low).filter(F.col("message").contains("entre 500 y 5000")).count()
    gaps = m.orders.withColumn("state", F.lit(None).cast("string"))
    assert check_not_null(gaps, ["state", "order_no"], ["order_no"]).first().message == \
        "NULL in state"
    with pytest.raises(BrokenRule):
        enforce(check_fk(m.lines, m.products.limit(0), ["product_id"]))
    texts = m.orders.select("order_no", F.lit("not-a-uuid").alias("u"))
    assert check_uuid(texts, "u", ["order_no"]).count() == 10


def test_delete_rules(m):
    doomed = m.orders.filter("order_no IN (1, 2)")
    gone = delete_with_children(m.orders, m.lines, doomed, "order_no", "order_no", "cascade")
    assert gone.parent.count() == 8 and gone.child.count() == 17
    kept = delete_with_children(m.customers, m.orders, m.customers, "customer_id", "customer_id")
    assert kept.parent.count() == 5 and kept.blocked.count() == 5


def test_order_list(m):
    rows = order_list(m.orders).collect()
    assert [r.order_no for r in rows] == list(range(1, 11))
    assert rows[1].seller_uuid == uuid_text(2)


REQUEST = ("request_no long, customer_uuid string, seller_uuid string, product1_uuid string, "
           "quantity1 int, product2_uuid string, quantity2 int, product3_uuid string, "
           "quantity3 int")


def test_register(spark, m, sold):
    u = uuid_text
    rows = [
        (1, u(1), u(2), u(8), 1, "  ", None, None, None),           # takes the last of product 8
        (2, u(1), u(2), u(6), 3, u(8), 1, None, None),              # product 8 is used up
        (3, u(2).upper(), u(1), u(6), 30, u(6), 3, "", None),       # same product twice: 33 of 33
        (4, "x", u(1), u(1), 1, None, None, None, None),
        (5, u(1), u(77), u(1), 1, None, None, None, None),
        (6, u(1), u(1), u(55), 1, None, None, None, None),
        (7, u(1), u(1), u(1), 1, u(2), None, None, None),
        (8, u(1), u(1), u(6), 1, None, None, None, None),           # nothing left of product 6
        (9, u(1), u(1), u(1), 1, None, None, u(2), 1)]              # second line left out
    got = register_orders(spark.createDataFrame(rows, REQUEST), m.customers, m.sellers, sold, 10,
                          "2025-05-01 10:00:00")
    assert {(r.request_no, r.order_no) for r in got.orders.collect()} == {(1, 11), (3, 12)}
    assert {(r.order_no, r.line_no, number(r.product_id), r.quantity, r.unit_price)
            for r in got.lines.collect()} == {
        (11, 1, 8, 1, D("2559.00")), (12, 1, 6, 30, D("1648.98")), (12, 2, 6, 3, D("1648.98"))}
    assert stocks(got.products) == {**AFTER, 8: 0, 6: 0}
    told = {r.request_no: (r.rule, r.message) for r in got.rejects.collect()}
    assert {k: v[0] for k, v in told.items()} == {
        2: "short_stock", 4: "customer_format", 5: "unknown_seller", 6: "unknown_product",
        7: "quantity2_missing", 8: "short_stock", 9: "product2_missing"}
    assert told[6][1] == "Producto inexistente: " + u(55)
    # Confirming what was registered moves nothing more.
    confirmed = got.orders.withColumn("state", F.lit("confirmado"))
    assert stock_moves(got.orders, confirmed, got.lines).count() == 0


def test_declared_keys(spark, m):
    tables = {"customers": m.customers, "suppliers": m.suppliers, "sellers": m.sellers,
              "products": m.products, "orders": m.orders, "lines": m.lines}
    assert check_model(tables).count() == 0
    tables["lines"] = m.lines.unionByName(m.lines.filter("order_no = 2"))
    tables["sellers"] = m.sellers.filter(F.col("seller_id") != F.lit(bytes(key(1))))
    tables["orders"] = m.orders.withColumn("state", F.when(F.col("order_no") != 3, F.col("state")))
    found = {(r.table_name, r.columns, r.rule) for r in check_model(tables).collect()}
    assert ("lines", "line_id", "unique") in found
    assert ("lines", "order_no, line_no", "unique") in found
    assert ("orders", "seller_id", "foreign_key") in found
    assert any(t == "orders" and rule == "not_null" for t, _, rule in found)


def test_compound_foreign_key(spark):
    keys = {"parent": Keys(("a", "b")), "child": Keys((), (), ((("a", "b"), "parent", ("a", "b")),))}
    layout = "a int, b int"
    parent = spark.createDataFrame([(1, 1), (1, 2)], layout)
    child = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (None, 1)], layout)
    got = check_model({"parent": parent, "child": child}, keys,
                      {"parent": parent.schema, "child": child.schema}).collect()
    assert [(r.table_name, r.key, r.rows) for r in got] == [("child", "2|1", 2)]
