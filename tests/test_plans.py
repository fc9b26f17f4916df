"""Warehouse, property tax and the state-change stream."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from orderdw.operators.stock import apply_moves
from orderdw.plans import property_tax as tax
from orderdw.plans.warehouse import run_etl
from orderdw.schemas import PROPERTY_TAX
from orderdw.session import stage_path
from orderdw.sources.tables import load, register_views, with_defaults, write_table
from orderdw.streaming.state_changes import (CHANGE, read_audit, read_changes, read_ledger,
                                             read_log, stock_now, stream_state_changes)
from seed import key, number, seed


def store(m, folder):
    for name in ["customers", "suppliers", "sellers", "products", "orders", "lines"]:
        write_table(getattr(m, name), f"{folder}/{name}")
    return folder


def test_etl_twice(spark):
    source = store(seed(spark), stage_path(spark, "oltp"))
    target = stage_path(spark, "dw")
    first = {k: sorted(df.collect()) for k, df in run_etl(spark, source, target).items()}
    assert {k: len(v) for k, v in first.items()} == {
        "dim_dates": 10, "dim_customers": 5, "dim_products": 10, "fact_orders": 21}
    again = {k: sorted(df.collect()) for k, df in run_etl(spark, source, target).items()}
    assert first == again
    total = load(spark, target, "fact_orders").agg(F.sum("quantity"), F.sum("total")).first()
    assert tuple(total) == (2137, D("17256220.16"))


def test_fact_drops_orphans_and_times_of_day(spark):
    from orderdw.plans.warehouse import dim_customers, dim_dates, dim_products, fact_orders
    m = seed(spark)
    timed = m.orders.withColumn("order_date", F.to_timestamp(F.concat(
        F.col("order_date").cast("string"), F.lit(" 13:45:00"))))
    dates = dim_dates(timed)
    assert dates.count() == 10
    facts = fact_orders(m.lines, timed, dates, dim_customers(m.customers),
                        dim_products(m.products.filter("stock > 300"), m.suppliers))
    assert facts.count() == 20  # product 7 has 213


def test_views_defaults_append(spark):
    folder = store(seed(spark), stage_path(spark, "oltp"))
    register_views(spark, folder, ["orders", "lines"])
    assert spark.sql("SELECT count(*) FROM lines JOIN orders USING (order_no)").first()[0] == 21
    bare = spark.createDataFrame([(1, None), (2, "anulado")], "order_no int, state string")
    got = with_defaults(bare, {"state": "pendiente", "note": "-"}).collect()
    assert [tuple(r) for r in got] == [(1, "pendiente", "-"), (2, "anulado", "-")]
    write_table(bare, f"{folder}/log")
    write_table(bare, f"{folder}/log", mode="append")
    assert spark.read.parquet(f"{folder}/log").count() == 4


@pytest.fixture(scope="module")
def town_model(spark):
    def table(name, rows):
        return spark.createDataFrame(rows, PROPERTY_TAX[name])

    provinces = [(key(i), n, key(1)) for i, n in enumerate(["Córdoba", "Santa Fe"], 1)]
    return {
        "owners": table("owners", [(key(i), f"O{i}", f"n{i}") for i in range(1, 5)]),
        "countries": table("countries", [(key(1), "Argentina")]),
        "provinces": table("provinces", provinces),
        "towns": table("towns", [(key(10 * p + i), f"town {p}{i}", f"{p}00{i}", key(p))
                                 for p in (1, 2) for i in range(4)]),
        "zones": table("zones", [(key(i), n) for i, n in
                                 enumerate(["Este", "Oeste", "Norte", "Sur"])]),
        "types": table("property_types", [(key(i), n) for i, n in enumerate(["casa", "lote"])]),
        "kinds": table("address_kinds", [(key(1), "particular"), (key(2), "de cobro")]),
        "addresses": table("addresses", [(key(i), f"street {i}", i, None, None, None)
                                         for i in range(1, 13)]),
        "links": table("owner_addresses", [(key(i), key(i), key(1)) for i in range(1, 5)]
                       + [(key(i), key(i + 4), key(2)) for i in (3, 4)]),
        "properties": table("properties", [(f"CAT{i}", key(1 + i % 4), key(6 + i), None, None)
                                           for i in range(6)])}


def test_instalments_and_report(town_model):
    t = town_model
    named = t["addresses"].withColumn("province", F.when(F.col("number") % 2 == 0, "Córdoba")
                                      .otherwise("Santa Fe"))
    placed = tax.assign_town(named, t["towns"], t["provinces"], seed=3)
    for r in placed.collect():
        assert number(r.town_id) // 10 == (1 if r.number % 2 == 0 else 2)
    asked = t["properties"].drop("zone_id", "type_id").withColumn(
        "zone", F.when(F.col("cadastral_no") == "CAT0", "Norte"))
    zoned = tax.assign_dim(asked, t["zones"], 1, "zone_id", F.col("cadastral_no"), fixed="zone")
    typed = tax.assign_dim(zoned, t["types"], 2, "type_id", F.col("cadastral_no"))
    rows = {r.cadastral_no: r for r in typed.collect()}
    assert number(rows["CAT0"].zone_id) == 2 and all(r.type_id and r.zone_id for r in rows.values())

    due = tax.generate_instalments(typed, 2025, "1000.00")
    assert due.count() == 72 and due.filter("paid OR dayofmonth(due_date) <> 15").count() == 0
    assert due.select("due_date").distinct().count() == 12
    last_year = tax.generate_instalments(typed, 2024, "900.00")
    report = tax.instalment_report(t["owners"], typed.drop("zone"), due.unionByName(last_year),
                                   placed.drop("province"), t["towns"], t["provinces"],
                                   t["countries"], t["zones"], t["types"], 2025)
    got = report.collect()
    assert len(got) == 72 and {r.value for r in got} == {D("1000.00")}
    assert all(r.country == "Argentina" and r.surnames and r.zone for r in got)


def test_addresses_by_kind(town_model):
    t = town_model
    by_kind = tax.addresses_by_kind(t["owners"], t["links"], t["addresses"], t["kinds"])
    assert by_kind.count() == 6
    wide = tax.addresses_side_by_side(by_kind, {"home": "particular", "billing": "de cobro"})
    got = {(r.surnames, r.position): (r.home, r.billing) for r in wide.collect()}
    assert got["O1", 1] == ("street 1 1", None) and got["O3", 1] == ("street 3 3", "street 7 7")
    home = by_kind.filter("surnames = 'O1'").withColumn("street", F.lit("second")).withColumn(
        "address_id", F.unhex(F.lit("ff")))
    wide = tax.addresses_side_by_side(by_kind.unionByName(home), {"home": "particular"})
    assert {(r.position, r.home) for r in wide.filter("surnames = 'O1'").collect()} == {
        (1, "second 1"), (2, "street 1 1")}


def change(event, hour, no, old, new):
    return (event, datetime(2025, 5, 1, hour), no, bytearray(key(no)), old, new)


def test_stream(spark):
    m = seed(spark)
    source, target = stage_path(spark, "changes"), stage_path(spark, "stream")
    c, p, a = "confirmado", "pendiente", "anulado"
    spark.createDataFrame([change(1, 9, 3, p, c), change(2, 10, 2, c, a), change(3, 11, 6, p, a),
                           change(2, 10, 2, c, a)], CHANGE).coalesce(1).write.parquet(source)
    stream_state_changes(read_changes(spark, source), m.lines, target).awaitTermination()
    # A second delivery: one repeat, order 3 cancelled again, and a change that is days late.
    late = (5, datetime(2025, 4, 1, 8), 9, bytearray(key(9)), p, c)
    spark.createDataFrame([change(1, 9, 3, p, c), change(4, 12, 3, c, a), late], CHANGE) \
        .coalesce(1).write.mode("append").parquet(source)
    stream_state_changes(read_changes(spark, source), m.lines, target).awaitTermination()

    start = {number(r.product_id): r.stock for r in m.products.collect()}
    ledger = read_ledger(spark, target)
    got = {number(r.product_id): r.stock for r in stock_now(m.products, ledger).collect()}
    # 3 is confirmed and cancelled, 2 cancelled, 9 confirmed, 6 never took stock.
    assert got == {**start, 5: start[5] + 36, 2: start[2] - 458}
    audit, log = read_audit(spark, target), read_log(spark, target)
    assert sorted(r.note for r in audit.collect()) == ["Pedido 2 anulado.", "Pedido 3 anulado."]
    assert sorted(r.order_no for r in log.collect()) == [2, 3, 6]
    moved = {(r.order_no, number(r.product_id)): r.delta for r in ledger.filter("order_no = 3")
             .groupBy("order_no", "product_id").agg(F.sum("delta").alias("delta")).collect()}
    assert set(moved.values()) == {0}
    assert apply_moves(m.products, ledger).count() == 10
