"""Requests are worked out once, also where the rejects are asked for."""

from __future__ import annotations

from orderdw.checks.derived import requests
from orderdw.operators import orders, running
from orderdw.operators.orders import register_orders
from orderdw.session import cut_and_measure, cut_lineage, stage_path
from orderdw.sources.testdata import order_model


def test_rejects_do_not_read_the_requests_again(spark):
    path = stage_path(spark, "asked")
    spark.sql("SELECT 1L AS request_no, 'x' AS customer_uuid, '' AS seller_uuid, 'zz' AS product1_uuid,"
              " 1 AS quantity1, '' AS product2_uuid, 1 AS quantity2, '' AS product3_uuid,"
              " 1 AS quantity3").write.parquet(path)
    none = spark.sql("SELECT X'01' AS customer_id, X'01' AS seller_id, X'01' AS product_id,"
                     " 'p' AS description, 1 AS stock, 2.00 AS unit_price")
    rejects = register_orders(spark.read.parquet(path), none, none, none).rejects
    assert [(r.request_no, r.rule) for r in rejects.collect()] == [(1, "customer_format")]
    assert not any("/asked-" in f for f in rejects.inputFiles())


def test_unknown_parents_are_told_as_they_were_given(spark):
    path = stage_path(spark, "asked")
    u = "0000000a-0000-0000-0000-00000000000{}".format
    rows = [(1, u(1).upper(), u(2)), (2, u(3), u(1).upper()), (3, u(2), u(2)), (4, u(3), u(2)),
            (5, u(1), u(9))]
    spark.createDataFrame([(*r, u(3), 1, None, None, " ", None) for r in rows],
                          "request_no long, customer_uuid string, seller_uuid string,"
                          " product1_uuid string, quantity1 int, product2_uuid string, quantity2 int,"
                          " product3_uuid string, quantity3 int").write.parquet(path)
    one = spark.sql("SELECT X'0000000a000000000000000000000003' AS customer_id,"
                    " X'0000000a000000000000000000000002' AS seller_id,"
                    " X'0000000a000000000000000000000003' AS product_id,"
                    " 'p' AS description, 1 AS stock, 2.00 AS unit_price")
    got = register_orders(spark.read.parquet(path), one.union(one), one, one)
    assert sorted(map(tuple, got.rejects.collect())) == [
        (1, "unknown_customer", "no parent for " + u(1).upper()),
        (2, "unknown_seller", "no parent for " + u(1).upper()),
        (3, "unknown_customer", "no parent for " + u(2)),
        (5, "unknown_customer", "no parent for " + u(1))]
    assert [tuple(r) for r in got.lines.select("order_no", "line_no", "quantity").collect()] == [
        (1, 1, 1)]


def test_requests_are_moved_neither_for_their_products_nor_for_known_parents(spark, monkeypatch):
    """Lines are numbered and put together where their order's rows are, and stored keys are narrow."""
    kept = {}

    def keep(df, label="stage"):
        kept.setdefault(label, []).append(df._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(df, label)

    monkeypatch.setattr(orders, "cut_lineage", keep)
    monkeypatch.setattr(running, "cut_lineage", keep)
    monkeypatch.setattr(running, "cut_and_measure", lambda df, label, **m: (
        kept.setdefault(label, []).append(df._jdf.queryExecution().executedPlan().toString())
        or cut_and_measure(df, label, **m)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = order_model(spark, "/root/testdata/sf0.001")
        got = register_orders(requests(m), m.customers, m.sellers, m.products).rejects
        assert got.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "within" not in kept and "requests" not in kept
    # One exchange of the lines, one of the orders.
    assert kept["numbers"][0].count("Exchange hashpartitioning") == 2
    assert "SortAggregate" not in kept["numbers"][0]
