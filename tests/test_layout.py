"""Skewed data and the storage layouts that spare large tables a full read or shuffle."""

import random
from collections import Counter, defaultdict
from datetime import date, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from orderdw.operators.orders import cancel_orders
from orderdw.operators.stock import apply_moves, stock_moves
from orderdw.plans import reports, warehouse
from orderdw.schemas import ORDERS_MODEL
from orderdw.session import stage_path
from orderdw.sources.tables import by_order_range, write_bucketed, write_table
from seed import key, number, seed


@pytest.fixture(scope="module")
def skewed(spark):
    """300 orders; one product, customer, seller and order each hold a third or more."""
    rng = random.Random(11)
    m = seed(spark)

    def hot(hi):
        return 1 if rng.random() < 0.4 else rng.randint(1, hi)

    orders = [(key(n), n, key(hot(5)), key(hot(3)), date(2025, 1, 1) + timedelta(n // 3),
               rng.choice(["confirmado", "pendiente", "anulado"])) for n in range(1, 301)]
    lines, numbers = [], Counter()
    for i in range(1500):
        no = 7 if rng.random() < 0.34 else rng.randint(1, 300)
        numbers[no] += 1
        lines.append((key(i), no, numbers[no], key(hot(10)), rng.randint(1, 9), D("10.00")))
    return {"m": m, "raw_orders": orders, "raw_lines": lines,
            "orders": spark.createDataFrame(orders, ORDERS_MODEL["orders"]),
            "lines": spark.createDataFrame(lines, ORDERS_MODEL["lines"])}


def test_reports_on_skewed_data(spark, skewed):
    s, m = skewed, skewed["m"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        per_order = Counter()
        per_product = Counter()
        for _, no, _, p, q, price in s["raw_lines"]:
            per_order[no] += q * price
            per_product[number(p)] += q
        got = {r.order_no: r.order_total
               for r in reports.orders_over(s["orders"], s["lines"], D("100")).collect()}
        assert got == {no: t for no, t in per_order.items() if t > 100}
        per_seller = Counter(number(o[3]) for o in s["raw_orders"])
        got = reports.orders_per_seller(m.sellers, s["orders"]).collect()
        assert {int(r.surname[1:]): r.order_count for r in got} == per_seller
        origin = {number(r.product_id): r.origin for r in m.products.collect()}
        want = defaultdict(int)
        for p, q in per_product.items():
            want[origin[p]] += q
        got = reports.sales_by_origin(m.products, s["lines"]).collect()
        assert {r.origin: r.quantity for r in got} == dict(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_order_ranges_are_pruned(spark, skewed):
    s, m = skewed, skewed["m"]
    folder = stage_path(spark, "ranges")
    for name in ("orders", "lines"):
        write_table(by_order_range(s[name], 50), f"{folder}/{name}", partition_by=["order_range"])
    orders, lines = (spark.read.parquet(f"{folder}/{n}") for n in ("orders", "lines"))
    args = (m.products, "2025-02-01", "2025-02-07")
    ranged = reports.product_sales_between(orders, lines, *args)
    plain = reports.product_sales_between(s["orders"], s["lines"], *args)
    assert sorted(ranged.collect()) == sorted(plain.collect())
    assert "dynamicpruning" in ranged._jdf.queryExecution().toString()

    asked = spark.createDataFrame([(7,), (8,)], "order_no long")
    got = cancel_orders(asked, orders, lines, m.products, "2025-05-01 10:00:00")
    want = cancel_orders(asked, s["orders"], s["lines"], m.products, "2025-05-01 10:00:00")
    assert sorted(got.products.collect()) == sorted(want.products.collect())
    later = orders.withColumn("state", F.lit("confirmado"))
    moved = apply_moves(m.products, stock_moves(orders, later, lines))
    same = apply_moves(m.products, stock_moves(
        s["orders"], s["orders"].withColumn("state", F.lit("confirmado")), s["lines"]))
    assert sorted(moved.collect()) == sorted(same.collect())


def test_bucketed_tables_join_unshuffled(spark, skewed):
    s = skewed
    folder = stage_path(spark, "buckets")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("orders", "lines"):
            write_bucketed(s[name], f"bucketed_{name}", f"{folder}/{name}", "order_no", 4)
        orders, lines = spark.table("bucketed_orders"), spark.table("bucketed_lines")
        totals = reports.orders_over(orders, lines, D("100"))
        assert "Exchange" not in totals._jdf.queryExecution().executedPlan().toString()
        assert sorted(totals.collect()) == sorted(
            reports.orders_over(s["orders"], s["lines"], D("100")).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("orders", "lines"):
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")


def test_warehouse_load_in_buckets(spark, skewed, monkeypatch):
    """Bucketed lines are not shuffled for their orders, and a hot product is split."""
    s, m = skewed, skewed["m"]
    folder = stage_path(spark, "bucketed")
    names = {n: f"warehouse_{n}" for n in ("orders", "lines")}
    for n, name in names.items():
        write_bucketed(s[n], name, f"{folder}/{n}", "order_no", 4)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        dims = (warehouse.dim_dates(s["orders"]), warehouse.dim_customers(m.customers),
                warehouse.dim_products(m.products, m.suppliers))
        facts = warehouse.fact_orders(spark.table(names["lines"]), spark.table(names["orders"]),
                                      *dims)
        plan = facts._jdf.queryExecution().executedPlan().toString()
        above = plan[:plan.index("warehouse_lines")].splitlines()
        join = max(i for i, line in enumerate(above) if "SortMergeJoin [order_no" in line)
        depth = above[join].index("SortMergeJoin")
        mine = [line for line in above[join + 1:] if len(line) > depth]
        assert not any("Exchange" in line for line in mine), plan
        plain = warehouse.fact_orders(s["lines"], s["orders"], *dims)
        assert sorted(map(tuple, facts.collect()), key=str) == sorted(map(tuple, plain.collect()),
                                                                      key=str)
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_hot_product_is_split_in_the_fact(spark):
    """Above the limit for skew, the partition of a hot product is read by several tasks."""
    n = 200_000
    lines = spark.range(n).select(
        F.col("id").alias("order_no"), F.lit(1).alias("quantity"), F.lit(1.0).alias("unit_price"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("product_id"))
    products = spark.range(997).select(F.col("id").alias("product_id"), F.md5(
        F.col("id").cast("string")).alias("product_key"))
    orders = spark.range(n).select(F.col("id").alias("order_no"), F.lit(1).alias("customer_id"),
                                   F.lit("2025-01-01").alias("order_date"))
    dates = spark.range(1).select(F.lit(date(2025, 1, 1)).alias("date"), F.lit("d").alias("date_key"))
    customers = spark.range(1).select(F.lit(1).alias("customer_id"), F.lit("c").alias("customer_key"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k"}
    kept = {k: spark.conf.get(k) for k in settings if spark.conf.get(k, None) is not None}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = warehouse.fact_orders(lines, orders, dates, customers, products)
        assert facts.count() == n
        facts.write.format("noop").mode("overwrite").save()
        facts.collect()
        assert "skew=true" in facts._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_few_row_groups_for_a_day_and_for_a_number(spark):
    from orderdw.operators.orders import find_orders
    from orderdw.plans.reports import customers_between
    from orderdw.sources.tables import rows_scanned, write_clustered
    n = 20_000
    orders = spark.range(n).select(
        (F.col("id") * 7919 % n).alias("order_no"),
        F.unhex(F.md5(F.col("id").cast("string"))).alias("order_id"),
        (F.col("id") % 50).cast("string").alias("customer_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 365).cast("int"))
        .alias("order_date"))
    plain, path = stage_path(spark, "plain"), stage_path(spark, "clustered")
    write_table(orders, plain)
    write_clustered(orders, path, "order_date", ["order_no", "order_id"], 4, rows_per_group=1000)
    plain, stored = spark.read.parquet(plain), spark.read.parquet(path)
    customers = spark.range(50).select(F.col("id").cast("string").alias("customer_id"), *[
        F.lit("x").alias(c) for c in ("surname", "names", "dni", "email")])

    def april(df):
        return customers_between(customers, df, "2024-04-01", "2024-04-10").select("dni")

    days = [df.filter("order_date between date'2024-04-01' and date'2024-04-10'")
            for df in (plain, stored)]
    assert rows_scanned(days[0]) == n and rows_scanned(days[1]) <= 3000
    assert april(plain).collect() == april(stored).collect()
    found = [find_orders(df, [17, 4711]) for df in (plain, stored)]
    assert sorted(found[0].collect()) == sorted(found[1].collect()) and found[1].count() == 2
    assert rows_scanned(found[0]) == n and rows_scanned(found[1]) <= 4000
    key = bytes(found[0].first().order_id)
    assert rows_scanned(stored.filter(F.col("order_id") == F.lit(key))) <= 3000
    assert find_orders(stored, []).count() == 0
