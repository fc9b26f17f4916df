"""Work is dealt to tasks by its size, whatever files it comes from."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderdw.plans import property_tax, warehouse


def test_instalments_of_one_file_are_dealt_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(property_tax, "PROPERTIES_PER_TASK", 10)
    properties = spark.range(35).select(F.concat(F.lit("CAT-"), "id").alias("cadastral_no"))
    due = property_tax.generate_instalments(properties.coalesce(1), 2025, "1000.00")
    tasks = due.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) == 4 and sum(r["count"] for r in tasks) == 35 * 12
    assert due.select("cadastral_no", "instalment_no").distinct().count() == 35 * 12


def test_days_are_looked_up_last(spark):
    """What is shuffled for customers and products carries the day, not the key of the day."""
    orders = spark.sql("SELECT 1L AS order_no, X'01' AS customer_id, DATE '2025-01-02' AS order_date")
    lines = spark.sql("SELECT 1L AS order_no, X'02' AS product_id, 3 AS quantity, 2.00 AS unit_price")
    dates = spark.sql("SELECT DATE '2025-01-02' AS date, X'AA' AS date_key")
    customers = spark.sql("SELECT X'01' AS customer_id, X'BB' AS customer_key")
    products = spark.sql("SELECT X'02' AS product_id, X'CC' AS product_key")
    facts = warehouse.fact_orders(lines, orders, dates, customers, products, with_year=True)
    got = facts.first()
    assert (bytes(got.date_key), bytes(got.customer_key), got.order_year) == (b"\xaa", b"\xbb", 2025)
    plan = facts._jdf.queryExecution().analyzed().toString()
    assert "date" in next(line for line in plan.splitlines() if "Join" in line)
    assert facts.join(dates, "date_key").count() == 1
