"""Sales reports.

Lines are summed per order or per product before they meet another table: the partial sums are
formed where the lines are read, so what is shuffled and joined grows with the number of orders or
products, and a product with a third of all lines sends one partial sum per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderdw.functions.scalars import between_dates, date_of
from orderdw.operators.running import number_within
from orderdw.operators.stock import with_line_total
from orderdw.sources.tables import order_keys

CUSTOMER_LABELS = ["surname", "names", "email"]


def customers_between(customers: DataFrame, orders: DataFrame, lo, hi) -> DataFrame:
    """Customers who ordered between two days, both included."""
    buyers = (orders.filter(between_dates(orders, "order_date", lo, hi))
              .select("customer_id").distinct())
    return (customers.join(buyers, "customer_id", "left_semi")
            .select("surname", "names", "dni", "email").distinct())


def _order_counts(orders: DataFrame, key: str) -> DataFrame:
    return orders.groupBy(key).agg(F.count("order_id").alias("order_count"))


def _with_counts(people: DataFrame, orders: DataFrame, key: str) -> DataFrame:
    """People with their number of orders, 0 for those without."""
    return (people.join(_order_counts(orders, key), key, "left")
            .withColumn("order_count", F.coalesce("order_count", F.lit(0).cast("long"))))


def orders_per_seller(sellers: DataFrame, orders: DataFrame) -> DataFrame:
    return _with_counts(sellers, orders, "seller_id").select(
        "surname", "names", "dni", "email", "order_count")


def orders_over(orders: DataFrame, lines: DataFrame, threshold) -> DataFrame:
    """Orders whose lines add up to more than ``threshold``."""
    big = (with_line_total(lines).groupBy("order_no").agg(F.sum("total").alias("order_total"))
           .filter(F.col("order_total") > F.lit(threshold)))
    return orders.join(big, "order_no").select(
        "order_no", date_of(F.col("order_date")).alias("order_date"), "order_total")


def product_sales_between(orders: DataFrame, lines: DataFrame, products: DataFrame, lo, hi,
                          loose: bool = False) -> DataFrame:
    """Quantity sold per product description between two days.

    ``loose`` groups descriptions without regard to case and accents and shows one of them.
    """
    on = order_keys(lines, orders)
    wanted = orders.filter(between_dates(orders, "order_date", lo, hi)).select(*on)
    sold = (lines.join(wanted, on).groupBy("product_id")
            .agg(F.sum("quantity").alias("_sold")))
    named = sold.join(products.select("product_id", "description"), "product_id")
    if not loose:
        return named.groupBy("description").agg(F.sum("_sold").alias("quantity"))
    return (named.groupBy(F.collate("description", "UNICODE_CI_AI").alias("_group"))
            .agg(F.min("description").alias("description"), F.sum("_sold").alias("quantity"))
            .drop("_group"))


def _sold_per_product(lines: DataFrame) -> DataFrame:
    return lines.groupBy("product_id").agg(F.sum("quantity").alias("_sold"))


def top_supplier(suppliers: DataFrame, products: DataFrame, lines: DataFrame,
                 n: int = 1) -> DataFrame:
    """The ``n`` suppliers with the largest quantity sold; equal ones by name."""
    per_supplier = (_sold_per_product(lines)
                    .join(products.select("product_id", "supplier_id"), "product_id")
                    .groupBy("supplier_id").agg(F.sum("_sold").alias("quantity")))
    return (per_supplier.join(suppliers.select("supplier_id", "name"), "supplier_id")
            .orderBy(F.desc("quantity"), "name", "supplier_id").limit(n)
            .select("name", "quantity"))


def customers_without_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    buyers = orders.select("customer_id").distinct()
    return customers.join(buyers, "customer_id", "left_anti").select(*CUSTOMER_LABELS)


def customers_below(customers: DataFrame, orders: DataFrame, n: int = 2) -> DataFrame:
    """Customers with fewer than ``n`` orders, those without any included."""
    return (_with_counts(customers, orders, "customer_id").filter(F.col("order_count") < n)
            .select(*CUSTOMER_LABELS))


def sales_by_origin(products: DataFrame, lines: DataFrame) -> DataFrame:
    return (_sold_per_product(lines).join(products.select("product_id", "origin"), "product_id")
            .groupBy("origin").agg(F.sum("_sold").alias("quantity")))


def names_per_supplier(suppliers: DataFrame, products: DataFrame) -> DataFrame:
    """The product descriptions of each supplier, one row per product with its position from 1.

    A text of all names would be as large as the supplier; numbered rows have no limit.
    """
    numbered = number_within(products.select("supplier_id", "description", "product_id"),
                             ["supplier_id"], ["description", "product_id"], "_n")
    return (numbered.join(suppliers.select("supplier_id", "name"), "supplier_id")
            .select("name", (F.col("_n") + 1).alias("position"), "description"))


def names_per_order(lines: DataFrame, products: DataFrame, sep: str = ", ") -> DataFrame:
    """The product descriptions of each order in the order of its lines, joined to one text."""
    named = lines.select("order_no", "line_no", "line_id", "product_id").join(
        products.select("product_id", "description"), "product_id")
    texts = named.groupBy("order_no").agg(F.array_sort(F.collect_list(
        F.struct("line_no", "line_id", "description"))).alias("_names"))
    return texts.select("order_no", F.array_join(F.col("_names.description"), sep)
                        .alias("products"))
