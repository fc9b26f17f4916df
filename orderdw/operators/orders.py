"""Registering and cancelling orders in batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from orderdw.functions.ids import bin_to_uuid, hex_text, is_uuid, stable_key, uuid_to_bin
from orderdw.functions.scalars import (BAD_CUSTOMER, BAD_PRODUCT, BAD_SELLER, NO_QUANTITY,
                                       NO_SUCH_ORDER, NOT_CONFIRMED, SHORT_STOCK_OF_REQUEST,
                                       date_of, is_not_blank, message)
from orderdw.operators.allocation import allocate, explain_rejects
from orderdw.operators.running import assign_numbers
from orderdw.operators.stock import apply_moves, audit_rows, log_rows, stamp_price
from orderdw.schemas import CANCELLED, CONFIRMED, PENDING
from orderdw.session import cut_lineage
from orderdw.sources.tables import ORDER_RANGE, order_keys

LINE_SLOTS = (1, 2, 3)


@dataclass(frozen=True)
class Registration:
    orders: DataFrame    # the new orders, pending, with stock_taken = true
    lines: DataFrame     # their lines, with the price of now
    products: DataFrame  # products with the stock taken
    explain: Callable[[], DataFrame]

    @cached_property
    def rejects(self) -> DataFrame:
        """``(request_no, rule, message)``; worked out only when asked for."""
        return self.explain()


def _first_flaw() -> Column:
    """The first check that a request fails, as (rule, message); NULL if all pass."""
    def bad(c: str) -> Column:
        return ~F.coalesce(is_uuid(c), F.lit(False))

    def told(rule: str, text: str, c: str) -> Column:
        return F.struct(F.lit(rule).alias("rule"),
                        F.concat(F.lit(text), F.coalesce(F.col(c), F.lit(""))).alias("message"))

    flaw = (F.when(bad("customer_uuid"),
                   told("customer_format", BAD_CUSTOMER, "customer_uuid"))
            .when(bad("seller_uuid"),
                  told("seller_format", BAD_SELLER, "seller_uuid"))
            .when(bad("product1_uuid"),
                  told("product1_format", BAD_PRODUCT[1], "product1_uuid")))
    for i in LINE_SLOTS[1:]:
        given = is_not_blank(F.col(f"product{i}_uuid"))
        flaw = (flaw.when(given & F.col(f"quantity{i}").isNull(),
                          F.struct(F.lit(f"quantity{i}_missing").alias("rule"),
                                   F.lit(NO_QUANTITY[i]).alias("message")))
                .when(given & bad(f"product{i}_uuid"),
                      told(f"product{i}_format", BAD_PRODUCT[i], f"product{i}_uuid")))
    # A third product without a second one leaves a gap in the lines: the request fails whole.
    gap = is_not_blank(F.col("product3_uuid")) & ~is_not_blank(F.col("product2_uuid"))
    return flaw.when(gap, F.struct(F.lit("product2_missing").alias("rule"),
                                   F.lit("Falta el producto 2").alias("message")))


def register_orders(requests: DataFrame, customers: DataFrame, sellers: DataFrame,
                    products: DataFrame, last_order_no: int = 0, as_of=None) -> Registration:
    """Turn requests into pending orders, each one whole or not at all.

    A request has ``request_no`` (its place in the queue), ``customer_uuid``, ``seller_uuid`` and
    ``product1_uuid``, ``quantity1`` up to ``product3_uuid``, ``quantity3`` (2 and 3 optional).
    Stock is taken at once, so confirming such an order later moves nothing (``stock_taken``).
    """
    as_of = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    flaw = F.col("_flaw")
    sound = F.col("_rule").isNull()

    def given(c: str) -> Column:
        """The text of a key where it is not the text that the key itself gives."""
        return F.when(sound & (F.lower(c) != F.col(c)), F.col(c)).alias(f"_{c}")

    def key(c: str, name: str) -> Column:
        return F.when(sound, uuid_to_bin(c)).alias(name)

    # Stored once, because sound requests and, if asked for, the malformed ones are read from it; as
    # keys, which take less room than their texts. A line without a product has no key.
    checked = cut_lineage(
        requests.withColumn("_flaw", _first_flaw())
        .withColumns({"_rule": flaw["rule"], "_message": flaw["message"]})
        .select("request_no", "_rule", "_message", key("customer_uuid", "customer_id"),
                key("seller_uuid", "seller_id"), given("customer_uuid"), given("seller_uuid"),
                *[key(f"product{i}_uuid", f"_product{i}") for i in LINE_SLOTS],
                *[F.col(f"quantity{i}") for i in LINE_SLOTS]), "checked")
    malformed = checked.filter(~sound).select(
        "request_no", F.col("_rule").alias("rule"), F.col("_message").alias("message"))

    def unknown(parents: DataFrame, name: str, flag: str) -> DataFrame:
        """Keys that requests name and no parent has, stored: their real size, mostly next to nothing,
        tells whether the requests must be moved to meet them."""
        asked = checked.filter(sound).select(name).distinct()
        return cut_lineage(asked.join(parents.select(name), name, "left_anti")
                           .withColumn(flag, F.lit(True)), "unknown")

    known = (checked.filter(sound).drop("_rule", "_message")
             .join(unknown(customers, "customer_id", "_no_customer"), "customer_id", "left")
             .join(unknown(sellers, "seller_id", "_no_seller"), "seller_id", "left"))
    stray = F.col("_no_customer").isNotNull() | F.col("_no_seller").isNotNull()
    strays = known.filter(stray).select(
        "request_no", F.when(F.col("_no_customer").isNotNull(), "unknown_customer")
        .otherwise("unknown_seller").alias("rule"), F.concat(
            F.lit("no parent for "), F.when(
                F.col("_no_customer").isNotNull(),
                F.coalesce("_customer_uuid", bin_to_uuid("customer_id")))
            .otherwise(F.coalesce("_seller_uuid", bin_to_uuid("seller_id")))).alias("message"))

    heads = known.filter(~stray).select(F.col("request_no").alias("order_no"),
                                        "customer_id", "seller_id")
    slots = F.array(*[F.struct(F.lit(i).alias("line_no"), F.col(f"_product{i}").alias("product_id"),
                               F.col(f"quantity{i}").alias("quantity")) for i in LINE_SLOTS])
    wanted = (known.filter(~stray).select(F.col("request_no").alias("order_no"),
                                          F.explode(slots).alias("l"))
              .filter("l.product_id IS NOT NULL")
              .select("order_no", "l.line_no", "l.product_id", "l.quantity"))
    result = allocate(wanted, heads, products, line_cols=["line_no"], takes=F.lit(True),
                      whole=True)

    numbered = assign_numbers(result.accepted.withColumnRenamed("order_no", "request_no"),
                              ["request_no"], start=last_order_no + 1)
    orders = numbered.select(
        stable_key(F.lit("order"), "order_no").alias("order_id"), "order_no", "customer_id",
        "seller_id", as_of.alias("order_date"), F.lit(PENDING).alias("state"),
        F.lit(True).alias("stock_taken"), "request_no")
    placed = (wanted.withColumnRenamed("order_no", "request_no")
              .join(orders.select("request_no", "order_no"), "request_no"))
    lines = stamp_price(placed, products).select(
        stable_key(F.lit("line"), "order_no", "line_no").alias("line_id"), "order_no", "line_no",
        "product_id", "quantity", "unit_price")
    taken = result.taken.select("product_id", (-F.col("quantity")).alias("delta"))

    def explain() -> DataFrame:
        short = explain_rejects(
            result, wanted, products, line_cols=["line_no"],
            short_stock=message(SHORT_STOCK_OF_REQUEST, bin_to_uuid("product_id"), "available",
                                "required"))
        return malformed.unionByName(strays).unionByName(
            short.select(F.col("order_no").alias("request_no"), "rule", "message"))

    return Registration(orders, lines, apply_moves(products, taken), explain)


class Cancellation(NamedTuple):
    orders: DataFrame
    products: DataFrame
    audit: DataFrame
    log: DataFrame
    rejects: DataFrame  # order_no, calls, message


def cancel_orders(numbers: DataFrame, orders: DataFrame, lines: DataFrame, products: DataFrame,
                  as_of=None) -> Cancellation:
    """Cancel confirmed orders by number and put their stock back once.

    Unknown orders and orders in another state are rejected. A number that comes more than once is
    cancelled by its first call; the other calls find it cancelled and are rejected (``calls``).
    """
    asked = numbers.groupBy("order_no").agg(F.count("*").alias("calls"))
    extra = [c for c in [ORDER_RANGE] if c in orders.columns]
    known = asked.join(orders.select("order_no", "order_id", "state", *extra), "order_no", "left")
    ok = F.col("state").eqNullSafe(F.lit(CONFIRMED))
    hit = known.filter(ok).select("order_no", "order_id", *extra, F.lit(CONFIRMED).alias("old_state"),
                                  F.lit(CANCELLED).alias("new_state"))
    text = (F.when(F.col("state").isNull(), message(NO_SUCH_ORDER, "order_no"))
            .otherwise(message(NOT_CONFIRMED, "order_no",
                               F.when(ok, CANCELLED).otherwise(F.col("state")))))
    rejects = (known.withColumn("message", text)
               .withColumn("calls", F.col("calls") - F.when(ok, 1).otherwise(0))
               .filter("calls > 0").select("order_no", "calls", "message"))

    on = order_keys(lines, hit)
    moved = (lines.select(*on, "product_id", "quantity").join(hit.select(*on), on, "left_semi")
             .select("product_id", F.col("quantity").alias("delta")))
    changed = (orders.join(hit.select("order_no", "new_state"), "order_no", "left")
               .withColumn("state", F.coalesce("new_state", "state")).select(*orders.columns))
    return Cancellation(changed, apply_moves(products, moved), audit_rows(hit, as_of),
                        log_rows(hit, as_of), rejects)


def find_orders(orders: DataFrame, numbers: Iterable[int]) -> DataFrame:
    """The orders of a few numbers. Each is an equality that reaches the Parquet scan, where Bloom
    filters (:func:`orderdw.sources.tables.write_clustered`) tell which row groups may hold it; for
    many numbers, join them instead."""
    wanted = [F.col("order_no") == int(n) for n in numbers]
    return orders.filter(reduce(Column.__or__, wanted) if wanted else F.lit(False))


def order_list(orders: DataFrame) -> DataFrame:
    return (orders.select("order_no", "state", date_of(F.col("order_date")).alias("order_date"),
                          bin_to_uuid("seller_id").alias("seller_uuid"))
            .orderBy("order_no"))


def log_list(log: DataFrame) -> DataFrame:
    """The cancellation log, latest first."""
    return (log.select(bin_to_uuid("log_id").alias("log_uuid"), "order_no", "cancelled_at")
            .orderBy(F.desc("cancelled_at"), "order_no"))
