"""Price stamping and the stock ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orderdw.functions.scalars import CANCEL_NOTE, message
from orderdw.functions.ids import hex_text, stable_key
from orderdw.schemas import CANCELLED, CONFIRMED
from orderdw.sources.tables import ORDER_RANGE, order_keys


def with_line_total(lines: DataFrame) -> DataFrame:
    return lines.withColumn("total",
                            (F.col("quantity") * F.col("unit_price")).cast("decimal(10,2)"))


def stamp_price(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Give each line the product's price of now. Lines of unknown products keep a NULL price."""
    prices = products.select("product_id", "unit_price")
    return lines.drop("unit_price").join(prices, "product_id", "left")


def changed_states(old: DataFrame, new: DataFrame, *extra: str) -> DataFrame:
    """Orders whose state changed, with both states; orders new to the table have no old state."""
    before = old.select("order_no", F.col("state").alias("old_state"))
    return (new.select("order_no", F.col("state").alias("new_state"), *extra)
            .join(before, "order_no", "left")
            .filter(~F.col("new_state").eqNullSafe(F.col("old_state"))))


def takes_stock() -> Column:
    return (F.col("new_state") == CONFIRMED) & F.coalesce(F.col("old_state") != CONFIRMED,
                                                          F.lit(True))


def gives_back() -> Column:
    return (F.col("new_state") == CANCELLED) & (F.col("old_state") == CONFIRMED)


def becomes_cancelled() -> Column:
    return (F.col("new_state") == CANCELLED) & (F.col("old_state") != CANCELLED)


def moves_of(changes: DataFrame, lines: DataFrame,
             keys: Sequence[str] = ("order_no",)) -> DataFrame:
    """Signed stock moves per product of changes ``(order_no, old_state, new_state)``.

    Changes that agree in ``keys`` (which contain ``order_no``) are netted first. With a
    ``stock_taken`` column, confirming an order whose stock left at registration moves nothing.
    """
    confirm = takes_stock()
    if "stock_taken" in changes.columns:
        confirm = confirm & ~F.coalesce(F.col("stock_taken"), F.lit(False))
    sign = F.when(confirm, -1).when(gives_back(), 1)
    on = order_keys(lines, changes)
    net = (changes.withColumn("_sign", sign).dropna(subset=["_sign"])
           .groupBy(*dict.fromkeys([*on, *keys])).agg(F.sum("_sign").alias("_sign"))
           .filter("_sign <> 0"))
    return (lines.select(*on, "product_id", "quantity").join(net, on)
            .groupBy(*keys, "product_id")
            .agg(F.sum(F.col("quantity") * F.col("_sign")).alias("delta")))


def stock_moves(old: DataFrame, new: DataFrame, lines: DataFrame) -> DataFrame:
    """The ledger between two versions of the orders table, new confirmed orders included."""
    extra = [c for c in ["stock_taken", ORDER_RANGE] if c in new.columns]
    return moves_of(changed_states(old, new, *extra), lines)


def apply_moves(products: DataFrame, moves: DataFrame) -> DataFrame:
    """Products with the ledger's deltas added to their stock."""
    deltas = moves.groupBy("product_id").agg(F.sum("delta").alias("_delta"))
    changed = (F.col("stock") + F.coalesce("_delta", F.lit(0))).cast(products.schema["stock"]
                                                                     .dataType)
    return (products.join(deltas, "product_id", "left").withColumn("stock", changed)
            .select(*products.columns))


def apply_confirmed(products: DataFrame, lines: DataFrame) -> DataFrame:
    """Take the stock of the lines of confirmed orders."""
    return apply_moves(products, lines.select("product_id", (-F.col("quantity")).alias("delta")))


def apply_cancelled(products: DataFrame, lines: DataFrame) -> DataFrame:
    """Put back the stock of the lines of orders cancelled after confirmation."""
    return apply_moves(products, lines.select("product_id", F.col("quantity").alias("delta")))


def _when(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def cancel_audit(old: DataFrame, new: DataFrame, as_of=None) -> DataFrame:
    """One audit row per order that went from confirmed to cancelled."""
    changed = changed_states(old, new, "order_id").filter(gives_back())
    return audit_rows(changed, as_of)


def audit_rows(changed: DataFrame, as_of=None) -> DataFrame:
    at = _when(as_of)
    return changed.select(
        stable_key(F.lit("audit"), hex_text("order_id"), at.cast("string")).alias("audit_id"),
        "order_id", at.alias("cancelled_at"), message(CANCEL_NOTE, "order_no").alias("note"))


def cancel_log(old: DataFrame, new: DataFrame, as_of=None) -> DataFrame:
    """One log row per order that was in some other state and is now cancelled."""
    return log_rows(changed_states(old, new).filter(becomes_cancelled()), as_of)


def log_rows(changed: DataFrame, as_of=None) -> DataFrame:
    at = _when(as_of)
    return changed.select(
        stable_key(F.lit("log"), "order_no", at.cast("string")).alias("log_id"),
        "order_no", at.alias("cancelled_at"))
