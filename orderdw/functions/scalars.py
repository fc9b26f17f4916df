"""Small column helpers whose meaning differs between SQL dialects."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Wording of the messages.
SHORT_STOCK = "Stock insuficiente para el producto %s. Stock disponible: %d. Cantidad requerida: %d"
STOCK_BOUNDS = "El stock (%d) debe estar entre %d y %d."
CANCEL_NOTE = "Pedido %d anulado."
NOT_CONFIRMED = ('No se puede anular el pedido %d porque su estado actual es "%s". '
                 "Solo los pedidos en estado CONFIRMADO pueden anularse.")
NO_SUCH_ORDER = "Pedido no encontrado: %d"
NO_SUCH_PRODUCT = "Producto inexistente: %s"
SHORT_STOCK_OF_REQUEST = "Stock insuficiente (prod %s): dispo %d, solicitado %d"
BAD_CUSTOMER = "UUID Cliente inválido: "
BAD_SELLER = "UUID Vendedor inválido: "
BAD_PRODUCT = {1: "UUID Producto 1 inválido: ", 2: "UUID Producto 2 inválido: ",
               3: "UUID Producto 3 inválido: "}
NO_QUANTITY = {2: "Debe indicar cantidad para producto 2",
               3: "Debe indicarse cantidad para producto 3"}


def message(template: str, *cols: Column | str) -> Column:
    return F.format_string(template, *cols)


def concat_skip_null(*cols: Column) -> Column:
    """Concatenation in which a NULL part counts as empty text."""
    return F.concat_ws("", *cols)


def is_not_blank(c: Column) -> Column:
    """True for text with a visible character; NULL and blanks give false."""
    return F.coalesce(F.trim(c) != "", F.lit(False))


def zero_pad(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def date_of(c: Column) -> Column:
    return c.cast("date")


def due_date(year: Column | int, month: Column, day: int = 15) -> Column:
    year = F.lit(year) if isinstance(year, int) else year
    return F.make_date(year, month, F.lit(day))


def as_money(c: Column) -> Column:
    """Two places, halves away from zero. ``c`` must be decimal, never double."""
    return F.round(c, 2).cast("decimal(10,2)")


def percent_factor(pct: Decimal | int | str) -> Column:
    return F.lit(Decimal(1) + Decimal(str(pct)) / Decimal(100))


def safe_int(c: Column) -> Column:
    return c.try_cast("int")


def safe_date(c: Column) -> Column:
    return c.try_cast("date")


def loose_text(c: Column, trailing_blanks: bool = False) -> Column:
    """Text that compares and groups without regard to case and accents."""
    return F.collate(c, "UNICODE_CI_AI" if not trailing_blanks else "UNICODE_CI_AI_RTRIM")


def between_dates(df: DataFrame, name: str, lo, hi) -> Column:
    """Days from ``lo`` to ``hi``, both included, whatever time of day the column holds.

    The bare column stays on one side of each comparison, so the test reaches the Parquet scan.
    """
    c, first, last = F.col(name), F.lit(lo).cast("date"), F.lit(hi).cast("date")
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return c.between(first, last)
    return (c >= first.cast(kind)) & (c < F.date_add(last, 1).cast(kind))
