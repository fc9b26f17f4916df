"""The small order data set that the expected answers belong to. People are codes."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import SparkSession

from orderdw.schemas import ORDERS_MODEL
from orderdw.sources.testdata import OrderModel

D = Decimal
N, I = "nacional", "importado"
# The quantities, prices and dates that the expected answers were worked out for.
PRODUCTS = [  # id, price, stock, max, min, supplier, origin
    (1, "20865.00", 1518, 5000, 500, 3, N), (2, "18999.00", 12497, 15000, 0, 2, N),
    (3, "1487.50", 1213, 12000, 1050, 1, N), (4, "11999.40", 870, 1942, 200, 2, N),
    (5, "6017.00", 1803, 7500, 780, 3, I), (6, "1648.98", 680, 3800, 230, 1, N),
    (7, "2240.00", 213, 1300, 25, 1, N), (8, "2559.00", 329, 1150, 20, 2, I),
    (9, "9799.00", 871, 900, 50, 2, N), (10, "7900.00", 852, 2500, 500, 1, I)]
C, P = "confirmado", "pendiente"
ORDERS = [  # no, customer, seller, date, state, lines (product, quantity)
    (1, 1, 1, date(2025, 2, 23), C, [(1, 58), (2, 32), (3, 211)]),
    (2, 5, 2, date(2025, 3, 14), C, [(5, 36)]),
    (3, 1, 1, date(2025, 4, 4), P, [(1, 9), (4, 12)]),
    (4, 4, 2, date(2025, 1, 28), C, [(9, 15), (6, 22), (8, 10)]),
    (5, 2, 3, date(2025, 4, 11), C, [(10, 14)]),
    (6, 2, 3, date(2025, 2, 18), P, [(4, 75), (8, 23)]),
    (7, 1, 3, date(2025, 1, 8), C, [(7, 38), (4, 52), (1, 92)]),
    (8, 3, 2, date(2025, 3, 5), C, [(8, 108), (6, 625)]),
    (9, 4, 2, date(2025, 4, 10), P, [(2, 458)]),
    (10, 3, 2, date(2025, 3, 21), C, [(5, 15), (3, 22), (8, 210)])]


def key(n: int) -> bytes:
    return n.to_bytes(16, "big")


def uuid_text(n: int) -> str:
    h = key(n).hex()
    return f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}"


def number(b) -> int:
    return int.from_bytes(bytes(b), "big")


def seed(spark: SparkSession, orders=ORDERS, customers: int = 5) -> OrderModel:
    def table(name: str, rows: list):
        return spark.createDataFrame(rows, ORDERS_MODEL[name])

    price = {p[0]: D(p[1]) for p in PRODUCTS}
    lines = [(key(100 * no + i), no, i, key(p), q, price.get(p, D(0)))
             for no, _, _, _, _, items in orders for i, (p, q) in enumerate(items, 1)]
    return OrderModel(
        customers=table("customers", [(key(i), f"d{i}", f"C{i}", f"n{i}", f"a{i}", f"c{i}@x")
                                      for i in range(1, customers + 1)]),
        suppliers=table("suppliers", [(key(i), f"S{i}", f"a{i}", f"s{i}@x") for i in (1, 2, 3)]),
        sellers=table("sellers", [(key(i), f"d{i}", f"V{i}", f"n{i}", f"v{i}@x", D(c))
                                  for i, c in ((1, "10.15"), (2, "23.20"), (3, "14.60"))]),
        products=table("products", [(key(i), f"product {i}", D(p), s, hi, lo, key(sup), o)
                                    for i, p, s, hi, lo, sup, o in PRODUCTS]),
        orders=table("orders", [(key(no), no, key(c), key(v), d, s)
                                for no, c, v, d, s, _ in orders]),
        lines=table("lines", lines))
