"""Table layouts of the order, warehouse and property-tax models."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

ID = T.BinaryType()
TEXT = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
DATE = T.DateType()
MONEY = T.DecimalType(10, 2)

# States of an order and origins of a product.
PENDING, CONFIRMED, CANCELLED = "pendiente", "confirmado", "anulado"
STATES = [PENDING, CONFIRMED, CANCELLED]
NATIONAL, IMPORTED = "nacional", "importado"
ORIGINS = [NATIONAL, IMPORTED]


def _table(required: dict, optional: dict | None = None) -> T.StructType:
    fields = [T.StructField(name, kind, False) for name, kind in required.items()]
    fields += [T.StructField(name, kind, True) for name, kind in (optional or {}).items()]
    return T.StructType(fields)


ORDERS_MODEL = {
    "customers": _table({"customer_id": ID, "dni": TEXT, "surname": TEXT, "names": TEXT,
                         "address": TEXT, "email": TEXT}),
    "suppliers": _table({"supplier_id": ID, "name": TEXT, "address": TEXT, "email": TEXT}),
    "sellers": _table({"seller_id": ID, "dni": TEXT, "surname": TEXT, "names": TEXT,
                       "email": TEXT, "commission": T.DecimalType(5, 2)}),
    "products": _table({"product_id": ID, "description": TEXT, "unit_price": MONEY, "stock": INT,
                        "stock_max": INT, "stock_min": INT, "supplier_id": ID, "origin": TEXT}),
    "orders": _table({"order_id": ID, "order_no": LONG, "customer_id": ID, "seller_id": ID,
                      "order_date": DATE, "state": TEXT}),
    "lines": _table({"line_id": ID, "order_no": LONG, "line_no": INT, "product_id": ID,
                     "quantity": INT, "unit_price": MONEY}),
    "cancel_audit": _table({"audit_id": ID, "order_id": ID, "cancelled_at": T.TimestampType()},
                           {"note": TEXT}),
    "cancel_log": _table({"log_id": ID, "order_no": LONG, "cancelled_at": T.TimestampType()}),
}

WAREHOUSE = {
    "dim_dates": _table({"date_key": ID}, {"date": DATE, "day": INT, "month": INT, "year": INT}),
    "dim_products": _table({"product_key": ID}, {"product_id": ID, "description": TEXT,
                                                 "supplier_name": TEXT}),
    "dim_customers": _table({"customer_key": ID}, {"customer_id": ID, "name": TEXT}),
    "fact_orders": _table({}, {"customer_key": ID, "product_key": ID, "date_key": ID,
                               "quantity": INT, "total": MONEY}),
}

PROPERTY_TAX = {
    "owners": _table({"id": ID}, {"surnames": TEXT, "names": TEXT}),
    "addresses": _table({"id": ID}, {"street": TEXT, "number": INT, "floor": TEXT, "unit": TEXT,
                                     "town_id": ID}),
    "address_kinds": _table({"id": ID}, {"description": TEXT}),
    "property_types": _table({"id": ID}, {"description": TEXT}),
    "zones": _table({"id": ID}, {"description": TEXT}),
    "countries": _table({"id": ID}, {"description": TEXT}),
    "provinces": _table({"id": ID}, {"description": TEXT, "country_id": ID}),
    "towns": _table({"id": ID}, {"description": TEXT, "postcode": TEXT, "province_id": ID}),
    "owner_addresses": _table({"owner_id": ID, "address_id": ID, "kind_id": ID}),
    "properties": _table({"cadastral_no": TEXT}, {"owner_id": ID, "address_id": ID, "zone_id": ID,
                                                  "type_id": ID}),
    "instalments": _table({"cadastral_no": TEXT, "year": INT, "instalment_no": INT},
                          {"value": T.DecimalType(12, 2), "due_date": DATE, "paid_date": DATE,
                           "paid": T.BooleanType()}),
}

TABLES = {**ORDERS_MODEL, **WAREHOUSE, **PROPERTY_TAX}


class Keys(NamedTuple):
    """Declared keys of a table: primary, further unique ones, and (columns, parent, its columns)."""
    primary: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()


def _to(parent: str, *columns: str, key: str = "id"):
    return columns, parent, (key,) if len(columns) == 1 else columns


ORDERS_KEYS = {
    "customers": Keys(("customer_id",)),
    "suppliers": Keys(("supplier_id",)),
    "sellers": Keys(("seller_id",)),
    "products": Keys(("product_id",), (), (_to("suppliers", "supplier_id", key="supplier_id"),)),
    "orders": Keys(("order_id",), (("order_no",),),
                   (_to("customers", "customer_id", key="customer_id"),
                    _to("sellers", "seller_id", key="seller_id"))),
    "lines": Keys(("line_id",), (("order_no", "line_no"),),
                  (_to("orders", "order_no", key="order_no"),
                   _to("products", "product_id", key="product_id"))),
    "cancel_audit": Keys(("audit_id",), (), (_to("orders", "order_id", key="order_id"),)),
    "cancel_log": Keys(("log_id",), (), (_to("orders", "order_no", key="order_no"),)),
}
WAREHOUSE_KEYS = {
    "dim_dates": Keys(("date_key",)),
    "dim_products": Keys(("product_key",)),
    "dim_customers": Keys(("customer_key",)),
    "fact_orders": Keys((), (), (_to("dim_customers", "customer_key", key="customer_key"),
                                 _to("dim_products", "product_key", key="product_key"),
                                 _to("dim_dates", "date_key", key="date_key"))),
}
TAX_KEYS = {
    "owners": Keys(("id",)),
    "addresses": Keys(("id",), (), (_to("towns", "town_id"),)),
    "address_kinds": Keys(("id",)),
    "property_types": Keys(("id",)),
    "zones": Keys(("id",)),
    "countries": Keys(("id",)),
    "provinces": Keys(("id",), (), (_to("countries", "country_id"),)),
    "towns": Keys(("id",), (), (_to("provinces", "province_id"),)),
    "owner_addresses": Keys(("owner_id", "address_id", "kind_id"), (),
                            (_to("owners", "owner_id"), _to("addresses", "address_id"),
                             _to("address_kinds", "kind_id"))),
    "properties": Keys(("cadastral_no",), (),
                       (_to("owners", "owner_id"), _to("addresses", "address_id"),
                        _to("zones", "zone_id"), _to("property_types", "type_id"))),
    "instalments": Keys(("cadastral_no", "year", "instalment_no"), (),
                        (_to("properties", "cadastral_no", key="cadastral_no"),)),
}
KEYS = {**ORDERS_KEYS, **WAREHOUSE_KEYS, **TAX_KEYS}

# Layout of the Parquet test tables that the adapter reads.
NTZ = T.TimestampNTZType()
REAL = T.DoubleType()
TEST_TABLES = {
    "region": _table({}, {"r_regionkey": INT, "r_name": TEXT}),
    "nation": _table({}, {"n_nationkey": INT, "n_name": TEXT, "n_regionkey": INT}),
    "customer": _table({}, {"c_custkey": LONG, "c_name": TEXT, "c_nationkey": INT,
                            "c_acctbal": REAL, "c_mktsegment": TEXT}),
    "supplier": _table({}, {"s_suppkey": LONG, "s_name": TEXT, "s_nationkey": INT,
                            "s_acctbal": REAL}),
    "part": _table({}, {"p_partkey": LONG, "p_name": TEXT, "p_brand": TEXT, "p_type": TEXT,
                        "p_size": INT, "p_retailprice": REAL}),
    "orders": _table({}, {"o_orderkey": LONG, "o_custkey": LONG, "o_orderstatus": TEXT,
                          "o_totalprice": REAL, "o_orderdate": NTZ, "o_orderpriority": TEXT}),
    "lineitem": _table({}, {"l_orderkey": LONG, "l_partkey": LONG, "l_suppkey": LONG,
                            "l_linenumber": INT, "l_quantity": REAL, "l_extendedprice": REAL,
                            "l_discount": REAL, "l_tax": REAL, "l_returnflag": TEXT,
                            "l_linestatus": TEXT, "l_shipdate": NTZ}),
    "events": _table({}, {"event_id": LONG, "ts": NTZ, "user_id": LONG, "event_type": TEXT,
                          "value": REAL, "props": TEXT}),
}
