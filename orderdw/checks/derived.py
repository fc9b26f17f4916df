"""Inputs that the registered queries derive from the test tables, beyond the order model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from orderdw.functions.ids import bin_to_uuid, stable_key
from orderdw.operators.running import assign_numbers, number_within, running_before, slotted
from orderdw.schemas import CANCELLED, CONFIRMED, PENDING
from orderdw.session import stage_path, stage_table
from orderdw.sources.tables import write_bucketed, write_clustered, write_table
from orderdw.sources.testdata import OrderModel, int_key, load_test_table

AS_OF = "2025-05-01 10:00:00"


def later_orders(orders: DataFrame) -> DataFrame:
    """A later version of the orders: old confirmed ones and the pending ones of 1996 are
    cancelled, pending ones from 2000 on are confirmed."""
    day, state = F.col("order_date"), F.col("state")
    new = (F.when((state == CONFIRMED) & (day < F.lit("1996-01-01").cast("timestamp_ntz")),
                  CANCELLED)
           .when((state == PENDING) & (F.year(day) == 1996), CANCELLED)
           .when((state == PENDING) & (day >= F.lit("2000-01-01").cast("timestamp_ntz")),
                 CONFIRMED).otherwise(state))
    return orders.withColumn("state", new)


def requests(m: OrderModel) -> DataFrame:
    """All order lines as requests of up to three lines, queued by order date."""
    lines = number_within(m.lines.select("order_no", "line_no", "line_id", "product_id",
                                         "quantity"), ["order_no"], ["line_no", "line_id"])
    chunked = lines.withColumn("chunk", F.floor(F.col("n") / 3))
    chunk = Window.partitionBy("order_no", "chunk").orderBy("n")

    def nth(c, i):
        return F.lead(c, i).over(chunk).alias(f"_{c}{i + 1}")

    grouped = (chunked.select("order_no", "chunk", "n", *[nth("product_id", i) for i in range(3)],
                              *[nth("quantity", i) for i in range(3)])
               .filter(F.col("n") % 3 == 0).drop("n"))
    heads = m.orders.select("order_no", "order_date", "customer_id", "seller_id")
    numbered = assign_numbers(grouped.join(heads, "order_no"),
                              ["order_date", "order_no", "chunk"], name="request_no")
    return with_flaws(numbered.select(  # as text last: up to then, keys take half the room
        "order_no", "chunk",
        *[bin_to_uuid(f"_product_id{i}").alias(f"product{i}_uuid") for i in (1, 2, 3)],
        *[F.col(f"_quantity{i}").alias(f"quantity{i}") for i in (1, 2, 3)], "order_date",
        bin_to_uuid("customer_id").alias("customer_uuid"),
        bin_to_uuid("seller_id").alias("seller_uuid"), "request_no"))


NOBODY = "ffffffff-ffff-ffff-ffff-ffffffffffff"


def with_flaws(asked: DataFrame) -> DataFrame:
    """Some requests, told by their number, made malformed, unknown or incomplete."""
    kind = F.col("request_no") % 40

    def put(column: str, *cases: tuple[Column, object]) -> Column:
        value = F.col(column)
        for when, other in cases:
            value = F.when(when, F.lit(other)).otherwise(value)
        return value.alias(column)

    second, third = F.col("product2_uuid").isNotNull(), F.col("product3_uuid").isNotNull()
    changed = {
        "customer_uuid": [(kind == 1, "x"), (kind == 7, NOBODY)],
        "seller_uuid": [(kind == 2, ""), (kind == 8, NOBODY)],
        "product1_uuid": [(kind == 3, "zz"), (kind == 9, NOBODY)],
        "product2_uuid": [((kind == 6) & second, "bad"), ((kind == 10) & third, None)],
        "quantity2": [(kind == 4, None)], "quantity3": [(kind == 5, None)]}
    return asked.select(*[put(c, *changed.get(c, [])) for c in asked.columns])


def asked_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Order numbers that someone wants cancelled: some repeat, some do not exist."""
    events = load_test_table(spark, folder, "events")
    return events.select((F.col("event_id") * 2).alias("order_no")).unionByName(
        events.select(F.col("user_id").alias("order_no")))


def state_changes(spark: SparkSession, folder: str, m: OrderModel) -> DataFrame:
    """Purchases and errors as confirmations and cancellations of the order ``user_id``, each with
    the state before it."""
    events = load_test_table(spark, folder, "events").filter(
        F.col("event_type").isin("purchase", "error"))
    named = events.select("event_id", F.col("ts").cast("timestamp").alias("ts"),
                          F.col("user_id").alias("order_no"),
                          F.when(F.col("event_type") == "purchase", CONFIRMED)
                          .otherwise(CANCELLED).alias("new_state"))
    slots, _ = slotted(named, ["order_no", "ts", "event_id"], "changes")
    known = m.orders.select("order_no", "order_id", "state")
    return (running_before(slots, ["order_no"], last={"previous": F.col("new_state")})
            .join(known, "order_no")
            .select("event_id", "ts", "order_no", "order_id",
                    F.coalesce("previous", "state").alias("old_state"), "new_state"))


def tax_model(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Customers as owners of one property each; regions and nations as provinces and towns."""
    customer = load_test_table(spark, folder, "customer")
    nation = load_test_table(spark, folder, "nation")
    region = load_test_table(spark, folder, "region")
    part = load_test_table(spark, folder, "part")
    person = int_key(F.col("c_custkey"))

    def dim(label: str, df: DataFrame, col: str) -> DataFrame:
        return df.select(F.col(col).alias("description")).distinct().select(
            stable_key(F.lit(label), "description").alias("id"), "description")

    segment = F.col("c_mktsegment")
    kinds = region.select(F.explode(F.array(F.lit("particular"), F.lit("de cobro")))
                          .alias("description")).distinct().select(
        stable_key(F.lit("kind"), "description").alias("id"), "description")
    home = customer.select(person.alias("owner_id"), person.alias("address_id"),
                           stable_key(F.lit("kind"), F.lit("particular")).alias("kind_id"))
    billing = customer.filter("c_acctbal > 5000").select(
        person.alias("owner_id"), person.alias("address_id"),
        stable_key(F.lit("kind"), F.lit("de cobro")).alias("kind_id"))
    # The rich have a second home, next door.
    second = customer.filter("c_acctbal > 8000").select(
        person.alias("owner_id"), int_key((F.col("c_custkey") + 1) % customer.select(
            F.count("*")).scalar()).alias("address_id"),
        stable_key(F.lit("kind"), F.lit("particular")).alias("kind_id"))
    return {
        "owners": customer.select(person.alias("id"), F.col("c_name").alias("surnames"),
                                  segment.alias("names")),
        "addresses": customer.select(
            person.alias("id"), F.concat(segment, F.lit(" street")).alias("street"),
            F.floor(F.abs("c_acctbal")).cast("int").alias("number"),
            F.lit(None).cast("string").alias("floor"), F.lit(None).cast("string").alias("unit"),
            int_key(F.col("c_nationkey")).alias("town_id"), "c_nationkey"),
        "towns": nation.select(int_key(F.col("n_nationkey")).alias("id"),
                               F.col("n_name").alias("description"),
                               F.lpad(F.col("n_nationkey").cast("string"), 4, "0")
                               .alias("postcode"),
                               int_key(F.col("n_regionkey")).alias("province_id")),
        "provinces": region.select(int_key(F.col("r_regionkey")).alias("id"),
                                   F.col("r_name").alias("description"),
                                   int_key(F.floor(F.col("r_regionkey") / 3)).alias("country_id")),
        "countries": region.select(F.floor(F.col("r_regionkey") / 3).alias("c")).distinct().select(
            int_key(F.col("c")).alias("id"),
            F.concat(F.lit("Country "), F.col("c").cast("string")).alias("description")),
        "zones": dim("zone", customer, "c_mktsegment"),
        "types": dim("type", part, "p_type"),
        "kinds": kinds,
        "links": home.unionByName(billing).unionByName(second),
        "properties": customer.select(
            F.concat(F.lit("CAT-"), F.col("c_custkey")).alias("cadastral_no"),
            person.alias("owner_id"), person.alias("address_id"),
            stable_key(F.lit("zone"), segment).alias("zone_id"),
            F.lit(None).cast("binary").alias("type_id"), segment.alias("zone_name"),
            "c_acctbal"),
    }


def stored_model(spark: SparkSession, m: OrderModel) -> tuple[str, dict[str, str]]:
    """The order model written as its own tables; gives their folder, and the names of those that
    lie in buckets of the order."""
    folder = stage_path(spark, "oltp")
    orders = m.orders.withColumn("order_date", F.col("order_date").cast("date"))
    for name, df in {"customers": m.customers, "suppliers": m.suppliers,
                     "products": m.products}.items():
        write_table(df, f"{folder}/{name}")
    names = {name: stage_table(spark, name) for name in ("orders", "lines")}
    for name, df in {"orders": orders, "lines": m.lines}.items():
        write_bucketed(df, names[name], f"{folder}/{name}", "order_no", 8)
    return folder, names


def clustered_orders(spark: SparkSession, m: OrderModel) -> DataFrame:
    """The orders stored by date, with Bloom filters on number and identifier."""
    path = stage_path(spark, "orders")
    write_clustered(m.orders.withColumn("order_date", F.col("order_date").cast("date")), path,
                    "order_date", ["order_no", "order_id"], files=8)
    return spark.read.parquet(path)
