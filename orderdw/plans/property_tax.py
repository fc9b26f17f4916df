"""Owners, properties and their yearly instalments."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderdw.functions.ids import hex_text
from orderdw.functions.scalars import due_date
from orderdw.operators.sampling import lookup_key, pick_within


PROPERTIES_PER_TASK = 100_000


def generate_instalments(properties: DataFrame, year: int, value: Decimal | str) -> DataFrame:
    """One unpaid instalment per property and month of ``year``, due on the 15th.

    The properties are counted and dealt out first: twelve rows come of each, and a task that reads
    a whole file of properties would hand on, or count by key, twelve times that file.
    """
    named = properties.select("cadastral_no")
    tasks = -(-named.count() // PROPERTIES_PER_TASK)
    dealt = named.repartition(tasks) if tasks > 1 else named
    months = dealt.select("cadastral_no", F.explode(F.sequence(F.lit(1), F.lit(12)))
                          .alias("instalment_no"))
    return months.select(
        "cadastral_no", F.lit(year).alias("year"), "instalment_no",
        F.lit(Decimal(value)).cast("decimal(12,2)").alias("value"),
        due_date(year, F.col("instalment_no")).alias("due_date"),
        F.lit(None).cast("date").alias("paid_date"), F.lit(False).alias("paid"))


def assign_town(addresses: DataFrame, towns: DataFrame, provinces: DataFrame,
                seed: int | str) -> DataFrame:
    """Give each address a random town of the province it names in its ``province`` column,
    whatever its case and accents.

    An address with a NULL or unknown province gets no town.
    """
    keyed = lookup_key(addresses, provinces, "province", name="_province_id", loose=True)
    pool = towns.select(F.col("province_id").alias("_province_id"), "id")
    return (pick_within(keyed.drop("town_id"), pool, ["_province_id"], "id", seed, hex_text("id"),
                        "town_id")
            .drop("_province_id"))


def assign_dim(df: DataFrame, dim: DataFrame, seed: int | str, name: str, row_key: Column,
               fixed: str | None = None) -> DataFrame:
    """Add the key of a zone or type: the named one where ``fixed`` holds a description (whatever
    its case and accents), a random one elsewhere."""
    if fixed is None:
        return pick_within(df, dim.select("id"), [], "id", seed, row_key, name)
    named = lookup_key(df, dim, fixed, name="_named", loose=True)
    picked = pick_within(named, dim.select("id"), [], "id", seed, row_key, "_picked")
    chosen = F.when(F.col(fixed).isNull(), F.col("_picked")).otherwise(F.col("_named"))
    return picked.withColumn(name, chosen).drop("_named", "_picked")


def addresses_by_kind(owners: DataFrame, links: DataFrame, addresses: DataFrame,
                      kinds: DataFrame) -> DataFrame:
    """Owners with each of their addresses and its kind (home, billing, ...)."""
    typed = links.join(kinds.select(F.col("id").alias("kind_id"),
                                    F.col("description").alias("kind")), "kind_id")
    placed = typed.join(addresses.withColumnRenamed("id", "address_id"), "address_id")
    return placed.join(owners.withColumnRenamed("id", "owner_id"), "owner_id").select(
        "owner_id", "surnames", "names", "kind", "address_id", "street", "number", "floor", "unit",
        "town_id")


def addresses_side_by_side(by_kind: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """One address column per kind; ``kinds`` maps column to kind.

    The addresses of an owner and kind are numbered in text order, and there is one row per owner
    and number (``position`` from 1), so that no address is left out.
    """
    text = F.concat_ws(" ", "street", F.col("number").cast("string"), "floor", "unit")
    who = ["owner_id", "surnames", "names"]
    # The key of the link is owner, address and kind, so the list of one owner is short.
    place = Window.partitionBy("owner_id", "kind").orderBy("_text", "address_id")
    numbered = (by_kind.withColumn("_text", text)
                .withColumn("position", F.row_number().over(place)))
    return numbered.groupBy(*who, "position").agg(
        *[F.max(F.when(F.col("kind") == kind, F.col("_text"))).alias(name)
          for name, kind in kinds.items()])


def with_place(addresses: DataFrame, towns: DataFrame, provinces: DataFrame,
               countries: DataFrame) -> DataFrame:
    """Addresses with the names of town, province and country; gaps stay NULL."""
    def named(dim: DataFrame, key: str, label: str, *more: str) -> DataFrame:
        return dim.select(F.col("id").alias(key), F.col("description").alias(label), *more)

    return (addresses.join(named(towns, "town_id", "town", "postcode", "province_id"), "town_id",
                           "left")
            .join(named(provinces, "province_id", "province", "country_id"), "province_id", "left")
            .join(named(countries, "country_id", "country"), "country_id", "left"))


def instalment_report(owners: DataFrame, properties: DataFrame, instalments: DataFrame,
                      addresses: DataFrame, towns: DataFrame, provinces: DataFrame,
                      countries: DataFrame, zones: DataFrame, types: DataFrame,
                      year: int) -> DataFrame:
    """Owner, property, and value and due date of each instalment of the year.

    Everything about a property is looked up once per property, before the instalments join it.
    """
    place = with_place(addresses, towns, provinces, countries).select(
        F.col("id").alias("address_id"), "street", "number", "town", "province", "country")
    described = (properties
                 .join(owners.withColumnRenamed("id", "owner_id"), "owner_id")
                 .join(place, "address_id", "left")
                 .join(zones.select(F.col("id").alias("zone_id"),
                                    F.col("description").alias("zone")), "zone_id", "left")
                 .join(types.select(F.col("id").alias("type_id"),
                                    F.col("description").alias("property_type")), "type_id",
                       "left"))
    due = instalments.filter(F.col("year") == year).select(
        "cadastral_no", "year", "instalment_no", "value", "due_date")
    return described.join(due, "cadastral_no").select(
        "surnames", "names", "cadastral_no", "property_type", "zone", "street", "number", "town",
        "province", "country", "year", "instalment_no", "value", "due_date")
