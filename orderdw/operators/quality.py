"""Table constraints as jobs that list what breaks them.

Each check gives rows ``(rule, key, rows, message)``; an empty result means the rule holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StructType

from orderdw.functions.ids import is_uuid
from orderdw.functions.scalars import STOCK_BOUNDS, message
from orderdw.schemas import KEYS, TABLES, Keys
from orderdw.session import cut_lineage


class BrokenRule(ValueError):
    pass


def _key_text(df: DataFrame, keys: Sequence[str]) -> Column:
    kinds = dict(df.dtypes)
    parts = [F.lower(F.hex(k)) if kinds[k] == "binary" else F.col(k).cast("string") for k in keys]
    return F.concat_ws("|", *[F.coalesce(p, F.lit("NULL")) for p in parts])


def _violations(df: DataFrame, rule: str, keys: Sequence[str], text: Column,
                rows: Column | None = None) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), _key_text(df, keys).alias("key"),
                     (F.lit(1) if rows is None else rows).cast("long").alias("rows"),
                     text.alias("message"))


def enforce(violations: DataFrame) -> DataFrame:
    """The strict form of any check: raise on the first violation found."""
    found = violations.take(1)
    if found:
        raise BrokenRule(f"{found[0]['rule']} broken for {found[0]['key']}: {found[0]['message']}")
    return violations


def check_not_null(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    bad = df.withColumn("_missing", missing).filter(F.col("_missing") != "")
    return _violations(bad, "not_null", keys, F.concat(F.lit("NULL in "), F.col("_missing")))


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counting is combined before the shuffle, so a value that repeats endlessly costs little."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter("_rows > 1")
    return _violations(repeated, "unique", keys, message("%d rows with this key", "_rows"),
                       F.col("_rows"))


def check_fk(child: DataFrame, parent: DataFrame, keys: Sequence[str],
             parent_keys: Sequence[str] | None = None) -> DataFrame:
    """Key values of ``child`` that ``parent`` lacks. NULL keys refer to nothing and pass.

    The child's keys are counted first, so the join sees each value once.
    """
    used = child.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("_rows"))
    known = parent.select(*[F.col(p).alias(k) for p, k in zip(parent_keys or keys, keys)])
    orphans = used.join(known, list(keys), "left_anti")
    return _violations(orphans, "foreign_key", keys, message("no parent for %d rows", "_rows"),
                       F.col("_rows"))


def check_values(df: DataFrame, col: str, values: Sequence[str], keys: Sequence[str]) -> DataFrame:
    bad = df.filter(~F.col(col).isin(list(values)))
    return _violations(bad, "allowed_values", keys,
                       F.concat(F.lit(f"{col} is "), F.col(col).cast("string")))


def check_stock_bounds(products: DataFrame) -> DataFrame:
    """New products must come with a stock between their minimum and maximum."""
    bad = products.filter((F.col("stock") < F.col("stock_min"))
                          | (F.col("stock") > F.col("stock_max")))
    return _violations(bad, "stock_bounds", ["product_id"],
                       message(STOCK_BOUNDS, "stock", "stock_min", "stock_max"))


def check_uuid(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    bad = df.filter(~F.coalesce(is_uuid(col), F.lit(False)))
    return _violations(bad, "uuid_format", keys,
                       F.concat(F.lit(f"{col} is not a UUID: "),
                                F.coalesce(F.col(col), F.lit("NULL"))))


def check_model(tables: Mapping[str, DataFrame], keys: Mapping[str, Keys] = KEYS,
                layouts: Mapping[str, StructType] = TABLES) -> DataFrame:
    """All declared rules of a model at once: required columns, primary, unique and foreign keys.

    ``tables`` are the model's tables by name; a foreign key to a table that is not given is left
    out. Gives the rows of the single checks with the ``table_name`` and the ``columns`` they are
    about.

    Each table is read once: its rows are counted by all its keys together (grouping sets), and its
    missing values on the way. Of the counts, those are stored that break a rule by themselves, or
    that a foreign key compares; both sides of that comparison are then at hand. A table is read
    again only to list rows with missing values, where there are any.
    """
    found = []

    def add(name: str, columns: Sequence[str], rows: DataFrame) -> None:
        found.append(rows.select(F.lit(name).alias("table_name"),
                                 F.lit(", ".join(columns)).alias("columns"), "*"))

    foreign = {name: [fk for fk in keys[name].foreign if fk[1] in tables] for name in tables}
    compared = {(parent, targets) for fks in foreign.values() for _, parent, targets in fks}
    compared |= {(name, columns) for name, fks in foreign.items() for columns, _, _ in fks}
    counted = {name: _key_counts(df, name, keys[name], layouts[name], compared)
               for name, df in tables.items()}

    for name, df in tables.items():
        own, (counts, missing) = keys[name], counted[name]
        if any(missing.values()):
            required = list(missing)
            add(name, required, check_not_null(df, required, own.primary or required))
        for columns in [own.primary, *own.unique]:
            if columns:
                repeated = counts[columns].filter("_rows > 1")
                add(name, columns, _violations(
                    repeated, "unique", columns, message("%d rows with this key", "_rows"),
                    F.col("_rows")))
        for columns, parent, targets in foreign[name]:
            used = counts[columns].dropna(subset=list(columns))
            known = counted[parent][0][targets].select(
                *[F.col(t).alias(c) for t, c in zip(targets, columns)])
            add(name, columns, _violations(
                used.join(known, list(columns), "left_anti"), "foreign_key", columns,
                message("no parent for %d rows", "_rows"), F.col("_rows")))
    if not found:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "table_name string, columns string, rule string,"
                                         " key string, rows long, message string")
    return reduce(DataFrame.unionByName, found)


def _key_counts(df: DataFrame, name: str, own: Keys, layout: StructType, compared: set
                ) -> tuple[dict[tuple[str, ...], DataFrame], dict[str, int]]:
    """Rows by each key of a table (``_rows``), and how many values its required columns miss."""
    required = [f.name for f in layout.fields if not f.nullable and f.name in df.columns]
    sets = list(dict.fromkeys(
        [k for k in (own.primary, *own.unique) if k] + [c for c, _, _ in own.foreign
                                                        if (name, c) in compared]
        + sorted(t for n, t in compared if n == name)))
    nulls = {c: F.count(F.when(F.col(c).isNull(), 1)) for c in required}
    seen = Observation()
    watched = df.observe(seen, F.count("*"), *[c.alias(n) for n, c in nulls.items()])
    columns = list(dict.fromkeys(c for k in sets for c in k))
    if not columns:
        missing = df.agg(*[c.alias(n) for n, c in nulls.items()]).first().asDict() if nulls else {}
        return {}, missing

    def number(key: tuple[str, ...]) -> int:
        """What Spark calls a grouping set: a bit for each column that it leaves out."""
        return sum(1 << i for i, c in enumerate(reversed(columns)) if c not in key)

    grouped = watched.select(*columns, *[c for c in required if c not in columns]).groupingSets(
        sets, *columns).agg(F.grouping_id(*columns).alias("_set"), F.count("*").alias("_rows"))
    kept = (F.col("_rows") > 1) | F.col("_set").isin([number(k) for k in sets
                                                      if (name, k) in compared])
    stored = cut_lineage(grouped.filter(kept), "keys")
    counts = {k: stored.filter(F.col("_set") == number(k)).select(*k, "_rows") for k in sets}
    return counts, {n: seen.get[n] for n in required}


class Deletion(NamedTuple):
    parent: DataFrame
    child: DataFrame
    blocked: DataFrame


def delete_with_children(parent: DataFrame, child: DataFrame, doomed: DataFrame, parent_key: str,
                         child_key: str, mode: str = "restrict") -> Deletion:
    """Delete the parents named in ``doomed[parent_key]``.

    ``cascade`` deletes their children too. ``restrict`` keeps parents that have children and
    lists them in ``blocked``.
    """
    doomed = doomed.select(parent_key).distinct()
    with_children = child.select(F.col(child_key).alias(parent_key)).distinct()
    if mode == "cascade":
        gone = doomed.withColumnRenamed(parent_key, child_key)
        return Deletion(parent.join(doomed, parent_key, "left_anti"),
                        child.join(gone, child_key, "left_anti"), doomed.limit(0))
    if mode != "restrict":
        raise ValueError(f"unknown mode: {mode}")
    blocked = doomed.join(with_children, parent_key, "left_semi")
    free = doomed.join(with_children, parent_key, "left_anti")
    return Deletion(parent.join(free, parent_key, "left_anti"), child, blocked)
