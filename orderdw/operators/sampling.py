"""Random picks that come out the same in every run, and lookups by description."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orderdw.functions.ids import hex_text
from orderdw.functions.scalars import loose_text
from orderdw.operators.running import assign_numbers, number_within


def draw(seed: int | str, *cols: Column | str) -> Column:
    """Hex text that is as good as random but depends on the values and the seed alone."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts], F.lit(str(seed))))


def draw_below(limit: Column, seed: int | str, *cols: Column | str) -> Column:
    """A whole number from 0 up to ``limit``, not included."""
    return F.conv(F.substring(draw(seed, *cols), 1, 8), 16, 10).cast("long") % limit


def random_pick(df: DataFrame, key: Column, seed: int | str, n: int = 1) -> DataFrame:
    """``n`` rows at random. Spark keeps only the best ``n`` of each partition while it sorts."""
    return (df.withColumn("_draw", draw(seed, key)).orderBy("_draw", key).limit(n)
            .drop("_draw"))


def pick_side_by_side(picks: Mapping[str, tuple[DataFrame, str, str | None]],
                      seed: int | str) -> DataFrame:
    """Independent random picks in one row.

    ``picks`` maps a label to (table, id column, extra column or None). All picks of a table are one
    aggregate that keeps the best row of each pick's own order, so a table is read once. The tables'
    values stand side by side as scalar subqueries of one row each.
    """
    by_table: dict[int, list[str]] = {}
    for label, (df, _, _) in picks.items():
        by_table.setdefault(id(df), []).append(label)
    rows = []
    for labels in by_table.values():
        best = []
        for label in labels:
            _, key, extra = picks[label]
            shown = [hex_text(key).alias("id"), *([F.col(extra).alias("extra")] if extra else [])]
            order = F.struct(draw(f"{seed}/{label}", hex_text(key)), hex_text(key))
            best.append(F.min_by(F.struct(*shown), order).alias(label))
        rows.append(picks[labels[0]][0].agg(*best))
    first, *others = rows
    for n, (row, labels) in enumerate(zip(others, list(by_table.values())[1:])):
        whole = row.select(F.struct(*labels)).scalar()
        first = first.withColumn(f"_t{n}", whole).select("*", f"_t{n}.*").drop(f"_t{n}")
    return first.select(*[c for label, (_, _, extra) in picks.items() for c in (
        F.col(f"{label}.id").alias(f"{label}_id"),
        *([F.col(f"{label}.extra").alias(f"{label}_{extra}")] if extra else []))])


def lookup_key(df: DataFrame, dim: DataFrame, text_col: str, key_col: str = "id",
               dim_text: str = "description", name: str | None = None,
               loose: bool = False) -> DataFrame:
    """Replace a description by the key of the dimension row that has it (smallest key if several).

    ``loose`` compares as the database does, without regard to case and accents: the text is joined
    under a collation, which Spark hashes by its collation key. Unknown descriptions give NULL.
    """
    name = name or f"{text_col}_id"

    def text(column: str) -> Column:
        return loose_text(F.col(column)) if loose else F.col(column)

    keys = dim.groupBy(text(dim_text).alias("_text")).agg(F.min(key_col).alias(name))
    return df.join(keys, text(text_col) == F.col("_text"), "left").drop("_text")


def pick_within(df: DataFrame, pool: DataFrame, on: Sequence[str], pool_key: str,
                seed: int | str, row_key: Column, name: str) -> DataFrame:
    """For each row, a random ``pool_key`` among the pool rows that share ``on``.

    The pool is numbered within ``on``; a row draws a number and joins on it, so no list of
    candidates is ever built. With ``on`` empty the whole pool is eligible; its size is then one
    value, computed as a scalar subquery.
    """
    if on:
        numbered = number_within(pool.select(*on, pool_key).dropna(subset=list(on)), on, [pool_key],
                                 "_n")
        sizes = numbered.groupBy(*on).agg(F.count("*").alias("_size"))
        drawn = df.join(sizes, list(on), "left").withColumn(
            "_n", draw_below(F.col("_size"), seed, row_key)).drop("_size")
    else:
        numbered = assign_numbers(pool.select(pool_key), [pool_key], start=0, name="_n")
        size = numbered.select(F.count("*")).scalar()
        drawn = df.withColumn("_n", draw_below(size, seed, row_key))
    return drawn.join(numbered.withColumnRenamed(pool_key, name), [*on, "_n"], "left").drop("_n")
