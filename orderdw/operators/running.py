"""Running totals, last values and numbering that no single hot key can block.

A window over ``partitionBy(key)`` puts all rows of one key into one task. Here the rows are first
cut into blocks along (key, order), at limits that are fixed beforehand. Windows run inside a block;
the part that earlier blocks contribute is worked out on one row per (block, key) and joined back. A
key with a third of all rows is then spread over a third of the blocks. Where limits are moved to the
start of keys and no key is larger than a block, nothing is carried from block to block. Where only
the order within a key counts, rows are dealt to blocks by a hash of the key as long as that makes no
block too large: that needs no limits, and none is searched for each row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from orderdw.session import cut_and_measure, cut_lineage, drop_stage

SLOT, BLOCK = "_slot", "_block"
ROWS_PER_BLOCK = 1_000_000
SAMPLED_PER_BLOCK = 40
_PLACE_BITS = 33  # a slot is its block above this bit, and the place within the block
_STEPS = 1 << 40
_GROUPS = 1 << 16  # of keys, whose rows are counted together


class Slots(NamedTuple):
    rows: DataFrame  # the input with ``_block`` and ``_slot``
    blocks: int
    limits: Sequence[tuple] = ()  # where the blocks after the first begin
    spans: bool = True  # whether a key may lie in several blocks


def range_limits(df: DataFrame, order_cols: Sequence[str], rows: int, blocks: int) -> list:
    """Rows of ``order_cols`` that cut ``df`` into about ``blocks`` equal parts.

    They are quantiles of a sample that a hash of the columns picks, so they are the same whenever
    they are worked out. The sample that comes to the driver is as large as Spark's own range sort
    would take: some rows for each block.
    """
    share = min(1.0, SAMPLED_PER_BLOCK * blocks / max(1, rows))
    picked = df.select(*order_cols).filter(
        F.pmod(F.xxhash64(*order_cols), F.lit(_STEPS)) < F.lit(int(share * _STEPS)))
    sample = picked.sort(*order_cols).collect() if blocks > 1 else []
    cuts = [sample[i * len(sample) // blocks] for i in range(1, blocks)] if sample else []
    return list(dict.fromkeys(cuts))


def goes_on(limits: Sequence[tuple], keys: int) -> list[bool]:
    """For each limit whether its key (the first ``keys`` columns) begins in the block before."""
    return [i > 0 and tuple(limits[i - 1][:keys]) == tuple(x[:keys]) for i, x in enumerate(limits)]


def _at_keys(limits: list, keys: int) -> list[tuple]:
    """The limits moved to the start of their key, where no value is below NULL; a key with several
    limits is larger than a block, and keeps the others."""
    return [tuple(x) if on else (*x[:keys], *[None] * (len(x) - keys))
            for x, on in zip(limits, goes_on(limits, keys))]


def _with_block(df: DataFrame, order_cols: Sequence[str], limits: list) -> DataFrame:
    """``_block``: how many of the limits are not above the row, by binary search in a constant."""
    if not limits:
        return df.withColumn(BLOCK, F.lit(0))
    kind = T.StructType([T.StructField(c, df.schema[c].dataType) for c in order_cols])
    known = df.sparkSession.createDataFrame(
        [([tuple(x) for x in limits],)], T.StructType([T.StructField("limits", T.ArrayType(kind))]))
    steps = [F.lit(1 << i) for i in reversed(range(len(limits).bit_length()))]
    found = F.aggregate(F.array(*steps), F.lit(0), lambda at, step: F.when(
        (at + step <= len(limits)) & (F.get("_limits", at + step - 1) <= F.struct(*order_cols)),
        at + step).otherwise(at))
    return df.withColumn("_limits", known.scalar()).withColumn(BLOCK, found).drop("_limits")


def _group(keys: Sequence[str], groups: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int")


def _largest_group(df: DataFrame, keys: Sequence[str], groups: int) -> int:
    """Rows of the largest of so many groups of keys: no key has more."""
    return (df.groupBy(_group(keys, groups).alias("_group")).agg(F.count("*").alias("_rows"))
            .agg(F.max("_rows")).first()[0] or 0)


def slotted(df: DataFrame, order_cols: Sequence[str], label: str = "slots",
            rows_per_block: int | None = None, least: int = 1, keys: int = 0, apart: bool = False,
            **metrics: Column) -> tuple[Slots, dict]:
    """Add ``_slot``, a number that grows along ``order_cols`` over the whole table, and ``_block``.

    ``order_cols`` must tell every two rows apart. The rows are written once and counted on the way:
    there are as many blocks as make ``rows_per_block`` rows each (ROWS_PER_BLOCK), but ``least`` at
    the least. That is sizing only; the result does not depend on it. The limits between blocks are
    taken from the stored rows and fixed, so the sort inside the blocks may be done again wherever
    the rows are used, and gives the same slots. ``metrics`` are measured on the way.

    With ``keys``, the first so many columns are a key: only keys larger than a block are cut. With
    ``apart``, slots need to grow within a key only.
    """
    stored, seen = cut_and_measure(df, label, _rows=F.count("*"), **metrics)
    rows, size = seen.pop("_rows"), rows_per_block or ROWS_PER_BLOCK
    blocks = max(least, -(-rows // size))
    inside = Window.partitionBy(BLOCK).orderBy(*order_cols)
    slot = (F.shiftleft(F.col(BLOCK).cast("long"), _PLACE_BITS)
            + F.row_number().over(inside).cast("long") - 1)
    if (apart and blocks > least
            and _largest_group(stored, order_cols[:keys], blocks) <= 2 * size):
        dealt = stored.withColumn(BLOCK, _group(order_cols[:keys], blocks))
        return Slots(dealt.withColumn(SLOT, slot), blocks, (), False), seen
    limits = range_limits(stored, order_cols, rows, blocks)
    if keys:
        limits = _at_keys(limits, keys)
    cut = _with_block(stored, order_cols, limits).withColumn(SLOT, slot)
    return Slots(cut, len(limits) + 1, limits, not keys or any(goes_on(limits, keys))), seen


def running_before(slots: Slots, keys: Sequence[str], sums: Mapping[str, Column] | None = None,
                   last: Mapping[str, Column] | None = None) -> DataFrame:
    """Per row, totals (``sums``) and latest values (``last``) of the earlier rows of its key.

    ``slots`` comes from :func:`slotted`, ordered by ``keys`` first; its rows may since have been
    filtered or given more columns. Keys must not be NULL.

    Values go into the window as they are given: a plain column adds nothing to the shuffle, so
    two uses of the result that differ only in what they read share one shuffle.
    """
    sums, df = dict(sums or {}), slots.rows
    last = {n: F.struct(F.col(SLOT).alias("at"), c.alias("value"))
            for n, c in dict(last or {}).items()}
    merge = {**{n: F.sum for n in sums}, **{n: F.max for n in last}}
    values = {**sums, **last}

    in_block = (Window.partitionBy(BLOCK, *keys).orderBy(SLOT)
                .rowsBetween(Window.unboundedPreceding, -1))
    found = df.select("*", *[merge[n](c).over(in_block).alias(f"_w_{n}")
                                 for n, c in values.items()])
    carries = slots.blocks > 1 and slots.spans
    if carries:
        totals = df.groupBy(BLOCK, *keys).agg(
            *[merge[n](c).alias(f"_t_{n}") for n, c in values.items()])
        before = (Window.partitionBy(*keys).orderBy(BLOCK)
                  .rowsBetween(Window.unboundedPreceding, -1))
        # Only the first key of a block has rows in earlier blocks: one row per block is left.
        carried = (totals
                   .select(BLOCK, *keys, F.count("*").over(before).alias("_earlier"),
                           *[merge[n](f"_t_{n}").over(before).alias(f"_c_{n}") for n in values])
                   .filter("_earlier > 0").drop("_earlier"))
        found = found.join(carried, [BLOCK, *keys], "left")

    def both(n: str) -> list[Column]:
        return [F.col(f"_w_{n}"), *([F.col(f"_c_{n}")] if carries else [])]

    def total(n: str) -> Column:
        return reduce(add, [F.coalesce(c, F.lit(0).cast("long")) for c in both(n)])

    return found.select(
        *df.columns, *[total(n).alias(n) for n in sums],
        *[F.coalesce(*both(n))["value"].alias(n) for n in last])


def number_within(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                  name: str = "n") -> DataFrame:
    """Number the rows of each key from 0 along ``order_cols``.

    Where no key can have more rows than a block, one window over the keys does it, and what follows
    finds the rows dealt by key. The counts read nothing but the keys.
    """
    if _largest_group(df, keys, _GROUPS) <= ROWS_PER_BLOCK:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols))
        return df.withColumn(name, place.cast("long") - 1)
    slots, _ = slotted(df, [*keys, *order_cols], "within", keys=len(keys), apart=True)
    return running_before(slots, keys, sums={name: F.lit(1)}).drop(SLOT, BLOCK)


def assign_numbers(df: DataFrame, order_cols: Sequence[str], start: int = 1,
                   name: str = "order_no") -> DataFrame:
    """Gapless numbers over the whole table, counted per block and shifted by the blocks before.

    The rows are stored, sorted by range and stored again with their places, so that limits which
    Spark chose are chosen once.
    """
    stored, seen = cut_and_measure(df, "numbers", _rows=F.count("*"))
    blocks = max(1, -(-8 * seen["_rows"] // ROWS_PER_BLOCK))  # what follows reads a file of each
    place = F.monotonically_increasing_id()  # the task above bit 33, and the place in it
    rows = cut_lineage(stored.repartitionByRange(blocks, *order_cols)
                       .sortWithinPartitions(*order_cols).withColumn(SLOT, place), "placed")
    drop_stage(stored)
    rows = rows.withColumn(BLOCK, F.shiftright(SLOT, _PLACE_BITS))
    first = F.lit(1 << _PLACE_BITS).cast("long")
    # One row per block, whatever the table holds.
    counts = rows.groupBy(BLOCK).agg(F.count("*").alias("_rows"))
    before = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(BLOCK, F.coalesce(F.sum("_rows").over(before), F.lit(0))
                           .alias("_shift"))
    return (rows.join(F.broadcast(shifts), BLOCK)
            .withColumn(name, F.col(SLOT) % first + F.col("_shift") + F.lit(start))
            .select(*df.columns, name))
