"""Append-only tables in parts: an append can be repeated, and many small parts become one.

A part holds the rows of a batch for one group (a day, say). Each group has a manifest of its own,
so an append looks at the groups that it touches only. A batch that comes again replaces its former
part. Compaction puts the parts of a group into one; the batches it holds are noted, so a batch that
comes again after that replaces its rows there too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from urllib.parse import quote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderdw.sources.files import folders, remove, size_of
from orderdw.sources.manifest import change, latest
from orderdw.sources.tables import write_table

BATCH = "_batch"
ALL = "all"  # the group of a table without groups
PARTS_BEFORE_COMPACTION = 16
FILE_BYTES = 128 << 20


class PartTable:
    """``group`` names the column whose values are the groups (dates or plain names), if there is
    one. Rows are read with ``schema``, the group's column included, and without their batch."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType,
                 group: str | None = None) -> None:
        self.spark, self.root, self.schema, self.group = spark, root, schema, group
        self.stored = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])

    def _manifest(self, group: str) -> str:
        return f"{self.root}/manifest/group={group}"

    def groups(self) -> list[str]:
        return sorted(folders(self.spark, f"{self.root}/manifest", "group"))

    def parts(self, group: str = ALL) -> list[dict]:
        """The parts in force: path below the root, the batches it holds, those replaced since."""
        return latest(self.spark, self._manifest(group))[1] or []

    def append(self, df: DataFrame, batch: str | int) -> list[str]:
        """Add the rows of a batch, in place of those it has added before; gives its groups.

        Rows of a batch go to their groups' parts in one write. The manifests follow group by group;
        where that is cut short, the batch is to be run again, as the writer of a stream does.
        """
        batch, name = str(batch), f"parts/{uuid4().hex}"
        rows = df.select(*self.schema.fieldNames()).withColumn(BATCH, F.lit(batch))
        if self.group:
            rows = rows.withColumn("_group", F.col(self.group).cast("string")).repartition("_group")
        write_table(rows, f"{self.root}/{name}", partition_by=["_group"] if self.group else [])
        written = ({g: f"{name}/_group={g}" for g in folders(
            self.spark, f"{self.root}/{name}", "_group")} if self.group else {ALL: name})
        # The batch's groups are noted first: a run that was cut short, or one with other rows, may
        # have left some in groups that it no longer touches.
        noted = change(self.spark, f"{self.root}/batches/{quote(batch, safe='')}",
                       lambda now: sorted({*(now or []), *written}))
        for group in noted:
            change(self.spark, self._manifest(group), lambda now, group=group: _replaced(
                now or [], batch, written.get(group)))
        return sorted(written)

    def replace(self, df: DataFrame) -> list[str]:
        """The rows of each group take the place of all that it held; gives the groups."""
        name = f"parts/{uuid4().hex}"
        rows = df.select(*self.schema.fieldNames()).withColumn(BATCH, F.lit("")).withColumn(
            "_group", F.col(self.group).cast("string"))
        write_table(rows.repartition("_group"), f"{self.root}/{name}", partition_by=["_group"])
        written = folders(self.spark, f"{self.root}/{name}", "_group")
        for group in written:
            part = {"path": f"{name}/_group={group}", "batches": [""], "without": []}
            change(self.spark, self._manifest(group), lambda _, part=part: [part])
        return sorted(written)

    def compact(self, group: str = ALL,
                clean: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
        """Put the parts of a group into one. ``clean`` may remove repeated rows on the way; it gets
        and keeps the rows' batch (``_batch``). Parts that come meanwhile stay beside it."""
        old = self.parts(group)
        if len(old) < 2:
            return
        name = f"parts/{uuid4().hex}"
        write_table(clean(self._of(old)).coalesce(self._files(old)), f"{self.root}/{name}")
        batches = sorted({b for p in old for b in p["batches"] if b not in p["without"]})
        paths = {p["path"] for p in old}

        def to(now: list[dict]) -> list[dict]:
            kept = [p for p in now if p["path"] not in paths]
            alive = {b for p in now if p["path"] in paths for b in p["batches"]
                     if b not in p["without"]}
            return [{"path": name, "batches": batches,
                     "without": sorted(set(batches) - alive)}, *kept]

        change(self.spark, self._manifest(group), to)

    def _files(self, parts: list[dict]) -> int:
        """As many files as make FILE_BYTES each."""
        return 1 + sum(size_of(self.spark, f"{self.root}/{p['path']}") for p in parts) // FILE_BYTES

    def compact_full(self, groups: Iterable[str], most: int = PARTS_BEFORE_COMPACTION,
                     clean: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
        """Compact those of ``groups`` that have more than ``most`` parts."""
        for group in groups:
            if len(self.parts(group)) > most:
                self.compact(group, clean)

    def _of(self, parts: list[dict]) -> DataFrame:
        """Rows with their batch. Whole parts are read together, the others each with a filter."""
        whole = [p for p in parts if not p["without"]]
        frames = [self.spark.read.schema(self.stored).parquet(
            *[f"{self.root}/{p['path']}" for p in whole])] if whole else []
        frames += [self.spark.read.schema(self.stored).parquet(f"{self.root}/{p['path']}")
                   .filter(~F.col(BATCH).isin(p["without"])) for p in parts if p["without"]]
        if not frames:
            return self.spark.createDataFrame([], self.stored)
        return reduce(DataFrame.unionByName, frames)

    def read(self, groups: Iterable[str] | None = None) -> DataFrame:
        """The rows of some groups, or of all."""
        groups = self.groups() if groups is None else groups
        return self._of([p for g in groups for p in self.parts(str(g))]).drop(BATCH)

    def drop_replaced(self) -> int:
        """Remove the parts that no manifest names, once nobody reads them any more."""
        live = {p["path"] for g in self.groups() for p in self.parts(g)}
        gone = 0
        for name, path in folders(self.spark, f"{self.root}/parts").items():
            inside = folders(self.spark, path, "_group")
            dead = {f"parts/{name}/_group={g}": p for g, p in inside.items()} or {
                f"parts/{name}": path}
            dead = {n: p for n, p in dead.items() if n not in live}
            for p in dead.values():
                remove(self.spark, p)
            gone += len(dead)
            if inside and len(dead) == len(inside):
                remove(self.spark, path)
        return gone


def _replaced(now: list[dict], batch: str, path: str | None) -> list[dict]:
    """The parts with the rows of ``batch`` at ``path`` (or nowhere) instead of where they were."""
    new = []
    for p in now:
        if batch in p["batches"] and batch not in p["without"]:
            p = {**p, "without": sorted([*p["without"], batch])}
        if set(p["batches"]) - set(p["without"]):
            new.append(p)
    return new + ([{"path": path, "batches": [batch], "without": []}] if path else [])
