"""Deletes along declared foreign keys, over as many tables as they reach."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from orderdw.schemas import KEYS, Keys
from orderdw.session import cut_lineage

CASCADE, RESTRICT = "cascade", "restrict"


class GraphDeletion(NamedTuple):
    tables: dict[str, DataFrame]  # what is left of each table
    gone: dict[str, DataFrame]    # the primary keys of what went, by table
    blocked: DataFrame            # table_name, key, by_table, rows: what stays, and what holds it


def _text(df: DataFrame, columns) -> Column:
    kinds = dict(df.dtypes)
    return F.concat_ws("|", *[F.lower(F.hex(c)) if kinds[c] == "binary" else F.col(c).cast("string")
                              for c in columns])


def cascade_order(start, edges) -> list[str]:
    """The tables that cascades reach from those of ``start``, parents before children. ``edges``
    are (child, parent); a cycle is refused."""
    reached, growing = list(dict.fromkeys(start)), True
    while growing:
        more = [c for c, p in edges if p in reached and c not in reached]
        reached += dict.fromkeys(more)
        growing = bool(more)
    order: list[str] = []
    while len(order) < len(reached):
        ready = [t for t in reached if t not in order
                 and all(p in order or p not in reached for c, p in edges if c == t)]
        if not ready:
            raise ValueError("cascades run in a circle through "
                             + ", ".join(sorted(set(reached) - set(order))))
        order += ready
    return order


def delete_along_keys(tables: Mapping[str, DataFrame], doomed: Mapping[str, DataFrame],
                      cascades: Mapping[str, set[str]], keys: Mapping[str, Keys] = KEYS
                      ) -> GraphDeletion:
    """Delete rows with all that hangs on them.

    ``doomed`` has, by table, the primary keys of the rows to delete. ``cascades`` names for a
    child table the parents whose rows take it along; all other foreign keys restrict. Each doomed
    row is a delete of its own on the tables as they are: it goes with the whole closure of its
    cascades, or stays whole where a row outside its closure refers to a part of it by a
    restricting key. Keys that are NULL refer to nothing; a doomed key that does not exist is left
    out; tables that are not given refer to nothing. A cycle of cascades is refused.

    A closure is one join per cascading key. Rows carry the doomed row that they belong to, so a row
    that two doomed rows reach goes if one of them may go.
    """
    edges = [(child, parent) for child in tables for parent in cascades.get(child, ())
             if parent in tables]
    for child, parent in edges:
        if not any(p == parent for _, p, _ in keys[child].foreign):
            raise ValueError(f"{child} has no foreign key to {parent}")
    order = cascade_order(doomed, edges)

    def columns(name: str) -> list[str]:
        """A table's primary key and what other tables refer to."""
        asked = [c for t in tables for _, p, targets in keys[t].foreign if p == name
                 for c in targets]
        return list(dict.fromkeys([*keys[name].primary, *asked]))

    def referring(child: str, fk, parent: str, targets) -> DataFrame:
        """Rows of ``child`` that refer to reached rows of ``parent``, with their roots."""
        own = tables[child].select(*dict.fromkeys([*columns(child), *fk]))
        roots = reached[parent].select("_root", *[F.col(t).alias(f"_to{i}")
                                                  for i, t in enumerate(targets)])
        same = reduce(Column.__and__, [own[c] == roots[f"_to{i}"] for i, c in enumerate(fk)])
        return own.join(roots, same).select("_root", *columns(child))

    reached: dict[str, DataFrame] = {}
    for name in order:
        found = []
        if name in doomed:
            primary = list(keys[name].primary)
            asked = doomed[name].select(*primary).distinct()
            mine = tables[name].select(*columns(name)).join(asked, primary, "left_semi")
            found.append(mine.select(F.struct(F.lit(name).alias("table_name"),
                                              _text(mine, primary).alias("key")).alias("_root"),
                                     *columns(name)))
        for fk, parent, targets in keys[name].foreign:
            if parent in cascades.get(name, ()) and parent in reached:
                found.append(referring(name, fk, parent, targets))
        reached[name] = cut_lineage(reduce(DataFrame.unionByName, found).distinct(), "reached")

    held = []
    for child in tables:
        for fk, parent, targets in keys[child].foreign:
            if parent not in reached or parent in cascades.get(child, ()):
                continue
            rows = referring(child, fk, parent, targets)
            if child in reached:  # rows that go with the same root hold nothing
                rows = rows.join(reached[child].select("_root", *keys[child].primary),
                                 ["_root", *keys[child].primary], "left_anti")
            held.append(rows.groupBy("_root").agg(F.count("*").alias("rows"))
                        .select("_root", F.lit(child).alias("by_table"), "rows"))
    if held:
        blocked = cut_lineage(reduce(DataFrame.unionByName, held).groupBy("_root", "by_table")
                              .agg(F.sum("rows").alias("rows")), "blocked")
    else:
        blocked = reached[order[0]].limit(0).select(
            "_root", F.lit("").alias("by_table"), F.lit(0).cast("long").alias("rows"))
    stays = blocked.select("_root").distinct()
    gone = {name: rows.join(stays, "_root", "left_anti").select(*keys[name].primary).distinct()
            for name, rows in reached.items()}
    left = {name: df.join(gone[name], list(keys[name].primary), "left_anti").select(df.columns)
            if name in gone else df for name, df in tables.items()}
    return GraphDeletion(left, gone, blocked.select("_root.*", "by_table", "rows"))
