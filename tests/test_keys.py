"""Deletes along foreign keys, all keys of a table in one pass, loose lookups, picks in one pass."""

import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from orderdw.operators.deletes import cascade_order, delete_along_keys
from orderdw.operators.quality import check_fk, check_model, check_not_null, check_unique
from orderdw.operators.sampling import lookup_key, pick_side_by_side
from orderdw.schemas import Keys
from orderdw.sources.tables import write_table
from orderdw.session import stage_path
from seed import number, seed

TREE = {
    "a": Keys(("id",)), "b": Keys(("id",), (), ((("a_id",), "a", ("id",)),)),
    "c": Keys(("id",), (), ((("b_id",), "b", ("id",)), (("a_id",), "a", ("id",)))),
    "d": Keys(("id",), (), ((("c_id",), "c", ("id",)),))}


def brute(rows, doomed, cascades):
    """Each doomed row by itself, with plain sets."""
    gone, blocked = {t: set() for t in rows}, set()
    for root in doomed:
        mine = {t: set() for t in rows}
        mine["a"] = {root} & set(rows["a"])
        for child in "bcd":
            for (fk,), parent, _ in TREE[child].foreign:
                if parent in cascades.get(child, ()):
                    mine[child] |= {i for i, r in rows[child].items() if r[fk] in mine[parent]}
        held = {(root, child) for child in "bcd" for (fk,), parent, _ in TREE[child].foreign
                if parent not in cascades.get(child, ())
                for i, r in rows[child].items() if r[fk] in mine[parent] and i not in mine[child]}
        blocked |= held
        if not held:
            for t in rows:
                gone[t] |= mine[t]
    return gone, blocked


@pytest.mark.parametrize("seed_no,cascades", [
    (1, {"b": {"a"}, "c": {"b"}}), (2, {"b": {"a"}, "c": {"a", "b"}, "d": {"c"}}),
    (3, {"c": {"a"}, "d": {"c"}}), (4, {})])
def test_deletes_like_plain_sets(spark, seed_no, cascades):
    rng = random.Random(seed_no)

    def some(n):
        return rng.choice([None, *range(n)]) if rng.random() < 0.9 else n + 5

    rows = {"a": {i: {} for i in range(12)},
            "b": {i: {"a_id": some(12)} for i in range(15)},
            "c": {i: {"b_id": some(15), "a_id": some(12)} for i in range(14)},
            "d": {i: {"c_id": some(14)} for i in range(6)}}
    frames = {t: spark.createDataFrame(
        [(i, *r.values(), "x") for i, r in rows[t].items()],
        "id long, " + "".join(f"{fk[0]} long, " for fk, _, _ in TREE[t].foreign) + "note string")
        for t in rows}
    doomed = [0, 1, 2, 3, 4, 5, 5, 99]
    got = delete_along_keys(frames, {"a": spark.createDataFrame([(i,) for i in doomed], "id long")},
                            cascades, TREE)
    gone, blocked = brute(rows, doomed, cascades)
    for t in rows:
        assert {r.id for r in got.tables[t].collect()} == set(rows[t]) - gone[t]
        assert got.tables[t].columns == frames[t].columns
        if t in got.gone:
            assert sorted(r.id for r in got.gone[t].collect()) == sorted(gone[t])
    assert {(int(r.key), r.by_table) for r in got.blocked.collect()} == blocked
    assert {r.table_name for r in got.blocked.collect()} <= {"a"}


def test_deletes_on_the_model_and_circles(spark):
    m = seed(spark)
    tables = {"customers": m.customers, "orders": m.orders, "lines": m.lines}
    got = delete_along_keys(tables, {"customers": m.customers.limit(1)},
                            {"orders": {"customers"}, "lines": {"orders"}})
    assert got.tables["customers"].count() == m.customers.count() - 1
    left = {r.order_no for r in got.tables["orders"].collect()}
    assert {r.order_no for r in got.tables["lines"].collect()} == left
    assert got.blocked.count() == 0
    none = delete_along_keys(tables, {"customers": m.customers.limit(0)}, {"orders": {"customers"}})
    assert none.tables["orders"].count() == m.orders.count()
    with pytest.raises(ValueError, match="circle"):
        cascade_order(["x"], [("y", "x"), ("z", "y"), ("y", "z")])
    with pytest.raises(ValueError, match="no foreign key"):
        delete_along_keys(tables, {"customers": m.customers}, {"lines": {"customers"}})
    assert cascade_order(["a"], [("d", "c"), ("c", "a"), ("b", "a"), ("c", "b")]) == list("abcd")


def test_all_keys_of_a_table_in_one_pass(spark):
    m = seed(spark)
    folder = stage_path(spark, "scan")
    gaps = m.lines.withColumn("quantity", F.when(F.col("line_no") > 1, F.col("quantity")))
    tables = {"orders": m.orders.filter("order_no <> 3"), "products": m.products,
              "lines": gaps.unionByName(gaps.limit(2))}
    read = {}
    for name, df in tables.items():
        write_table(df, f"{folder}/{name}")
        count = read[name] = spark.sparkContext.accumulator(0)

        def counted(batches, count=count):
            for batch in batches:
                count.add(batch.num_rows)
                yield batch

        stored = spark.read.parquet(f"{folder}/{name}")
        tables[name] = stored.mapInArrow(counted, stored.schema)
    sizes = {name: spark.read.parquet(f"{folder}/{name}").count() for name in tables}
    found = check_model(tables)
    got = sorted((r.table_name, r.columns, r.rule, r.key, r.rows) for r in found.collect())
    # Lines are read once more, to list those with a missing quantity.
    assert {n: c.value for n, c in read.items()} == {**sizes, "lines": 2 * sizes["lines"]}
    single = {n: spark.read.parquet(f"{folder}/{n}") for n in tables}
    want = [("lines", ", ".join(c), r.rule, r.key, r.rows) for c, rows in [
        (("line_id",), check_unique(single["lines"], ["line_id"])),
        (("order_no", "line_no"), check_unique(single["lines"], ["order_no", "line_no"])),
        (("order_no",), check_fk(single["lines"], single["orders"], ["order_no"]))]
        for r in rows.collect()]
    required = [f.name for f in m.lines.schema if f.name in (
        "line_id", "order_no", "line_no", "product_id", "quantity", "unit_price")]
    nulls = check_not_null(single["lines"], required, ["line_id"]).collect()
    assert len(nulls) >= 10 and any(w[2] == "foreign_key" for w in want)
    assert [g for g in got if g[2] != "not_null"] == sorted(want)
    assert len([g for g in got if g[2] == "not_null"]) == len(nulls)


def test_loose_lookup_is_a_join_on_equal_keys(spark):
    dim = spark.createDataFrame([(2, "Córdoba"), (1, "CORDOBA"), (3, "Salta"), (4, None)],
                                "id int, description string")
    rows = spark.createDataFrame([("cordoba",), ("CÓRDOBA",), ("salta",), ("jujuy",), (None,)],
                                 "zone string")
    got = lookup_key(rows, dim, "zone", loose=True)
    assert {r.zone: r.zone_id for r in got.collect()} == {
        "cordoba": 1, "CÓRDOBA": 1, "salta": 3, "jujuy": None, None: None}
    assert got.columns == ["zone", "zone_id"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashJoin" in plan or "SortMergeJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    exact = lookup_key(rows, dim, "zone").collect()
    assert {r.zone: r.zone_id for r in exact if r.zone_id} == {}


def test_picks_read_each_table_once(spark):
    folder = stage_path(spark, "picks")
    m = seed(spark)
    write_table(m.products, f"{folder}/products")
    write_table(m.customers, f"{folder}/customers")
    products = spark.read.parquet(f"{folder}/products")
    customers = spark.read.parquet(f"{folder}/customers")
    got = pick_side_by_side({"customer": (customers, "customer_id", None),
                             **{f"p{i}": (products, "product_id", "stock") for i in (1, 2, 3)},
                             "buyer": (customers, "customer_id", "surname")}, 7)
    row = got.collect()[0]
    assert got.columns == ["customer_id", "p1_id", "p1_stock", "p2_id", "p2_stock", "p3_id",
                           "p3_stock", "buyer_id", "buyer_surname"]
    stock = {number(r.product_id): r.stock for r in m.products.collect()}
    for i in (1, 2, 3):
        assert stock[int(row[f"p{i}_id"], 16)] == row[f"p{i}_stock"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    scans = plan.split("FileScan parquet")
    assert sum(f"{folder}/products".split(":")[-1] in s for s in scans) <= 1 + plan.count("ReusedSubquery")
    assert len({s.split("[")[1].split("]")[0] for s in scans[1:]}) == 2
    empty = pick_side_by_side({"a": (products.limit(0), "product_id", "stock")}, 1).collect()
    assert [tuple(r) for r in empty] == [(None, None)]
