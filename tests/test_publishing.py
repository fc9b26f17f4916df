"""Tables that readers and repeated or failed jobs leave whole."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from orderdw.plans import warehouse
from orderdw.plans.warehouse import run_etl
from orderdw.sources import manifest
from orderdw.sources.files import create_text, folders
from orderdw.sources.parts import PartTable
from orderdw.sources.publish import Release, drop_replaced, load_published, published, refresh
from orderdw.sources.tables import write_table
from seed import seed


def _stored(spark, folder):
    m = seed(spark)
    for name in ("customers", "suppliers", "products", "orders", "lines"):
        write_table(getattr(m, name), f"{folder}/{name}")
    return m


TABLES = ["dim_customers", "dim_dates", "dim_products", "fact_orders"]


def _all(spark, target):
    return {n: sorted(load_published(spark, target, n).collect()) for n in TABLES}


@pytest.mark.parametrize("fails", ["dim_dates", "dim_products", "fact_orders"])
def test_a_failed_load_leaves_the_old_warehouse_whole(spark, tmp_path, monkeypatch, fails):
    source, target = f"{tmp_path}/source", f"{tmp_path}/dw"
    m = _stored(spark, source)
    run_etl(spark, source, target)
    old, opened = _all(spark, target), load_published(spark, target, "fact_orders")
    # Another state of the source, and a load that breaks on the way.
    write_table(m.lines.filter("line_no = 1"), f"{source}/lines", mode="overwrite")
    write_table(m.customers.withColumn("surname", F.lit("X")), f"{source}/customers", mode="overwrite")

    def broken(*args, **options):
        made = getattr(original, fails)(*args, **options)
        return made.withColumn(made.columns[0], F.raise_error(F.lit("broken")).cast(
            made.schema[0].dataType))

    class original:
        dim_dates = staticmethod(warehouse.dim_dates)
        dim_products = staticmethod(warehouse.dim_products)
        fact_orders = staticmethod(warehouse.fact_orders)

    monkeypatch.setattr(warehouse, fails, broken)
    with pytest.raises(Exception, match="broken"):
        run_etl(spark, source, target)
    assert _all(spark, target) == old and sorted(opened.collect()) == old["fact_orders"]
    assert len(folders(spark, f"{target}/releases")) == 1  # nothing of the failed load is left
    monkeypatch.undo()
    run_etl(spark, source, target)
    new = _all(spark, target)
    assert new["fact_orders"] != old["fact_orders"] and new["dim_customers"] != old["dim_customers"]
    assert sorted(opened.collect()) == old["fact_orders"]  # a reader that began before
    assert len(drop_replaced(spark, target)) == 4 and _all(spark, target) == new
    assert drop_replaced(spark, target) == []


def test_refresh_may_read_what_it_replaces(spark, tmp_path):
    target = f"{tmp_path}/t"
    refresh(spark.range(5).toDF("x"), target, "n")
    for _ in range(3):
        refresh(load_published(spark, target, "n").withColumn("x", F.col("x") + 1), target, "n")
    assert sorted(r.x for r in load_published(spark, target, "n").collect()) == [3, 4, 5, 6, 7]
    with Release(spark, target) as release:  # tables that a release does not name stay
        release.write("other", spark.range(1).toDF("y"))
    assert published(spark, target) == ["n", "other"]
    with pytest.raises(LookupError):
        load_published(spark, target, "none")
    empty = refresh(spark.range(0).toDF("x"), target, "n")
    assert empty.count() == 0 and empty.columns == ["x"]


def test_manifests_of_two_writers_and_of_a_broken_one(spark, tmp_path):
    folder = f"{tmp_path}/m"
    assert manifest.latest(spark, folder) == (0, None)
    calls = []

    def slow(now):
        calls.append(now)
        if len(calls) == 1:  # another writer comes first
            manifest.change(spark, folder, lambda now: ["other"])
        return [*(now or []), "mine"]

    assert manifest.change(spark, folder, slow) == ["other", "mine"] and calls == [None, ["other"]]
    assert create_text(spark, f"{folder}/{3:012d}", '["half')  # a writer that died
    assert manifest.latest(spark, folder) == (3, ["other", "mine"])
    manifest.change(spark, folder, lambda now: [*now, "next"])
    assert manifest.latest(spark, folder)[1] == ["other", "mine", "next"]
    for i in range(6):
        manifest.change(spark, folder, lambda now, i=i: [i])
    assert manifest.latest(spark, folder)[1] == [5]
    assert len(os.listdir(folder)) <= 2 * manifest.KEPT + 2


def _rows(spark, rows):
    return spark.createDataFrame(rows, "k long, day string, v long")


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    t = PartTable(spark, f"{tmp_path}/log", _rows(spark, []).schema, group="day")

    def now():
        return sorted((r.k, r.day, r.v) for r in t.read().collect())

    a, b = [(1, "d1", 1), (2, "d2", 1)], [(3, "d1", 1), (4, "d3", 1)]
    assert t.append(_rows(spark, a), "a") == ["d1", "d2"]
    for _ in range(2):
        t.append(_rows(spark, b), "b")
    assert now() == sorted(a + b)
    t.compact("d1")
    t.append(_rows(spark, b), "b")  # again, though its rows lie in a common part by now
    assert now() == sorted(a + b) and len(t.parts("d1")) == 2
    t.append(_rows(spark, [(5, "d2", 9)]), "a")  # other rows, and one day less
    assert now() == sorted([(5, "d2", 9)] + b)
    t.append(_rows(spark, []), "b")
    assert now() == [(5, "d2", 9)]
    t.compact_full(t.groups(), most=1)
    assert now() == [(5, "d2", 9)] and t.drop_replaced() > 0 and now() == [(5, "d2", 9)]
    whole = PartTable(spark, f"{tmp_path}/whole", _rows(spark, []).schema)
    assert whole.read().count() == 0
    for batch in ("x/1", "y", "x/1"):
        whole.append(_rows(spark, a), batch)
    assert sorted(r.k for r in whole.read().collect()) == [1, 1, 2, 2]


def test_compaction_while_a_batch_comes_again(spark, tmp_path):
    t = PartTable(spark, f"{tmp_path}/log", _rows(spark, []).schema)
    for batch in range(3):
        t.append(_rows(spark, [(batch, "d", 0)]), batch)

    def meanwhile(df):
        t.append(_rows(spark, [(1, "d", 1), (7, "d", 1)]), 1)
        t.append(_rows(spark, [(9, "d", 1)]), 9)
        return df

    t.compact(clean=meanwhile)
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(0, 0), (1, 1), (2, 0), (7, 1), (9, 1)]


def test_two_hundred_small_batches_become_one_folder(spark, tmp_path):
    t = PartTable(spark, f"{tmp_path}/log", _rows(spark, []).schema, group="day")
    small = spark.range(1)

    def clean(df):
        return df.dropDuplicates(["day", "k"])

    for i in range(200):  # each repeats a row of the batch before, and some come late
        day = "d1" if i % 10 else "d0"
        rows = small.select(F.explode(F.sequence(F.lit(max(0, i - 1)), F.lit(i))).alias("k"),
                            F.lit(day).alias("day"), F.lit(1).cast("long").alias("v")).coalesce(1)
        t.compact_full(t.append(rows, i), clean=clean)
    want = {(k, "d1" if i % 10 else "d0") for i in range(200) for k in (max(0, i - 1), i)}
    t.append(_rows(spark, [(41, "d1", 1), (40, "d1", 1)]), 41)
    for final in (False, True):
        if final:
            t.compact_full(t.groups(), most=1, clean=clean)
            assert [len(t.parts(d)) for d in t.groups()] == [1, 1]
            t.drop_replaced()
            assert len(folders(spark, f"{tmp_path}/log/parts")) == 2
        got = [(r.k, r.day) for r in clean(t.read()).collect()]
        assert len(got) == len(want) and set(got) == want
    assert len(t.read(["d1"]).inputFiles()) == 1
