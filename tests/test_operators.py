"""Operators against plain sequential code on small random batches."""

import random
from collections import defaultdict
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from orderdw.functions import ids, scalars
from orderdw.operators import allocation, running
from orderdw.operators.allocation import allocate, explain_rejects
from orderdw.operators.running import assign_numbers, number_within, running_before, slotted
from orderdw.operators.sampling import lookup_key, pick_side_by_side, pick_within, random_pick
from orderdw.session import CLEANUP, checkpoint_dir, cut_lineage, stage_path
from orderdw.sources.files import remove
from seed import key, number, seed, uuid_text

real = running.cut_and_measure


def sequential(stock, orders):
    """orders: (no, takes, [(product, quantity)]) in order; gives rejected {no: (p, avail, q)}."""
    stock, rejected = dict(stock), {}
    for no, takes, items in orders:
        trial = dict(stock)
        for p, q in items:
            if p not in trial:
                rejected[no] = (p, None, q)
                break
            if trial[p] < q:
                rejected[no] = (p, trial[p], q)
                break
            if takes:
                trial[p] -= q
        else:
            stock = trial
    return rejected, stock


def batch(rng, n, hot=False, negative=False):
    orders = []
    for no in range(1, n + 1):
        items = []
        for _ in range(rng.randint(1, 3)):
            p = 1 if hot and rng.random() < 0.6 else rng.randint(1, 6)
            items.append((p, rng.randint(-4 if negative else 0, 12)))
        if rng.random() < 0.03:
            items.append((99, 1))
        orders.append((no, rng.random() < 0.7, items))
    return {p: rng.randint(0, 60) for p in range(1, 7)}, orders


@pytest.mark.parametrize("seed_no, hot, negative, block_rows", [
    (1, False, False, 1_000_000), (2, True, False, 40), (3, True, True, 7), (4, False, True, 40),
    (5, True, False, 3), (6, True, True, 1_000_000)])
def test_allocate_like_a_loop(spark, monkeypatch, seed_no, hot, negative, block_rows):
    """One block of rows, a few, or about fifty give the same result."""
    monkeypatch.setattr(running, "ROWS_PER_BLOCK", block_rows)
    stock, orders = batch(random.Random(seed_no), 150, hot, negative)
    want, left = sequential(stock, orders)
    rows = [(no, i, p, q) for no, _, items in orders for i, (p, q) in enumerate(items)]
    lines = spark.createDataFrame(rows, "order_no long, line_no int, product_id long, quantity int")
    lines = lines.withColumn("product_id", F.unhex(F.lpad(F.hex("product_id"), 32, "0")))
    heads = spark.createDataFrame([(no, "confirmado" if t else "pendiente")
                                   for no, t, _ in orders], "order_no long, state string")
    products = spark.createDataFrame([(key(p), f"product {p}", s) for p, s in stock.items()],
                                     "product_id binary, description string, stock int")
    got = allocate(lines, heads, products, line_cols=["line_no"])
    assert {r.order_no for r in got.rejected.collect()} == set(want)
    assert {r.order_no for r in got.accepted.collect()} == {o[0] for o in orders} - set(want)
    taken = defaultdict(int)
    for r in got.taken.collect():
        taken[number(r.product_id)] += r.quantity
    assert {p: s - taken[p] for p, s in stock.items()} == left
    why = explain_rejects(got, lines, products, line_cols=["line_no"])
    for r in why.collect():
        p, avail, q = want[r.order_no]
        if r.rule == "short_stock":
            assert (number(r.product_id), r.available, r.required) == (p, avail, q)
        else:
            assert number(r.product_id) == 99


@pytest.mark.parametrize("hot", [False, True])
def test_only_keys_larger_than_a_block_are_cut(spark, hot):
    rows = [(k, i, (7 * k + i) % 5) for k in range(60) for i in range(900 if hot and k == 30 else 10)]
    slots, _ = slotted(spark.createDataFrame(rows, "k int, i int, v int"), ["k", "i"], least=12, keys=1)
    at = slots.rows.groupBy("k").agg(F.countDistinct("_block").alias("n")).collect()
    assert slots.blocks > 4 and {r.k for r in at if r.n > 1} == ({30} if hot else set())
    assert slots.spans == hot
    got = running_before(slots, ["k"], sums={"before": F.col("v")}).collect()
    for r in got:
        assert r.before == sum((7 * r.k + i) % 5 for i in range(r.i))
    slots = [r._slot for r in sorted(got, key=lambda r: (r.k, r.i))]
    assert len(got) == len(rows) and slots == sorted(set(slots))


def test_rounds_read_what_the_last_one_changed(spark):
    """Each order hangs on the one before it: it needs the product that one may have taken."""
    n = 24

    def product(c):
        return F.unhex(F.lpad(F.hex(c), 32, "0")).alias("product_id")

    pairs = spark.range(1, n + 1).select(
        F.col("id").alias("order_no"),
        F.explode(F.array(F.col("id"), F.col("id") + 1)).alias("p"))
    lines = pairs.select("order_no", F.lit(1).alias("line_no"), product(F.col("p")),
                         F.lit(1).alias("quantity"))
    orders = spark.range(1, n + 1).select(F.col("id").alias("order_no"),
                                          F.lit("confirmado").alias("state"))
    products = spark.range(1, n + 2).select(product(F.col("id")), F.lit("p").alias("description"),
                                            F.lit(1).alias("stock"))
    got = allocate(lines, orders, products, line_cols=["line_no"])
    assert sorted(r.order_no for r in got.rejected.collect()) == list(range(2, n + 1, 2))
    assert len(got.rounds) > n // 2  # nothing but one order after the other
    assert all(r.queued <= 8 and r.lines <= 8 for r in got.rounds[1:])


@pytest.mark.parametrize("blocks", [1, 3, 50])
def test_slots_are_the_same_each_time(spark, monkeypatch, blocks):
    """Limits are fixed: rows that are sorted again get the slots they had, and one copy is stored."""
    rows = [(i * 7919 % 1000 // 3, f"s{i}" if i % 5 else None, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, s string, i int").repartition(6)
    monkeypatch.setattr(running, "ROWS_PER_BLOCK", -(-1000 // blocks))
    stored = []
    monkeypatch.setattr(running, "cut_and_measure",
                        lambda *a, **m: stored.append(real(*a, **m)) or stored[-1])
    slots, _ = slotted(df, ["k", "s", "i"])
    assert len(stored) == 1 and (slots.blocks == blocks or blocks == 50 and slots.blocks > 30)
    once = [(r._slot, r.i) for r in slots.rows.collect()]
    again = [(r._slot, r.i) for r in slots.rows.repartition(3, "i").collect()]
    assert sorted(once) == sorted(again)
    want = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or "", r[2]))
    assert [i for _, i in sorted(once)] == [r[2] for r in want]


def test_running_before_with_a_hot_key(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(1 if rng.random() < 0.5 else rng.randint(2, 40), i, rng.randint(0, 9), f"s{i}")
            for i in range(4000)]
    df = spark.createDataFrame(rows, "k int, i int, v int, s string").repartition(8)
    monkeypatch.setattr(running, "ROWS_PER_BLOCK", 80)  # fifty blocks
    slots, _ = slotted(df, ["k", "i"])
    assert slots.blocks > 1
    per_block = slots.rows.groupBy(F.shiftright("_slot", 33), "k").count()
    assert per_block.filter("k = 1").count() > 1  # the hot key is spread
    got = {r.i: (r.total, r.previous) for r in running_before(
        slots, ["k"], sums={"total": F.col("v")}, last={"previous": F.col("s")}).collect()}
    total, previous = defaultdict(int), {}
    for k, i, v, s in rows:
        assert got[i] == (total[k], previous.get(k))
        total[k] += v
        previous[k] = s


@pytest.mark.parametrize("block_rows", [1_000_000, 334, 20])
def test_numbering(spark, monkeypatch, block_rows):
    monkeypatch.setattr(running, "ROWS_PER_BLOCK", block_rows)
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(7)
    got = assign_numbers(df, ["x"], start=11, name="n").collect()
    assert sorted((r.x, r.n) for r in got) == [(x, x + 11) for x in range(1000)]
    within = number_within(df.withColumn("g", F.col("x") % 3), ["g"], ["x"]).collect()
    assert all(r.n == r.x // 3 for r in within)


def test_ids(spark):
    good = uuid_text(0xABCDEF0123456789)
    df = spark.createDataFrame([(good,), (good.upper(),), (good[:-1],), (good.replace("-", "", 1),),
                                ("g" + good[1:],), (None,)], "u string")
    rows = df.select(ids.is_uuid("u").alias("ok"), ids.bin_to_uuid(ids.uuid_to_bin("u")).alias("a"),
                     ids.bin_to_uuid(ids.uuid_to_bin_dashless("u")).alias("b")).collect()
    assert [r.ok for r in rows] == [True, True, False, False, False, None]
    assert [r.a for r in rows[:2]] == [good, good] and [r.b for r in rows[:2]] == [good, good]
    assert rows[3].b == good  # a missing dash does not matter when dashes are dropped
    assert rows[2].a is None and rows[4].a is None and rows[5].a is None
    keys = spark.range(1).select(ids.stable_key(F.lit("a"), F.lit(None)).alias("x"),
                                 ids.stable_key(F.lit("a")).alias("y")).first()
    assert len(keys.x) == 16 and keys.x != keys.y


def test_scalars(spark):
    one = spark.range(1)

    def value(c):
        return one.select(c.alias("v")).first().v

    assert value(scalars.as_money(F.lit(D("1.005")))) == D("1.01")
    assert value(scalars.as_money(F.lit(D("-1.005")))) == D("-1.01")
    assert value(scalars.concat_skip_null(F.lit("a"), F.lit(None), F.lit("b"))) == "ab"
    assert [value(scalars.is_not_blank(F.lit(x))) for x in ("  ", "", " x ")] == [False, False, True]
    assert value(scalars.zero_pad(F.lit(7), 2)) == "07"
    assert value(scalars.due_date(2025, F.lit(2))) == date(2025, 2, 15)
    assert value(scalars.safe_int(F.lit("12x"))) is None and value(scalars.safe_int(F.lit("12"))) == 12
    assert value(scalars.safe_date(F.lit("2025-02-30"))) is None
    assert value(scalars.loose_text(F.lit("Córdoba")) == scalars.loose_text(F.lit("cordoba")))
    assert value(scalars.loose_text(F.lit("a "), True) == scalars.loose_text(F.lit("A"), True))


def test_picks(spark):
    m = seed(spark)
    pick = [random_pick(m.products.repartition(n), ids.hex_text("product_id"), 7, 3)
            .select("description").collect() for n in (1, 5)]
    assert pick[0] == pick[1] and len(pick[0]) == 3
    side = pick_side_by_side({"customer": (m.customers, "customer_id", None),
                              "product1": (m.products, "product_id", "stock"),
                              "product2": (m.products, "product_id", "stock")}, 7).collect()
    assert len(side) == 1 and side[0].product1_stock > 0 and side[0].customer_id is not None


def test_picks_keep_their_types(spark):
    prices = spark.createDataFrame([(bytearray(key(i)), D(f"{i}.25"), f"n{i}") for i in range(3)],
                                   "id binary, price decimal(10,2), label string")
    row = pick_side_by_side({"a": (prices, "id", "price"), "b": (prices, "id", "label")}, 7).first()
    assert row.a_price % 1 == D("0.25") and row.b_label.startswith("n")


def test_lookup_and_pick_within(spark):
    dim = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b")], "id int, description string")
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "zone string")
    assert {r.zone: r.zone_id for r in lookup_key(rows, dim, "zone").collect()} == {
        "a": 1, "b": 2, "c": None}
    pool = spark.createDataFrame([(g, g * 100 + i) for g in range(3) for i in range(g + 1)],
                                 "g int, id int")
    df = spark.range(300).select("id", (F.col("id") % 4).cast("int").alias("g"))
    got = pick_within(df, pool, ["g"], "id", 1, F.col("id"), "chosen").collect()
    assert len(got) == 300
    assert all(r.chosen is None if r.g == 3 else r.chosen // 100 == r.g for r in got)
    assert len({r.chosen for r in got if r.g == 2}) == 3


def test_checkpoint_folder_comes_from_the_session(spark):
    folder = checkpoint_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert stage_path(spark, "x").startswith(folder)


@pytest.mark.parametrize("hot", [False, True])
def test_keys_are_dealt_by_hash_unless_one_is_too_large(spark, hot):
    rows = [(k, i, (7 * k + i) % 5) for k in range(60) for i in range(900 if hot and k == 30 else 10)]
    df = spark.createDataFrame(rows, "k int, i int, v int")
    slots, _ = slotted(df, ["k", "i"], rows_per_block=50, keys=1, apart=True)
    assert slots.spans == hot and bool(slots.limits) == hot and slots.blocks > 8
    at = slots.rows.groupBy("k").agg(F.countDistinct("_block").alias("n")).collect()
    assert {r.k for r in at if r.n > 1} == ({30} if hot else set())
    got = running_before(slots, ["k"], sums={"before": F.col("v")}).collect()
    assert len({r._slot for r in got}) == len(rows)
    assert all(r.before == sum((7 * r.k + i) % 5 for i in range(r.i)) for r in got)


@pytest.mark.parametrize("hot, least, folder_rows", [(False, 1, 60), (True, 16, 12), (True, 16, 3)])
def test_allocate_in_many_folders(spark, monkeypatch, hot, least, folder_rows):
    """Folders by a hash of the product, and folders between which hot products are cut."""
    monkeypatch.setattr(allocation, "ROWS_PER_FOLDER", folder_rows)
    monkeypatch.setattr(allocation, "LEAST_FOLDERS", least)
    gone = []
    monkeypatch.setattr(allocation, "remove", lambda s, path: gone.append(path) or remove(s, path))
    stock, orders = batch(random.Random(8), 150, hot, False)
    want, left = sequential(stock, orders)
    rows = [(no, i, p, q) for no, _, items in orders for i, (p, q) in enumerate(items)]
    lines = spark.createDataFrame(rows, "order_no long, line_no int, product_id long, quantity int")
    lines = lines.withColumn("product_id", F.unhex(F.lpad(F.hex("product_id"), 32, "0")))
    heads = spark.createDataFrame([(no, "confirmado" if t else "pendiente")
                                   for no, t, _ in orders], "order_no long, state string")
    products = spark.createDataFrame([(key(p), f"product {p}", s) for p, s in stock.items()],
                                     "product_id binary, description string, stock int")
    got = allocate(lines, heads, products, line_cols=["line_no"])
    assert {r.order_no for r in got.rejected.collect()} == set(want)
    assert got.demand.spans == hot and got.demand.blocks > 2
    # What a round has replaced is gone: queues and open orders of the rounds before.
    assert len(got.rounds) > 2 and {"queues" if "/queues/" in p else "orders" for p in gone} == {
        "queues", "orders"}


def test_stored_rows_leave_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return sum(1 for b in str(manager.getAllBlocks().mkString(" ")).split() if b.startswith("shuffle"))

    was, conf = shuffled(), spark.conf.get(CLEANUP, "false")
    stored = cut_lineage(spark.range(1000).repartition(5, F.col("id") % 7), "counted")
    assert shuffled() <= was and stored.count() == 1000
    assert spark.conf.get(CLEANUP, "false") == conf
