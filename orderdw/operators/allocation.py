"""Which orders can be served when they are taken one after the other.

An order is accepted if each of its lines fits the stock that the accepted confirmed orders before
it left over; otherwise the whole order is rejected and takes nothing. Orders in another state are
checked the same way but take nothing.

Products with enough stock for all that is asked of them are set aside first; the rest is decided
in rounds. One order's fate hangs on all earlier ones, across products, so a single pass cannot
decide it. The stock taken before an open order lies between two bounds: none of the open orders
before it is accepted, or all are. A line that fits under the upper bound fits for good, one that
does not fit under the lower bound fails for good. An order is accepted when all its lines fit, and
rejected when one fails. The first open order has equal bounds, so every round settles one at least,
and in practice most.

After the first round, a round looks only at what the last one changed. The queues of the products
lie in folders along (product, place in the queue), the open orders in folders by their number; both
are replaced folder by folder. A round reads the queues of the products whose orders were settled in
the round before, and then the orders whose lines have come to fit or to fail there. Long chains, in
which each order hangs on the one before, take many rounds, but each reads a few folders only.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T

from orderdw.functions.ids import bin_to_uuid
from orderdw.functions.scalars import NO_SUCH_PRODUCT, SHORT_STOCK, message
from orderdw.operators.running import BLOCK, SLOT, Slots, goes_on, running_before, slotted
from orderdw.schemas import CONFIRMED
from orderdw.session import cut_and_measure, cut_lineage, stage_path, without_shuffles_left
from orderdw.sources.files import folders, remove


ROWS_PER_FOLDER, LEAST_FOLDERS = 100_000, 16


class Round(NamedTuple):
    queued: int  # rows of queues that were read
    lines: int   # rows of orders that were read
    settled: int  # of the latter, rows of orders settled


class Allocation(NamedTuple):
    accepted: DataFrame  # the orders that fit
    rejected: DataFrame  # order_no
    taken: DataFrame     # order_no, product_id, quantity: what accepted orders take from stock
    demand: Slots        # (order, product) of scarce products in queue order
    rounds: list[Round]


def _demand(lines: DataFrame, orders: DataFrame, sequence: Sequence[str], line_cols: Sequence[str],
            takes, whole: bool) -> DataFrame:
    """One row per (order, product): what it takes, and the stock it needs to get through; stored."""
    ranks = [f"_s{i}" for i in range(len(sequence))]
    joined = lines.select("order_no", "product_id", "quantity")
    if whole:
        joined = joined.withColumn("takes", takes)
    else:
        heads = orders.select("order_no", *[F.col(c).alias(r) for c, r in zip(sequence, ranks)],
                              takes.alias("takes"))
        joined = joined.join(heads, "order_no")
    pairs = joined.groupBy("order_no", "product_id", "takes", *ranks).agg(
        F.sum("quantity").alias("_sum"), F.max("quantity").alias("_max"),
        F.max(F.col("quantity").isNull()).alias("_no_quantity"),
        F.coalesce(F.max(F.col("quantity") < 0), F.lit(False)).alias("_negative"))
    pairs, seen = cut_and_measure(pairs, "sums", negatives=F.count(F.when(F.col("_negative"), 1)))
    need = F.when(F.col("takes"), F.col("_sum")).otherwise(F.col("_max").cast("long"))
    if seen["negatives"]:
        # A negative line gives stock back to the later lines of its order: the need is then the
        # highest running total, not the sum.
        mixed = pairs.filter("_negative").select("order_no", "product_id")
        slots, _ = slotted(lines.select("order_no", "product_id", "quantity", *line_cols)
                           .join(mixed, ["order_no", "product_id"], "left_semi"),
                           ["order_no", "product_id", *line_cols], "mixed", keys=2, apart=True)
        peaks = (running_before(slots, ["order_no", "product_id"], sums={"_own": F.col("quantity")})
                 .groupBy("order_no", "product_id")
                 .agg(F.max(F.col("_own") + F.col("quantity")).alias("_peak")))
        pairs = pairs.join(peaks, ["order_no", "product_id"], "left")
        need = F.when(F.col("takes"), F.coalesce("_peak", "_sum")).otherwise(
            F.col("_max").cast("long"))
        pairs = cut_lineage(pairs.withColumn("_need", need), "peaks")
        need = F.col("_need")
    return pairs.select("order_no", "product_id", *ranks, "_no_quantity", "takes",
                        F.when(F.col("takes"), F.col("_sum")).otherwise(F.lit(0)).cast("long")
                        .alias("take"), need.alias("need"))


def _on_scarce_products(pairs: DataFrame, products: DataFrame) -> DataFrame:
    """The demand that could fail at all, with the product's stock.

    A product whose stock covers everything asked of it never fails an order, whoever else is
    accepted, so its lines need no queue. Unknown products and missing quantities stay in.
    """
    asked = F.when(F.col("takes"), F.greatest("take", "need", F.lit(0)))
    looked_at = F.max(F.when(~F.col("takes"), F.col("need")))
    loads = pairs.groupBy("product_id").agg(
        (F.coalesce(F.sum(asked), F.lit(0)) + F.coalesce(looked_at, F.lit(0))).alias("_load"),
        F.max("_no_quantity").alias("_flawed"))
    stock = products.select("product_id", F.col("stock").cast("long").alias("stock"))
    scarce = (loads.join(stock, "product_id", "left")
              .filter(F.col("stock").isNull() | F.col("_flawed")
                      | (F.col("_load") > F.col("stock")))
              .select(F.col("product_id").alias("_product"), "stock"))
    return (pairs.join(scarce, pairs["product_id"].eqNullSafe(scarce["_product"]))
            .drop("_product"))


def allocate(lines: DataFrame, orders: DataFrame, products: DataFrame,
             sequence: Sequence[str] = (), line_cols: Sequence[str] = ("line_no", "line_id"),
             takes=None, whole: bool = False) -> Allocation:
    """Decide all orders of the batch, in the order of ``sequence`` and then ``order_no``.

    ``takes`` tells which orders take stock (default: the confirmed ones). With ``whole``, the lines
    are those of these orders and no others, ``takes`` reads no order and there is no ``sequence``:
    the lines then need not meet their orders.
    """
    takes = F.col("state") == CONFIRMED if takes is None else takes
    sequence = [c for c in sequence if c != "order_no"]
    ranks = [*[f"_s{i}" for i in range(len(sequence))], "order_no"]

    pairs = _demand(lines, orders, sequence, line_cols, takes, whole)
    flaw = F.col("stock").isNull() | F.col("_no_quantity")
    slots, seen = slotted(_on_scarce_products(pairs, products), ["product_id", *ranks], "demand",
                          rows_per_block=ROWS_PER_FOLDER, least=LEAST_FOLDERS, keys=1, apart=True,
                          flaws=F.count(F.when(flaw, 1)),
                          negatives=F.count(F.when(F.col("take") < 0, 1)))
    base = slots.rows.drop("takes")
    flawed = base.filter(flaw).select("order_no").distinct()
    if seen["flaws"]:
        # A line that could never be stored rejects its order before any stock is looked at.
        base = base.join(flawed, "order_no", "left_anti")
    queues = _Queues(base, slots, plain=not seen["negatives"])
    queues.settle()

    rejected = queues.rejected()
    if seen["flaws"]:
        rejected = rejected.unionByName(flawed)
    rejected = cut_lineage(rejected, "rejected")
    accepted = orders.join(rejected, "order_no", "left_anti")
    taken = (pairs.filter("take <> 0").join(rejected, "order_no", "left_anti")
             .select("order_no", "product_id", F.col("take").alias("quantity")))
    return Allocation(accepted, rejected, taken, slots, queues.rounds)


class _Queues:
    """The open rows of scarce products, and the open orders, in folders that rounds replace."""

    def __init__(self, base: DataFrame, slots: Slots, plain: bool) -> None:
        self.spark, self.plain = base.sparkSession, plain
        self.blocks = slots.blocks
        # Only a product with more rows than a block goes on in the next one.
        first = [None, *[x[0] for x in slots.limits]]
        self.after = {b: b + 1 for b, on in enumerate(goes_on(slots.limits, 1)) if on}
        self.before = {b: a for a, b in self.after.items()}
        self.spanning = bool(self.after)  # whether a product in hand lies in more than one block
        self.base = base.select("order_no", "product_id", SLOT, BLOCK, "take", "need", "stock")
        if self.after:
            runs = [(b, first[b] if b in self.before else None,
                     first[b + 1] if b in self.after else None) for b in range(self.blocks)]
            kind = T.StructType([T.StructField(BLOCK, T.IntegerType()),
                                 T.StructField("_first", T.BinaryType()),
                                 T.StructField("_last", T.BinaryType())])
            self.base = self.base.join(
                F.broadcast(self.spark.createDataFrame(runs, kind)), BLOCK)
        # Whether a row's product goes on in the block before and in the block after.
        product = F.col("product_id")
        self.base = self.base.withColumns(
            {"_head": product.eqNullSafe(F.col("_first")), "_tail": product.eqNullSafe(F.col("_last"))}
            if self.after else {"_head": F.lit(False), "_tail": F.lit(False)}).drop("_first", "_last")
        self.root = stage_path(self.spark, "rounds")
        self.queue_at: dict[str, str] = {}   # block: where its open rows lie now
        self.orders_at: dict[str, str] = {}  # bucket: where its open orders lie now
        self.settled_at: list[str] = []
        self.spent: list[str] = []  # queues that the round in hand replaces
        self.rounds: list[Round] = []

    def _read(self, table: str, paths: list[str]) -> DataFrame:
        return (self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*paths)
                .drop("_round", "_folder", "_done", "_bucket"))

    def _remove(self, paths: list[str]) -> None:
        """Folders that others have replaced are read no more."""
        for path in paths:
            remove(self.spark, path)

    def settle(self) -> None:
        """Rounds until no order is open."""
        rows = self.base.withColumns({"taken": F.lit(0).cast("long"), "fits": F.lit(False),
                                      "accepted": F.lit(None).cast("boolean"),
                                      "_changed": F.lit(True)})
        while rows is not None:
            queued, stored, asked = self._bounds(rows)
            lines, done, touched = self._judge(stored, asked) if asked else (0, 0, [])
            self.rounds.append(Round(queued, lines, done))
            rows = self._queues_after(touched) if done else None

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("order_no"), F.lit(max(LEAST_FOLDERS, self.blocks))).cast("int")

    def _bounds(self, rows: DataFrame) -> tuple[int, DataFrame, list[int]]:
        """New bounds of the rows of changed products. Stores what is open, and what is new about
        it: a row fits from now on (1), or fails (2). Gives the rows read, the rows stored, and the
        folders of the orders that have news (as many as there are folders at most)."""
        open_ = F.col("accepted").isNull()
        sums = {"_taken": F.when(F.col("accepted"), F.col("take")),
                "_most": F.when(open_, F.greatest("take", F.lit(0)))}
        if not self.plain:  # rows that give stock back have a lower bound of their own
            sums["_least"] = F.when(open_, F.least("take", F.lit(0)))
        found = running_before(Slots(rows, self.blocks if self.spanning else 1), ["product_id"],
                               sums=sums)
        taken = F.col("taken") + F.when(F.col("_changed"), F.col("_taken")).otherwise(0)
        left = F.col("stock") - F.col("taken")
        fits = F.col("_changed") & (left - F.col("_most") >= F.col("need"))
        fails = F.col("_changed") & (
            left - (F.lit(0) if self.plain else F.col("_least")) < F.col("need"))
        found = (found.withColumn("taken", taken)
                 .withColumn("news", F.when(fits & ~F.col("fits"), 1).when(fails, 2))
                 .withColumn("fits", F.col("fits") | fits))
        seen = Observation()
        path = f"{self.root}/queues/_round={len(self.rounds)}"
        found = (found.observe(seen, F.count("*").alias("rows"), F.collect_set(
            F.when(open_ & F.col("news").isNotNull(), self._bucket())).alias("asked"))
            .filter(open_).drop("accepted", "_changed", "_taken", "_most", "_least"))
        with without_shuffles_left(self.spark):
            found.withColumn("_folder", F.col(BLOCK)).write.partitionBy("_folder").parquet(path)
        # What was read is replaced; folders without open rows are gone.
        written = folders(self.spark, path, "_folder")
        self.queue_at |= written
        self._remove(self.spent)
        return (seen.get["rows"], self._read("queues", [path]) if written else None,
                seen.get["asked"])

    def _judge(self, stored: DataFrame, asked: list[int]) -> tuple[int, int, list]:
        """Settles the orders that the news decide, and stores what else they say. Gives the rows
        read, the rows settled, and where those lie (a few facts for each block)."""
        line = ["order_no", SLOT, "product_id", BLOCK, "_head", "_tail"]
        fits, bucket = F.col("fits"), self._bucket()
        if not self.rounds:
            lines = stored.select(*line, "fits", "news", bucket.alias("_bucket")).repartition("_bucket")
            paths = []
        else:
            # News come as rows of their own and meet the lines where these meet each other.
            news = stored.filter("news IS NOT NULL").select("order_no", SLOT, "news")
            paths = [self.orders_at.pop(str(b)) for b in asked if str(b) in self.orders_at]
            lines = (self._read("orders", paths).drop("accepted").withColumn("_line", F.lit(True))
                     .unionByName(news, allowMissingColumns=True)
                     .withColumn("_bucket", bucket).repartition("_bucket")
                     .withColumn("news", F.max("news").over(
                         Window.partitionBy("_bucket", "order_no", SLOT)))
                     .filter("_line")
                     .withColumn("fits", fits | F.coalesce(F.col("news") == 1, F.lit(False))))
        of_order = Window.partitionBy("_bucket", "order_no")
        judged = lines.withColumns({
            "_all": F.bool_and("fits").over(of_order),
            "_fails": F.coalesce(F.bool_or(F.col("news") == 2).over(of_order), F.lit(False))})
        seen = Observation()
        path = f"{self.root}/orders/_round={len(self.rounds)}"
        done = F.col("_all") | F.col("_fails")
        judged = judged.select(
            *line, "fits", (F.col("_all") & ~F.col("_fails")).alias("accepted"),
            done.cast("int").alias("_done"), "_bucket").observe(
            seen, F.count("*").alias("rows"),
            F.coalesce(F.sum("_done"), F.lit(0)).alias("done"),
            F.collect_set(F.when(F.col("_done") == 1, F.struct(BLOCK, "_head", "_tail")))
            .alias("touched"))
        with without_shuffles_left(self.spark):
            judged.write.partitionBy("_done", "_bucket").parquet(path)
        self.orders_at |= folders(self.spark, f"{path}/_done=0", "_bucket")
        self._remove(paths)
        if seen.get["done"]:
            self.settled_at.append(f"{path}/_done=1")
        return seen.get["rows"], seen.get["done"], seen.get["touched"]

    def _queues_after(self, places: list) -> DataFrame | None:
        """The queues of the products of the rows settled last, with what became of those rows."""
        touched = set()
        for block, head, tail in places:
            touched.add(block)
            for goes_on, next_ in ((head, self.before), (tail, self.after)):
                at = block
                while goes_on and at in next_:
                    at = next_[at]
                    touched.add(at)
        self.spanning = any(self.after.get(b) in touched for b in touched)
        settled = self._read("orders", self.settled_at[-1:])
        paths = [self.queue_at.pop(str(b)) for b in sorted(touched) if str(b) in self.queue_at]
        self.spent = paths
        if not paths:
            return None
        queues = self._read("queues", paths).drop("news")
        if self.after:  # a folder may hold a part of a product whose other parts are not read
            changed = settled.select("product_id").distinct().withColumn("_changed", F.lit(True))
            queues = queues.join(changed, "product_id", "left").withColumn(
                "_changed", F.coalesce("_changed", F.lit(False)))
        else:  # what is whole and has not changed gives the bounds that it gave before
            queues = queues.withColumn("_changed", F.lit(True))
        return (queues.withColumn("_row", F.lit(True))
                .unionByName(settled.select("product_id", SLOT, BLOCK, "accepted"),
                             allowMissingColumns=True)
                .repartition(BLOCK)
                .withColumn("accepted", F.max("accepted").over(
                    Window.partitionBy(BLOCK, "product_id", SLOT)))
                .filter("_row").drop("_row"))

    def rejected(self) -> DataFrame:
        if not self.settled_at:
            return self.base.select("order_no").limit(0)
        return (self._read("orders", self.settled_at).filter("NOT accepted")
                .select("order_no").distinct())


def explain_rejects(result: Allocation, lines: DataFrame, products: DataFrame,
                    line_cols: Sequence[str] = ("line_no", "line_id"),
                    short_stock: Column | None = None) -> DataFrame:
    """For each rejected order the first line that failed and the message it fails with.

    Gives ``(order_no, rule, product_id, available, required, message)``; ``short_stock`` is the
    message for missing stock, over the same columns and the product's description. What was taken before is
    summed over the stored demand; only the lines of rejected orders are looked at.
    """
    out = result.rejected.withColumn("_out", F.lit(True))
    demand = result.demand.rows.join(out, "order_no", "left").withColumn(
        "_kept", F.when(F.col("_out").isNull(), F.col("take")).otherwise(F.lit(0)))
    before = (running_before(result.demand._replace(rows=demand), ["product_id"],
                             sums={"_taken": F.col("_kept")})
              .filter("_out").select("order_no", "product_id", "takes", "stock", "_taken"))
    order_cols = list(line_cols)
    wanted = lines.select("order_no", "product_id", "quantity", *order_cols)
    # A line without any product is one of those to explain, so NULL must meet NULL.
    same = ((wanted["order_no"] == before["order_no"])
            & wanted["product_id"].eqNullSafe(before["product_id"]))
    slots, _ = slotted(wanted.join(before, same).drop(before["order_no"], before["product_id"]),
                       ["order_no", "product_id", *order_cols], "explain", keys=2, apart=True)
    own = F.when(F.col("takes"), F.coalesce("quantity", F.lit(0))).otherwise(F.lit(0))
    rule = (F.when(F.col("stock").isNull(), "unknown_product")
            .when(F.col("quantity").isNull(), "no_quantity").otherwise("short_stock"))
    available = F.col("stock") - F.col("_taken") - F.col("_own")
    broken = (F.col("stock").isNull() | F.col("quantity").isNull()
              | (available < F.col("quantity")))
    first = (running_before(slots, ["order_no", "product_id"], sums={"_own": own})
             .withColumn("available", available).filter(broken).groupBy("order_no")
             .agg(F.min_by(F.struct(rule.alias("rule"), "product_id", "available", "quantity"),
                           F.struct(*order_cols)).alias("f"))
             .select("order_no", "f.rule", "f.product_id", "f.available",
                     F.col("f.quantity").alias("required"))
             .join(products.select("product_id", "description"), "product_id", "left"))
    text = (F.when(F.col("rule") == "unknown_product",
                   message(NO_SUCH_PRODUCT, bin_to_uuid("product_id")))
            .when(F.col("rule") == "no_quantity", F.lit("NULL in quantity"))
            .otherwise(message(SHORT_STOCK, "description", "available", "required")
                       if short_stock is None else short_stock))
    return first.withColumn("message", text).select(
        "order_no", "rule", "product_id", "available", "required", "message")
