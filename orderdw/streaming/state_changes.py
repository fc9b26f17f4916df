"""Order-state changes as a stream: stock ledger, cancellation audit and log."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from orderdw.operators.stock import (apply_moves, audit_rows, becomes_cancelled, gives_back,
                                     log_rows, moves_of)
from orderdw.schemas import ORDERS_MODEL
from orderdw.sources.parts import PartTable
from orderdw.sources.tables import by_order_range

# A change carries the state before and after it, as the row images of an update do, so a batch
# needs nothing from the batches before it.
CHANGE = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("order_no", T.LongType()), T.StructField("order_id", T.BinaryType()),
    T.StructField("old_state", T.StringType()), T.StructField("new_state", T.StringType())])

DAY = T.StructField("day", T.DateType())
LEDGER = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("order_no", T.LongType()),
    T.StructField("product_id", T.BinaryType()), T.StructField("delta", T.LongType()), DAY])
DAILY = T.StructType([
    T.StructField("product_id", T.BinaryType()), T.StructField("delta", T.LongType()), DAY])
# Outputs lie by the day of the change, so a change and its repeats meet in one day: layout, and
# what tells the rows of a day apart.
OUTPUTS = {
    "ledger": (LEDGER, ["event_id", "product_id"]),
    "audit": (T.StructType([*ORDERS_MODEL["cancel_audit"], DAY]), ["audit_id"]),
    "log": (T.StructType([*ORDERS_MODEL["cancel_log"], DAY]), ["log_id"])}


def output(spark: SparkSession, target: str, name: str) -> PartTable:
    layout = DAILY if name == "daily" else OUTPUTS[name][0]
    return PartTable(spark, f"{target}/{name}", layout, group="day")


def read_changes(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    return (spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", files_per_batch)
            .parquet(folder))


def stream_state_changes(changes: DataFrame, lines: DataFrame, target: str,
                         orders_per_range: int | None = None) -> StreamingQuery:
    """Follow a stream of state changes until the files at hand are read.

    Each output has its rows in parts by day of the change, and a manifest per day. A micro-batch
    adds a part to the days that it touches, and looks at those days only; run again after a
    failure, it replaces its parts. Every row is keyed by its change, and repeats are removed within
    their day, however late they come; no change is too late to count. A day with many parts gets
    them put into one. After each batch the stock moves of the days that it touched are summed anew
    from the ledger of those days alone (``daily``), so the stock of now needs one small row per day
    and product.

    Lines stored by order range (``orders_per_range``) are read only in the folders of the orders
    that a batch changes.
    """
    spark = changes.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.dropDuplicates(["event_id"]).withColumn("day", F.to_date("ts"))
        if orders_per_range is not None:
            rows = by_order_range(rows, orders_per_range)
        rows = rows.persist()
        try:
            outputs = {
                "ledger": moves_of(rows, lines, keys=["event_id", "order_no", "day"]),
                "audit": audit_rows(rows.filter(gives_back()), F.col("ts")),
                "log": log_rows(rows.filter(becomes_cancelled()), F.col("ts")),
            }
            for name, df in outputs.items():
                if "day" not in df.columns:
                    df = df.withColumn("day", F.to_date("cancelled_at"))
                table = output(spark, target, name)
                days = table.append(df, batch_id)  # a batch touches few days
                table.compact_full(days, clean=_without_repeats(name))
                if name == "ledger" and days:
                    moves = read_ledger(spark, target, days)
                    output(spark, target, "daily").replace(
                        moves.groupBy("day", "product_id").agg(F.sum("delta").alias("delta")))
        finally:
            rows.unpersist()

    return (changes.writeStream.foreachBatch(handle)
            .option("checkpointLocation", f"{target}/_progress")
            .trigger(availableNow=True).start())


def _without_repeats(name: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.dropDuplicates(["day", *OUTPUTS[name][1]])


def _read(spark: SparkSession, target: str, name: str,
          days: Iterable[str] | None = None) -> DataFrame:
    return _without_repeats(name)(output(spark, target, name).read(days))


def read_ledger(spark: SparkSession, target: str, days: Iterable[str] | None = None) -> DataFrame:
    return _read(spark, target, "ledger", days)


def read_daily_moves(spark: SparkSession, target: str) -> DataFrame:
    """(day, product_id, delta): the ledger summed per day."""
    return output(spark, target, "daily").read()


def read_audit(spark: SparkSession, target: str) -> DataFrame:
    return _read(spark, target, "audit").drop("day")


def read_log(spark: SparkSession, target: str) -> DataFrame:
    return _read(spark, target, "log").drop("day")


def compact_outputs(spark: SparkSession, target: str) -> None:
    """Put each day into one part, and remove the files that nothing names any more. Readers that
    began before must be done."""
    for name in OUTPUTS:
        table = output(spark, target, name)
        table.compact_full(table.groups(), most=1, clean=_without_repeats(name))
        table.drop_replaced()
    output(spark, target, "daily").drop_replaced()


def stock_now(products: DataFrame, ledger: DataFrame) -> DataFrame:
    """Products with all moves applied: of the ledger, or of its daily sums."""
    return apply_moves(products, ledger)
