"""Time the headline queries: one warm-up, then the median of three runs. Prints one JSON line.

A job whose input the query has to derive first (the requests of a registration) is timed on the
stored input.

Environment: BENCH_SF_DIR (data), BENCH_CPUS (threads), BENCH_RUNS, BENCH_QUERIES (names).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderdw.checks import QUERIES  # noqa: E402
from orderdw.checks.derived import AS_OF, requests  # noqa: E402
from orderdw.operators.orders import register_orders  # noqa: E402
from orderdw.session import build_session, cut_lineage, drop_stages  # noqa: E402
from orderdw.sources.testdata import order_model  # noqa: E402

HEADLINE = ["r1_customers_between", "r2_orders_per_seller", "r3_orders_over",
            "r4_product_sales_between", "r5_top_supplier", "r6_customers_without_orders",
            "r7_customers_below", "r8_sales_by_origin", "r9_instalment_report",
            "w4_fact_orders", "s3_s4_ledger", "s8_cancel_stock", "s9_reprice", "d2_unique",
            "d3_foreign_key", "n1_assign_numbers", "s2_allocation", "s7_register_orders",
            "w5_run_etl", "z1_stream_stock", "g7_names_per_order", "x2_assign_town"]
# Several rounds or batches each: one timed run after the warm-up.
ONCE = {"s2_allocation", "s7_register_orders", "w5_run_etl", "z1_stream_stock"}


def registration(spark, folder):
    m = order_model(spark, folder)
    asked = cut_lineage(requests(m), "requests")
    return lambda: register_orders(asked, m.customers, m.sellers, m.products, as_of=AS_OF).lines


PREPARED = {"s7_register_orders": registration}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session("bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in names:
        times = []
        run = (PREPARED[name](spark, folder) if name in PREPARED
               else lambda name=name: QUERIES[name](spark, folder))
        for _ in range(1 + (1 if name in ONCE else runs)):
            started = time.perf_counter()
            run().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        took[name] = round(statistics.median(times[1:]), 3)
        print(name, took[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3),
                      "unit": "sec", "queries": took,
                      "sf": os.path.basename(os.path.normpath(folder))}))
    drop_stages(spark)
    spark.stop()


if __name__ == "__main__":
    main()
