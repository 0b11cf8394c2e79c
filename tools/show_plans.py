"""Print the formatted physical plan of headline operators on a stored,
date-partitioned trades table (written from the F1 fixture below the shared
folder), plus a one-line census per plan: scans with their pruning, exchanges,
windows, broadcasts.  Usage: python tools/show_plans.py [sf_dir] [--full]"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from runlens.operators import compare, runs  # noqa: E402
from runlens.operators.top_runs import top_runs  # noqa: E402
from runlens.plans import catalog  # noqa: E402
from runlens.session import build_session, scratch_path  # noqa: E402
from runlens.sources import store  # noqa: E402


def census(name, df, full):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan, "run the DataFrame before reading its plan"
    plan = plan.split("== Initial Plan ==")[0]
    if full:
        print(f"===== {name}")
        df.explain("formatted")
    scans = re.findall(r"FileScan parquet [^\n]*", plan)
    print(f"{name}: shuffles={plan.count('ShuffleQueryStage')} "
          f"broadcasts={plan.count('BroadcastExchange')} windows={plan.count('Window [')} "
          f"single_partition={plan.count('SinglePartition')} reused={plan.count('ReusedExchange')} "
          f"group_limits={plan.count('WindowGroupLimit')}")
    for s in scans:
        pf = re.search(r"PartitionFilters: \[([^\]]*)\]", s)
        pu = re.search(r"PushedFilters: \[([^\]]*)\]", s)
        rs = re.search(r"ReadSchema: (struct<[^>]*>)", s)
        print(f"    scan partition_filters=[{pf.group(1) if pf else ''}] pushed=[{pu.group(1)[:90] if pu else ''}] "
              f"read={rs.group(1)[:110] if rs else ''}")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 and not sys.argv[1].startswith("--") else "/root/testdata/sf0.01"
    full = "--full" in sys.argv
    spark = build_session("local[8]", shuffle_partitions=8)
    path = scratch_path(spark, "plans-trades")
    store.load_days(catalog.f1_trades(spark, sf), path, "trades")
    ppath = scratch_path(spark, "plans-prices")
    store.load_days(catalog.f1_prices(spark, sf), ppath, "prices")
    trades = store.read_table(spark, path, "trades")
    prices = store.read_table(spark, ppath, "prices")
    s, e = catalog.START, catalog.END
    items = {
        "with_run_ids(buy)": runs.with_run_ids(trades, "buy", s, e),
        "naive global window": runs.with_run_ids_naive(trades, "buy", s, e),
        "top_runs(all, buy, 800)": top_runs(trades, prices, "buy", s, e, 800),
        "top_runs(symbol, sell, 100)": top_runs(trades, prices, "sell", s, e, 100, symbol="purchase"),
        "compare_all(800)": compare.compare_all(trades, prices, s, e, 800),
    }
    for name, df in items.items():
        # Execute this DataFrame's own QueryExecution (a write would plan a new
        # one) so that AQE's final plan, with reused stages, is what we read.
        df.collect()
        census(name, df, full)


if __name__ == "__main__":
    main()
