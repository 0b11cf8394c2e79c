"""Plan guards for the properties that matter at scale (static physical plans,
i.e. before AQE adapts them to the tiny test inputs)."""

from __future__ import annotations

import re

import pytest

from runlens.operators import runs
from runlens.operators.top_runs import top_runs
from runlens.plans import catalog
from runlens.session import scratch_path
from runlens.sources import store

from .conftest import SF001


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch_path(spark, "guard-trades")
    store.load_days(catalog.f1_trades(spark, SF001), path, "trades")
    ppath = scratch_path(spark, "guard-prices")
    store.load_days(catalog.f1_prices(spark, SF001), ppath, "prices")
    return store.read_table(spark, path, "trades"), store.read_table(spark, ppath, "prices")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _single_partition_inputs(plan: str) -> list[str]:
    """The operator lines feeding each SinglePartition exchange."""
    lines = plan.split("\n")
    return [lines[i + 1] for i, line in enumerate(lines) if "Exchange SinglePartition" in line]


def test_segmented_scan_never_puts_trades_in_one_task(stored):
    trades, _ = stored
    plan = _plan(runs.with_run_ids(trades, "buy", catalog.START, catalog.END))
    inputs = _single_partition_inputs(plan)
    assert inputs, "expected the (small) super-segment scan"
    for line in inputs:
        # only per-super-segment summary rows: no trade columns
        assert not re.search(r"\b(amount|quantity|id)#", line), line
    naive = _plan(runs.with_run_ids_naive(trades, "buy", catalog.START, catalog.END))
    assert "SinglePartition" in naive   # the baseline really is one task


def test_date_range_prunes_partitions_and_columns(stored):
    trades, prices = stored
    plan = _plan(top_runs(trades, prices, "buy", catalog.START, catalog.END, 800))
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
    trade_scans = [s for s in scans if "buyer" in s]
    price_scans = [s for s in scans if "pc_change" in s]
    # trades: the date range prunes partitions; only the needed columns are read
    assert trade_scans and all("(date" in s and ">= 2024-01-02" in s for s in trade_scans)
    assert all("seller" not in s and "rate:" not in s for s in trade_scans)
    # prices: pruned to the dates of the top-n rows (dynamic partition pruning)
    # or to the inferred range
    assert price_scans and all("dynamicpruning" in s or ">= 2024-01-02" in s for s in price_scans)


def test_top_n_is_bounded_and_broadcast(stored):
    trades, prices = stored
    plan = _plan(top_runs(trades, prices, "sell", catalog.START, catalog.END, 100))
    assert "TakeOrderedAndProject(limit=100" in plan
    assert "BroadcastExchange" in plan
