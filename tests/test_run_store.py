"""Stored runs: equal to full numbering after each day, and drill-down by the index."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from runlens.operators import run_store, runs
from runlens.schema import TRADES
from runlens.sources import store


def day(rng, k, n=60, brokers="123"):
    """Trades of day ``k``, with NULL symbols and brokers."""
    rows = []
    for i in range(n):
        symbol = rng.choice(["A", "A", "A", "AB", "B", None])
        buyer, seller = (rng.choice([*brokers, None]) for _ in range(2))
        rows.append((k * 1000 + i, f"2024-01-{k:02d}", symbol, buyer, seller, i + 1, None, None))
    return rows


def with_amount(spark, rows):
    return spark.createDataFrame(rows, TRADES).withColumn("amount", (F.col("quantity") * 2).cast("decimal(18,4)"))


def lines(df):
    names = ["side", "grp", "date", "stock_symbol", "broker", "cuml", "cumq", "trnxs"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_totals_after_each_day_equal_full_numbering(spark, tmp_path):
    rng, path, rows = random.Random(3), str(tmp_path / "runs"), []
    for k in (1, 2, 4, 3):   # the third day comes last, between stored ones
        rows += day(rng, k, brokers="1" if k == 2 else "123")
        run_store.put_days(spark, path, with_amount(spark, [r for r in rows if r[1].endswith(f"{k:02d}")]), bucket_width=37)
        assert lines(run_store.stored_totals(spark, path, fanout=2)) == lines(
            runs.run_summary_sides(with_amount(spark, rows), bucket_width=37))
    again = day(rng, 2)
    rows = [r for r in rows if not r[1].endswith("02")] + again
    run_store.put_days(spark, path, with_amount(spark, again), bucket_width=37)
    want = with_amount(spark, rows)
    assert lines(run_store.stored_totals(spark, path)) == lines(runs.run_summary_sides(want))
    assert lines(run_store.stored_totals(spark, path, "2024-01-02", "2024-01-03")) == lines(
        runs.run_summary_sides(want, start="2024-01-02", end="2024-01-03"))


@pytest.mark.parametrize("most", [64, 0])
def test_drill_down_by_index(spark, tmp_path, monkeypatch, most):
    """Runs inside a part, over parts, symbols and days, by ranges and by the join."""
    monkeypatch.setattr(run_store, "MAX_RANGES", most)
    rng = random.Random(9)
    rows = day(rng, 1) + day(rng, 2, brokers="1") + day(rng, 3)
    path, table, index = (str(tmp_path / n) for n in ("runs", "trades", "index"))
    store.load_days(with_amount(spark, rows), table)
    trades = store.read_table(spark, table, "trades")
    run_store.put_days(spark, path, trades, bucket_width=20)
    run_store.write_index(spark, path, index)
    full = runs.with_run_ids(trades, "buy").collect()
    numbers = sorted({r.grp for r in full})
    largest = max(numbers, key=lambda g: sum(r.grp == g for r in full))
    for g in {1, largest, numbers[len(numbers) // 2], numbers[-1], numbers[-1] + 1}:
        got = run_store.indexed_run_trades(spark, index, trades, "buy", g)
        assert sorted((r.id, r.grp) for r in got.collect()) == sorted((r.id, r.grp) for r in full if r.grp == g)


def test_drill_down_reads_the_runs_days_only(spark, tmp_path):
    rng = random.Random(4)
    path, table, index = (str(tmp_path / n) for n in ("runs", "trades", "index"))
    for k in (1, 2, 3):
        store.load_days(with_amount(spark, [r for r in day(rng, k) if r[2]]), table)
    trades = store.read_table(spark, table, "trades")
    run_store.put_days(spark, path, trades)
    run_store.write_index(spark, path, index)
    plan = run_store.indexed_run_trades(spark, index, trades, "sell", 2)._jdf.queryExecution().executedPlan().toString()
    assert "date#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(id" in plan and "LessThanOrEqual(id" in plan


def test_days_that_interleave_are_refused(spark, tmp_path):
    path = str(tmp_path / "runs")
    rows = [(i, f"2024-01-0{1 + i % 2}", "A", "1", "2", 1, None, None) for i in range(6)]
    with pytest.raises(ValueError, match="interleave"):
        run_store.put_days(spark, path, with_amount(spark, rows))
    assert run_store.stored_totals(spark, path).count() == 0
