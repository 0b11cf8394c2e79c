"""Top runs and side-by-side reports: limit/join order, ties, padding, rates."""

from __future__ import annotations

from decimal import Decimal

from runlens.functions.numeric import pc_change_expr, rate_1dp, rate_int
from runlens.operators import compare as cmp
from runlens.operators.top_runs import top_runs
from runlens.schema import TRADES

D = "2024-01-01"


def _trades(spark, rows):
    """rows: (symbol, buyer, seller, amount) in id order, quantity 1."""
    data = [(i + 1, D, s, b, sl, 1, Decimal(a), Decimal(a)) for i, (s, b, sl, a) in enumerate(rows)]
    return spark.createDataFrame(data, TRADES)


def _prices(spark, rows):
    return spark.createDataFrame(rows, "date string, stock_symbol string, pc_change double")


def test_limit_before_inner_price_join(spark):
    tr = _trades(spark, [("A", "1", "5", 100), ("A", "2", "5", 90), ("B", "3", "6", 80)])
    # No price row for B: the top-3 loses it; a duplicate price row for A fans out.
    pr = _prices(spark, [(D, "A", 1.5), (D, "A", 1.5)])
    out = top_runs(tr, pr, "buy", None, None, 3).collect()
    assert len(out) == 4
    assert {r.stock_symbol for r in out} == {"A"}
    out2 = top_runs(tr, _prices(spark, [(D, "A", 1.5), (D, "B", -2.0)]), "buy", None, None, 2).collect()
    assert sorted(r.buyer for r in out2) == ["1", "2"]  # B ranks third and is cut before the join


def test_symbol_filter_after_numbering(spark):
    # Broker 1 runs from A into B: the B row carries the whole run's totals.
    tr = _trades(spark, [("A", "1", "5", 10), ("B", "1", "6", 20), ("B", "2", "6", 5)])
    pr = _prices(spark, [(D, "A", 0.0), (D, "B", 0.0)])
    rows = top_runs(tr, pr, "buy", None, None, 10, symbol="B").collect()
    got = sorted((r.buyer, r.cuml, r.trnxs) for r in rows)
    assert got == [("1", 30.0, 2), ("2", 5.0, 1)]


def test_broker_text_order(spark):
    tr = _trades(spark, [("A", "9", "1", 1), ("A", "58", "1", 1), ("A", "6", "1", 1)])
    pr = _prices(spark, [(D, "A", 0.0)])
    rows = top_runs(tr, pr, "buy", None, None, 10, symbol="A").collect()
    assert [r.buyer for r in rows] == ["9", "6", "58"]


def test_ties_are_deterministic(spark):
    tr = _trades(spark, [("A", str(i % 2), "1", 7) for i in range(10)])
    pr = _prices(spark, [(D, "A", 0.0)])
    a = [r.grp for r in top_runs(tr, pr, "buy", None, None, 4).collect()]
    b = [r.grp for r in top_runs(tr.repartition(5), pr, "buy", None, None, 4).collect()]
    assert sorted(a) == sorted(b) == [1, 2, 3, 4]


def test_compare_symbol_missing_sell_side_is_null(spark):
    tr = _trades(spark, [("A", "1", "5", 10), ("A", "2", "5", 20)])
    pr = _prices(spark, [(D, "A", 0.0)])
    rows = cmp.compare_symbol(tr, pr, None, None, "A", 5).collect()
    assert len(rows) == 2
    assert [r.sell_amount for r in rows].count(None) == 1
    assert all(r.buy_rate in (10, 20) for r in rows)


def test_compare_all_pads_both_sides(spark):
    tr = _trades(spark, [("A", "1", "5", 10), ("A", "2", "5", 20), ("B", "1", "6", 1), ("B", "1", "7", 2)])
    pr = _prices(spark, [(D, "A", 0.0), (D, "B", 0.0)])
    rows = cmp.compare_all(tr, pr, None, None, 10).collect()
    a = [r for r in rows if r.stock_symbol == "A"]
    b = [r for r in rows if r.stock_symbol == "B"]
    assert len(a) == 2 and sum(r.sell_amount is None for r in a) == 1   # 2 buys, 1 sell
    assert len(b) == 2 and sum(r.buy_amount is None for r in b) == 1    # 1 buy, 2 sells
    assert [r.pos for r in a] == [1, 2]


def test_rates(spark):
    import numpy as np
    vals = [(7.9, 1), (-7.9, 1), (0.25, 1), (0.35, 1), (2.675, 1), (1234.56, 7), (5.0, 0)]
    df = spark.createDataFrame(vals, "a double, q long")
    got = df.select(rate_int("a", "q").alias("i"), rate_1dp("a", "q").alias("r")).collect()
    assert [r.i for r in got] == [7, -7, 0, 0, 2, 176, None]
    # half-even on the scaled value, exactly as NumPy's around
    assert [r.r for r in got][:-1] == [float(np.around(a / q, 1)) for a, q in vals[:-1]]
    assert got[-1].r is None


def test_pc_change(spark):
    df = spark.createDataFrame([(5.0, 0.0), (1.0, 3.0), (-2.0, 8.0)], "d double, p double")
    got = [r.x for r in df.select(pc_change_expr("d", "p").alias("x")).collect()]
    assert got == [0.0, 33.33, -25.0]


def test_side_names(spark):
    tr = _trades(spark, [("A", "1", "5", 10)])
    pr = _prices(spark, [(D, "A", 0.0)])
    cols = top_runs(tr, pr, "sell", None, None, 1).columns
    assert cols == ["grp", "date", "stock_symbol", "seller", "cuml", "cumq", "trnxs", "pc_change"]


def test_top_runs_sides_equals_per_side(spark):
    import random
    from runlens.operators.top_runs import top_runs_sides
    rnd = random.Random(7)
    rows = [(rnd.choice("AB"), rnd.choice("123"), rnd.choice("45"), rnd.randint(1, 9)) for _ in range(80)]
    tr = _trades(spark, rows)
    pr = _prices(spark, [(D, "A", 1.0), (D, "B", 2.0)])
    both = top_runs_sides(tr, pr, None, None, {"buy": 7, "sell": 9}).collect()
    for side, n, b in (("buy", 7, "buyer"), ("sell", 9, "seller")):
        one = sorted((r.grp, r.stock_symbol, r[b], r.cuml, r.trnxs) for r in top_runs(tr, pr, side, None, None, n).collect())
        got = sorted((r.grp, r.stock_symbol, r.broker, r.cuml, r.trnxs) for r in both if r.side == side)
        assert got == one


def test_compare_all_plan_bounds_the_per_side_top_n(spark):
    tr = _trades(spark, [("A", "1", "5", 10), ("A", "2", "5", 20)])
    pr = _prices(spark, [(D, "A", 0.0)])
    df = cmp.compare_all(tr, pr, None, None, 10)
    # The static physical plan (before AQE adapts it to this tiny input, where a
    # coalesced single partition makes the split unnecessary) must keep a partial
    # top-n per side before the shuffle: never a full sort of all runs of a side.
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 11, Partial" in plan and "row_number(), 11, Final" in plan


def test_top_runs_sides_above_group_limit_threshold(spark):
    from runlens.operators.top_runs import top_runs_sides
    tr = _trades(spark, [("A", str(i % 3), str(i % 2), i + 1) for i in range(12)])
    pr = _prices(spark, [(D, "A", 0.5)])
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "3")
        df = top_runs_sides(tr, pr, None, None, {"buy": 4, "sell": 5})
        assert "WindowGroupLimit" not in df._jdf.queryExecution().executedPlan().toString()
        slow = sorted(tuple(r) for r in df.collect())
    finally:
        spark.conf.set(key, old)
    fast = sorted(tuple(r) for r in top_runs_sides(tr, pr, None, None, {"buy": 4, "sell": 5}).collect())
    assert slow == fast and len(fast) == 9
