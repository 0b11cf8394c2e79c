"""Run numbering: hand-made edge cases (FIXTURES.md F7) and properties."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from runlens.operators import runs
from runlens.schema import TRADES


def _trades(spark, rows):
    """rows: (symbol, buyer) in id order, or (symbol, buyer, date)."""
    data = []
    for i, r in enumerate(rows):
        sym, buyer = r[0], r[1]
        date = r[2] if len(r) > 2 else "2024-01-01"
        data.append((i + 1, date, sym, buyer, buyer, 1, None, None))
    return spark.createDataFrame(data, TRADES)


def _grps(df):
    return [r.grp for r in df.orderBy("id").collect()]


CASES = [
    ("one trade", [("A", "1")], [1]),
    ("one broker across symbols", [("A", "1"), ("A", "1"), ("B", "1")], [1, 1, 1]),
    ("alternating", [("A", "1"), ("A", "2"), ("A", "1")], [1, 2, 3]),
    ("null broker", [("A", "1"), ("A", None), ("A", None), ("A", "1")], [1, 2, 3, 4]),
]


@pytest.mark.parametrize("name,rows,expected", CASES, ids=[c[0] for c in CASES])
@pytest.mark.parametrize("width,fanout", [(100_000, 4096), (1, 2), (2, 1), (1, (2, 2)), (1, ())])
def test_edge_cases(spark, name, rows, expected, width, fanout):
    df = runs.with_run_ids(_trades(spark, rows), "buy", bucket_width=width, fanout=fanout)
    assert _grps(df) == expected


def test_flags(spark):
    df = runs.with_run_ids(_trades(spark, [("A", "1"), ("A", "1"), ("A", "2"), ("B", "2")]), "buy", bucket_width=1)
    assert [r.r for r in df.orderBy("id").collect()] == [1, None, 1, None]


def test_strict_by_symbol(spark):
    rows = [("A", "1"), ("A", "1"), ("B", "1")]
    df = runs.with_run_ids(_trades(spark, rows), "buy", break_on=("stock_symbol",))
    assert _grps(df) == [1, 1, 2]


def test_strict_by_date(spark):
    rows = [("A", "1", "2024-01-01"), ("A", "1", "2024-01-02"), ("A", "1", "2024-01-02")]
    df = runs.with_run_ids(_trades(spark, rows), "buy", break_on=("stock_symbol", "date"), bucket_width=1)
    assert _grps(df) == [1, 2, 2]


def test_symbol_order_is_bytewise_and_nulls_last(spark):
    rows = [("a", "1"), (None, "1"), ("B", "2"), ("A", "2")]
    df = runs.with_run_ids(_trades(spark, rows), "buy", bucket_width=1)
    got = {r.id: r.grp for r in df.collect()}
    # order: A(id4,b2) B(id3,b2) a(id1,b1) NULL(id2,b1) -> runs 1,1,2,2
    assert got == {4: 1, 3: 1, 1: 2, 2: 2}


def test_empty_range(spark):
    df = runs.with_run_ids(_trades(spark, [("A", "1")]), "buy", start="2030-01-01", end="2030-12-31")
    assert df.count() == 0


def test_totals_repeat_across_dates(spark):
    rows = [("A", "1", "2024-01-01"), ("A", "1", "2024-01-02"), ("A", "2", "2024-01-02")]
    tr = _trades(spark, rows).withColumn("amount", F.lit(10).cast("decimal(18,4)"))
    tot = runs.run_totals(runs.with_run_ids(tr, "buy"), "buy")
    got = sorted((r.grp, r.date, float(r.cuml), r.trnxs) for r in tot.collect())
    assert got == [(1, "2024-01-01", 20.0, 2), (1, "2024-01-02", 20.0, 2), (2, "2024-01-02", 10.0, 1)]


def test_run_detail(spark):
    rows = [("A", "1"), ("A", "1"), ("A", "2")]
    numbered = runs.with_run_ids(_trades(spark, rows), "buy")
    assert sorted(r.id for r in runs.run_detail(numbered, 1).collect()) == [1, 2]
    sel = spark.createDataFrame([(2,)], "grp long")
    assert [r.id for r in runs.run_detail(numbered, sel).collect()] == [3]


def test_bad_arguments(spark):
    tr = _trades(spark, [("A", "1")])
    with pytest.raises(ValueError):
        runs.with_run_ids(tr, "hold")
    with pytest.raises(ValueError):
        runs.with_run_ids(tr, "buy", break_on=("buyer",))
    with pytest.raises(ValueError):
        runs.with_run_ids(tr, "buy", bucket_width=0)
    with pytest.raises(ValueError):
        runs.with_run_ids(tr, "buy", fanout=(4, 0))


def _random_trades(spark, seed, n):
    rnd = random.Random(seed)
    syms = ["A", "B", "a", None][: rnd.randint(1, 4)]
    brokers = ["1", "2", "58", "9", None][: rnd.randint(1, 5)]
    ids = rnd.sample(range(-50, 5 * n + 50), n)
    data = [(i, f"2024-01-0{rnd.randint(1, 3)}", rnd.choice(syms), rnd.choice(brokers), rnd.choice(brokers),
             rnd.randint(0, 5), None, None) for i in ids]
    return spark.createDataFrame(data, TRADES)


FANOUTS = st.one_of(st.integers(1, 5), st.tuples(st.integers(1, 4), st.integers(1, 4)),
                   st.tuples(st.integers(1, 3), st.integers(1, 3), st.integers(1, 3)), st.just(()))


@settings(max_examples=16, deadline=None)
@given(seed=st.integers(0, 10_000), n=st.integers(1, 60), width=st.integers(1, 40), fanout=FANOUTS,
       mode=st.sampled_from([(), ("stock_symbol",), ("stock_symbol", "date")]),
       side=st.sampled_from(["buy", "sell"]))
def test_segmented_equals_global_window(spark, seed, n, width, fanout, mode, side):
    tr = _random_trades(spark, seed, n)
    seg = runs.with_run_ids(tr, side, break_on=mode, bucket_width=width, fanout=fanout).select("id", "r", "grp")
    naive = runs.with_run_ids_naive(tr, side, break_on=mode).select("id", "r", "grp")
    key = lambda t: t[0]  # noqa: E731  (ids are unique)
    assert sorted(map(tuple, seg.collect()), key=key) == sorted(map(tuple, naive.collect()), key=key)
    grps = sorted({r.grp for r in seg.collect()})
    assert grps == list(range(1, len(grps) + 1))  # numbered 1..max without holes
    tot = runs.run_totals(runs.with_run_ids(tr, side, break_on=mode, bucket_width=width), side)
    per_run = {r.grp: r.trnxs for r in tot.collect()}
    assert sum(per_run.values()) == n  # every trade in exactly one run
    if mode == ("stock_symbol", "date"):
        # strict runs never repeat a total across rows
        assert tot.count() == len(per_run)


@settings(max_examples=8, deadline=None)
@given(seed=st.integers(0, 10_000), n=st.integers(1, 60), width=st.integers(1, 40), fanout=FANOUTS,
       mode=st.sampled_from([(), ("stock_symbol", "date")]))
def test_summary_from_pieces_equals_per_trade_totals(spark, seed, n, width, fanout, mode):
    tr = _random_trades(spark, seed, n).withColumn("amount", (F.col("id") % 7).cast("decimal(18,4)"))
    fast = runs.run_summary(tr, "buy", break_on=mode, bucket_width=width, fanout=fanout)
    slow = runs.run_totals(runs.with_run_ids_naive(tr, "buy", break_on=mode), "buy")
    key = lambda t: (t[0], t[1], t[2] or "")
    assert sorted(map(tuple, fast.collect()), key=key) == sorted(map(tuple, slow.collect()), key=key)


@settings(max_examples=8, deadline=None)
@given(seed=st.integers(0, 10_000), n=st.integers(1, 50), width=st.integers(1, 20), fanout=FANOUTS,
       mode=st.sampled_from([(), ("stock_symbol", "date")]))
def test_stacked_sides_equal_one_side_at_a_time(spark, seed, n, width, fanout, mode):
    tr = _random_trades(spark, seed, n).withColumn("amount", (F.col("id") % 5).cast("decimal(18,4)"))
    both = runs.run_summary_sides(tr, ("buy", "sell"), break_on=mode, bucket_width=width, fanout=fanout).collect()
    key = lambda t: (t[0], t[1], t[2] or "", t[3] or "")
    for side, b in (("buy", "buyer"), ("sell", "seller")):
        one = runs.run_summary(tr, side, break_on=mode, bucket_width=width, fanout=fanout).collect()
        want = sorted(((r.grp, r.date, r.stock_symbol, r[b], r.cuml, r.cumq, r.trnxs) for r in one), key=key)
        got = sorted(((r.grp, r.date, r.stock_symbol, r.broker, r.cuml, r.cumq, r.trnxs) for r in both
                      if r.side == side), key=key)
        assert got == want


@pytest.mark.parametrize("mode", [(), ("stock_symbol", "date")], ids=["global", "strict"])
def test_run_trades_equals_the_numbered_rows(spark, mode):
    """Every run, read by its segments: NULL symbols and brokers, runs over many
    segments, runs across symbols."""
    r = random.Random(11)
    rows = [(r.choice(["A", "AB", "B", None]), r.choice(["1", "1", "1", "2", None]), r.choice(["2024-01-01", "2024-01-02"]))
            for _ in range(80)]
    trades = _trades(spark, rows)
    want = {}
    for x in runs.with_run_ids_naive(trades, "buy", break_on=mode).collect():
        want.setdefault(x.grp, []).append(tuple(x))
    for grp in [*sorted(want, key=lambda g: -len(want[g]))[:5], min(want), max(want), 0, max(want) + 1]:
        got = runs.run_trades(trades, "buy", grp, break_on=mode, bucket_width=4, fanout=(2, 2))
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.get(grp, [])))
