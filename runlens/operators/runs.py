"""Consecutive same-broker trade runs ("gaps and islands") at any scale.

Semantics (kept from the reference):

* trades are ordered by ``(stock_symbol, id)``; NULL symbols sort last;
* a row starts a run (flag ``r = 1``) unless the previous row in that order has
  the same, non-NULL broker; inside a run ``r`` is NULL;
* ``grp`` is the running sum of ``r`` over the *whole* range: runs are global,
  so a run may cross from one symbol into the next, and across dates;
* with ``break_on`` (ours, "strict" runs) the order becomes
  ``(stock_symbol, [date], id)`` and a run also ends when a ``break_on``
  column changes.

A naive ``Window.orderBy(...)`` without ``partitionBy`` would move every trade
to one task.  ``with_run_ids`` instead computes the same numbers with a
segmented prefix scan:

1. segment = (order prefix, ``id div W``): ids are unique, so a segment holds
   at most ``W`` trades whatever the skew of a symbol;
2. flags and local run numbers are computed per segment (one hash shuffle of
   the trades, sorted by id inside each segment);
3. one summary row per segment (local run count, first and last broker) is
   scanned per super-segment of ``K`` consecutive segments (more levels with
   ``fanout=(K1, K2, ...)``), then per symbol and per group of symbols with the
   same first two characters; one row per such group is scanned in a single task;
4. the segment offsets are joined back on the segment key, which the trades
   (or their per-run pieces) are already partitioned and sorted by.

The summary needs only (id, broker, keys), so Spark plans it as a second,
narrow pass over the trades; the wide pass is shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import broker_col

# Ids per segment: a segment never holds more trades than this.
# Ten pages of a loaded table (ids hold 10^5 rows a page).
DEFAULT_BUCKET_WIDTH = 1_000_000
# Segments per super-segment (one level; pass a tuple for more levels).
DEFAULT_FANOUT = 4_096

_B1, _B2 = "_seg", "_sup"
_ROWS_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def trades_in_range(trades: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Inclusive text range on ``date`` (R-1).  On a table partitioned by date
    this is partition pruning; on Parquet it is a pushed filter."""
    out = trades
    if start is not None:
        out = out.filter(F.col("date") >= F.lit(start))
    if end is not None:
        out = out.filter(F.col("date") <= F.lit(end))
    return out


def _bucket(name: str, width: int) -> Column:
    """Exact integer floor division of a long column (also for negative ids)."""
    w = int(width)
    return F.expr(f"(`{name}` - pmod(`{name}`, {w}L)) div {w}L")


def order_prefix(break_on: Sequence[str] = ()) -> list[str]:
    extra = [c for c in break_on if c != "stock_symbol"]
    bad = [c for c in extra if c != "date"]
    if bad:
        raise ValueError(f"break_on supports 'stock_symbol' and 'date', got {bad}")
    return ["stock_symbol", *extra]


def _key_cols(prefix: Sequence[str]) -> tuple[list[Column], list[str]]:
    """Non-null stand-ins for the order prefix: (is NULL, value-or-empty) per
    column.  Sorting on them equals ``ASC NULLS LAST``; equality on them is
    NULL-safe; and joins on plain columns keep the existing partitioning."""
    exprs, names = [], []
    for c in prefix:
        exprs += [F.col(c).isNull().alias(f"_n_{c}"), F.coalesce(F.col(c), F.lit("")).alias(f"_v_{c}")]
        names += [f"_n_{c}", f"_v_{c}"]
    return exprs, names


def _segmented(trades: DataFrame, b: str, start: str | None, end: str | None,
               break_on: Sequence[str], bucket_width: int, group: Sequence[str] = ()):
    """Steps 1-2: trades in range with segment keys, local flag ``_r0`` and
    local run number ``_g0`` for broker column ``b``.  ``group`` columns (never
    NULL) split the input into independent sequences, e.g. the ``side`` of
    stacked trades.  Returns (frame, key columns, segment columns)."""
    if bucket_width < 1:
        raise ValueError("bucket_width must be positive")
    prefix = order_prefix(break_on)
    key_exprs, pkeys = _key_cols(prefix)
    keys = [*group, *pkeys]
    # Non-nullable key: no inferred IS NOT NULL filters, so every consumer of
    # this frame plans the same shuffle and Spark reuses it.
    bucket = F.coalesce(_bucket("id", bucket_width), F.lit(0).cast("long")).alias(_B1)
    # The prefix columns travel only as their keys (flag + value) and are
    # rebuilt after the shuffle, so no string is shuffled twice.
    rest = [c for c in trades.columns if c not in prefix]
    df = trades_in_range(trades, start, end).select(*rest, *key_exprs, bucket)
    seg = [*keys, _B1]
    w0 = Window.partitionBy(*seg).orderBy("id")
    r0 = F.when(F.lag(b).over(w0) == F.col(b), F.lit(None).cast("int")).otherwise(F.lit(1))
    df = df.select("*", r0.alias("_r0"))
    df = df.select("*", F.sum("_r0").over(w0.rowsBetween(*_ROWS_TO_HERE)).alias("_g0"))
    restored = [F.when(F.col(f"_n_{c}"), F.lit(None).cast("string")).otherwise(F.col(f"_v_{c}")).alias(c)
                for c in prefix]
    return df.select("*", *restored), keys, seg


def _fanouts(fanout) -> tuple[int, ...]:
    ks = (fanout,) if isinstance(fanout, int) else tuple(fanout)
    if any(int(k) < 1 for k in ks):
        raise ValueError("fanout must be positive")
    return tuple(int(k) for k in ks)


def _segment_offsets(summ: DataFrame, keys: list[str], breaks: Sequence[str], fanout,
                     group: Sequence[str] = (), inner: Sequence[str] = ()) -> DataFrame:
    """Steps 3-4 on a block summary ``(keys..., _seg, _nb, _first, _last)``:
    per block its runs ``_nb``, the run-number offset ``_soff`` and ``_smerge`` = 1
    when its first local run continues the previous block's last run.

    Blocks are grouped into parent blocks that keep the order, whose summaries
    have the same shape and are solved the same way: ``K1`` blocks at a time, then
    ``K2`` of those, ... for fanouts ``(K1, K2, ...)``; then all blocks of a symbol
    (where a date stands between), then the symbols that share their first two
    characters.  Only the last scan is one task: a row per two characters.  ``inner``
    orders the parts of a segment where a block is one of those."""
    flags = [f"_{w}_{c}" for c in breaks for w in ("n", "v")]
    summ = summ.select("*", *[F.col(k).alias(f"{end}{k}") for k in flags for end in ("_a", "_z")])
    order = [k for k in keys if k not in group]
    levels, cols = [([], [*order, _B1])] if inner else [], [*order, _B1]
    for i, k in enumerate(_fanouts(fanout)):
        made = F.coalesce(_bucket(cols[-1], k), F.lit(0).cast("long")).alias(f"{_B2}{i}")
        levels.append(([made], [*order, f"{_B2}{i}"]))
        cols = [*order, f"{_B2}{i}"]
    if len(order) > 2:
        levels.append(([], order[:2]))
    levels.append(([F.substring(order[1], 1, 2).alias("_chars")], [order[0], "_chars"]))
    return _solve(summ, list(group), [*order, _B1, *inner], flags, levels)


def _solve(s: DataFrame, group: list[str], cols: list[str], flags: list[str], levels: list) -> DataFrame:
    """Offsets of blocks ``cols`` (in that order, per ``group``).  ``levels``:
    (columns to make, parent columns), from the smallest parents up."""
    made, parent_cols = levels[0] if levels else ([], [])
    s = s.select("*", *made)
    inside = [*group, *parent_cols]
    w = (Window.partitionBy(*inside) if inside else Window).orderBy(*cols)
    same = F.lag("_last").over(w) == F.col("_first")
    for k in flags:   # a change of a break column between the neighbours
        same = same & (F.lag(f"_z{k}").over(w) == F.col(f"_a{k}"))
    s = s.select("*", F.lag(F.lit(True)).over(w).isNull().alias("_head"),
                 F.coalesce(same, F.lit(False)).cast("long").alias("_m"))
    s = s.select("*", (F.col("_nb") - F.col("_m")).alias("_net"))
    s = s.select("*", (F.sum("_net").over(w.rowsBetween(*_ROWS_TO_HERE)) - F.col("_nb")).alias("_off"))
    if not levels:
        return s.select(*group, *cols, "_nb", F.col("_off").alias("_soff"), F.col("_m").alias("_smerge"))
    at = F.struct(*cols)
    parent = s.groupBy(*inside).agg(
        F.sum("_net").alias("_nb"), F.min_by("_first", at).alias("_first"), F.max_by("_last", at).alias("_last"),
        *[F.min_by(f"_a{k}", at).alias(f"_a{k}") for k in flags],
        *[F.max_by(f"_z{k}", at).alias(f"_z{k}") for k in flags])
    up = _solve(parent, group, parent_cols, flags, levels[1:]).select(
        *inside, F.col("_soff").alias("_poff"), F.col("_smerge").alias("_pmerge"))
    return s.join(up, inside).select(
        *group, *cols, "_nb", (F.col("_off") + F.col("_poff")).alias("_soff"),
        F.when(F.col("_head"), F.col("_pmerge")).otherwise(F.col("_m")).alias("_smerge"))


def with_run_ids(trades: DataFrame, side: str, start: str | None = None, end: str | None = None,
                 break_on: Sequence[str] = (), bucket_width: int = DEFAULT_BUCKET_WIDTH,
                 fanout: int | Sequence[int] = DEFAULT_FANOUT) -> DataFrame:
    """Trades in range plus ``r`` (run-start flag, 1 or NULL) and ``grp`` (run
    number, 1..) for the buying (``side='buy'``) or selling broker (R-3, R-4).

    The segment summary needs only (id, broker, keys) and is planned as its own
    narrow shuffle; the wide trades shuffle once and join the per-segment
    offsets on the key they are already partitioned and sorted by."""
    b = broker_col(side)
    df, keys, seg = _segmented(trades, b, start, end, break_on, bucket_width)
    return _numbered(df, _offsets(df, b, keys, seg, break_on, fanout), seg, trades.columns)


def _offsets(df: DataFrame, b: str, keys: list[str], seg: list[str], break_on: Sequence[str], fanout,
             group: Sequence[str] = ()) -> DataFrame:
    """``_segment_offsets`` of the segments of ``_segmented``."""
    summ = df.groupBy(*seg).agg(
        F.max("_g0").alias("_nb"),
        F.min_by(b, "id").alias("_first"),
        F.max_by(b, "id").alias("_last"))
    return _segment_offsets(summ, keys, list(break_on), fanout, group)


def _numbered(df: DataFrame, segs: DataFrame, seg: list[str], columns: list[str]) -> DataFrame:
    """Segmented trades with ``r`` and ``grp`` from the offsets of their segments."""
    out = df.join(segs, seg)
    first_row = (F.col("_r0") == 1) & (F.col("_g0") == 1)
    r = F.when(first_row & (F.col("_smerge") == 1), F.lit(None).cast("int")).otherwise(F.col("_r0"))
    return out.select(*columns, r.alias("r"), (F.col("_g0") + F.col("_soff")).cast("long").alias("grp"))


def run_pieces(trades: DataFrame, side: str, start: str | None = None, end: str | None = None,
               break_on: Sequence[str] = (), bucket_width: int = DEFAULT_BUCKET_WIDTH,
               fanout: int | Sequence[int] = DEFAULT_FANOUT) -> DataFrame:
    """Runs without per-trade output: one row per (run, date, symbol, segment)
    with partial sums ``_a``, ``_q``, ``_c`` and the global ``grp``.

    The trades shuffle to segments; everything after works on one row per local
    run.  The segment summary needs only (id, broker, keys); Spark plans it as a
    second, narrow pass over the trades."""
    return _pieces(trades, broker_col(side), (), start, end, break_on, bucket_width, fanout)


def _pieces(trades: DataFrame, b: str, group: Sequence[str], start, end, break_on, bucket_width,
            fanout) -> DataFrame:
    df, keys, seg = _segmented(trades, b, start, end, break_on, bucket_width, group)
    # Grouping keys contain the segment key: no shuffle.
    local = df.groupBy(*seg, "_g0", "date", "stock_symbol", b).agg(
        F.sum("amount").alias("_a"),
        F.sum("quantity").cast("long").alias("_q"),
        F.count(F.lit(1)).alias("_c"))
    # The summary reads only (id, broker, keys): Spark plans it as a narrow pass.
    segs = _offsets(df, b, keys, seg, break_on, fanout, group)
    return local.join(segs, seg).select(
        *group, (F.col("_g0") + F.col("_soff")).cast("long").alias("grp"), "date", "stock_symbol", b,
        "_a", "_q", "_c")


def with_run_ids_naive(trades: DataFrame, side: str, start: str | None = None, end: str | None = None,
                       break_on: Sequence[str] = ()) -> DataFrame:
    """The textbook formulation (global ``lag`` and running ``sum``).  It sends
    every trade of the range to one task; kept only as the baseline that the
    benchmark and the property tests compare the segmented scan against."""
    b = broker_col(side)
    prefix = order_prefix(break_on)
    order = [F.col(c).asc_nulls_last() for c in prefix] + [F.col("id")]
    w = Window.orderBy(*order)
    same = F.lag(b).over(w) == F.col(b)
    for c in break_on:
        same = same & F.lag(c).over(w).eqNullSafe(F.col(c)) & F.lag("id").over(w).isNotNull()
    df = trades_in_range(trades, start, end)
    df = df.withColumn("r", F.when(same, F.lit(None).cast("int")).otherwise(F.lit(1)))
    return df.withColumn("grp", F.sum("r").over(w.rowsBetween(*_ROWS_TO_HERE)).cast("long"))


def run_totals(numbered: DataFrame, side: str) -> DataFrame:
    """One row per (run, date, symbol) with the whole run's totals (R-5, R-6),
    from trades numbered by ``with_run_ids``."""
    b = broker_col(side)
    pieces = numbered.select(
        "grp", "date", "stock_symbol", b, F.col("amount").alias("_a"),
        F.col("quantity").cast("long").alias("_q"), F.lit(1).cast("long").alias("_c"))
    return totals_from_pieces(pieces, side)


def totals_from_pieces(pieces: DataFrame, side: str) -> DataFrame:
    """Whole-run totals on every (run, date, symbol) row: the pieces are shuffled
    once by run, grouped to those rows, and summed over the run by a window."""
    return _totals(pieces, broker_col(side), ())


def _totals(pieces: DataFrame, b: str, group: Sequence[str]) -> DataFrame:
    run = [*group, "grp"]
    rows = pieces.repartition(*run).groupBy(*run, "date", "stock_symbol", b).agg(
        *[F.sum(c).alias(c) for c in ("_a", "_q", "_c")])
    w = Window.partitionBy(*run)
    return rows.select(*run, "date", "stock_symbol", b, F.sum("_a").over(w).alias("cuml"),
                       F.sum("_q").over(w).alias("cumq"), F.sum("_c").over(w).alias("trnxs"))


def run_summary(trades: DataFrame, side: str, start: str | None = None, end: str | None = None,
                break_on: Sequence[str] = (), bucket_width: int = DEFAULT_BUCKET_WIDTH,
                fanout: int | Sequence[int] = DEFAULT_FANOUT) -> DataFrame:
    """``run_totals`` straight from trades, via ``run_pieces`` (one trades
    shuffle)."""
    return totals_from_pieces(run_pieces(trades, side, start, end, break_on, bucket_width, fanout), side)


def stack_sides(trades: DataFrame, sides: Sequence[str] = ("buy", "sell")) -> DataFrame:
    """One row per (trade, side) with ``side`` and ``broker`` instead of the
    buyer/seller columns, so both sides run through one pipeline (one scan
    and one shuffle of the trades) partitioned by ``side``."""
    pairs = F.array(*[F.struct(F.lit(s).alias("side"), F.col(broker_col(s)).alias("broker")) for s in sides])
    rest = [c for c in trades.columns if c not in ("buyer", "seller")]
    return trades.select(*rest, F.explode(pairs).alias("_s")).select(*rest, "_s.side", "_s.broker")


def run_summary_sides(trades: DataFrame, sides: Sequence[str] = ("buy", "sell"), start: str | None = None,
                      end: str | None = None, break_on: Sequence[str] = (),
                      bucket_width: int = DEFAULT_BUCKET_WIDTH,
                      fanout: int | Sequence[int] = DEFAULT_FANOUT) -> DataFrame:
    """``run_summary`` for several sides at once: columns ``side, grp, date,
    stock_symbol, broker, cuml, cumq, trnxs``; run numbers per side equal the
    one-side results."""
    stacked = stack_sides(trades, sides)
    pieces = _pieces(stacked, "broker", ["side"], start, end, break_on, bucket_width, fanout)
    return _totals(pieces, "broker", ["side"])


def run_detail(numbered: DataFrame, grp) -> DataFrame:
    """Every trade of one run (R-16, R-17).  ``grp`` is a number or a one-column
    DataFrame of run numbers (semi join, nothing collected; the planner
    broadcasts the selection when its size is known to be small, e.g. after a
    ``limit``)."""
    if isinstance(grp, DataFrame):
        return numbered.join(grp.select("grp").distinct(), "grp", "left_semi")
    return numbered.filter(F.col("grp") == F.lit(int(grp)))


def run_trades(trades: DataFrame, side: str, grp: int, start: str | None = None, end: str | None = None,
               break_on: Sequence[str] = (), bucket_width: int = DEFAULT_BUCKET_WIDTH,
               fanout: int | Sequence[int] = DEFAULT_FANOUT) -> DataFrame:
    """``run_detail`` straight from trades (R-16, R-17), without numbering the
    others: the narrow pass over (id, broker, keys) gives each segment's run numbers,
    and only trades of the segments that hold run ``grp`` are shuffled whole."""
    b, g = broker_col(side), F.lit(int(grp))
    narrow, keys, seg = _segmented(trades, b, start, end, break_on, bucket_width)
    segs = _offsets(narrow, b, keys, seg, break_on, fanout)
    hit = segs.filter((F.col("_soff") < g) & (F.col("_soff") + F.col("_nb") >= g))
    key_exprs, _ = _key_cols(order_prefix(break_on))
    bucket = F.coalesce(_bucket("id", bucket_width), F.lit(0).cast("long")).alias(_B1)
    inside = (trades_in_range(trades, start, end).select(*trades.columns, *key_exprs, bucket)
              .join(hit.select(*seg), seg, "left_semi").select(*trades.columns))
    df, _, _ = _segmented(inside, b, None, None, break_on, bucket_width)
    return _numbered(df, hit, seg, trades.columns).filter(F.col("grp") == g)
