"""Registered queries: one per operator of the inventory, each with its
DuckDB oracle where the result is expressible in SQL.

Every query reads the supplied tables (or tables Spark derives from them) in
full; date ranges, symbols and ``n`` are the operators' own parameters, fixed
to the sample values of FIXTURES.md.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import compare as cmp
from ..operators import runs
from ..operators.top_runs import top_runs, top_runs_sides, with_position
from ..schema import broker_col
from ..sources import fixtures as fx
from . import oracle as O

START, END = fx.F1_RANGE
SYMBOL = fx.F1_SYMBOL
N_ONE = 100   # one symbol (reference sample)
N_ALL = 800   # all symbols (reference sample)
DAY = "2024-01-10"   # one-day range, as the reference's sample calls (start = end)

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)


def _load_all() -> None:
    # Registration side effects of the other query modules.
    from . import catalog_ingest, catalog_enrich  # noqa: F401


def as_output(df: DataFrame) -> DataFrame:
    """Decimals leave as DOUBLE (exact sums, then one rounding)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


# --------------------------------------------------------------------------
# Inputs
# --------------------------------------------------------------------------

def f1_trades(spark: SparkSession, sf: str) -> DataFrame:
    """F1 trades, all dates: the range is the operators' own work."""
    return fx.trades_from_events(fx.table(spark, sf, "events"))


def f1_prices(spark: SparkSession, sf: str) -> DataFrame:
    """F2 with the rows that show the price join losing runs left out."""
    return fx.prices_from_trades(f1_trades(spark, sf))


def f1_prices_all(spark: SparkSession, sf: str) -> DataFrame:
    return fx.prices_from_trades(f1_trades(spark, sf), drop_symbol=None, drop_dates=None)


def f3_trades(spark: SparkSession, sf: str) -> DataFrame:
    return fx.trades_from_orders(fx.table(spark, sf, "orders"), fx.table(spark, sf, "customer"))


def f3_prices(spark: SparkSession, sf: str) -> DataFrame:
    return fx.prices_from_trades(f3_trades(spark, sf), drop_symbol=None, drop_dates=None)


F1 = f"trades AS ({O.TRADES_F1})"
F3 = f"trades AS ({O.TRADES_F3})"
P1 = O.prices_sql()
P1_ALL = O.prices_sql(drop=False)
P3 = O.prices_sql(drop=False)
TRADE_COLS = "id, date, stock_symbol, buyer, seller, quantity, CAST(rate AS DOUBLE) AS rate, CAST(amount AS DOUBLE) AS amount"


# --------------------------------------------------------------------------
# R: runs
# --------------------------------------------------------------------------

@register("trades_in_range", O.with_ctes(F1) + f"SELECT {TRADE_COLS} FROM trades WHERE date >= '{START}' AND date <= '{END}'")
def q_trades_in_range(spark, sf):
    return as_output(runs.trades_in_range(f1_trades(spark, sf), START, END))


def _register_side(side: str) -> None:
    b = broker_col(side)

    def run_flags(spark, sf):
        n = runs.with_run_ids(f1_trades(spark, sf), side)
        return n.select("id", "date", "stock_symbol", b, "r")

    register(f"run_flags_{side}",
             O.with_ctes(F1, O.runs_sql(side, None, None)) + f"SELECT id, date, stock_symbol, {b}, r FROM numbered")(run_flags)

    def run_ids(spark, sf):
        return as_output(runs.with_run_ids(f1_trades(spark, sf), side))

    register(f"run_ids_{side}",
             O.with_ctes(F1, O.runs_sql(side, None, None)) + f"SELECT {TRADE_COLS}, r, grp FROM numbered")(run_ids)

    def totals(spark, sf):
        return as_output(runs.run_totals(runs.with_run_ids(f1_trades(spark, sf), side), side))

    register(f"run_totals_{side}",
             O.with_ctes(F1, O.runs_sql(side, None, None), O.totals_sql(side))
             + f"SELECT grp, date, stock_symbol, {b}, CAST(cuml AS DOUBLE) AS cuml, CAST(cumq AS BIGINT) AS cumq, "
               "CAST(trnxs AS BIGINT) AS trnxs FROM run_rows")(totals)

    def top_symbol(spark, sf):
        return top_runs(f1_trades(spark, sf), f1_prices(spark, sf), side, START, END, N_ONE, symbol=SYMBOL)

    register(f"top_runs_symbol_{side}",
             O.with_ctes(F1, P1, O.runs_sql(side, START, END), O.totals_sql(side), O.top_sql(side, N_ONE, SYMBOL))
             + "SELECT * FROM largest")(top_symbol)

    def top_all(spark, sf):
        return top_runs(f1_trades(spark, sf), f1_prices(spark, sf), side, START, END, N_ALL)

    register(f"top_runs_all_{side}",
             O.with_ctes(F1, P1, O.runs_sql(side, START, END), O.totals_sql(side), O.top_sql(side, N_ALL, None))
             + "SELECT * FROM largest")(top_all)

    def detail(spark, sf):
        # Drill into the largest run of the range (its number found by Spark,
        # never collected): R-16 / R-17.
        numbered = runs.with_run_ids(f1_trades(spark, sf), side, START, END)
        best = (runs.run_totals(numbered, side)
                .orderBy(F.col("cuml").desc_nulls_last(), "grp").limit(1).select("grp"))
        return as_output(runs.run_detail(numbered, best))

    register(f"run_detail_{side}",
             O.with_ctes(F1, O.runs_sql(side, START, END), O.totals_sql(side),
                         "best AS (SELECT grp FROM run_rows ORDER BY cuml DESC NULLS LAST, grp LIMIT 1)")
             + f"SELECT {TRADE_COLS}, r, grp FROM numbered WHERE grp IN (SELECT grp FROM best)")(detail)

    def one_run(spark, sf):
        # The same run read by segments; only its number comes to the driver.
        trades = f1_trades(spark, sf)
        best = (runs.run_summary(trades, side, START, END)
                .orderBy(F.col("cuml").desc_nulls_last(), "grp").select("grp").first())
        return as_output(runs.run_trades(trades, side, best.grp if best else 0, START, END, bucket_width=1000))

    register(f"run_trades_{side}", _SQL[f"run_detail_{side}"])(one_run)

    place = f"row_number() OVER (ORDER BY {{}}date NULLS LAST, {b} DESC NULLS FIRST, cuml DESC NULLS FIRST, grp)"

    def placed_symbol(spark, sf):
        return with_position(top_symbol(spark, sf), side, False)

    register(f"report_order_symbol_{side}", _SQL[f"top_runs_symbol_{side}"].replace(
        "SELECT * FROM largest", f"SELECT *, CAST({place.format('')} AS INTEGER) AS pos FROM largest"))(placed_symbol)

    def placed_all(spark, sf):
        return with_position(top_all(spark, sf), side, True)

    register(f"report_order_all_{side}", _SQL[f"top_runs_all_{side}"].replace(
        "SELECT * FROM largest",
        f"SELECT *, CAST({place.format('stock_symbol NULLS LAST, ')} AS INTEGER) AS pos FROM largest"))(placed_all)

    def strict(spark, sf):
        return top_runs(f1_trades(spark, sf), f1_prices(spark, sf), side, START, END, N_ALL,
                        break_on=("stock_symbol", "date"))

    register(f"top_runs_strict_{side}",
             O.with_ctes(F1, P1, O.runs_sql(side, START, END, strict=True), O.totals_sql(side),
                         O.top_sql(side, N_ALL, None)) + "SELECT * FROM largest")(strict)

    # Same operators on F3 (orders): id order is not date order, 25 symbols,
    # whole table, no range.
    def f3_top(spark, sf):
        return top_runs(f3_trades(spark, sf), f3_prices(spark, sf), side, None, None, N_ALL)

    register(f"top_runs_all_{side}_orders",
             O.with_ctes(F3, P3, O.runs_sql(side, None, None), O.totals_sql(side), O.top_sql(side, N_ALL, None))
             + "SELECT * FROM largest")(f3_top)

    def f3_strict_ids(spark, sf):
        return as_output(runs.with_run_ids(f3_trades(spark, sf), side, break_on=("stock_symbol", "date")))

    register(f"run_ids_strict_{side}_orders",
             O.with_ctes(F3, O.runs_sql(side, None, None, strict=True)) + f"SELECT {TRADE_COLS}, r, grp FROM numbered")(f3_strict_ids)


for _side in ("buy", "sell"):
    _register_side(_side)


# Segments of 64 ids and two levels of super-segments: every symbol spans many
# segments, so the offsets between them are part of the result.
SMALL = {"bucket_width": 64, "fanout": (4, 4)}


@register("run_ids_buy_small_segments", O.with_ctes(F1, O.runs_sql("buy", None, None))
          + f"SELECT {TRADE_COLS}, r, grp FROM numbered")
def q_run_ids_small(spark, sf):
    return as_output(runs.with_run_ids(f1_trades(spark, sf), "buy", **SMALL))


@register("run_totals_sell_small_segments", O.with_ctes(F1, O.runs_sql("sell", None, None), O.totals_sql("sell"))
          + "SELECT grp, date, stock_symbol, seller, CAST(cuml AS DOUBLE) AS cuml, CAST(cumq AS BIGINT) AS cumq, "
            "CAST(trnxs AS BIGINT) AS trnxs FROM run_rows")
def q_run_totals_small(spark, sf):
    out = runs.run_summary(f1_trades(spark, sf), "sell", **SMALL)
    return as_output(out).select("grp", "date", "stock_symbol", "seller", "cuml", "cumq", "trnxs")


@register("top_runs_all_buy_small_segments",
          O.with_ctes(F1, P1, O.runs_sql("buy", START, END), O.totals_sql("buy"), O.top_sql("buy", N_ALL, None))
          + "SELECT * FROM largest")
def q_top_runs_small(spark, sf):
    return top_runs(f1_trades(spark, sf), f1_prices(spark, sf), "buy", START, END, N_ALL, **SMALL)


# --------------------------------------------------------------------------
# C: side-by-side reports
# --------------------------------------------------------------------------

def _side_sql(side: str, n: int, symbol: str | None, rate: str | None, partition: bool,
              start: str = START, end: str = END) -> list[str]:
    """CTEs ``<side>_largest`` (top runs) and, with ``rate``, ``<side>_pos`` (+ rate, position)."""
    b, p = broker_col(side), f"{side}_"
    out = [O.runs_sql(side, start, end, p=p), O.totals_sql(side, p=p),
           O.top_sql(side, n, symbol, name=f"{p}largest", p=p)]
    if rate is not None:
        part = "PARTITION BY stock_symbol " if partition else ""
        out.append(f"""{p}pos AS (
  SELECT *, {rate} AS rate,
         CAST(row_number() OVER ({part}ORDER BY date NULLS LAST, {b} DESC NULLS FIRST, cuml DESC NULLS FIRST, grp)
              AS INTEGER) AS pos
  FROM {p}largest)""")
    return out


_PAIR_COLS = """b.date AS buy_date, b.stock_symbol AS buy_symbol, b.cuml AS buy_amount, b.cumq AS buy_quantity,
       b.trnxs AS buy_trnxs, b.pc_change AS buy_pc_change, b.rate AS buy_rate, b.grp AS buy_grp, b.buyer,
       s.date AS sell_date, s.stock_symbol AS sell_symbol, s.cuml AS sell_amount, s.cumq AS sell_quantity,
       s.trnxs AS sell_trnxs, s.pc_change AS sell_pc_change, s.rate AS sell_rate, s.grp AS sell_grp, s.seller"""


def _compare_symbol_sql(n: int, symbol: str) -> str:
    rate = "CAST(trunc(cuml / cumq) AS BIGINT)"
    return (O.with_ctes(F1, P1, *_side_sql("buy", n, symbol, rate, False), *_side_sql("sell", n, symbol, rate, False))
            + f"SELECT b.pos, {_PAIR_COLS}\nFROM buy_pos b LEFT JOIN sell_pos s ON b.pos = s.pos")


def _two_sides_sql(n_buy: int, n_sell: int, rate: str | None, start: str = START, end: str = END) -> list[str]:
    return [*_side_sql("buy", n_buy, None, rate, True, start, end),
            *_side_sql("sell", n_sell, None, rate, True, start, end)]


@register("compare_symbol", _compare_symbol_sql(N_ONE, SYMBOL))
def q_compare_symbol(spark, sf):
    return cmp.compare_symbol(f1_trades(spark, sf), f1_prices(spark, sf), START, END, SYMBOL, N_ONE)


@register("run_rate_int", O.with_ctes(F1, P1, O.runs_sql("buy", START, END), O.totals_sql("buy"),
                                      O.top_sql("buy", N_ONE, SYMBOL))
          + "SELECT *, CAST(trunc(cuml / cumq) AS BIGINT) AS rate FROM largest")
def q_run_rate_int(spark, sf):
    t = top_runs(f1_trades(spark, sf), f1_prices(spark, sf), "buy", START, END, N_ONE, symbol=SYMBOL)
    return cmp.with_rate_int(t)


@register("run_rate_1dp", O.with_ctes(F1, P1, O.runs_sql("buy", START, END), O.totals_sql("buy"),
                                      O.top_sql("buy", N_ALL, None))
          + "SELECT *, round_even(cuml / cumq, 1) AS rate FROM largest")
def q_run_rate_1dp(spark, sf):
    t = top_runs(f1_trades(spark, sf), f1_prices(spark, sf), "buy", START, END, N_ALL)
    return cmp.with_rate_1dp(t)


def _both_tops(spark, sf, n_buy, n_sell):
    return top_runs_sides(f1_trades(spark, sf), f1_prices(spark, sf), START, END,
                          {"buy": n_buy, "sell": n_sell})


@register("runs_per_symbol", O.with_ctes(F1, P1, *_two_sides_sql(N_ALL, N_ALL + 1, None)) + """
SELECT 'buy' AS side, stock_symbol, count(*) AS runs FROM buy_largest GROUP BY stock_symbol
UNION ALL
SELECT 'sell' AS side, stock_symbol, count(*) AS runs FROM sell_largest GROUP BY stock_symbol""")
def q_runs_per_symbol(spark, sf):
    return cmp.runs_per_symbol(_both_tops(spark, sf, N_ALL, N_ALL + 1))


@register("symbols_either_side", O.with_ctes(F1, P1, *_two_sides_sql(N_ALL, N_ALL + 1, None)) + """
SELECT stock_symbol FROM buy_largest UNION SELECT stock_symbol FROM sell_largest""")
def q_symbols_either_side(spark, sf):
    return cmp.symbols_either_side(_both_tops(spark, sf, N_ALL, N_ALL + 1))


def _compare_all_sql(start: str, end: str, n: int = N_ALL) -> str:
    return O.with_ctes(F1, P1, *_two_sides_sql(n, n + 1, "round_even(cuml / cumq, 1)", start, end)) + f"""
SELECT coalesce(b.stock_symbol, s.stock_symbol) AS stock_symbol, coalesce(b.pos, s.pos) AS pos,
       {_PAIR_COLS}
FROM buy_pos b FULL OUTER JOIN sell_pos s ON b.stock_symbol = s.stock_symbol AND b.pos = s.pos"""


COMPARE_ALL_SQL = _compare_all_sql(START, END)


@register("compare_all", COMPARE_ALL_SQL)
def q_compare_all(spark, sf):
    return cmp.compare_all(f1_trades(spark, sf), f1_prices(spark, sf), START, END, N_ALL)


@register("compare_all_1000", _compare_all_sql(START, END, 1000))
def q_compare_all_1000(spark, sf):
    return cmp.compare_all(f1_trades(spark, sf), f1_prices(spark, sf), START, END, 1000)


# One trading day (start = end), the shape of the reference's own sample calls:
# runs cannot cross dates, only symbols.

@register("top_runs_all_buy_one_day",
          O.with_ctes(F1, P1, O.runs_sql("buy", DAY, DAY), O.totals_sql("buy"), O.top_sql("buy", N_ALL, None))
          + "SELECT * FROM largest")
def q_top_runs_all_buy_one_day(spark, sf):
    return top_runs(f1_trades(spark, sf), f1_prices(spark, sf), "buy", DAY, DAY, N_ALL)


@register("compare_all_one_day", _compare_all_sql(DAY, DAY))
def q_compare_all_one_day(spark, sf):
    return cmp.compare_all(f1_trades(spark, sf), f1_prices(spark, sf), DAY, DAY, N_ALL)
