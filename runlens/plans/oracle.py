"""Reference-shaped SQL for the correctness oracle (DuckDB dialect).

Independent formulations: run starts by ``IS DISTINCT FROM`` on the previous
broker, run numbers as a count of starts, totals by a plain ``GROUP BY`` joined
to the rows a run touches.  The Spark side uses other operators (segmented scan),
so agreement is a real check.  Decimals are cast to DOUBLE on output on both
sides; sums of decimals are exact, so the doubles agree bit for bit.
"""

from __future__ import annotations

from ..schema import broker_col

TRADES_F1 = """
  SELECT event_id AS id,
         strftime(ts, '%Y-%m-%d') AS date,
         event_type AS stock_symbol,
         CAST(user_id % 4 AS VARCHAR) AS buyer,
         CAST((user_id // 4) % 4 AS VARCHAR) AS seller,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS quantity,
         CAST(value AS DECIMAL(18,2)) AS rate,
         CAST(CAST(value AS DECIMAL(18,2)) * (TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) + 1)
              AS DECIMAL(18,2)) AS amount
  FROM events"""

TRADES_F3 = """
  SELECT o_orderkey AS id,
         strftime(o_orderdate, '%Y-%m-%d') AS date,
         c_mktsegment || '-' || substr(o_orderpriority, 1, 1) AS stock_symbol,
         CAST(c_nationkey % 5 AS VARCHAR) AS buyer,
         CAST(c_custkey % 12 AS VARCHAR) AS seller,
         CAST(o_orderkey % 50 + 1 AS INTEGER) AS quantity,
         CAST(floor(o_totalprice * 100 / (o_orderkey % 50 + 1)) / 100 AS DECIMAL(18,2)) AS rate,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey"""


def pc_change_sql(diff: str, prev: str) -> str:
    return (f"CAST(CASE WHEN CAST({prev} AS DOUBLE) = 0 THEN 0.0 "
            f"ELSE round_even(CAST({diff} AS DOUBLE) / CAST({prev} AS DOUBLE) * 100.0, 2) END AS DOUBLE)")


def prices_sql(trades_cte: str = "trades", drop: bool = True) -> str:
    """F2 prices as CTE bodies (``daily``, ``prices``)."""
    gone = ("WHERE NOT (stock_symbol = 'signup' AND date BETWEEN '2024-01-05' AND '2024-01-07')"
            if drop else "")
    return f"""
daily AS (
  SELECT date, stock_symbol, count(*) AS num_trnx, max(rate) AS max_price, min(rate) AS min_price,
         arg_max(rate, id) AS closing_price,
         CAST(sum(quantity) AS DECIMAL(18,2)) AS traded_shares,
         CAST(sum(amount) AS DECIMAL(18,2)) AS amount
  FROM {trades_cte} GROUP BY date, stock_symbol),
daily_prev AS (
  SELECT *, CAST(coalesce(lag(closing_price) OVER (PARTITION BY stock_symbol ORDER BY date), 0)
                 AS DECIMAL(18,2)) AS previous_price
  FROM daily),
daily_diff AS (
  SELECT *, CAST(CASE WHEN previous_price = 0 THEN 0 ELSE closing_price - previous_price END
                 AS DECIMAL(18,2)) AS difference
  FROM daily_prev),
prices AS (
  SELECT date, upper(stock_symbol) || ' LTD' AS stock_name, stock_symbol, num_trnx, max_price, min_price,
         closing_price, traded_shares, amount, previous_price, difference,
         {pc_change_sql('difference', 'previous_price')} AS pc_change
  FROM daily_diff {gone})"""


def _range(start: str | None, end: str | None) -> str:
    conds = []
    if start is not None:
        conds.append(f"date >= '{start}'")
    if end is not None:
        conds.append(f"date <= '{end}'")
    return ("WHERE " + " AND ".join(conds)) if conds else ""


def runs_sql(side: str, start: str | None, end: str | None, strict: bool = False,
             src: str = "trades", p: str = "") -> str:
    """CTE bodies ``seen`` and ``numbered`` (names prefixed by ``p``): a trade
    starts a run when its broker is unknown or differs from the one before, and
    the run number counts the starts so far."""
    b = broker_col(side)
    over = "PARTITION BY stock_symbol, date ORDER BY id" if strict else "ORDER BY stock_symbol NULLS LAST, id"
    order = "stock_symbol NULLS LAST, " + ("date NULLS LAST, id" if strict else "id")
    return f"""
{p}seen AS (
  SELECT id, date, stock_symbol, buyer, seller, quantity, rate, amount,
         {b} IS NULL OR {b} IS DISTINCT FROM lag({b}) OVER ({over}) AS starts
  FROM {src} {_range(start, end)}),
{p}numbered AS (
  SELECT * EXCLUDE (starts), CASE WHEN starts THEN 1 END AS r,
         count(*) FILTER (WHERE starts) OVER (ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS grp
  FROM {p}seen)"""


def totals_sql(side: str, p: str = "") -> str:
    """CTE bodies ``run_sums`` (one row per run) and ``run_rows`` (its totals on
    every date, symbol and broker it touches); after ``numbered``."""
    b = broker_col(side)
    return f"""
{p}run_sums AS (
  SELECT grp, sum(amount) AS cuml, sum(quantity) AS cumq, count(*) AS trnxs FROM {p}numbered GROUP BY grp),
{p}run_rows AS (
  SELECT t.grp, t.date, t.stock_symbol, t.{b}, s.cuml, s.cumq, s.trnxs
  FROM (SELECT grp, date, stock_symbol, {b} FROM {p}numbered GROUP BY ALL) t JOIN {p}run_sums s USING (grp))"""


def top_sql(side: str, n: int, symbol: str | None, name: str = "largest", p: str = "") -> str:
    b = broker_col(side)
    where = f"WHERE stock_symbol = '{symbol}'" if symbol is not None else ""
    return f"""
{name} AS (
  SELECT grp, date, stock_symbol, {b}, CAST(cuml AS DOUBLE) AS cuml, CAST(cumq AS BIGINT) AS cumq,
         CAST(trnxs AS BIGINT) AS trnxs, CAST(prices.pc_change AS DOUBLE) AS pc_change
  FROM (FROM {p}run_rows {where} ORDER BY cuml DESC NULLS LAST, grp, date, stock_symbol LIMIT {int(n)})
  JOIN prices USING (date, stock_symbol))"""


def with_ctes(*bodies: str) -> str:
    return "WITH " + ",\n".join(b.strip() for b in bodies) + "\n"
