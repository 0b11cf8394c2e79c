"""Numeric column expressions with the reference's rounding rules.

All are built-in expressions (whole-stage codegen), no UDFs.  ANSI mode is on
in Spark 4, so divisions use ``try_divide`` and yield NULL where the reference
would raise or divide by zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_even(x, digits: int) -> Column:
    """Half-even rounding of a double on its scaled value: ``rint(x*10^d)/10^d``.

    Equals NumPy's ``around`` and DuckDB's ``round_even``.  Python's
    ``round`` works on the exact binary value and may differ by one unit in the
    last digit at ties; that gap is documented, not emulated.
    """
    scale = float(10 ** digits)
    return F.rint(_c(x).cast("double") * F.lit(scale)) / F.lit(scale)


def pc_change_expr(difference, previous) -> Column:
    """Percent change: 0 when the previous price is 0, else the rounded ratio."""
    d = _c(difference).cast("double")
    p = _c(previous).cast("double")
    return (F.when(p == 0, F.lit(0.0))
            .otherwise(round_half_even(F.try_divide(d, p) * F.lit(100.0), 2))).cast("double")


def rate_int(amount, quantity) -> Column:
    """Average rate truncated toward zero, ``int(amount / quantity)``."""
    return F.try_divide(_c(amount).cast("double"), _c(quantity).cast("double")).cast("bigint")


def rate_1dp(amount, quantity) -> Column:
    """Average rate rounded half-even to one decimal, as ``np.around(a/q, 1)``."""
    return round_half_even(F.try_divide(_c(amount).cast("double"), _c(quantity).cast("double")), 1)
