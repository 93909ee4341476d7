"""Scalar weight functions, all as JVM-side Column expressions (no Python UDF).

F1  logistic scale      -1 + 2 / (1 + e^(-p*x))        (= tanh(p*x/2))
F2  logistic inverse    -ln(2 / (y + 1) - 1) / p
F3  fit p so that the quantile q of a column maps to y
F9  popularity boost chosen by name: 'SQRT', 'LOG' (natural log), '' (identity)
"""

from __future__ import annotations

import math
from typing import Callable, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]

# Orderings compare values rounded to this many significant bits (relative
# steps of 2**-28, finer than a 32-bit float), so that last-digit noise of
# parallel sums cannot flip an ordering between values that are equal in exact
# arithmetic, however small the values are.
SORT_BITS = 28
# Registered queries show doubles with this many significant bits (7 digits).
SHOWN_BITS = 24


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def logistic_scale(x: ColumnOrName, p: float) -> Column:
    """maps [0, inf) onto [0, 1) with diminishing returns."""
    return F.lit(-1.0) + F.lit(2.0) / (F.lit(1.0) + F.exp(F.lit(-float(p)) * _col(x)))


def logistic_inverse(y: ColumnOrName, p: float) -> Column:
    """inverse of ``logistic_scale`` on [0, 1)."""
    return -F.log(F.lit(2.0) / (_col(y) + F.lit(1.0)) - F.lit(1.0)) / F.lit(float(p))


def logistic_param_for(value_at_quantile: float, y: float) -> float:
    """F3 core: the p with logistic_scale(value_at_quantile, p) == y."""
    if not 0.0 < y < 1.0:
        raise ValueError("y must lie in (0, 1)")
    if value_at_quantile <= 0:
        raise ValueError("the quantile value must be positive")
    return math.log((1.0 + y) / (1.0 - y)) / value_at_quantile


def fit_logistic_param(df: DataFrame, col: str, q: float, y: float,
                       exact: bool = False, accuracy: int = 10000) -> DataFrame:
    """one-row frame (quantile_value, logistic_param) such that the q-quantile
    of ``col`` is scaled to ``y``.  Lazy with approximate quantiles; ``exact``
    ones run jobs while the plan is built."""
    from cograph.operators.stats import quantiles

    qv = quantiles(df, col, [q], exact=exact, accuracy=accuracy)
    k = math.log((1.0 + y) / (1.0 - y))
    return qv.select(
        F.col("value").alias("quantile_value"),
        F.try_divide(F.lit(k), F.col("value")).alias("logistic_param"),
    )


_BOOSTS: dict[str, Callable[[Column], Column]] = {
    "SQRT": F.sqrt,
    "LOG": F.log,          # natural logarithm
    "": lambda c: c,       # linear
}


def popularity_boost(name: str) -> Callable[[Column], Column]:
    """boost function by name."""
    try:
        return _BOOSTS[name.upper()]
    except KeyError:
        raise ValueError(f"unknown popularity boost {name!r}; use SQRT, LOG or ''") from None


def significant(c: ColumnOrName, bits: int) -> Column:
    """A double rounded to ``bits`` significant bits, with plain arithmetic that
    stays inside generated code: (x * k) - (x * k - x) for k = 2**(53 - bits) + 1."""
    x = _col(c)
    big = x * F.lit(float(2 ** (53 - bits) + 1))
    return F.when(F.abs(x) < F.lit(1e290), big - (big - x)).otherwise(x)


def sort_key(c: ColumnOrName) -> Column:
    """Value used only inside orderings (see SORT_BITS)."""
    return significant(c, SORT_BITS) + F.lit(0.0)
