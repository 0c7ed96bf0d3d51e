"""NaN-aware aggregate helpers.

Spark orders NaN above every number, so plain ``min``/``max`` return NaN as
soon as one value is NaN.  The reference skips NaN (numpy ``nanmin``/``nanmax``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def not_nan(x) -> Column:
    x = _c(x)
    return x.isNotNull() & ~F.isnan(x)


def nan_min(x) -> Column:
    return F.min(F.when(not_nan(x), _c(x)))


def nan_max(x) -> Column:
    return F.max(F.when(not_nan(x), _c(x)))


def all_nan(x) -> Column:
    """True when the group has no non-NaN value (also for an empty group)."""
    return F.coalesce(F.bool_and(~not_nan(x)), F.lit(True))


def round4(x) -> Column:
    """Four decimals, half toward +infinity (JavaScript ``Math.round``).

    NaN and infinities pass through (``floor`` would turn them into longs).
    """
    x = _c(x)
    finite = F.abs(x) < F.lit(float("inf"))
    return F.when(finite, F.floor(x * F.lit(10000.0) + F.lit(0.5)) / F.lit(10000.0)).otherwise(x)


def round_half_up(x, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` - the same IEEE operations in any
    engine (SQL ``round`` differs between engines on near-ties)."""
    scale = float(10 ** digits)
    return F.floor(_c(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
