"""Division helpers with explicit zero rules.

Spark 4 runs in ANSI mode, where ``x / 0`` raises; every KPI division goes
through one of these two helpers instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _dbl(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def ratio_or_null(num: Column | str, den: Column | str) -> Column:
    """``num / nullif(den, 0)`` on doubles: NULL when the divisor is 0 or NULL."""
    d = _dbl(den)
    return _dbl(num) / F.when(d != 0, d)


def ratio_or_zero(num: Column | str, den: Column | str) -> Column:
    """``CASE WHEN den > 0 THEN num / den ELSE 0 END`` on doubles."""
    d = _dbl(den)
    return F.when(d > 0, _dbl(num) / F.when(d > 0, d)).otherwise(F.lit(0.0))
