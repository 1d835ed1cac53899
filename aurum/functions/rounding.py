"""Decimal rounding.

``round(x, 2)`` of a double is taken half-up on the shortest decimal text of
``x`` (1.005 rounds to 1.01, as a person would), once: Spark's own ``round``.
The result is a double again.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_up(x, scale: int = 2) -> Column:
    return F.round(_c(x).cast("double"), scale)


def pct(num, den, scale: int = 2) -> Column:
    """round(num * 100 / den, scale); null when den is 0 or null."""
    ratio = F.try_divide(_c(num).cast("double") * F.lit(100.0), _c(den).cast("double"))
    return round_half_up(ratio, scale)


#: Measures are summed as decimals of eight places (up to 10^14): the sum does not depend on the order of the rows.
MEASURE = "decimal(22,8)"


def exact_mean(x, scale: int = 2, shift: float = 0.0) -> Column:
    """Mean of ``x - shift`` over a group, rounded half-up once, from an exact sum; null for a group without values.

    ``avg`` of doubles depends on the order in which tasks finish; this does not.
    """
    total = F.sum(_c(x).cast(MEASURE) - F.lit(Decimal(str(shift))).cast(MEASURE))
    n = F.count(_c(x))
    steps = F.call_function("div", F.abs(total) * F.lit(2 * 10 ** scale) + n, F.nullif(n * 2, F.lit(0)))
    return F.when(total < 0, -steps).otherwise(steps).cast("double") / F.lit(float(10 ** scale))
