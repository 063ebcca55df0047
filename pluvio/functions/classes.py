"""Seven-class binning of catchment values for the map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The map's seven colours, class 0 (>= 0) to class 6 (>= 6k).
COLOURS = ["#ffffcc", "#c7e9b4", "#7fcdbb", "#41b6c4", "#1d91c0", "#225ea8", "#0c2c84"]

# Fixed value: the interval control's initial setting.
DEFAULT_INTERVAL = 5


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def class_of(value, interval) -> Column:
    """Class 6 if value >= 6k, ..., 0 if value >= 0, null below 0 or NaN.

    A chain of comparisons (not ``floor(v/k)``) so boundaries are exact.
    """
    v = F.nanvl(_c(value).cast("double"), F.lit(None).cast("double"))   # NaN sorts above every number
    k = _c(interval) if not isinstance(interval, (int, float)) else F.lit(interval)
    expr = None
    for i in range(6, -1, -1):
        cond = v >= k * F.lit(i)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(None).cast("int"))


def colour_of(cls) -> Column:
    """Class index -> colour; null class -> null (the reference's empty fill)."""
    c = _c(cls)
    # explicit null guard: an array-literal lookup with a null index is not
    # reliably null after optimisation
    return F.when(c.isNotNull(), F.element_at(F.array(*[F.lit(x) for x in COLOURS]), c + 1))


def reference_class(value, interval) -> Column:
    """The map's own rule: bin with k, then re-bin ``5 * class`` with k.

    Equal to ``class_of`` only when k = 5.
    """
    first = class_of(value, interval)
    return class_of(first * F.lit(5), interval)
