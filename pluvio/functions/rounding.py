"""Rounding rules, all as JVM-side column expressions.

Three roundings meet in the reference and none equals Spark's ``round``:

* statistics tables are rounded like a numpy/pandas frame: scale by ten,
  round half to even on the *binary* product, scale back
  (``numpy_round1``);
* scalar values are rounded like Python's ``round(x, 1)``: the exact binary
  value decides, exact ties go to even (``py_round1``);
* sums of one-decimal values are exact decimals (``decimal_sum1``).

Integer fixed-point helpers (``half_even_div``) keep weighted means exact
and independent of summation order, so results do not depend on how Spark
partitions the data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def numpy_round1(x) -> Column:
    """``round(x, 1)`` as a numpy/pandas frame does it: rint(x*10)/10."""
    return F.rint(_c(x) * F.lit(10.0)) / F.lit(10.0)


def half_even_div(num, den) -> Column:
    """Exact ``round_half_even(num / den)`` for integral ``num`` and ``den > 0``."""
    num, den = _c(num), _c(den)
    r = F.pmod(num, den)
    q = (num - r).cast("long") / den
    q = q.cast("long")
    return (F.when(r * 2 > den, q + 1)
            .when((r * 2 == den) & (F.pmod(q, F.lit(2)) == 1), q + 1)
            .otherwise(q))


def py_round1(x) -> Column:
    """Python's ``round(x, 1)`` for a double, exactly, without a UDF.

    ``20*x`` is formed exactly as ``16x + 4x`` (both exact) plus the TwoSum
    error term; comparing it with the odd integers around ``rint(10x)``
    decides the rounding on the exact binary value, ties to even.  Exact for
    |x| < 4.5e14 and for |x| >= 2^49 (where the result is x itself).
    """
    x = _c(x).cast("double")
    n = F.rint(x * F.lit(10.0))
    a = x * F.lit(16.0)
    b = x * F.lit(4.0)
    s = a + b
    bb = s - a
    err = (a - (s - bb)) + (b - bb)
    up = n * 2 + 1
    dn = n * 2 - 1
    even_up = F.when(F.pmod(n + 1, F.lit(2.0)) == 0, n + 1).otherwise(n)
    even_dn = F.when(F.pmod(n - 1, F.lit(2.0)) == 0, n - 1).otherwise(n)
    r = (F.when((s > up) | ((s == up) & (err > 0)), n + 1)
         .when((s == up) & (err == 0), even_up)
         .when((s < dn) | ((s == dn) & (err < 0)), n - 1)
         .when((s == dn) & (err == 0), even_dn)
         .otherwise(n))
    # |x| >= 2^49: the spacing of doubles is >= 1/8, so Python returns x itself
    big = F.abs(x) >= F.lit(float(2 ** 49))
    return F.when(F.isnan(x) | x.isNull() | big, x).otherwise(r / F.lit(10.0))


def decimal1(x) -> Column:
    """A one-decimal double as an exact decimal (after A4 rounding); NaN -> null."""
    c = _c(x)
    return F.when(~F.isnan(c), c).cast("decimal(18,1)")


def decimal_sum1(x, poison: bool = True) -> Column:
    """``round(sum(values), 1)`` of one-decimal values, order independent.

    ``poison``: like the reference's Python ``sum``, one missing (NaN/null)
    value makes the total missing (null); otherwise missing values are
    skipped.
    """
    c = _c(x)
    # values that are whole tenths, as A4 leaves them, are summed as whole numbers,
    # exact as the decimals are and a fraction of their time; others as decimals
    tenths = F.rint(c * F.lit(10.0))
    plain = (F.abs(c) < F.lit(1e9)) & (tenths / F.lit(10.0) == c)
    whole = F.sum(F.when(plain, tenths.cast("long")))
    rest = F.sum(F.when(~plain, decimal1(c)))
    both = F.coalesce(rest, F.lit(0).cast("decimal(28,1)")) + (F.coalesce(whole, F.lit(0)).cast("decimal(20,0)") * F.lit(0.1).cast("decimal(1,1)"))
    total = F.when(whole.isNotNull() | rest.isNotNull(), both.cast("double"))
    if not poison:
        return total
    missing = F.sum(F.when(c.isNull() | F.isnan(c), 1).otherwise(0))
    return F.when(missing == 0, total)
