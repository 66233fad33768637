"""Column helpers that reproduce pandas / numpy null semantics exactly.

pandas reads a missing value as NaN.  The rules kept here:

* ``(x > k).astype(int)``: a comparison with NaN is False -> 0.  Spark gives
  NULL, so every atomic comparison is coalesced to False *before* it is
  combined with others (``~(NaN > k)`` is True in pandas).
* ``np.maximum`` / ``np.minimum``: NaN wins.  Spark ``greatest``/``least``
  skip NULL, so they are guarded.
* ``clip(lo, hi)`` keeps NaN.
* row-wise ``sum/mean/std(axis=1)`` skip NaN; the sum of an all-NaN row is 0,
  its mean and std are NaN; std uses ddof=1.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def test(cond: Column) -> Column:
    """A comparison as pandas evaluates it: NULL operands give False."""
    return F.coalesce(cond, F.lit(False))


def flag(cond: Column) -> Column:
    """``(cond).astype(int)`` with pandas semantics (NULL -> 0)."""
    return test(cond).cast("int")


def any_of(*conds: Column) -> Column:
    out = test(conds[0])
    for c in conds[1:]:
        out = out | test(c)
    return out.cast("int")


def all_of(*conds: Column) -> Column:
    out = test(conds[0])
    for c in conds[1:]:
        out = out & test(c)
    return out.cast("int")


def nz(c: str | Column, value) -> Column:
    """``fillna(value)``."""
    return F.coalesce(col(c), F.lit(value))


def np_maximum(a, b) -> Column:
    """``np.maximum(a, b)``: NULL if either side is NULL."""
    a, b = _lit(a), _lit(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def np_minimum(a, b) -> Column:
    """``np.minimum(a, b)``: NULL if either side is NULL."""
    a, b = _lit(a), _lit(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def clip(x: str | Column, lo, hi) -> Column:
    """``Series.clip(lo, hi)``: NULL stays NULL, bounds are not substituted for it."""
    x, lo, hi = col(x), _lit(lo), _lit(hi)
    return F.when(x < lo, lo).when(x > hi, hi).otherwise(x)


def safe_div(a, b) -> Column:
    """Division that yields NULL for a zero divisor (ANSI mode would raise)."""
    return F.try_divide(_lit(a), _lit(b))


def row_stats(cols: Iterable[str]) -> dict[str, Column]:
    """Row-wise sum / mean / sample std over ``cols``, skipping NULLs (pandas axis=1).

    Plain column arithmetic (no arrays or lambdas), so it stays inside whole-stage
    codegen; values are summed in column order."""
    xs = [F.col(c).cast("double") for c in cols]
    total = F.lit(0.0)
    n = F.lit(0)
    for x in xs:
        total = total + F.coalesce(x, F.lit(0.0))
        n = n + x.isNotNull().cast("int")
    mean = F.when(n > 0, total / n)
    sq = F.lit(0.0)
    for x in xs:
        sq = sq + F.when(x.isNotNull(), (x - mean) * (x - mean)).otherwise(F.lit(0.0))
    std = F.when(n > 1, F.sqrt(sq / (n - 1)))
    return {"sum": total, "mean": mean, "std": std}


def _lit(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.col(v)
    return F.lit(v)
