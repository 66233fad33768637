"""Exact table quantiles by histogram narrowing: one path at every size.

pandas ``median`` / ``quantile`` interpolate linearly between order statistics.
``exact_quantiles`` finds them for all columns at once:

1. one aggregate counts the values and brackets each target rank with a sketch of a
   fixed accuracy; a second one counts the values below each bracket;
2. each pass counts the values of every open bracket in ``BINS`` equal bins, with the
   smallest and largest value of a bin, and goes on in the bin that holds the rank.
   A pass shrinks a bracket's width at least ``BINS`` times, and two different ends
   never share a bin, so it ends.

A bracket that misses its rank is opened to the column's whole range and narrowed in
the same way.  The driver reads at most ``BINS`` rows for each open target a pass; no
buffer, task or read-back grows with rows, distinct values or ties.  The columns are
stored once, so the passes do not repeat the plan behind ``df``.

Values are those of Spark's ``percentile``, with its interpolation.  NULL and NaN are
missing; a column without values gives None.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

BINS = 256
ACCURACY = 1000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _key(c) -> str:
    return c if isinstance(c, str) else str(c)


@dataclass
class _Target:
    """One quantile of a column: its bracket, the values below that, and its two ranks."""
    column: str
    p: float
    n: int
    low: float
    high: float
    below: int = 0
    value: float | None = None

    @property
    def position(self) -> float:
        return self.p * (self.n - 1)

    @property
    def ranks(self) -> tuple[int, int]:
        return math.floor(self.position), math.ceil(self.position)

    def bin(self, bins: int) -> Column:
        x = F.col(self.column)
        span = self.high / 2 - self.low / 2
        if span == 0 or not math.isfinite(span):  # no arithmetic between such ends: they and the rest
            return F.when(x == F.lit(self.low), 0).when(x == F.lit(self.high), 2).otherwise(1)
        return F.least(F.floor((x / 2 - F.lit(self.low / 2)) / F.lit(span) * bins), F.lit(bins - 1)).cast("int")

    def inside(self) -> Column:
        return F.col(self.column).between(F.lit(self.low), F.lit(self.high))

    def settle(self, a: float, b: float) -> None:
        first, last = self.ranks
        self.value = a if first == last or a == b else (last - self.position) * a + (self.position - first) * b

    def narrow(self, counted: list[tuple[int, int, float, float]]) -> bool:
        """Go on in the bin that holds the ranks; False if the bracket misses them."""
        first, last = self.ranks
        if first < self.below:
            return False
        seen, a = self.below, None
        for _, n, low, high in sorted(counted):
            if a is not None:  # the first rank ended the bin before, the last one begins this
                self.settle(a, low)
                return True
            if first < seen + n:
                if last >= seen + n:
                    a = high
                elif low == high:
                    self.settle(low, low)
                    return True
                else:
                    self.below, self.low, self.high = seen, low, high
                    return True
            seen += n
        return False


def exact_quantiles(df: DataFrame, specs: Mapping[str, tuple], *, bins: int = BINS,
                    accuracy: int = ACCURACY) -> dict[str, float | None]:
    """``specs``: name -> (column, p).  Returns name -> value (None if no value)."""
    if not specs:
        return {}
    columns = {_key(c): _c(c).cast("double") for c, _ in specs.values()}
    short = {k: f"v{i}" for i, k in enumerate(columns)}
    data = materialize(df.select(*[F.when(~F.isnan(c), c).alias(short[k]) for k, c in columns.items()]))
    wanted = {(short[_key(c)], float(p)) for c, p in specs.values()}
    probs = {v: sorted(p for c, p in wanted if c == v) for v in short.values()}

    margin = 3.0 / accuracy
    sketch = data.agg(*[
        F.struct(F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"),
                 F.percentile_approx(v, [q for p in ps for q in (max(0.0, p - margin), min(1.0, p + margin))], accuracy).alias("at")).alias(v)
        for v, ps in probs.items()]).first()
    targets = {(v, p): _Target(v, p, sketch[v]["n"], *sketch[v]["at"][2 * i:2 * i + 2])
               for v, ps in probs.items() if sketch[v]["n"] for i, p in enumerate(ps)}

    todo = list(targets.values())
    if todo:
        below = data.agg(*[F.count_if(F.col(t.column) < F.lit(t.low)).alias(f"t{i}") for i, t in enumerate(todo)]).first()
        for t, n in zip(todo, below):
            t.below = n
    while todo:
        hits = F.array(*[F.when(t.inside(), F.struct(F.lit(i).alias("t"), t.bin(bins).alias("bin"), F.col(t.column).alias("x")))
                         for i, t in enumerate(todo)])
        counted = (data.select(F.explode(F.array_compact(hits)).alias("r")).groupBy("r.t", "r.bin")
                   .agg(F.count("*").alias("n"), F.min("r.x").alias("low"), F.max("r.x").alias("high")).collect())
        found: dict[int, list] = {}
        for r in counted:
            found.setdefault(r["t"], []).append((r["bin"], r["n"], r["low"], r["high"]))
        for i, t in enumerate(todo):
            if not t.narrow(found.get(i, [])):
                t.low, t.high, t.below = sketch[t.column]["low"], sketch[t.column]["high"], 0
        todo = [t for t in todo if t.value is None]

    value = {k: t.value for k, t in targets.items()}
    return {name: value.get((short[_key(c)], float(p))) for name, (c, p) in specs.items()}


def table_stats(df: DataFrame, exprs: Mapping[str, Column]) -> dict:
    """One aggregate row of scalar statistics, as a dict."""
    row = df.agg(*[e.alias(n) for n, e in exprs.items()]).first()
    return row.asDict()
