"""URL filter by a cascade of Bloom filters, in DataFrame operations only.

A list names keys ``host/path-prefix``; a key fits a url whose host is the key's or a
subdomain of it and whose path starts with the key's path.  The keys that could fit a
url are few: for each shape (labels of the host, characters of the path) found in the
list, the url has at most one.

A cascade makes Bloom filters exact for a known universe, here every candidate key of
the corpus.  Level 0 encodes the listed keys; level 1 the universe's other keys that
level 0 lets through; level 2 the listed keys that level 1 lets through, and so on
until a level lets nothing through.  The first level that refuses a key settles it: an
even level refuses unlisted keys, an odd level listed ones.  Each level holds about a
thousandth of the one before.  One scan of the corpus finds what passes level 0; all
further work is on those few keys.  Judging a url joins and shuffles nothing.

Filters are at most 8 MB by ``bloom.MAX_BITS`` (four million keys at 16 bits; beyond
that, levels pass more keys and become more, and the answer stays exact).

Null urls and urls without ``://`` have an empty host and path, fit no key and get the
default.  Keys are compared as they stand; ties of length go to the longer host.  Rows
are independent, so repeated rows and null ids need no rule; an empty table gives an
empty one, an empty list the default for all.  Further columns are not read.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import bloom

MAX_SHAPES = 64
MAX_LEVELS = 64


def with_parts(df: DataFrame, url_col: str) -> DataFrame:
    """``df`` with columns ``host`` and ``path``."""
    rest = F.expr("if(instr(_url, '://') > 0, substr(_url, instr(_url, '://') + 3), '')")
    lower = F.translate(F.regexp_extract("_rest", r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return (df.withColumn("_url", F.coalesce(F.col(url_col), F.lit(""))).withColumn("_rest", rest)
            .withColumn("host", lower)
            .withColumn("path", F.regexp_extract(F.expr("substr(_rest, length(host) + 1)"), r"^[^?#]*", 0))
            .drop("_url", "_rest"))


@dataclass(frozen=True)
class Cascade:
    """Levels (bits, n_bits, seed) over keys of these shapes, longest keys first."""
    levels: tuple[tuple[Column, int, int], ...]
    shapes: tuple[tuple[int, int], ...]

    def lists(self, key: Column) -> Column:
        """True exactly for the listed keys of the universe."""
        out = F.lit(len(self.levels) % 2 == 1)  # what passes every level
        for i in reversed(range(len(self.levels))):
            bits, n_bits, seed = self.levels[i]
            out = F.when(bloom.test(bits, key, n_bits, seed), out).otherwise(F.lit(i % 2 == 1))
        return out


def candidate(shape: tuple[int, int]) -> Column:
    """The key of that shape that fits the row's host and path; null if there is none."""
    labels, size = shape
    long_enough = (F.length("path") >= size) & (F.size(F.split("host", r"\.")) >= labels) & (F.col("host") != "")
    return F.when(long_enough, F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, size)))


def shapes_of(keys: DataFrame) -> tuple[tuple[int, int], ...]:
    """Shapes of the keys in column ``key``, those of longer keys first."""
    host = F.substring_index("key", "/", 1)
    shape = keys.select(F.size(F.split(host, r"\.")).alias("labels"), (F.length("key") - F.length(host)).alias("size"))
    found = [(r["labels"], r["size"]) for r in shape.distinct().limit(MAX_SHAPES + 1).collect()]
    if len(found) > MAX_SHAPES:
        raise ValueError(f"keys of more than {MAX_SHAPES} shapes; split the list")
    return tuple(sorted(found, key=lambda s: (-s[1], -s[0])))


def build(urls: DataFrame, keys: DataFrame, seed: int = 0) -> Cascade:
    """Cascade over the keys (column ``key``) for all candidates of ``urls`` (host, path)."""
    keys = materialize(keys.select("key").where("key is not null").distinct())
    shapes = shapes_of(keys)
    if not shapes:
        return Cascade((), ())
    n_bits = bloom.bits_for(keys.count())
    levels = [(bloom.build(keys, "key", n_bits, seed), n_bits, seed)]
    universe = urls.select(F.explode(F.array(*map(candidate, shapes))).alias("key")).where("key is not null")
    passed = materialize(universe.where(bloom.test(levels[0][0], F.col("key"), n_bits, seed)).distinct())
    listed = materialize(passed.join(keys, "key", "left_semi"))
    rest = [materialize(passed.join(keys, "key", "left_anti")), listed]  # encoded by odd levels, by even ones
    while (n := rest[0].count()):
        if len(levels) == MAX_LEVELS:
            raise ValueError("the cascade does not end; raise bloom.MAX_BITS")
        seed += bloom.PROBES
        n_bits = bloom.bits_for(n)
        bits = bloom.build(rest[0], "key", n_bits, seed)
        levels.append((bits, n_bits, seed))
        rest = [materialize(rest[1].where(bloom.test(bits, F.col("key"), n_bits, seed))), rest[0]]
    return Cascade(tuple(levels), shapes)


def judge(df: DataFrame, allow: DataFrame, block: DataFrame, also_block: DataFrame | None = None,
          url_col: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with host, path, rule (the longest fitting key of ``allow`` and ``block``)
    and verdict: the rule's, else ``block`` where a key of ``also_block`` fits, else
    ``default``.  The lists have a column ``key`` and no key in common."""
    urls = with_parts(df, url_col)
    slim = urls.select("host", "path").where("host != ''")
    lists = [(build(slim, allow, 10), "allow"), (build(slim, block, 1010), "block")]
    by_length = sorted(((shape, c, v) for c, v in lists for shape in c.shapes), key=lambda x: (-x[0][1], -x[0][0]))
    # longest key: host and path together; hosts of one label count differ in length by row
    found = F.array_compact(F.array(*[
        F.when(c.lists(candidate(shape)), F.struct(F.length(candidate(shape)).alias("size"), candidate(shape).alias("rule"), F.lit(v).alias("verdict")))
        for shape, c, v in by_length])) if by_length else F.array().cast("array<struct<size:int,rule:string,verdict:string>>")
    out = urls.withColumn("_best", F.array_max(found))
    verdict = F.lit(default)
    if also_block is not None:
        more = build(slim, also_block, 2010)
        for shape in more.shapes:
            verdict = F.when(more.lists(candidate(shape)), F.lit("block")).otherwise(verdict)
    return out.withColumn("rule", F.col("_best.rule")).withColumn("verdict", F.coalesce(F.col("_best.verdict"), verdict)).drop("_best")
