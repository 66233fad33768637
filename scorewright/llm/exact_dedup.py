"""Exact duplicates by progressive refinement, in DataFrame operations only.

Texts are equal when identical after ``[\\x20\\x09-\\x0D]`` is deleted.  One scan groups
rows by the length of that text, then by a hash of its first characters; both are
cheap.  Groups of one row are done.  The keys of the others go into a Bloom filter of
at most 8 MB, and a second scan computes the full SHA-256 only for rows that the
filter lets through: a false positive costs one more hash and changes nothing.  Equal
hashes are the classes.  Text is never shuffled, only lengths and hashes are, and
groups are counted before the shuffle, so a class of a third of all rows is a few
partial counts; the lines of large classes are broadcast to their rows.

``keep_first`` decides by row: of a class one row stays, by the order below, then by a
hash of the text, then by a stored row number; a repeated row or one without an id goes
as any other, and a row that shares only its id with a copy stays.

Of a class, the row with the most code points in its original text stays, then the
smallest id (a null id comes last).  Null texts count as empty and form one class with
empty and blank texts.  Rows that repeat an id and a text share one verdict.  An empty
table gives an empty one.  Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import bloom
from .util import join_counted, numbered

PREFIX = 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t-\r]+", "")


def _coarse(norm: Column) -> Column:
    """Length, then prefix hash."""
    return F.struct(F.length(norm).alias("n"), F.xxhash64(F.substring(norm, 1, PREFIX)).alias("prefix"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_all: bool = False,
                row_col: str | None = None) -> DataFrame:
    """(id, keep_id, group_size, kept[, text_sha256][, row]) for each row.

    With ``row_col``, a stored unique number of rows, ``kept`` holds for one row of a class.

    ``hash_all`` adds ``text_sha256`` for every row, also for those that the first two
    levels already show to be alone.
    """
    number = [] if row_col is None else ["number"]
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                     *[F.col(row_col).alias(n) for n in number])
    docs = docs.withColumn("norm", normalised(F.col("text")))
    shared = materialize(docs.select(_coarse(F.col("norm")).alias("key")).groupBy("key").count()
                         .where("count > 1").select("key"))
    n_bits = bloom.bits_for(shared.count())
    maybe = bloom.test(bloom.build(shared, "key", n_bits), _coarse(F.col("norm")), n_bits)
    full = F.sha2(F.col("norm"), 256)
    rows = docs.select("id", *number, *[F.xxhash64("text").alias("hash") for _ in number],
                       F.length("text").alias("chars"), F.when(maybe, full).alias("full"),
                       *[full.alias("text_sha256")] * hash_all)
    rows = materialize(rows)

    order = F.struct(-F.col("chars"), F.col("id").isNull(), "id", *["hash", "number"] * len(number))
    best = [F.min_by(c, order).alias(f"keep_{c}") for c in ("id", *number)]
    hashed = rows.where("full is not null")  # the others are alone and meet nothing
    classes = materialize(hashed.groupBy("full").agg(F.count("*").alias("group_size"), *best).where("group_size > 1"))
    out = join_counted(hashed, classes, ["full"], "group_size", rows.count(), "left").unionByName(
        rows.where("full is null"), allowMissingColumns=True)
    alone = F.col("group_size").isNull()
    return out.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("number") == F.col("keep_number") if number else F.col("id").eqNullSafe(F.col("keep_id")))).alias("kept"),
        *[F.col("text_sha256")] * hash_all, *[F.col(n).alias(row_col) for n in number])


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class, with all its columns."""
    rows, number = numbered(df)
    gone = exact_dedup(rows, id_col, text_col, row_col=number).where("not kept").select(number)
    return rows.join(gone, number, "left_anti").drop(number)
