"""Quality rules: repetition coverage by rolling n-gram hashes in numpy.

Rules of a text, in words ``[^\\x20\\x09-\\x0D]+``:

* base: fewer than ``MIN_WORDS`` words, or more than ``MAX_REPEAT`` of them in a
  3-word window that occurs twice or more;
* for each n of ``COVERAGE``: more than that share of all word characters lies in
  n-word windows that occurred before in the text;
* more than ``MAX_LINES`` of the word characters stand in lines equal to an earlier line;
* more than ``MAX_SYMBOLS`` symbols for each word character.

A window of n + 1 words can only repeat where the window of n words does, so each
length sorts only the positions that the length before left.  Work is done on whole
Arrow batches, a few megabytes of text at a time; there is no shuffle.

Null texts have no words: all counts are 0 and the base rule fails them, as for
empty texts.  Rows are independent, so ties, repeated rows and null ids need no
rule; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .util import mix64, slices, utf8

MIN_WORDS = 50
MAX_REPEAT = 0.5
COVERAGE = {5: 0.30, 6: 0.29, 7: 0.28, 8: 0.27, 9: 0.26, 10: 0.25}
MAX_LINES = 0.3
MAX_SYMBOLS = 0.1
SYMBOLS = b"#*$%&|<>"
SLICE = 512 << 10       # bytes of text that are judged at once

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: if another equals it, and if an earlier one does."""
    n = len(keys)
    any_, later = np.zeros(n, bool), np.zeros(n, bool)
    if n:
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        any_[order[1:]] = same
        later[order[1:]] = same
        any_[order[:-1]] |= same
    return any_, later


def _covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in a window of n words that starts in ``at``."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + n, -1)
    return np.cumsum(step[:-1]) > 0


def measures(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts for each row of ``data[offsets[i]:offsets[i + 1]]``; cover_n: characters
    inside repeated n-word windows."""
    rows = len(offsets) - 1
    w = W.split(data, offsets)
    total = lambda x, weights=None: np.bincount(x, weights, rows).astype(np.int64)
    out = {"n_words": total(w.row), "word_chars": total(w.row, w.chars)}
    symbol = np.concatenate([[0], np.cumsum(_IS_SYMBOL[data[offsets[0]:offsets[-1]]])])
    out["n_symbols"] = np.diff(symbol[offsets - offsets[0]]).astype(np.int64)

    size = len(w.hash)
    seed = mix64(w.row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(77))
    at, _ = W.ngrams(w, 3)
    any_, later = _repeats(W.ngram_hash(w.hash, at, 3) ^ seed[at])
    out["n_repeat_words"] = total(w.row[_covered(at[any_], 3, size)])
    at = at[any_]
    for n in COVERAGE:
        at = at[at + n <= size]
        at = at[w.row[at] == w.row[at + n - 1]]
        any_, later = _repeats(W.ngram_hash(w.hash, at, n) ^ seed[at])
        hit = _covered(at[later], n, size)
        out[f"cover_{n}"] = total(w.row[hit], w.chars[hit])
        at = at[any_]

    lines, chars = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    for i in range(rows):
        seen: set[bytes] = set()
        for line in data[offsets[i]:offsets[i + 1]].tobytes().split(b"\n"):
            if line in seen:
                lines[i] += 1
                chars[i] += len(b"".join(line.split()).decode())
            elif line.split(None, 1):
                seen.add(line)
    return out | {"n_dup_lines": lines, "dup_line_chars": chars}


def verdicts(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """base_failed and kept of each row."""
    base = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > round(100 * MAX_REPEAT) * m["n_words"])
    chars = m["word_chars"]
    bad = base | (m["dup_line_chars"] > MAX_LINES * chars) | (m["n_symbols"] > MAX_SYMBOLS * chars)
    for n, share in COVERAGE.items():
        bad = bad | (m[f"cover_{n}"] > share * chars)
    return base, ~bad


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, counts, cover_n, base_failed, kept) for each row."""
    names = [*COUNTS, *(f"cover_{n}" for n in COVERAGE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = utf8(batch.column(1))
            for lo, hi in slices(offsets, SLICE):
                m = measures(data, offsets[lo:hi + 1])
                base, kept = verdicts(m)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], *(pa.array(m[k], pa.int64()) for k in names), pa.array(base), pa.array(kept)],
                    ["id", *names, "base_failed", "kept"])

    slim = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {slim.schema['id'].dataType.simpleString()}, " + ", ".join(f"{k} long" for k in names) + ", base_failed boolean, kept boolean"
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def keep_good(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that the rules keep, with all their columns."""
    @F.arrow_udf("boolean")  # no copies of a batch's texts as Python strings
    def kept(texts: pa.Array) -> pa.Array:
        offsets, data = utf8(texts)
        out = [verdicts(measures(data, offsets[lo:hi + 1]))[1] for lo, hi in slices(offsets, SLICE)]
        return pa.array(np.concatenate(out) if out else np.zeros(0, bool))

    return df.where(kept(F.col(text_col)))
