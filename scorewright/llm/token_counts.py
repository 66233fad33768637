"""Token counts of every prefix by dynamic programming over a BPE vocabulary.

For byte-pair encodings whose merge order is given by the vocabulary, a prefix of
an encoding is the encoding of the text it covers, and a sequence of tokens is an
encoding exactly if each two neighbours are (``encode(a + b) == [a, b]``).  So the
last token of a prefix is the one vocabulary entry that ends there and agrees with
the last token of the prefix before it, and

    count[i] = count[i - len(last token)] + 1.

An Aho-Corasick automaton over the vocabulary lists the entries ending at each
position; whether two tokens agree is asked of the library once per pair.  No entry
joins characters before a word mark with it, so words are counted apart and a
bounded cache holds the totals of frequent words.

``prefix_store`` keeps the count at every prefix of every text (blocks of int16
differences), from which ``count_of_prefix`` answers truncation questions by reading one block a
text.  ``token_counts`` gives one row a text.

Null texts count as empty (0 tokens).  Rows are independent: ties, repeated rows,
repeated or null ids and further columns pass through unchanged; an empty table
gives an empty table.  A text of any length is read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import BoundedCache

MARK = "▁"          # fixed value: the library's visible space
BARRIER = "\n"           # encoded as a byte token, so nothing merges across it
CACHED_WORDS = 400_000
CACHED_PAIRS = 400_000
BLOCK = 4096             # characters of a stored block


class PrefixCounter:
    """Exact token counts of all prefixes under one sentencepiece BPE model."""

    def __init__(self, model_path: str):
        import ahocorasick
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        probe = self.sp.encode(BARRIER)
        if not all(self.sp.is_byte(i) for i in probe[1:]) or len(probe) != 2:
            raise ValueError("the model has no byte fallback for the barrier character")
        self.ids, self.automaton = {}, ahocorasick.Automaton()
        for i in range(self.sp.get_piece_size()):
            if not (self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_unused(i)):
                piece = self.sp.id_to_piece(i)
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {piece!r} crosses a word's start")
                self.ids[piece] = i
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.pieces = {i: p for p, i in self.ids.items()}
        self.single = {p for p in self.ids if len(p) == 1}
        if not self.single >= set("".join(self.ids)):
            raise ValueError("a piece has a character that is no piece")
        self.whole = BoundedCache(lambda i: self._encode(self.pieces[i]) == [i], 1 << 30)
        self.agree = BoundedCache(lambda ab: self._encode(self.pieces[ab[0]] + self.pieces[ab[1]]) == [*ab], CACHED_PAIRS)
        # stops that no entry joins with a letter or digit, so they are counted apart from the word before them
        self.stops = {c for c in ".,;:!?" if not any(c in p and any(x.isalnum() for x in p) for p in self.ids)}
        self.totals = BoundedCache(self._total, CACHED_WORDS)
        self.chunks = BoundedCache(lambda c: self.prefixes(c)[-1], CACHED_WORDS)

    def _encode(self, text: str) -> list[int]:
        return self.sp.encode(BARRIER + text.replace(MARK, " "))[2:]

    def _total(self, word: str) -> int:
        if word[-1:] in self.stops and word[-2:-1].isalnum():
            return self.totals[word[:-1]] + self.prefixes(word[-1])[-1]
        return self.prefixes(MARK + word)[-1]

    def prefixes(self, chunk: str) -> list[int]:
        """Token counts of all prefixes of a word with its marks, the empty one first."""
        n, done = len(chunk), 0
        count, last = [0] * (n + 1), [-1] * (n + 1)  # last: the prefix's last token; -1 after a barrier
        whole, agree = self.whole, self.agree
        for end, (token, size) in self.automaton.iter(chunk):  # longest first at each end
            end += 1
            if end <= done:
                continue
            if done < end - 1:
                done = self._bytes(chunk, done, end - 1, count)
            begin = end - size
            before = last[begin]
            if whole[token] if before < 0 else agree[before, token]:
                count[end], last[end], done = count[begin] + 1, token, end
        self._bytes(chunk, done, n, count)
        return count

    def _bytes(self, chunk: str, done: int, end: int, count: list[int]) -> int:
        """Characters outside the vocabulary: a token for each byte, and nothing merges across them."""
        for i in range(done, end):
            if chunk[i] in self.single:
                raise ValueError(f"no encoding ends after {chunk[:i + 1]!r}")
            count[i + 1] = count[i] + len(chunk[i].encode())
        return end

    def words(self, text: str) -> tuple[list[str], BoundedCache, bool]:
        """The text's parts that are counted apart, the cache with their totals, and if these lack their mark."""
        text = text.replace(MARK, " ") if MARK in text else text
        parts = text.split(" ")
        if "" in parts:
            return re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK)), self.chunks, False
        return parts, self.totals, True

    def count(self, text: str) -> int:
        if not text:
            return 0
        parts, totals, _ = self.words(text)
        n = sum(map(totals.__getitem__, parts))
        self.trim()
        return n

    def trim(self):
        for cache in (self.totals, self.chunks, self.agree):
            cache.trim()

    def longest_prefix(self, text: str, budget: int) -> int:
        """Most characters of the text that encode to at most ``budget`` tokens."""
        if not text or budget <= 0:
            return 0
        parts, totals, bare = self.words(text)
        used, chars = 0, -1  # the library puts one mark before the text
        for part in parts:
            size = len(part) + bare
            step = totals[part]
            if used + step > budget:
                break
            used, chars = used + step, chars + size
        else:
            return len(text)
        rest = self.prefixes(MARK + part if bare else part)
        # a shorter prefix can have more tokens, so the last fit counts; the first character alone is one token
        fit = max(i for i, c in enumerate(rest) if used + c <= budget)
        return max(0, chars + fit)

    def counts(self, text: str) -> np.ndarray:
        """Token counts of text[:0], text[:1], ..., text."""
        if not text:
            return np.zeros(1, np.int64)
        out, used = [np.zeros(0, np.int64)], 0
        parts, _, bare = self.words(text)
        for part in parts:
            c = np.array(self.prefixes(MARK + part if bare else part)[1:], np.int64) + used
            used = int(c[-1])
            out.append(c)
        self.trim()
        all_counts = np.concatenate(out)
        all_counts[0] = 0  # the mark before the text: the empty prefix has no token
        return all_counts


_counters: dict[str, PrefixCounter] = {}


def counter(model_path: str) -> PrefixCounter:
    """One counter, with its caches, for each Python worker."""
    if model_path not in _counters:
        _counters[model_path] = PrefixCounter(model_path)
    return _counters[model_path]


def token_counts(df: DataFrame, model_path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, fit_chars) for each row.

    ``fit_chars``: code points of the longest prefix with at most ``limit`` tokens.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(model_path)
        for batch in batches:
            n_bytes, n_tokens, fit = [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                n = c.count(text)
                n_bytes.append(len(text.encode()))
                n_tokens.append(n)
                fit.append(len(text) if n <= limit else c.longest_prefix(text, limit))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_()), pa.array(fit, pa.int64())],
                ["id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    slim = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {slim.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long"
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def prefix_store(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 block: int = BLOCK) -> DataFrame:
    """The count at every prefix: (id, block, base, counts) with ``counts`` the int16
    differences to ``base`` of prefixes ``block * BLOCK ... block * BLOCK + BLOCK - 1``."""
    def run(batches):
        c = counter(model_path)
        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1)):
                counts = c.counts(value.as_py() or "")
                at = range(0, len(counts), block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key.as_py()] * len(at), batch.schema.field(0).type), pa.array([i // block for i in at], pa.int64()),
                     pa.array([int(counts[i]) for i in at], pa.int64()),
                     pa.array([(counts[i:i + block] - counts[i]).astype("<i2").tobytes() for i in at], pa.binary())],
                    ["id", "block", "base", "counts"])

    slim = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {slim.schema['id'].dataType.simpleString()}, block long, base long, counts binary"
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def count_of_prefix(store: DataFrame, chars: int, id_col: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """Tokens of each text's first ``chars`` code points (of the whole text, if shorter)."""
    last = (store.where(F.col("block") <= chars // block).groupBy(id_col)
            .agg(F.max(F.struct("block", "base", "counts")).alias("b")).select(id_col, "b.*"))
    end = F.expr("int(length(counts) / 2) - 1")
    last = last.withColumn("at", F.when(F.col("block") < chars // block, end).otherwise(F.least(F.lit(chars % block), end)))
    byte = "int(conv(hex(substring(counts, {}, 1)), 16, 10))"
    value = F.expr(f"{byte.format('2 * at + 1')} + 256 * {byte.format('2 * at + 2')}")
    return last.select(id_col, (F.col("base") + F.when(value >= 32768, value - 65536).otherwise(value)).alias("n_tokens"))
