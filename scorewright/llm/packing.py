"""Packing documents into training windows: best-fit decreasing on a segment tree.

A document is its token ids and one end id.  Documents of more than a window are
first cut into full windows, each a sequence of its own; what remains (1 to 2047
ids) is packed best-fit decreasing: longest first, each into the open window with
the least room that still holds it.  A segment tree indexed by remaining room finds
that window in log2(window) steps, whatever the number of open windows.

``tokenize`` turns texts into pieces inside the tasks that read them; only the pieces
(ids left out, unless asked for) are shuffled.  ``pack`` deals the pieces by a hash
into groups of about ``GROUP`` pieces, whose number follows the counted pieces, and
packs each group alone, so no task or driver sees all of them.  A group leaves some
windows short at its end, a few in ten thousand.

Null texts count as empty: one piece that holds the end id alone.  Rows are
independent; rows that repeat an id are packed each for itself, and null ids too.
An empty table gives no pieces.  Texts of any length are cut, never shortened.
Further columns are not read.
"""

from __future__ import annotations

import math
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .util import slices, utf8

WINDOW = 2048
GROUP = 50_000          # pieces packed together
CACHED_WORDS = 600_000  # of either generation
LONG_WORD = 64          # characters of a word that is remembered
TOGETHER = 1 << 20      # bytes of texts that are encoded together
WIDE = " \u00a0"       # a space that a token may hold together with what follows
COMMON = re.compile("[!-~\\t\\n\\rÀ-ÖØ-öø-ÿ]+")
# fixed value: the pre-token pattern of the byte-level vocabulary
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Token ids of whole texts as little-endian uint32 bytes.

    A space that stands between two other characters begins a pre-token of the
    byte-level pattern, and only beside another space, or a no-break space, can a token
    reach over it.  So the words of a text without such pairs are encoded apart, and the ids
    of frequent words come from a bounded cache.  New words of common characters are merged
    by tiktoken with the library's own vocabulary, all of a batch as one text, in which each
    token that begins with a space begins a word.  Other words, and other texts whole, go
    to the library.
    Words of over ``LONG_WORD`` characters are not kept.
    """

    def __init__(self, path: str, cached_words: int):
        self.cached_words = cached_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        alphabet = {}  # the library's character for each byte of a common character
        for c in [" ", *filter(COMMON.fullmatch, map(chr, range(256)))]:
            alphabet |= zip(level.pre_tokenize_str(c)[0][0], c.encode())
        ranks = {bytes(map(alphabet.get, token)): i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items()
                 if alphabet.keys() >= set(token)}
        self.merges = tiktoken.Encoding("common", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.begins = np.zeros(max(ranks.values()) + 1, bool)
        self.begins[[i for token, i in ranks.items() if token.startswith(b" ")]] = True
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words that follow a space; all but long ones are put into the young cache."""
        found = {w: self.old[w] for w in words if w in self.old}
        new = [w for w in words if w not in found]
        common = [w for w in new if COMMON.fullmatch(w) and not any(x in w for x in self.special)]
        if common:
            ids = np.array(self.merges.encode_ordinary(" " + " ".join(common)), "<u4")
            at, data = (np.flatnonzero(self.begins[ids]) * 4).tolist(), ids.tobytes()
            found.update(zip(common, [data[a:b] for a, b in zip(at, [*at[1:], len(data)])]))
        odd = [w for w in new if w not in found]
        found.update(zip(odd, self._ids([" " + w for w in odd])))
        self.young.update((w, ids) for w, ids in found.items() if len(w) <= LONG_WORD)
        return found

    def batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; pass texts of bounded size together."""
        out: list[bytes | None] = [None] * len(texts)
        split = {i: t.split(" ") for i, t in enumerate(texts) if "  " not in t and WIDE not in t}
        whole = [i for i in range(len(texts)) if i not in split]
        for i, ids in zip(whole, self._ids([texts[i] for i in whole])):
            out[i] = ids
        get, missing, found = self.young.get, set(), {}
        for i, words in split.items():
            found[i] = ids = list(map(get, words[1:]))
            if None in ids:
                missing.update(w for w, x in zip(words[1:], ids) if x is None)
        learned = self._learn(list(missing)) if missing else {}
        for (i, words), first in zip(split.items(), self._ids([words[0] for words in split.values()])):
            ids = found[i]
            if None in ids:
                ids = [learned[w] if x is None else x for w, x in zip(words[1:], ids)]
            out[i] = first + b"".join(ids)
        if len(self.young) > self.cached_words:
            self.old, self.young = self.young, {}
        return out

    def __call__(self, text: str) -> bytes:
        return self.batch([text])[0]


_encoders: dict[str, Encoder] = {}


def encoder(path: str, cached_words: int = CACHED_WORDS) -> Encoder:
    """One encoder, with its cache, for each Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, cached_words)
    return _encoders[path]


def tokenize(df: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = WINDOW, with_ids: bool = False,
             id_col: str = "doc_id", text_col: str = "text", cached_words: int = CACHED_WORDS) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens[, ids]): full windows, then what remains."""
    end = np.array([end_id], "<u4").tobytes()
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, cached_words)
        for batch in batches:
            column = batch.column(1)
            for lo, hi in slices(utf8(column)[0], TOGETHER):  # only a slice's texts and ids are held as Python objects
                texts = ["" if t is None else t for t in column[lo:hi].to_pylist()]
                rows: list[tuple] = []
                for i, ids in enumerate(encode.batch(texts), lo):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, window):
                        piece = ids[4 * start:4 * (start + window)]
                        rows.append((i, start, len(piece) // 4, zlib.crc32(piece), n, piece if with_ids else None))
                at, *columns, pieces = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, pa.int64()) for c in columns),
                     *[pa.array(pieces, pa.binary())] * with_ids], names)

    slim = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {slim.schema['id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


class RoomTree:
    """Open windows by remaining room; each node knows if a window is open below it."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()  # rooms 0 .. window
        self.open = bytearray(2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, window: int):
        if not self.windows[room]:
            node = self.leaves + room
            while node and not self.open[node]:
                self.open[node] = 1
                node >>= 1
        self.windows[room].append(window)

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return the (room, window) with the least room of at least ``length``."""
        is_open, node = self.open, self.leaves + length
        while not is_open[node]:  # up to the first open subtree on the right
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if is_open[2 * node] else 2 * node + 1
        room = node - self.leaves
        window = self.windows[room].pop()
        if not self.windows[room]:
            while node and not (node < self.leaves and (is_open[2 * node] or is_open[2 * node + 1])):
                is_open[node] = 0
                node >>= 1
        return room, window


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset in it) of each piece; full windows stand alone."""
    order = np.argsort(-lengths, kind="stable")
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, opened = RoomTree(window), 0
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        found = tree.take(n) if n < window else None
        if found is None:
            room, at, opened = window, opened, opened + 1
        else:
            room, at = found
        number[i], offset[i] = at, window - room
        if room > n:
            tree.add(room - n, at)
    return number, offset


def pack(pieces: DataFrame, window: int = WINDOW, id_col: str = "doc_id", group: int = GROUP) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``pieces`` is read twice, so pass a stored table.

    The hash that deals pieces to groups takes in the row's place in the stored table, so
    equal pieces are dealt too."""
    groups = max(1, math.ceil(pieces.count() / group))
    columns = pieces.columns
    key = F.xxhash64(id_col, "start", "doc_tokens", "ids_crc32", F.monotonically_increasing_id())
    dealt = pieces.withColumn("_group", F.pmod(key, F.lit(groups)).cast("long"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id long, offset long"

    def run(table: pa.Table) -> pa.Table:
        # one order whatever the shuffle brings, so a task that runs again gives the same windows
        table = table.sort_by([(c, "ascending") for c in (id_col, "start", "ids_crc32", "doc_tokens")])
        number, offset = best_fit_decreasing(table["length"].to_numpy(), window)
        number = number + table["_group"][0].as_py() * (group << 12)
        return table.select(columns).append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))

    return dealt.groupBy("_group").applyInArrow(run, schema)


def pack_documents(df: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = WINDOW,
                   id_col: str = "doc_id", text_col: str = "text", cached_words: int = CACHED_WORDS) -> DataFrame:
    """Sequences of all rows.  ``cached_words`` bounds a worker's cache: about 200 bytes
    for each word, twice; fewer words cost time, not results."""
    return pack(materialize(tokenize(df, tokenizer_path, end_id, window, False, id_col, text_col, cached_words)), window, id_col)
