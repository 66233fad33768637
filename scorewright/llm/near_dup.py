"""Near duplicates: improved consistent weighted sampling over TF-IDF shingles, banded,
verified by weighted Jaccard similarity.

Two texts are linked when the weighted Jaccard similarity of their shingle vectors is
0.8 or more; classes are the connected components of the links.  A shingle is five
words in a row (all words, of a text with fewer); its weight is its count in the text
times ``ln(1 + N / (df + N / 2))``.  The half in it keeps weights between 0.5 and 1.1:
a passage that most documents share counts half.  A group of near copies makes its own
shingles frequent: with a third of all rows in it, two of its texts need a plain shingle
Jaccard of 0.848 to be linked directly, with a twentieth 0.809.
Document frequencies are counted over all rows in ``FEATURES`` hashed features, as
HashingTF and IDF do, so the table that tasks need has a fixed size.

1. One pass counts document frequencies: an array a task, summed by segments.
2. One pass draws ``BANDS * ROWS`` weighted samples a text.  The draw's parameters
   come from the shingle's hash through quantile tables, in numpy, a slice of a batch
   at a time.  Texts with the same words are one text from here on.
3. Texts that agree on all samples of a band are a group of candidates (0.9998 of the
   pairs at 0.8 are in one).  Groups with the same members are one.  A group is cut
   into blocks of about ``BLOCK`` texts and ``BLOCK_BYTES`` by a hash.  The blocks form a
   tree of ``HUB`` children; a block and its parent make a unit, and a task compares a
   unit's whole texts by matrix products and returns a spanning forest of its links,
   never its pairs.  After that, only groups that do not lie in one component are dealt
   to blocks anew, by component, and blocks of different components meet.  So every
   candidate pair is compared or already in one component, and no link between
   different texts is lost.  A group whose texts are alike costs in proportion to its
   texts; one of many texts that are near 0.8 but not linked costs its square, divided
   by ``BLOCK``, in texts sent to tasks.

Texts are compared by row, whatever their ids: null ids and ids that several texts share
link like others.  A class is named by its least id (null where no row of it has one), and
the rows with that id, or all rows of a class without ids, are kept; ``keep_one_row``,
which the pipeline uses, keeps one row.  Ids may be numbers or strings.  Null texts count
as empty; texts without words are one class.  Rows with the same words share a class.  An
empty table gives an empty one.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import bloom
from . import words as W
from .util import join_counted, mix64, numbered, slices, utf8

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 3
FEATURES = 1 << 20          # hashed features of document frequencies: 4 MB in every task
SEGMENTS = 256
SLICE = 512 << 10           # bytes of text that are sampled at once
SMOOTH = 0.5
BLOCK = 256                 # texts of a candidate group in a block; two blocks meet at once
BLOCK_BYTES = 8 << 20       # their bytes, about
KNOWN = 1 << 22             # elements of vectors that a task keeps
COLUMNS = 8192              # common elements of a matrix product
HUB = 16                    # blocks of a candidate group that one of its blocks is first compared with

_U = np.uint64
_CELLS = 4096


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1), of the logarithm of Gamma(2, 1), and of the uniform law."""
    q = (np.arange(_CELLS) + 0.5) / _CELLS
    lo, hi = np.zeros(_CELLS), np.full(_CELLS, 64.0)
    for _ in range(60):  # the distribution function is 1 - (1 + x) exp(-x)
        mid = (lo + hi) / 2
        low = 1 - (1 + mid) * np.exp(-mid) < q
        lo, hi = np.where(low, mid, lo), np.where(low, hi, mid)
    gamma = (lo + hi) / 2
    return gamma.astype(np.float32), np.log(gamma).astype(np.float32), q.astype(np.float32)


_ROW_BITS = _U(20)  # a slice has fewer rows than that


def packed_shingles(w: W.Words, rows: int, n: int = SHINGLE) -> np.ndarray:
    """A sorted key for each shingle: its row above 44 bits of its hash."""
    at, h = W.ngrams(w, n)
    row = w.row[at]
    size = np.bincount(w.row, minlength=rows)
    short = np.flatnonzero((size > 0) & (size < n))
    if len(short):
        begin = np.concatenate([[0], np.cumsum(size)])
        extra = np.array([W.ngram_hash(w.hash, begin[i:i + 1], int(size[i]))[0] for i in short], np.uint64)
        row, h = np.concatenate([row, short]), np.concatenate([h, extra])
    return np.sort((row.astype(np.uint64) << (_U(64) - _ROW_BITS)) | (h >> _ROW_BITS))


def shingles(w: W.Words, rows: int, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of each row's distinct shingles, ordered by row and hash."""
    key = packed_shingles(w, rows, n)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate([first, [len(key)]]))
    key = key[first]
    return (key >> (_U(64) - _ROW_BITS)).astype(np.int64), key << _ROW_BITS, count


def feature(h: np.ndarray, features: int) -> np.ndarray:
    return (mix64(h ^ _U(0xA5A5)) & _U(features - 1)).astype(np.int64)


def samples(row: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with shingles, and their n weighted samples (row, sample) as uint64."""
    gamma, log_gamma, uniform = _tables_once()
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, np.int64)
    out = np.zeros((len(starts), n), np.uint64)
    if not len(starts):
        return row[starts], out
    log_w = np.log(weight).astype(np.float32)
    number = np.arange(len(h), dtype=np.int64)
    mask = _U(_CELLS - 1)
    for k in range(n):
        u = mix64(h + _U((0x9E3779B97F4A7C15 * (k + 1)) & (1 << 64) - 1))
        r = gamma[(u & mask).astype(np.int32)]
        beta = uniform[((u >> _U(12)) & mask).astype(np.int32)]
        t = np.floor(log_w / r + beta)
        a = log_gamma[((u >> _U(24)) & mask).astype(np.int32)] - r * (t - beta + np.float32(1))
        key = a.view(np.int32)
        key = key ^ ((key >> 31) & np.int32(0x7FFFFFFF))  # floats in the order of integers
        best = np.minimum.reduceat((key.astype(np.int64) << 32) | number, starts) & 0xFFFFFFFF
        out[:, k] = mix64(h[best] ^ (t[best].astype(np.int64).astype(np.uint64) * _U(0xD6E8FEB86659FD93)) ^ _U(k))
    return row[starts], out


_cached_tables: list = []


def _tables_once():
    if not _cached_tables:
        _cached_tables.append(_tables())
    return _cached_tables[0]


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key for each band; keys of different bands differ."""
    out = np.zeros((len(sig), bands), np.uint64)
    for b in range(bands):
        x = np.full(len(sig), b + 1, np.uint64)
        for j in range(rows):
            x = mix64(x * _U(0x9E3779B97F4A7C15) + sig[:, b * rows + j])
        out[:, b] = x
    return out


def document_frequencies(docs: DataFrame, features: int = FEATURES) -> tuple[np.ndarray, int]:
    """Rows that hold each hashed feature, and all rows.  ``docs`` has a column ``text``.
    The driver gets one array of ``features`` counts, whatever the input."""
    per = max(1, features // SEGMENTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(features, np.int64), 0
        for batch in batches:
            offsets, data = utf8(batch.column(0))
            for lo, hi in slices(offsets, SLICE):
                key = packed_shingles(W.split(data, offsets[lo:hi + 1]), hi - lo)
                f = np.sort((key >> (_U(64) - _ROW_BITS)).astype(np.int64) * features + feature(key << _ROW_BITS, features))
                f = f[np.concatenate([[True], f[1:] != f[:-1]])] if len(f) else f
                total += np.bincount(f % features, minlength=features)
            n += batch.num_rows
        if n:
            yield emit({i: total[i * per:(i + 1) * per] for i in range(features // per)} | {-1: np.array([n])})

    def emit(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
        rows = []
        for i, x in parts.items():
            at = np.flatnonzero(x)
            if len(at):
                rows.append((i, at.astype("<i4").tobytes(), x[at].astype("<i8").tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                                           pa.array([r[2] for r in rows], pa.binary())], ["segment", "at", "n"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, at, n in zip(*(c.to_pylist() for c in batch.columns)):
                parts.setdefault(i, np.zeros(per, np.int64))[np.frombuffer(at, "<i4")] += np.frombuffer(n, "<i8")
        if parts:
            yield emit(parts)

    schema = "segment int, at binary, n binary"
    counted = docs.select("text").mapInArrow(count, schema).repartition(SEGMENTS, "segment").mapInArrow(merge, schema)
    out, n = np.zeros(features, np.int64), 0
    for segment, at, x in counted.toLocalIterator():
        where, x = np.frombuffer(at, "<i4"), np.frombuffer(x, "<i8")
        if segment < 0:
            n = int(x[0])
        else:
            out[segment * per + where] = x
    return out, n


def inverse_frequency(counts: np.ndarray, n_rows: int) -> np.ndarray:
    return np.log1p(n_rows / (counts + SMOOTH * max(n_rows, 1)))


def signatures(docs: DataFrame, idf, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, key, bands, bytes, and further columns of ``docs``) of each row; ``key`` stands for
    the text's words, and ``bands`` is null without words.  ``idf`` is a broadcast of weights."""
    n, more = bands * rows, [f for f in docs.schema.fields if f.name not in ("id", "text")]
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = idf.value
        for batch in batches:
            offsets, data = utf8(batch.column(1))
            for lo, hi in slices(offsets, SLICE):
                own = offsets[lo:hi + 1]
                key = [hashlib.blake2b(b" ".join(data[a:b].tobytes().split()), digest_size=16).digest() for a, b in zip(own, own[1:])]
                first = {k: i for i, k in reversed(list(enumerate(key)))}  # copies in one slice are drawn once
                w = W.split(data, own)
                fresh = np.array([first[k] == i for i, k in enumerate(key)])
                pick = fresh[w.row]
                w = W.Words(w.start[pick], w.end[pick], w.hash[pick], w.chars[pick], w.row[pick])
                row, h, tf = shingles(w, hi - lo)
                of, sig = samples(row, h, weight[feature(h, len(weight))] * tf, n)
                band, place = band_keys(sig, bands, rows).view(np.int64), {int(r): i for i, r in enumerate(of)}
                at = [place.get(first[k]) for k in key]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(key, pa.binary()),
                     pa.array([None if i is None else band[i].tolist() for i in at], pa.list_(pa.int64())),
                     pa.array(np.diff(own), pa.int64()), *(c[lo:hi] for c in batch.columns[2:])],
                    ["id", "key", "bands", "bytes", *(f.name for f in more)])

    schema = f"id {id_type}, key binary, bands array<bigint>, bytes bigint" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in more)
    return docs.select("id", "text", *(f.name for f in more)).mapInArrow(run, schema)


def _vector(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Elements and weights of a text: a shingle that occurs k times is k elements, so
    the weighted Jaccard similarity is that of the two sets of elements."""
    offsets, data = utf8(pa.array([text], pa.string()))
    _, h, tf = shingles(W.split(data, offsets), 1)
    weight = idf[feature(h, len(idf))]
    if len(tf) and tf.max() > 1:
        again = np.arange(tf.sum()) - np.repeat(np.cumsum(tf) - tf, tf)
        h, weight = np.repeat(h, tf), np.repeat(weight, tf)
        h = np.where(again > 0, mix64(h + again.astype(np.uint64)), h)
    return h, weight


def similarities(vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weighted Jaccard similarity of each two vectors, by matrix products over common elements."""
    k = len(vectors)
    of = np.repeat(np.arange(k), [len(v[0]) for v in vectors])
    h, weight = np.concatenate([v[0] for v in vectors]), np.concatenate([v[1] for v in vectors])
    total = np.bincount(of, weight, k)
    _, at, number, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    pick = shared[number]
    of, number, root = of[pick], column[number[pick]], np.sqrt(weight[at[shared]])
    common, order = np.zeros((k, k)), np.argsort(number, kind="stable")
    of, number = of[order], number[order]
    for lo in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(number, [lo, lo + COLUMNS])
        block = np.zeros((k, COLUMNS), np.float32)
        block[of[a:b], number[a:b] - lo] = root[number[a:b]]
        common += block @ block.T
    return common / np.maximum(total[:, None] + total[None, :] - common, 1e-300)


def weighted_jaccard(x: tuple, y: tuple) -> float:
    common, i, _ = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    low = float(x[1][i].sum())
    return low / max(float(x[1].sum() + y[1].sum()) - low, 1e-300)


def _forest(similar: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what ``similar`` joins, one fewer than each component has nodes."""
    seen, out = np.zeros(len(similar), bool), []
    for root in range(len(similar)):
        stack = [] if seen[root] else [root]
        seen[root] = True
        while stack:
            i = stack.pop()
            new = np.flatnonzero(similar[i] & ~seen)
            seen[new] = True
            out += [(i, int(j)) for j in new]
            stack += new.tolist()
    return out


def compare(units: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """Links (x, y) between the similar texts of each unit; ``units`` has unit and rep, a long number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = {}, [0]

        def links(reps: list, texts: list) -> list[tuple]:
            vectors = []
            for rep, text in zip(reps, texts):
                if rep not in known:
                    if held[0] > KNOWN:
                        known.clear()
                        held[0] = 0
                    known[rep] = _vector(text, idf.value)
                    held[0] += len(known[rep][0])
                vectors.append(known[rep])
            return [(reps[i], reps[j]) for i, j in _forest(similarities(vectors) >= threshold - 1e-6)]

        unit, reps, own = None, [], []
        for batch in batches:
            out = []
            for u, rep, text in zip(*(c.to_pylist() for c in batch.columns)):
                if u != unit:
                    out += links(reps, own) if len(reps) > 1 else []
                    unit, reps, own = u, [], []
                reps.append(rep)
                own.append(text)
            yield link_rows(out)
        yield link_rows(links(reps, own) if len(reps) > 1 else [])

    def link_rows(found: list[tuple]) -> pa.RecordBatch:
        x, y = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])

    with_text = units.join(texts, "rep").select("unit", "rep", "text")
    dealt = with_text.repartition("unit").sortWithinPartitions("unit", "rep")
    return dealt.mapInArrow(run, "x long, y long")


def components(links: DataFrame) -> DataFrame:
    """(rep, comp): the smallest node of each node's component.  ``links`` has x and y.

    Rounds of least neighbour and pointer jumping; each round is stored."""
    both = materialize(links.select(F.col("x").alias("u"), F.col("y").alias("v")).unionByName(
        links.select(F.col("y").alias("u"), F.col("x").alias("v"))).distinct())
    label = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("c")))
    while True:
        of = lambda a, b: label.select(F.col("u").alias(a), F.col("c").alias(b))
        least = both.join(of("v", "cv"), "v").groupBy("u").agg(F.min("cv").alias("m"))
        step = label.join(least, "u").select("u", "c", F.least("c", "m").alias("m"))
        jump = step.join(of("m", "cm"), "m").select("u", "c", F.least("m", "cm").alias("d"))
        jump = materialize(jump)
        moved = jump.where("c <> d").limit(1).count()
        label = jump.select("u", F.col("d").alias("c"))
        if not moved:
            return label.select(F.col("u").alias("rep"), F.col("c").alias("comp"))


def open_pairs(member: DataFrame, label: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Texts of the groups that do not lie in one component yet, dealt anew: (b, k, rep), and the
    blocks that still have to meet: (b, k, k2).  None where no group is open.

    A component of a block's size or more has blocks of its own, and the others of a group
    share blocks.  All blocks but those of the group's largest component meet all blocks, so
    no two blocks of that component are ever listed."""
    texts = member.where("blocks > 2").join(label, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    texts = materialize(texts.select("b", "rep", "bytes", "comp"))
    per = materialize(texts.groupBy("b", "comp").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")))
    still = per.groupBy("b").agg(F.count("*").alias("comps")).where("comps > 1").select("b")
    parts = F.ceil(F.greatest(F.sum("n") / BLOCK, F.least(F.sum("bytes") / BLOCK_BYTES, F.sum("n") / 2))).cast("long").alias("parts")
    per = materialize(per.join(still, "b").withColumn("large", F.col("n") >= BLOCK))
    if not per.limit(1).count():
        return None
    # (b, own, parts): own is the component that has blocks alone, null for the shared ones
    dealt = materialize(per.withColumn("own", F.when(F.col("large"), F.col("comp"))).groupBy("b", "own").agg(parts, F.sum("n").alias("n")))
    name = F.xxhash64("b", "own", "part")
    blocks = materialize(dealt.select("b", "own", "n", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).select("b", "own", name.alias("k")))
    most = dealt.where("own is not null").groupBy("b").agg(F.max_by("own", F.struct("n", "own")).alias("most"))
    blocks = blocks.join(most, "b", "left").withColumn("in_most", F.coalesce(F.col("own") == F.col("most"), F.lit(False))).drop("most")
    other = blocks.select("b", F.col("own").alias("own2"), F.col("k").alias("k2"), F.col("in_most").alias("in_most2"))
    same = F.coalesce(F.col("own") == F.col("own2"), F.lit(False))
    pairs = blocks.where("not in_most").join(other, "b").where(
        F.col("in_most2") | ((F.col("k") < F.col("k2")) & ~same) | ((F.col("k") == F.col("k2")) & F.col("own").isNull()))
    sized = materialize(per.join(dealt.where("own is not null").select("b", F.col("own").alias("comp"), F.col("parts").alias("own_parts")), ["b", "comp"], "left")
                        .join(dealt.where("own is null").select("b", F.col("parts").alias("shared_parts")), "b", "left")
                        .select("b", "comp", "n", F.when(F.col("large"), F.col("comp")).alias("own"), "own_parts", "shared_parts"))
    texts = join_counted(texts.select("b", "rep", "comp"), sized, ["b", "comp"], "n", texts.count())
    part = F.when(F.col("own").isNotNull(), F.pmod(F.xxhash64("rep"), "own_parts")).otherwise(F.pmod(F.xxhash64("comp"), "shared_parts"))
    return texts.withColumn("part", part).select("b", name.alias("k"), "rep"), pairs.select("b", "k", "k2")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS, features: int = FEATURES) -> DataFrame:
    """(id, class_id, class_size, kept) of each row."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts, n_rows = document_frequencies(docs, features)
    idf = spark.sparkContext.broadcast(inverse_frequency(counts, n_rows))
    # a text is named by its row's id and 128 bits of its own, so ids may be null, reused or of any type
    named = docs.withColumn("h1", F.xxhash64("id", "text")).withColumn("h2", F.xxhash64("text", F.lit(1)))
    signed = materialize(signatures(named, idf, bands, rows))
    row = F.struct("id", "h1", "h2")
    reps = signed.groupBy("key").agg(F.min(row).alias("row"), F.first("bands").alias("bands"), F.max("bytes").alias("bytes"),
                                       F.count("*").alias("n"), F.min("id").alias("least"))
    reps = materialize(reps.withColumn("rep", F.monotonically_increasing_id()))

    member = reps.where("bands is not null").select("rep", "bytes", F.explode("bands").alias("b"))
    shared = member.groupBy("b").agg(F.count("*").alias("n")).where("n > 1")
    member = materialize(member.join(shared, "b"))
    nodes = materialize(reps.join(member.select("rep").distinct(), "rep").select("rep", "row.*"))

    # the texts that are compared, taken from their scan by a Bloom filter before they are shuffled
    n_bits = bloom.bits_for(nodes.count())
    wanted = bloom.test(bloom.build(nodes, "h1", n_bits), F.col("h1"), n_bits)
    picked = named.where(wanted).groupBy("id", "h1", "h2").agg(F.first("text").alias("text"))
    alike = F.col("id").eqNullSafe(F.col("id2"))
    texts = materialize(picked.join(nodes.withColumnRenamed("id", "id2"), ["h1", "h2"]).where(alike).select("rep", "text"))

    # groups with the same members are compared once
    same = member.groupBy("b").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.bit_xor(F.xxhash64("rep")).alias("h1"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("h2"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.least(F.col("bytes") / BLOCK_BYTES, F.col("n") / 2))).cast("int")
    groups = same.groupBy("n", "bytes", "h1", "h2").agg(F.min("b").alias("b")).select("b", blocks.alias("blocks"))
    member = materialize(member.select("rep", "b", "bytes").join(groups, "b").withColumn("block", F.pmod(F.xxhash64("b", "rep"), "blocks").cast("int")))

    # a group of one block is a unit; the blocks of a larger one form a tree, in which each meets its parent
    first, block = F.col("block") * HUB + 1, F.col("block")
    children = F.filter(F.sequence(first, first + HUB - 1), lambda i: i < F.col("blocks"))
    met = F.when(F.col("blocks") == 1, F.array(block)).otherwise(F.concat(F.filter(F.array(block), lambda i: i > 0), children))
    units = member.select("b", "rep", F.explode(met).alias("i")).select(F.xxhash64("b", "i").alias("unit"), "rep")
    links = materialize(compare(units, texts, idf, threshold))
    label = components(links)

    found = open_pairs(member, label)
    if found:  # other blocks of a group meet where it does not lie in one component yet
        dealt, pairs = found
        meets = pairs.select("b", F.explode(F.array_distinct(F.array("k", "k2"))).alias("k"), F.xxhash64("b", "k", "k2").alias("unit"))
        more = compare(dealt.join(meets, ["b", "k"]).select("unit", "rep"), texts, idf, threshold)
        label = components(links.unionByName(materialize(more)))

    comps = materialize(reps.join(label, "rep", "left").select("key", "n", "least", F.coalesce("comp", "rep").alias("comp")))
    classes = comps.groupBy("comp").agg(F.min("least").alias("class_id"), F.sum("n").alias("class_size"))
    comps = materialize(comps.join(classes, "comp").select("key", "n", "class_id", "class_size"))
    out = join_counted(signed.select("id", "key"), comps, ["key"], "n", n_rows)
    return out.select(F.col("id").alias(id_col), "class_id", "class_size", F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def keep_one_row(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each class, with all its columns: the smallest id (null ids last), then
    by a hash of the text, then by a stored row number.  Classes are those of rows, so
    repeated rows, reused ids and null ids need no rule of their own."""
    rows, number = numbered(df)
    classes = near_duplicates(rows, number, text_col, **options).select(F.col(number).alias("n"), "class_id")
    order = rows.select(F.col(number).alias("n"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"))
    best = F.min_by("n", F.struct(F.col("id").isNull(), "id", "hash", "n"))
    stay = classes.join(order, "n").groupBy("class_id").agg(best.alias(number)).select(number)
    return rows.join(stay, number, "left_semi").drop(number)
