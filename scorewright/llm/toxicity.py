"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context windows.

The lexicon is learned from labelled rows: words, and stems of four to six letters, that
toxic documents hold many times as often as others; near copies are counted once, so
that the words of a copied text do not enter by their number.  Its trie and the automata of one
edit run as one: a state is a set of (trie node, edits so far), and states and their
transitions are kept once computed, so a word costs a look-up a letter and most words
end in the dead state after three or four.  Stems match words that begin with them and
allow no edit; words of five letters or more, which stay beside their stems, allow one.

Each hit carries its context: quoted if it lies between quotation marks, or if a word of
reporting or rejecting stands in the window of ``WINDOW`` words before it or after it.  For each
lexicon entry, number of edits and context, the learner counts labelled documents; the
share of toxic ones, drawn towards the share of all hits of that kind, is the hit's
weight.  A document's score is the largest weight of its entries, and further entries
of weight ``STRONG`` or more raise it as independent signs do; without hits it is
``base``, the share of toxic ones among labelled documents without hits.

The learner reads a bounded sample, ``SAMPLE`` labelled rows in the order of a hash, which
bounds the lexicon too; everything else covers all rows.  Null texts count as empty and
score ``base``.  Labels that are null are left out; an id with several labels is toxic if
one of them is.  Rows are independent, so ties, repeated rows and null ids need no rule; an empty table gives an
empty one; without labelled rows of both kinds all scores are the share of toxic ones
(0 without any).  Further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import near_dup
from .util import BoundedCache

SAMPLE = 20_000
LEAST_DOCS = 3          # toxic sample documents, copies counted once, that hold an entry
LIFT = 15.0             # times as frequent in toxic documents
EVIDENCE = 8.0          # log-likelihood ratio against chance, so that rare words don't enter by luck
LEAST_SHARE = 0.005     # of the toxic sample documents
COPY_BANDS, COPY_ROWS = 12, 6   # 0.97 of the pairs of similarity 0.8 are taken as copies, 0.01 of those of 0.3
STRONG = 0.5
FUZZY_LENGTH = 5
WINDOW = 6
PRIOR = 2.0
CACHED_WORDS = 300_000
CACHED_STATES = 100_000
THRESHOLD = 0.7

_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’¿¡…"
_QUOTES = re.compile("[\"«»„“”]")
# words of reporting or rejecting, in the corpus's languages
REPORTING = frozenset("""said says quote quoted quotes called wrote cited reported never dit disait cite écrit jamais
sagte sagt zitat schrieb niemals dijo dice cita escribió nunca""".split())


def in_fold(doc_id: Column) -> Column:
    """False for rows whose labels are held out."""
    return F.crc32(doc_id.cast("string")) % 3 != 1


def words_of(text: str) -> list[str]:
    return [w.strip(_EDGE) for w in text.lower().split()]


def features_of(words) -> set[str]:
    """Words, and stems written with a closing ``*``."""
    out = set()
    for w in words:
        if len(w) >= 3:
            out.add(w)
            out.update(w[:n] + "*" for n in (4, 5, 6) if len(w) > n)
    return out


@dataclass
class Lexicon:
    """Trie of entries, walked together with the automata of one edit."""
    entries: list[str]
    children: list[dict] = field(default_factory=lambda: [{}])
    word_at: dict = field(default_factory=dict)
    stem_at: dict = field(default_factory=dict)

    def __post_init__(self):
        for i, entry in enumerate(self.entries):
            node = 0
            for c in entry.rstrip("*"):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                node = self.children[node][c]
            (self.stem_at if entry.endswith("*") else self.word_at)[node] = i
        self.states: dict[frozenset, dict] = {}
        self.start = self._close({(0, 0)})
        self.hits = BoundedCache(self._find, CACHED_WORDS)

    def _close(self, state: set) -> frozenset:
        """With what leaving out a letter of an entry adds."""
        return frozenset(state | {(child, 1) for node, edits in state if edits == 0 for child in self.children[node].values()})

    def _step(self, state: frozenset, c: str) -> frozenset:
        out = set()
        for node, edits in state:
            child = self.children[node].get(c)
            if child is not None:
                out.add((child, edits))
            if edits == 0:
                out.add((node, 1))                                            # a letter too many
                out.update((x, 1) for x in self.children[node].values())      # another letter
        return self._close(out)

    def _find(self, word: str) -> tuple:
        """(entry, edits) of the best match, or ()."""
        state = self.start
        if len(self.states) > CACHED_STATES:
            self.states.clear()
        stem = ()
        for c in word:
            step = self.states.setdefault(state, {})
            after = step.get(c)
            if after is None:
                after = step[c] = self._step(state, c)
            state = after
            if not state:
                break
            if self.stem_at:
                for node, edits in state:
                    if edits == 0 and node in self.stem_at:
                        stem = (self.stem_at[node], 0)
        best = min(((edits, self.word_at[node]) for node, edits in state if node in self.word_at
                    and (edits == 0 or len(self.entries[self.word_at[node]]) >= FUZZY_LENGTH)), default=None)
        if best and best[0] == 0:
            return best[1], 0
        return stem or ((best[1], best[0]) if best else ())

    def kinds(self, text: str) -> set[tuple[int, int, bool]]:
        """(entry, edits, quoted) of the text's hits."""
        raw = text.lower().split()
        found = list(map(self.hits.__getitem__, [w.strip(_EDGE) for w in raw]))
        self.hits.trim()
        at = [i for i, x in enumerate(found) if x]
        out = set()
        if at:
            marks, seen = [], 0
            for w in raw:
                here = len(_QUOTES.findall(w))
                marks.append(seen)
                seen += here
            for i in at:
                near = raw[max(0, i - WINDOW):i + WINDOW + 1]
                quoted = (marks[i] % 2 == 1 and seen > marks[i]) or len(_QUOTES.findall(raw[i])) > 1
                out.add((*found[i], quoted or any(w.strip(_EDGE) in REPORTING for w in near)))
        return out


@dataclass
class Model:
    entries: list[str]
    base: float
    weight: dict

    def lexicon(self) -> Lexicon:
        return Lexicon(self.entries)

    def score(self, lexicon: Lexicon, text: str) -> float:
        best: dict[int, float] = {}
        for entry, edits, quoted in lexicon.kinds(text):
            w = self.weight.get((entry, edits, quoted))
            if w is None:
                w = self.weight.get((-1, edits, quoted), 0.0 if quoted else 0.5)  # of a kind that the sample lacks
            best[entry] = max(best.get(entry, 0.0), w)
        clean = 1 - max([self.base, *best.values()])
        for w in sorted(best.values())[:-1]:
            clean *= 1 - w if w >= STRONG else 1
        return 1 - clean


def sample_of(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most ``size`` labelled rows; ``docs`` has id and text, ``labels`` id and toxic."""
    picked = (labels.where("id is not null and toxic is not null").where(in_fold(F.col("id")))
              .groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(size))
    return docs.join(F.broadcast(picked), "id").select("text", (F.col("toxic") > 0).alias("toxic")).dropDuplicates()


def copies_of(rows: DataFrame) -> DataFrame:
    """(row, copy) of a bounded sample (row, text): rows that agree on a band of weighted samples share a copy class."""
    spark = rows.sparkSession
    drawn = near_dup.signatures(rows.select(F.col("row").alias("id"), "text"), spark.sparkContext.broadcast(np.ones(1)), COPY_BANDS, COPY_ROWS)
    parent: dict[int, int] = {}
    holder: dict = {}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for row, key, bands in drawn.select("id", "key", "bands").collect():
        parent[row] = row
        for k in (bytes(key), *(bands or ())):
            parent[find(holder.setdefault(k, row))] = find(row)
    return spark.createDataFrame([(i, find(i)) for i in parent], "row long, copy long")


def learn(sample: DataFrame) -> Model:
    """Fit on a stored sample (text, toxic) of bounded size."""
    def count(batches):
        """Classes of copies that hold each feature; the rows come class by class."""
        good, bad, at, held = Counter(), Counter(), None, {True: set(), False: set()}
        for batch in batches:
            for c, text, toxic in zip(*(x.to_pylist() for x in batch.columns)):
                if c != at:
                    bad.update(held[True])
                    good.update(held[False])
                    at, held = c, {True: set(), False: set()}
                held[toxic] |= features_of(set(words_of(text or "")))
        bad.update(held[True])
        good.update(held[False])
        keys = [k for k in bad if bad[k]] + [k for k in good if k not in bad]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([bad[k] for k in keys], pa.int64()),
                                          pa.array([good[k] for k in keys], pa.int64())], ["f", "bad", "good"])

    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_bad, n_good = n.get(True, 0), n.get(False, 0)
    if not n_bad or not n_good:
        return Model([], n_bad / max(1, n_bad + n_good), {})
    # copies of a text are one witness
    rows = materialize(sample.select("text", "toxic").withColumn("row", F.monotonically_increasing_id()))
    rows = rows.join(F.broadcast(copies_of(rows)), "row").select("copy", "text", "toxic")
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.countDistinct("copy").alias("n")).collect()}
    n_bad, n_good = n[True], n[False]
    per = rows.repartition("copy").sortWithinPartitions("copy").mapInArrow(count, "f string, bad long, good long").groupBy("f").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    lift = (F.col("bad") / n_bad) / ((F.col("good") + 1) / n_good)
    share = n_bad / (n_bad + n_good)
    seen = F.col("bad") + F.col("good")
    evidence = F.col("bad") * F.log(F.col("bad") / (seen * share)) + F.when(
        F.col("good") > 0, F.col("good") * F.log(F.col("good") / (seen * (1 - share)))).otherwise(0.0)
    rows = per.where((F.col("bad") >= max(LEAST_DOCS, LEAST_SHARE * n_bad)) & (lift >= LIFT)).where(evidence >= EVIDENCE).collect()
    entries = sorted(r["f"] for r in rows)

    def hits(batches):
        lexicon, bad, good = Lexicon(entries), Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                kinds = lexicon.kinds(text or "")
                (bad if toxic else good).update(kinds | {(-1, e, q) for _, e, q in kinds} | ({(-2, 0, False)} if not kinds else set()))
        keys = list(bad.keys() | good.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([k[2] for k in keys], pa.bool_()),
             pa.array([bad[k] for k in keys], pa.int64()), pa.array([good[k] for k in keys], pa.int64())], ["e", "d", "q", "bad", "good"])

    rows = (sample.select("text", "toxic").mapInArrow(hits, "e long, d long, q boolean, bad long, good long")
            .groupBy("e", "d", "q").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect())
    # labelled rows stand for their kind: toxic ones are rare, so counts are taken as they are
    count = {(r["e"], r["d"], r["q"]): (r["bad"], r["good"]) for r in rows}
    overall = {k: (b + 0.5) / (b + g + 1) for k, (b, g) in count.items() if k[0] == -1}
    weight = {k: (b + PRIOR * overall[-1, k[1], k[2]]) / (b + g + PRIOR) for k, (b, g) in count.items() if k[0] >= 0} | overall
    b, g = count.get((-2, 0, False), (0, 0))
    return Model(entries, (b + 0.1) / (b + g + 10), weight)


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SAMPLE) -> DataFrame:
    """(id, held_out, score, predicted) of each row; ``labels`` has the id and ``toxic``."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = materialize(sample_of(docs, labels.select(F.col(id_col).alias("id"), "toxic"), size))
    model = learn(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = model.lexicon()
        for batch in batches:
            scores = [model.score(lexicon, x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["id", "score"])

    scored = docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, score double")
    return scored.select(F.col("id").alias(id_col), F.coalesce(~in_fold(F.col("id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
