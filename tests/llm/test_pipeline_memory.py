"""What the pipeline's stages hold at once: plans on the driver, texts and arrays in Python workers."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType

from scorewright.llm import mixing, packing, quality, words
from scorewright.llm.queries import tokenizer


def test_raking_plans_do_not_double_with_each_margin(spark, monkeypatch):
    cells = spark.range(60).select(*[F.concat(F.lit(m), (F.col("id") % n).cast("string")).alias(m) for m, n in (("source", 5), ("lang", 4), ("topic", 3))],
                                   (F.col("id") * F.col("id") + 1).alias("tokens"))
    joins, store = [], mixing.materialize

    def stored(df):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return store(df)

    goals = mixing.goals_of(cells, {m: mixing.shares(cells, m, 0.8) for m in mixing.MARGINS}, 0.5)
    monkeypatch.setattr(mixing, "materialize", stored)
    raked, worst = mixing.rake(cells, goals, 0.5)
    assert max(joins) <= 2 and raked.count() == 60 and worst < mixing.TOLERANCE
    assert mixing.errors(raked, goals).agg(F.max("error")).first()[0] == worst


def test_words_are_split_in_small_chunks():
    text = np.frombuffer((b"x" * 999 + b" ") * 8000, np.uint8)
    words._power_tables()
    tracemalloc.start()
    w = words.split(text, np.array([0, 1000 * 5, len(text)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(w.hash) == 8000 and len(set(w.hash.tolist())) == 1 and w.row.sum() == 7995
    assert peak < 16 << 20


def test_tokens_are_given_out_by_slices(spark, monkeypatch):
    texts = ["", None, "é ü " * 40_000, "a plain text", *["some words in a row " * 3000] * 40, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    path, taken = tokenizer("byte_bpe_50k.json"), []
    whole = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: taken.append(run) or whole(self, run, schema))
    rows = packing.tokenize(df, path, with_ids=True).collect()
    out = list(taken[0](iter([pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])])))
    assert len(out) > 2 and max(b.nbytes for b in out) < 4 << 20
    assert sorted(map(tuple, rows)) == sorted(tuple(x.values()) for b in out for x in b.to_pylist())
    encode = packing.Encoder(path, 1000)
    ids = {i: b"" for i in range(len(texts))}
    for r in sorted(rows):
        ids[r.doc_id] += bytes(r.ids)
    assert all(ids[i] == encode(t or "") + np.array([1], "<u4").tobytes() for i, t in enumerate(texts))


def test_good_rows_are_found_without_pandas(spark):
    texts = [None, "", "few words", " ".join(f"w{i}" for i in range(80)), "same line here\n" * 60, " ".join(f"é{i}" for i in range(60))]
    df = spark.createDataFrame([(i % 5, t) for i, t in enumerate(texts * 3)], "doc_id long, text string").coalesce(1)
    kept = quality.keep_good(df)
    assert f", {PythonEvalType.SQL_SCALAR_ARROW_UDF}" in kept._jdf.queryExecution().executedPlan().toString()
    want = [t for t, k in zip(texts * 3, [r.kept for r in quality.quality(df).collect()]) if k]
    assert sorted(r.text for r in kept.collect()) == sorted(want) and len(want) == 6
