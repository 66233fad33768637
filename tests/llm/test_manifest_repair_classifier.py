"""The Merkle manifest, conversation repair and the quality classifier against brute force."""

import collections
import itertools
import random
import re
import time
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.llm import conversations, merkle, mixing, packing, pu_quality, queries, secret_scan, warc
from scorewright.llm.queries import QUERIES, tokenizer

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- Merkle manifest
def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def folded(nodes, at, value):
    """Root, siblings on the way and root with ``value`` at a place, all hashed anew."""
    siblings, changed = [], list(nodes)
    changed[at] = value
    while len(nodes) > 1:
        lo = at // 8 * 8
        siblings += [x for i, x in enumerate(nodes[lo:lo + 8], lo) if i != at]
        nodes, changed = ([h(*level[i:i + 8]) for i in range(0, len(level), 8)] for level in (nodes, changed))
        nodes, changed, at = list(nodes), list(changed), at // 8
    return nodes[0], siblings, changed[0]


def brute_manifest(rows):
    null_first = lambda v: (v is not None, v if v is not None else 0)
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda r: (null_first(r["doc_id"]), leaf_of(r, r["text"])))
    leaves = {g: [leaf_of(r, r["text"]) for r in groups[g]] for g in langs}
    tops = [folded(leaves[g], 0, leaves[g][0])[0] for g in langs]
    out = []
    for j, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            subroot, below, changed = folded(leaves[g], i, leaf_of(r, text))
            root, above, changed = folded(tops, j, changed)
            out.append((r["doc_id"], leaves[g][i], subroot, root, h(*below, *above), changed, changed == root))
    return sorted(out, key=repr)


def documents(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    return df.select("*", *[F.lit("x").alias(c) for c in ("g", "id", "leaf", "i", "n", "h", "root", "part")])


def third(df):
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 0


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 700, None: 9, "": 8, "é": 65}, {f"l{i:02d}": 2 for i in range(70)}])
def test_manifest_equals_brute_force(spark, sizes):
    rng = random.Random(len(sizes))
    rows, n = [], 0
    for lang, size in sizes.items():
        for _ in range(size):
            rows.append((n, rng.choice(["a", None, "ü"]), lang, rng.choice([3, None]), rng.choice([None, "", "Some TEXT ÄÖ", "lower", "X" * 3000])))
            n += 1
    rows += [rows[0], rows[0], (None, "s", "en", 1, "Null ID"), (None, None, "en", None, None)]  # repeated rows, null ids
    df = documents(spark, rows).repartition(5)
    out = merkle.manifest(df, marked=third(df))
    want = brute_manifest([dict(zip(("doc_id", "source", "lang", "n_chars", "text"), r)) for r in rows])
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, out.collect()), key=repr) == want


def test_manifest_proofs_fold_to_the_root(spark):
    rows = [(i, "s", "en" if i % 3 else "de", 1, f"Text {i}") for i in range(100)]
    for r in merkle.manifest(documents(spark, rows), with_proof=True).collect():
        assert r.verified and r.folded_root == r.root
        value = r.leaf
        for step in r.proof:
            value = h(*step.children[:step.slot], value, *step.children[step.slot:])
        assert value == r.root and r.proof_sha256 == h(*(c for step in r.proof for c in step.children))
    assert merkle.manifest(documents(spark, []).where("false")).count() == 0


def test_parent_folds_by_its_states():
    for n in range(1, 9):
        children = [h(str(i)).encode() for i in range(n)]
        parent = merkle.Parent(children)
        for slot in range(n):
            other = h("other").encode()
            assert parent.fold(slot, other).decode() == sha256(b"".join([*children[:slot], other, *children[slot + 1:]])).hexdigest()


# ------------------------------------------------------------ conversation repair
def brute_repair(rows):
    """Cost and least audit by trying all edits of (role, text) rows with at most two insertions in a place."""
    best = None
    seen, faults = set(), []
    for role, text in rows:
        body = text.rstrip(" \t\n\v\f\r")
        faults.append("gone" if not body or (role, text) in seen else "" if body[-1] in ".!?" else "cut")
        seen.add((role, text))
    def options(i):
        role, text = rows[i]
        more = 3 * (faults[i] == "cut")
        yield 4, "D", []
        if faults[i] != "gone":
            yield more, "K", [(role, text)]
            for new in ("user", "assistant"):
                yield 3 + more, "R", [(new, text)]
    inserts = [[]] + [[x] for x in "ua"] + [list(x) for x in itertools.product("ua", repeat=2)]
    full = {"u": "user", "a": "assistant"}
    def walk(i, cost, audit, out):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        for ins in inserts:
            grown, price = out + [(full[x], "") for x in ins], cost + 3 * len(ins)
            trace = audit + "I" * len(ins)
            if i == len(rows):
                if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in grown)):
                    found = (price, trace, "\n".join(f"{r}:{t}" for r, t in grown))
                    best = found if best is None or found[:2] < best[:2] else best
                continue
            for c, e, kept in options(i):
                walk(i + 1, price + c, trace + e, grown + kept)
    walk(0, 0, "", [])
    return best


def test_hirschberg_finds_the_least_audit():
    rng = random.Random(8)
    for _ in range(120):
        rows = [(rng.choice(["user", "assistant", "system", "tool", " ", ""]), rng.choice(["Hi.", "Yes!", "cut", "", "a b?"])) for _ in range(rng.randint(0, 4))]
        (_, blank, duplicate, truncated, _, cost, audit, digest), found = conversations.whole([(i, *r) for i, r in enumerate(rows)])
        want = brute_repair(rows)
        assert (cost, audit) == want[:2] and digest == sha256(want[2].encode()).hexdigest()
        assert "\n".join(f"{r}:{t}" for r, t in found) == want[2]


def test_crossings_of_blocks_equal_those_of_rows():
    """Rows joined to blocks of four vectors have the same cost and audit as one solution."""
    rng = random.Random(3)
    for _ in range(200):
        kinds = bytes(rng.randrange(12) for _ in range(rng.randint(1, 60)))
        cost, edits = conversations.solve(kinds)
        cuts = sorted({0, len(kinds), *(rng.randint(0, len(kinds)) for _ in range(5))})
        blocks = [kinds[a:b] for a, b in zip(cuts, cuts[1:])]
        moves = []
        for block in blocks:
            table = {}
            for start in range(4):
                costs, ranks = conversations.forward([conversations.MOVES[k] for k in block], start)
                table[start] = {s: (costs[s], ranks[s]) for s in costs}
            moves.append(table)
        states = conversations.crossings(moves)
        parts = [conversations.solve(block, a, b)[1] for block, a, b in zip(blocks, states, states[1:])]
        assert "".join(e for p in parts for e in p) + conversations.CLOSING[states[-1]] == "".join(edits)
        assert cost == sum({"K": 0, "R": 3, "D": 4, "I": 3}[e] for e in "".join(edits)) + 3 * sum(
            k % 3 == conversations.CUT and e[-1] != "D" for k, e in zip(kinds, edits))


def turns(spark, n_long, rng):
    rows = [(1, i, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"t{i}", f"T{i}.", "", None])) for i in range(n_long)]
    rows += [(c, t, rng.choice(["system", "user", "assistant", None, "tool"]), rng.choice(["Hi.", "cut", None, "Fine!"]))
             for c in range(2, 40) for t in rng.sample([*range(6), None], rng.randint(1, 6))]
    rows += [(None, 0, "user", "Null id."), (None, 1, "assistant", "Yes."), rows[5], rows[5], (99, 3, "user", "Lost.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return rows, df.select("*", F.expr("not (conv_id <=> 99)").alias("live"), *[F.lit("x").alias(c) for c in ("g", "conv", "part", "no", "rows", "order", "tie", "cost")])


@pytest.mark.parametrize("block_rows", [3, 4096])
def test_repair_of_cut_conversations(spark, block_rows):
    """One conversation holds most rows and is cut into blocks and partitions; results are those of whole ones."""
    rows, df = turns(spark, 300, random.Random(6))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.conv_id: tuple(r)[1:] for r in conversations.repair(df.repartition(4), live=F.col("live"), block_rows=block_rows).collect()}
        listed = collections.defaultdict(list)
        for r in conversations.repaired_rows(df, live=F.col("live"), block_rows=block_rows).orderBy("part", "no", "at").collect():
            listed[r.conv_id].append(f"{r.role}:{r.text}")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        own[c] += [] if c == 99 else [(t, " " if role is None else role, " " if text is None else text)]
    md5 = lambda x: __import__("hashlib").md5(x.encode()).hexdigest()
    for c, r in own.items():
        r.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], md5(x[2])))
        assert got[c] == conversations.whole(r)[0]
        assert sha256("\n".join(listed[c]).encode()).hexdigest() == got[c][-1]
    assert set(got) == set(own) and got[99] == (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    assert conversations.repair(df.where("false")).count() == 0


def test_damage_of_the_contract(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(60) for t in range(5)] + [(None, None, None, None)]
    out = collections.defaultdict(list)
    for r in queries.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        out[r.conv_id, r.turn].append((r.role, r.text, r.live))
    for c, t, role, text in rows:
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        one = ("user" if f == 4 else role, "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text, f != 0)
        assert out[c, t] == [one] * (2 if f == 3 else 1)


# -------------------------------------------------------------- quality classifier
def brute_features(text):
    data = text.encode()
    kinds = [next((i for i, c in enumerate(["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\v\f\r", "\n", ".,;:?!"])
                   if chr(b) in c), 6) if b < 128 else 7 for b in data]
    pairs = collections.Counter(zip(kinds, kinds[1:]))
    shares = [np.sqrt(pairs[a, b] / max(len(data) - 1, 1)) for a in range(8) for b in range(8)]
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, count = len(words), collections.Counter(words)
    triples = collections.Counter(zip(words, words[1:], words[2:]))
    per = max(n, 1)
    return [*shares, np.log1p(n), sum(map(len, words)) / per, sum(a == b for a, b in zip(words, words[1:])) / per, np.log1p(len(count)) / np.log1p(per),
            np.sqrt(max(count.values(), default=0) / per), np.sqrt(sum(c for c in triples.values() if c > 1) / max(n - 2, 1)), 1.0]


def test_features_equal_brute_force(monkeypatch):
    monkeypatch.setattr(pu_quality, "SLICE", 50)
    rng = random.Random(2)
    texts = ["", " ", "a", "Ab 12.\n\nß #x ab ab ab", *("".join(rng.choice(["a", "B", " ", "\n", "é", "1", "!", "ab ", "#"]) for _ in range(rng.randint(0, 200))) for _ in range(60))]
    data = "".join(texts).encode()
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    assert np.allclose(pu_quality.features(np.frombuffer(data, np.uint8), offsets), [brute_features(t) for t in texts], atol=1e-5)


def planted(spark, n, share, seed):
    """Texts of small words, of which ``share`` are good and the others shout."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        good = rng.random() < share
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(20, 60))]
        rows.append((i, " ".join(words if good else [w.upper() + "!!" for w in words]), int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_prior_and_scores_of_planted_quality(spark):
    for share in (0.3, 0.8):
        rows = planted(spark, 1500, share, 7)
        known = rows.where("doc_id % 3 = 0").select("doc_id", "quality")
        table = pu_quality.feature_table(rows.select(F.col("doc_id").alias("id"), "text"), known.where("quality = 1").select(F.col("doc_id").alias("id")))
        assert pu_quality.learn(table).prior == pytest.approx(share, abs=0.06)
        out = pu_quality.quality_scores(rows.select("doc_id", "text", F.lit(1).alias("score"), F.lit(2).alias("x")), known).join(rows, "doc_id").collect()
        assert sum(r.predicted == r.quality for r in out) > 0.97 * len(out)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)


def test_labels_of_negatives_and_held_out_rows_are_not_read(spark):
    rows = planted(spark, 400, 0.7, 3)
    labels = rows.select("doc_id", "quality")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    other = labels.where("quality = 1").union(rows.where(held).select("doc_id", F.lit(1).alias("quality")))
    a, b = ({r.doc_id: r.score for r in pu_quality.quality_scores(rows.select("doc_id", "text"), y).collect()} for y in (labels, other))
    assert a == pytest.approx(b)


def test_non_negative_risk():
    sums = {"u": 0.2, "p": 0.1, "p_as_negative": 0.5}
    assert pu_quality.risk(sums, 0.5) == (pytest.approx(0.05), pytest.approx(-0.05))
    assert pu_quality.risk(sums, 0.2) == (pytest.approx(0.02 + 0.1), pytest.approx(0.1))


def test_classifier_on_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b c"), (2, "x " * 50_000), (5, "é" * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit(0))
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (None, 1), (5, None)], "doc_id long, quality int")
    out = pu_quality.quality_scores(docs, labels).collect()
    assert collections.Counter(r.doc_id for r in out) == collections.Counter(i for i, _ in rows) and all(0 <= r.score <= 1 for r in out)
    assert {r.score for r in pu_quality.quality_scores(docs, labels.where("false")).collect()} == {pu_quality.FIRST}
    assert pu_quality.quality_scores(docs.where("false"), labels).count() == 0


def test_quality_on_the_held_out_fold(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    out = QUERIES["op13_quality_classifier"](spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").toPandas()
    rank, good = out.score.rank(), out.quality == 1
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.97 and out.predicted[good].mean() > 0.97 and out.predicted[~good].mean() < 0.05


# ------------------------------------------------------------- mended operators
def test_packing_keeps_large_ids_beside_null_ids_and_deals_equal_rows(spark):
    ids = [2**60 + 1, None, 2**60 + 3, *[7] * 300]
    df = spark.createDataFrame([(i, "same text") for i in ids], "doc_id long, text string").repartition(4)
    path = tokenizer("byte_bpe_50k.json")
    pieces = packing.materialize(packing.tokenize(df, path))
    out = packing.pack(pieces, group=20).collect()
    assert collections.Counter(r.doc_id for r in out) == collections.Counter(ids)
    per = collections.Counter(r.sequence_id // (20 << 12) for r in out)
    assert len(per) > 8 and max(per.values()) < 60
    windows = collections.defaultdict(list)
    for r in out:
        windows[r.sequence_id].append((r.offset, r.length))
    assert all(offset == sum(n for o, n in parts if o < offset) for parts in windows.values() for offset, _ in parts)


def test_encoder_equals_the_library_on_odd_texts():
    encode, rng = packing.Encoder(tokenizer("byte_bpe_50k.json"), 50), random.Random(1)
    odd = ["a", "b", "th", " ", "  ", "\n", "\t", "é", "中", "😀", "<|endoftext|>", "1", "...", " ", "'s", "Ġ", "　", "!?", "W"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 25))) for _ in range(4000)] + ["x" * 9000, "word " * 500, " "]
    for lo in range(0, len(texts), 100):
        assert encode.batch(texts[lo:lo + 100]) == encode._ids(texts[lo:lo + 100])


def test_hostile_html_is_read_in_one_pass():
    for page in ("<!-- " * 200_000, "<script>" * 125_000, "<a " * 300_000, "<title>" * 140_000, "<script " * 125_000, "<a " * 300_000 + ">"):
        begun = time.time()
        warc.text_of(page), warc.title_of(page), warc.links_of(warc.visible(page))
        assert time.time() - begun < 20


def test_many_spans_in_one_text(spark):
    rows = [(1, "abcdef0123456789 " * 100_000), (2, "secret=abcdefghijklmnop " * 20_000 + "7fQz+Lk9/aBcD3eRtYuIoP2sX4vN8mWq " * 2000)]
    begun = time.time()
    out = {r.doc_id: (r.n_hex, r.n_assign, r.n_random) for r in secret_scan.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: (100_000, 0, 0), 2: (0, 20_000, 2000)} and time.time() - begun < 240


def test_mixing_meets_margins_where_cells_are_whole(spark):
    """At budget 0.8 some cells are taken whole; every margin's goal is still met within a tenth of a percent."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    slim = mixing.with_margins(docs).select(F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"))
    cells = mixing.materialize(mixing.cells_of(slim))
    goals = mixing.goals_of(cells, {m: mixing.shares(cells, m, mixing.TEMPERATURE[m]) for m in mixing.MARGINS}, 0.8)
    raked, worst = mixing.rake(cells, goals, 0.8)
    total = cells.agg(F.sum("tokens")).first()[0]
    assert raked.where("prob >= 1").count() and raked.where("prob <= 0 or prob > 1").count() == 0
    assert raked.agg(F.sum(F.col("prob") * F.col("tokens"))).first()[0] == pytest.approx(0.8 * total, rel=0.01)
    assert worst < 0.01 and mixing.errors(raked, goals).agg(F.max("error")).first()[0] == pytest.approx(worst)
