"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling.

Documents fall into cells (source, language, topic).  Raking multiplies the cells'
weights by goal / current in turn for each margin until all margins hold; a document is
sampled with its cell's weight, at most 1, as probability.  The goals of a margin sum to
``budget`` times all tokens, and cells at 1 stand fixed while the others are raked to the
rest, so the expected tokens meet the margins also where the budget is large.  The draw is a hash of the
document's id and a seed; rows whose id is null or repeated are drawn by a hash of their
text and a stored row number, too, so each is drawn alone.  A task that runs again draws
the same.

Only cell sums are shuffled, counted before the shuffle, so a source of a third of all
rows is one partial sum a task.  Cells stay a distributed table through the iterations;
each margin of a round is stored.  Documents meet their cell by a broadcast join while there are at
most ``BROADCAST_CELLS`` cells, by a shuffled join beyond.

A null margin counts as the empty string.  Null texts count as empty: 0 tokens, kept
with the probability of their cell, which is 1 in a cell without tokens.  A target without
documents is spread over the others; a value without a target keeps its share.  An
empty table gives an empty one.  Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .util import numbered

ROUNDS = 100
TOLERANCE = 1e-3        # relative, of every margin
FASTEST = 1e6           # a weight's largest value and step
BROADCAST_CELLS = 50_000
BROADCAST_IDS = 1_000_000
MARGINS = ("source", "lang", "topic")
TEMPERATURE = {"source": 0.7, "lang": 0.8, "topic": 0.9}  # default targets: shares to this power


def n_words(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), lambda w: w != "")).cast("long")


def form(text: Column, words: Column) -> Column:
    """Topic of a text where none is given: its form."""
    lines = F.size(F.split(F.coalesce(text, F.lit("")), "\n"))
    return (F.when(lines * 12 > words, "list").when(words >= 2000, "book").when(words >= 300, "article").otherwise("note"))


def shares(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Default target of a margin: (value, share), its token shares to a power."""
    sums = cells.groupBy(F.col(margin).alias("value")).agg(F.sum("tokens").alias("t"))
    return sums.select("value", F.pow("t", F.lit(power)).alias("share"))


def goals_of(cells: DataFrame, targets: dict[str, DataFrame], budget: float) -> dict[str, DataFrame]:
    """(value, goal) of each margin: the expected tokens that its target (value, share) asks for.

    No value can give more than all its tokens, so a goal above them is cut to them, and what
    it lacks is asked of the margin's other values, by their shares."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    goals = {}
    for m, target in targets.items():
        # shares over the values that have tokens; a value without a target keeps its tokens' share
        have = cells.where("tokens > 0").groupBy(F.col(m).alias("value")).agg(F.sum("tokens").alias("t")).join(target, "value", "left")
        have = materialize(have.withColumn("share", F.coalesce("share", F.col("t") / total if total else F.lit(0.0))))
        scale, before = 0.0, -1.0
        while scale > before:  # it grows with each value that is cut, and ends when none is
            cut = F.col("share") * scale >= F.col("t")
            r = have.agg(F.sum(F.when(cut, F.col("t")).otherwise(0)).alias("whole"), F.sum(F.when(cut, 0.0).otherwise(F.col("share"))).alias("open")).first()
            before, scale = scale, max(scale, (budget * total - (r["whole"] or 0)) / r["open"] if r["open"] else scale)
        goals[m] = materialize(have.select(F.col("value").alias(m), F.least(F.col("share") * scale, F.col("t").cast("double")).alias("goal")))
    return goals


def rake(cells: DataFrame, goals: dict[str, DataFrame], budget: float, rounds: int = ROUNDS) -> tuple[DataFrame, float]:
    """``cells`` (margins and tokens) with ``prob``, so that the expected tokens meet each
    margin's goals, and the largest relative error that is left.

    A probability is the least of 1 and the cell's weight.  In each round and margin, cells at
    1 stand fixed, and the weights of a value's cells are raked to what its goal leaves for the
    others; so what cells at 1 cannot take goes to other cells of the same margin.  It ends
    when no margin is off by ``TOLERANCE``, or no longer moves; margins that contradict each
    other leave an error, which is returned."""
    state, before = materialize(cells.withColumn("weight", F.lit(float(budget)))), None
    prob = F.least(F.lit(1.0), F.col("weight"))
    while True:
        for m, goal in goals.items():
            inner = F.col("weight") < 1
            sums = state.groupBy(m).agg(F.sum(F.when(inner, F.col("weight") * F.col("tokens")).otherwise(0.0)).alias("free"),
                                        F.sum(F.when(inner, 0).otherwise(F.col("tokens"))).alias("fixed"))
            rest = F.col("goal") - F.col("fixed")
            factor = (F.when((rest > 0) & (F.col("free") > 0), rest / F.col("free"))
                      .when(F.col("goal") < F.col("fixed") + F.col("free"), F.col("goal") / (F.col("fixed") + F.col("free"))).otherwise(1.0))
            factors = sums.join(goal, m).select(m, F.least(factor, F.lit(FASTEST)).alias("f"))
            state = state.join(factors, m, "left").withColumn("weight", F.least(F.col("weight") * F.coalesce("f", F.lit(1.0)), F.lit(FASTEST))).drop("f")
            state = materialize(state)  # a margin reads the state twice, so unstored margins would double the plan
        left = errors(state.withColumn("prob", prob), goals)
        worst = left.agg(F.max("error")).first()[0] or 0.0
        rounds -= 1
        if worst < TOLERANCE or not rounds or (before is not None and abs(before - worst) < TOLERANCE / 100):
            return state.withColumn("prob", F.when(F.col("tokens") > 0, prob).otherwise(1.0)).drop("weight"), worst
        before = worst


def errors(cells: DataFrame, goals: dict[str, DataFrame]) -> DataFrame:
    """(margin, value, goal, expected, error): what the probabilities of ``cells`` make of each goal."""
    out = None
    for m, goal in goals.items():
        now = cells.groupBy(m).agg(F.sum(F.col("prob") * F.col("tokens")).alias("expected")).join(goal, m)
        now = now.select(F.lit(m).alias("margin"), F.col(m).alias("value"), "goal", "expected",
                         F.when(F.col("goal") > 0, F.abs(F.col("expected") / F.col("goal") - 1)).otherwise(0.0).alias("error"))
        out = now if out is None else out.unionByName(now)
    return out


def cells_of(docs: DataFrame) -> DataFrame:
    return docs.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))


def with_margins(df: DataFrame, text_col: str = "text", topic: Column | None = None) -> DataFrame:
    """``df`` with _source, _lang, _topic and _tokens."""
    words = n_words(F.col(text_col))
    return df.withColumns({
        "_source": F.coalesce(F.col("source").cast("string"), F.lit("")), "_lang": F.coalesce(F.col("lang").cast("string"), F.lit("")),
        "_tokens": words}).withColumn("_topic", F.coalesce(topic, F.lit("")) if topic is not None else form(F.col(text_col), F.col("_tokens")))


def mix(df: DataFrame, budget: float, targets: dict[str, DataFrame] | None = None, seed: int = 17,
        id_col: str = "doc_id", text_col: str = "text", topic: Column | None = None) -> DataFrame:
    """(id, source, lang, topic, n_tokens, prob, kept) of each row."""
    slim = with_margins(df, text_col, topic).select(
        F.col(id_col).alias("id"), F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"), F.xxhash64(text_col).alias("hash"))
    slim, number = numbered(slim)
    slim = uniform(slim, "id", F.col("hash"), F.col(number), seed)
    return draw(slim, calibrate(slim, budget, targets)).withColumnRenamed("id", id_col)


def calibrate(slim: DataFrame, budget: float, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """(margins, prob) of each cell."""
    cells = materialize(cells_of(slim))
    targets = {m: shares(cells, m, TEMPERATURE[m]) for m in MARGINS} | (targets or {})
    raked, _ = rake(cells, goals_of(cells, targets, budget), budget)
    return materialize(raked.select(*MARGINS, "prob"))


def uniform(df: DataFrame, id_col: str, hash_: Column, number: Column, seed: int) -> DataFrame:
    """``df`` with ``_u``, the draw of each row."""
    unit = lambda *key: F.xxhash64(*key, F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)
    own, shared = unit(id_col), F.col(id_col).isNull()
    repeated = materialize(repeated_ids(df, id_col))
    n = repeated.count()
    if n:
        df = df.join(F.broadcast(repeated) if n <= BROADCAST_IDS else repeated, df[id_col] == repeated["_repeated"], "left")
        shared = shared | F.col("_repeated").isNotNull()
    return df.withColumn("_u", F.when(shared, unit(id_col, hash_, number)).otherwise(own)).drop("_repeated")


def repeated_ids(df: DataFrame, id_col: str) -> DataFrame:
    ids = df.select(F.col(id_col).alias("_repeated")).where("_repeated is not null")
    return ids.groupBy("_repeated").count().where("count > 1").select("_repeated")


def draw(slim: DataFrame, cells: DataFrame) -> DataFrame:
    small = cells.count() <= BROADCAST_CELLS
    out = slim.join(F.broadcast(cells) if small else cells, list(MARGINS))
    return out.select("id", *MARGINS, "n_tokens", "prob", (F.col("_u") < F.col("prob")).alias("kept"))


def keep_mixed(df: DataFrame, budget: float, seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sampled rows, with all their columns."""
    names = {"_source": "source", "_lang": "lang", "_topic": "topic"}
    rows, number = numbered(df)
    marked = with_margins(rows, text_col)
    slim = marked.select(*[F.col(a).alias(b) for a, b in names.items()], F.col("_tokens").alias("n_tokens"))
    cells = calibrate(materialize(slim), budget)
    small = cells.count() <= BROADCAST_CELLS
    cells = cells.select(*[F.col(b).alias(a) for a, b in names.items()], F.col("prob").alias("_prob"))
    marked = uniform(marked, id_col, F.xxhash64(text_col), F.col(number), seed)
    return marked.join(F.broadcast(cells) if small else cells, list(names)).where("_u < _prob").select(*df.columns)
