"""Secret scan: patterns, and a battery of randomness tests, in DataFrame operations only.

Base kinds are patterns (``assign``, ``access``, ``hex``).  The method adds ``random``:
runs of 20 or more characters of ``[A-Za-z0-9+/_=-]`` outside base spans that look
drawn from an encoding.  The encoding (hex, base32 or base64) is inferred from the
characters and gives the alphabet's size k.  Of a run of n characters are measured

* chi-squared against a uniform alphabet: about k - 1 if random, and more by
  ``n * (k * sum f^2 - 1)`` for the letter frequencies f of words;
* runs: changes between capitals, small letters, digits and signs, 64 in 100 of the
  neighbours in random base64 and few in words;
* serial correlation of neighbouring characters, which is near 0 if random.

A run that a test shows not to be random (4 standard deviations) is no secret.  For the
others, the first two give a p-value of the hypothesis "words"; short runs, which tell
less, get larger ones.  The false discovery rate is held at ``FDR`` in each class of
lengths (by powers of two), by the Benjamini-Hochberg rule on a histogram of p-values
over the whole corpus: at most 32 x 81 counts, whatever the input.

Positions are code points, found by splitting the text at the matches.  Null texts
count as empty.  Rows are independent but for the thresholds; ties, repeated rows and
null ids need no rule, an empty table gives an empty one, further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# fixed values: the base patterns of the contract
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"   # runs are taken whole, so 18 characters or more are 14 after the mark
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE = 12

RUN = r"[A-Za-z0-9+/_=-]{20,}"
FDR = 0.01
BINS = 80                       # quarter decades of p-values
WORD_SQUARES = 0.066            # sum of squared letter frequencies of English
WORD_CHANGES = 0.10
RANDOM_CHANGES = {16: 0.47, 32: 0.31, 64: 0.645}

_SPAN = "array<struct<s:int,e:int,t:string>>"


BLOCK = 256                     # spans that are numbered or compared together


def _with(name: str, value: str, body: str) -> str:
    """SQL for ``body`` in which ``name`` is ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _blocks(items: str) -> str:
    """SQL for an array cut into arrays of ``BLOCK``."""
    return f"transform(sequence(0, greatest(0, size({items}) - 1) div {BLOCK}), i -> slice({items}, i * {BLOCK} + 1, {BLOCK}))"


def _matches(text: str, pattern: str) -> str:
    """SQL for the spans (start, end, text) of a pattern's matches.

    Lengths are summed over blocks of matches first, then within each block, so the copies
    that a running sum makes of its array stay short."""
    quoted = "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
    pieces = (f"zip_with(regexp_extract_all({text}, {quoted}, 0), split({text}, {quoted}, -1), "
              "(m, b) -> struct(m as m, b as b))")
    lengths = "transform(k, x -> aggregate(x, 0, (a, y) -> a + length(y.b) + coalesce(length(y.m), 0)))"
    begins = f"aggregate({lengths}, struct(0 as p, cast(array() as array<int>) as o), (a, x) -> struct(a.p + x as p, concat(a.o, array(a.p)) as o)).o"
    step = ("(a, x) -> if(x.m is null, a, struct(a.p + length(x.b) + length(x.m) as p, concat(a.o, array(struct("
            "a.p + length(x.b) as s, a.p + length(x.b) + length(x.m) as e, x.m as t))) as o))")
    spans = f"flatten(zip_with(k, {begins}, (x, p) -> aggregate(x, struct(p as p, cast(array() as {_SPAN}) as o), {step}).o))"
    return f"if({text} rlike {quoted}, {_with('v', pieces, _with('k', _blocks('v'), spans))}, cast(array() as {_SPAN}))"


def _free(runs: str, spans: str) -> str:
    """SQL for the runs that overlap none of the spans; both are ordered and disjoint.  A block
    of runs is compared with the spans between its ends only."""
    near = f"filter({spans}, y -> y.s < element_at(x, -1).e and x[0].s < y.e)"
    kept = _with("near", near, "filter(x, c -> not exists(near, y -> y.s < c.e and c.s < y.e))")
    return f"if(size({runs}) = 0 or size({spans}) = 0, {runs}, flatten(transform({_blocks(runs)}, x -> {kept})))"


def _battery() -> str:
    """SQL from a candidate ``c`` to (s, e, size class, p-value bin or -1)."""
    body = "rtrim('=', c.t)"
    k = "case when b rlike '^([0-9a-f]+|[0-9A-F]+)$' then 16 when b rlike '^[A-Z2-7]+$' then 32 else 64 end"
    kind = "case when x between 'a' and 'z' then 1 when x between 'A' and 'Z' then 2 when x between '0' and '9' then 3 else 4 end"
    chained = [
        ("b", body), ("ch", "filter(split(v.b, ''), x -> x <> '')"),
        ("n", "cast(size(v.ch) as double)"), ("k", k.replace("b rlike", "v.b rlike")),
        ("sq", "aggregate(array_distinct(v.ch), 0D, (a, x) -> a + pow(size(filter(v.ch, y -> y = x)), 2))"),
        ("cl", f"transform(v.ch, x -> {kind})"), ("code", "transform(v.ch, x -> cast(ascii(x) as double))"),
        ("changes", "aggregate(zip_with(v.cl, slice(v.cl, 2, size(v.cl)), (x, y) -> if(y is null or x = y, 0, 1)), 0, (a, x) -> a + x)"),
        ("mean", "aggregate(v.code, 0D, (a, x) -> a + x) / greatest(v.n, 1)"),
        ("var", "aggregate(v.code, 0D, (a, x) -> a + (x - v.mean) * (x - v.mean))"),
        ("lag", "aggregate(zip_with(v.code, slice(v.code, 2, size(v.code)), (x, y) -> if(y is null, 0D, (x - v.mean) * (y - v.mean))), 0D, (a, x) -> a + x)"),
        ("chi", "v.k * v.sq / greatest(v.n, 1) - v.n"),
        ("lambda", f"v.k * {WORD_SQUARES}D - 1"),
        ("p_change", "case v.k " + " ".join(f"when {a} then {b}D" for a, b in RANDOM_CHANGES.items()) + " end"),
    ]
    value = "struct(c.s as s, c.e as e, c.t as t)"
    for name, sql in chained:  # one column of the struct after another
        value = f"element_at(transform(array({value}), {'c' if name == 'b' else 'v'} -> named_struct({_fields(chained, name)}'{name}', {sql})), 1)"
    z = (f"((v.k - 1 + v.n * v.lambda - v.chi) / sqrt(2 * v.k + 4 * v.n * greatest(v.lambda, 0.1D)) + "
         f"(v.changes - (v.n - 1) * {WORD_CHANGES}D) / sqrt((v.n - 1) * {WORD_CHANGES * (1 - WORD_CHANGES)}D)) / sqrt(2D)")
    fits = ("v.n >= 2 and (v.chi - (v.k - 1)) < 4 * sqrt(2 * (v.k - 1)) and abs(v.lag) * sqrt(v.n) <= 4 * greatest(v.var, 1e-9D) "
            "and v.changes > (v.n - 1) * v.p_change - 4 * sqrt((v.n - 1) * v.p_change * (1 - v.p_change))")
    # the normal tail by its logistic approximation
    y = f"(1.5976D * z + 0.070566D * z * z * z)"
    p_bin = f"element_at(transform(array({z}), z -> cast(least({BINS}D, greatest(0D, floor(4 * ln(1 + exp(least(600D, greatest(-600D, {y})))) / ln(10D)))) as int)), 1)"
    return (f"element_at(transform(array({value}), v -> struct(v.s as s, v.e as e, cast(least(31, floor(log2(greatest(v.n, 1)))) as int) as size, "
            f"if({fits}, {p_bin}, -1) as bin)), 1)")


def _fields(chained, until: str) -> str:
    """The struct's earlier fields, copied by name."""
    if until == "b":
        return "'s', c.s, 'e', c.e, "
    names = ["s", "e"]
    for name, _ in chained:
        if name == until:
            break
        names.append(name)
    return "".join(f"'{n}', v.{n}, " for n in names)


def secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_random, base_sha256, spans) of each row."""
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    value = "'" + ASSIGN.replace("\\", "\\\\").replace("'", "\\'") + "'"
    found = (docs.withColumn("assign", F.expr(f"filter({_matches('text', ASSIGN)}, x -> length(regexp_extract(x.t, {value}, 2)) >= {LEAST_VALUE})"))
             .withColumn("access", F.expr(_matches("text", ACCESS)))
             .withColumn("hex", F.expr(_matches("text", HEX)))
             .withColumn("run", F.expr(_matches("text", RUN))).drop("text"))
    spans = lambda kind: f"transform({kind}, x -> struct(x.s as s, {KINDS.index(kind)} as k, x.e as e))"
    base = found.select("id", *(F.size(k).cast("long").alias("n_" + k) for k in KINDS[:3]),
                        F.expr("array_sort(concat(" + ", ".join(map(spans, KINDS[:3])) + "))").alias("base"), "assign", "run")
    # a run is as long as its characters last, so a hexadecimal or access span lies in one run or in none
    hidden = " or ".join(f"c.t rlike '{p}'" for p in (HEX, ACCESS))
    free = base.withColumn("run", F.expr(_free(f"filter(run, c -> not ({hidden}))", "assign")))
    tested = materialize(free.drop("assign").withColumn("run", F.expr(f"transform(run, c -> {_battery()})")))

    bins = tested.select(F.explode("run").alias("c")).select("c.size", "c.bin").where("bin >= 0").groupBy("size", "bin").count()
    # one line a size class and p-value bin
    size = Window.partitionBy("size")
    counted = bins.withColumns({"m": F.sum("count").over(size), "found": F.sum("count").over(size.orderBy(F.desc("bin")))})
    least = counted.where(f"m * pow(10D, -bin / 4D) <= {FDR}D * found").groupBy("size").agg(F.min("bin").alias("least_bin"))
    limits = least.agg(F.map_from_entries(F.collect_list(F.struct("size", "least_bin"))).alias("m"))
    out = tested.withColumn("limit", limits.scalar())
    out = out.withColumn("run", F.expr("filter(run, c -> c.bin >= coalesce(limit[c.size], 1000))"))
    joined = lambda a: f"array_join(transform({a}, x -> concat(element_at(array({', '.join(repr(k) for k in KINDS)}), x.k + 1), ':', x.s, ':', x.e)), ',')"
    return out.select(
        F.col("id").alias(id_col), "n_assign", "n_access", "n_hex", F.size("run").cast("long").alias("n_random"),
        F.sha2(F.expr(joined("base")), 256).alias("base_sha256"),
        F.expr(joined("array_sort(concat(base, transform(run, x -> struct(x.s as s, 3 as k, x.e as e))))")).alias("spans"))
