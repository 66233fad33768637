"""Queries of this package: thin calls of the operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, exact_dedup, merkle, mixing, near_dup, packing, pu_quality, quality, secret_scan, token_counts, toxicity, url_filter, warc
from .util import read

QUERIES = {}
ORACLE_SQL = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return keep


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


TOKEN_LIMIT = 4096


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), TOKEN_LIMIT)


_COVER_SQL = ",\n".join(f"""c{n} AS (
  SELECT doc_id, CAST(sum(length(w)) AS BIGINT) AS cover_{n} FROM (
    SELECT doc_id, w, max(CASE WHEN again THEN i END) OVER (
      PARTITION BY doc_id ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS hit
    FROM (SELECT doc_id, w, i, i <= n_words - {n - 1} AND row_number() OVER (
            PARTITION BY doc_id, i <= n_words - {n - 1}, array_to_string(list_slice(ws, i, i + {n - 1}), ' ') ORDER BY i) > 1 AS again
          FROM pos)) WHERE hit IS NOT NULL GROUP BY doc_id)""" for n in quality.COVERAGE)

QUALITY_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
b AS (SELECT doc_id, ws, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols FROM d),
pos AS (SELECT doc_id, ws, n_words, i, ws[i] AS w FROM (SELECT *, unnest(range(1, n_words + 1)) AS i FROM b)),
r AS (SELECT doc_id, count(*) AS n_repeat_words FROM (
    SELECT doc_id, i, max(CASE WHEN twice THEN i END) OVER (
      PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS hit
    FROM (SELECT doc_id, i, i <= n_words - 2 AND count(*) OVER (
            PARTITION BY doc_id, i <= n_words - 2, array_to_string(list_slice(ws, i, i + 2), ' ')) > 1 AS twice FROM pos))
  WHERE hit IS NOT NULL GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_dup_lines, CAST(sum(n) AS BIGINT) AS dup_line_chars FROM (
    SELECT doc_id, n, row_number() OVER (PARTITION BY doc_id, line) AS k FROM (
      SELECT doc_id, line, length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS n
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)) WHERE n > 0)
  WHERE k > 1 GROUP BY doc_id),
{_COVER_SQL},
m AS (SELECT b.doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(dup_line_chars, 0) AS dup_line_chars,
    {", ".join(f"coalesce(cover_{n}, 0) AS cover_{n}" for n in quality.COVERAGE)}
  FROM b LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)
  {" ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in quality.COVERAGE)})
SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {round(100 * quality.MAX_REPEAT)} * n_words AS base_failed,
  NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {round(100 * quality.MAX_REPEAT)} * n_words
    OR dup_line_chars > CAST({quality.MAX_LINES} AS DOUBLE) * word_chars OR n_symbols > CAST({quality.MAX_SYMBOLS} AS DOUBLE) * word_chars
    OR {" OR ".join(f"cover_{n} > CAST({share} AS DOUBLE) * word_chars" for n, share in quality.COVERAGE.items())}) AS kept
FROM m"""


@query("op2_quality_rules", QUALITY_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"))


# fixed values: the list of the query's contract
ALLOW_KEYS = ["org/", "com/fr/"]
BLOCK_KEYS = ["example.org/es/", "example.org/en/1", "com/de/"]
# host labels of sites that a language model's corpus leaves out
BLOCK_TERMS = r"(^|[.-])(adult|xxx|porn|casino|bets|pills|spam|ads)([.-])"

_FITS = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}') THEN '{h}/{p}'"
    for h, p in (k.split("/", 1) for k in sorted(ALLOW_KEYS + BLOCK_KEYS, key=len, reverse=True)))

URL_SQL = f"""
WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM a),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT *, CASE {_FITS} END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ({", ".join(f"'{k}'" for k in BLOCK_KEYS)}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN regexp_matches(host, '{BLOCK_TERMS}') AND path <> '' THEN 'block' ELSE 'allow' END AS verdict FROM r"""


@query("op3_url_filter", URL_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    keys = lambda values: spark.createDataFrame([(k,) for k in values], "key string")
    # the list that grows with the corpus: its hosts with a blocked label
    hosts = (url_filter.with_parts(pages, "url").where(F.col("host").rlike(BLOCK_TERMS))
             .select(F.concat("host", F.lit("/")).alias("key")).distinct())
    out = url_filter.judge(pages, keys(ALLOW_KEYS), keys(BLOCK_KEYS), hosts)
    return out.select("page_id", "host", "path", "rule", "verdict")


@query("op4_near_duplicates")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read(spark, sf_dir, "documents"))


EXACT_SQL = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
    sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256 FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g"""


@query("op5_exact_dedup", EXACT_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"), hash_all=True)


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query("op8_secrets")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(read(spark, sf_dir, "documents"))


@query("op7_warc_derivatives")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.derive(warc.responses(read(spark, sf_dir, "pages")))
    return out.select("page_id", "kind", "record_id", "refers_to", "target_uri", "date", "content_type", "block_digest", "source_digest",
                      F.length("block").cast("long").alias("block_bytes"), F.sha2("record", 256).alias("record_sha256"))


MIX_BUDGET = 0.8        # of all tokens


@query("op9_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), MIX_BUDGET)


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    wide = "CAST({} AS UBIGINT)".format
    byte = f"list_transform(range(1, length({text}) + 1), lambda i: {wide(f'ascii(({text})[i])')})"
    bits = f"list_transform(range(8), lambda z: {wide('z')})"
    step = f"CASE WHEN x % 2 = 1 THEN xor(x // 2, {wide(0xEDB88320)}) ELSE x // 2 END"
    return (f"xor(list_reduce(list_prepend({wide(0xFFFFFFFF)}, {byte}), lambda a, b: list_reduce(list_prepend(xor(a, b), {bits}), "
            f"lambda x, z: {step})), {wide(0xFFFFFFFF)})")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LEVELS = 8  # of the SQL twin: groups of at most 8 ** 8 rows


def _tree_sql(name: str) -> str:
    """Levels of the tree above ``{name}0`` (g, i, n, h); level k has the children ``c`` of each node."""
    return ",\n".join(f"""{name}{k} AS (SELECT g, i // 8 AS i, (n + 7) // 8 AS n, n > 1 AS inner_node, list(h ORDER BY i) AS c,
    CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h FROM {name}{k - 1} GROUP BY g, i // 8, n)""" for k in range(1, _LEVELS + 1))


def _fold_sql(name: str, tree: str) -> str:
    """Folds of ``{name}0`` (g, i, h, proof) up the tree."""
    left, right = "array_to_string(list_slice(c, 1, f.i % 8), '')", "array_to_string(list_slice(c, f.i % 8 + 2, len(c)), '')"
    left, right = f"coalesce({left}, '')", f"coalesce({right}, '')"
    return ",\n".join(f"""{name}{k} AS (SELECT f.* REPLACE (f.i // 8 AS i, CASE WHEN inner_node THEN sha256({left} || f.h || {right}) ELSE f.h END AS h,
    CASE WHEN inner_node THEN proof || {left} || {right} ELSE proof END AS proof)
  FROM {name}{k - 1} f JOIN {tree}{k} p ON p.g = f.g AND p.i = f.i // 8)""" for k in range(1, _LEVELS + 1))


def _leaf_sql(text: str) -> str:
    part = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    return "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


MERKLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf_sql("text")} AS leaf,
    CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf_sql("text")} END AS changed FROM documents),
l0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n, leaf AS h FROM d),
{_tree_sql("l")},
u0 AS (SELECT '' AS g, g AS name, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n, h FROM l{_LEVELS}),
{_tree_sql("u")},
f0 AS (SELECT doc_id, leaf, g, i, changed AS h, '' AS proof FROM l0),
{_fold_sql("f", "l")},
t0 AS (SELECT doc_id, leaf, '' AS g, u0.i, f.h, proof, u0.h AS subroot FROM f{_LEVELS} f JOIN u0 ON u0.name = f.g),
{_fold_sql("t", "u")}
SELECT doc_id, leaf, subroot, u.h AS root, sha256(proof) AS proof_sha256, t.h AS folded_root, t.h = u.h AS verified FROM t{_LEVELS} t, u{_LEVELS} u"""


@query("op11_merkle_manifest", MERKLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the contract's tampering: every third document by its id's CRC, its text in lower case
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle.manifest(read(spark, sf_dir, "documents"), marked=third)


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage to conversations: one in five rows, by the CRC of its id and turn."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), (kind != 0).alias("live"),
                       F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again")).drop("again")


def _cheapest(*options: tuple[str, int | str, str, str]) -> str:
    """The least of options (state, price, edits, message) by cost, then audit, as a struct (c, s, r)."""
    add = lambda state, message: f"{state}.r || CASE WHEN {state}.r = '' THEN '' ELSE chr(10) END || {message}" if message else f"{state}.r"
    return "list_min([" + ", ".join(f"struct_pack(c := {state}.c + {price}, s := {state}.s || '{edits}', r := {add(state, message)})"
                                    for state, price, edits, message in options) + "])"


_FAR = 1 << 40  # cost of a state that is not reached
_KEEPS = lambda initial: f"CASE WHEN ini = '{initial}' THEN 0 ELSE {_FAR} END + stay"
_OWN, _ASKS, _TELLS = "role || ':' || text", "'user:'", "'assistant:'"

REPAIR_SQL = f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS id FROM conversations),
x AS (SELECT *, {crc32_sql("id")} % 20 AS f FROM k),
d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE f WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) FROM x),
o AS (SELECT *, coalesce('=' || conv_id, '') AS g, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
    regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS ending, substr(role, 1, 1) AS ini FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) AS nth, lag(ini) OVER (PARTITION BY g ORDER BY i) AS prior FROM o),
m AS (SELECT *, ending = '' AS blank, ending <> '' AND nth > 1 AS duplicate, ending <> '' AND nth = 1 AND ending NOT IN ('.', '!', '?') AS truncated FROM p),
q AS (SELECT *, CASE WHEN blank OR duplicate THEN {_FAR} WHEN truncated THEN 3 ELSE 0 END AS stay FROM m),
c AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate,
    count_if(truncated) AS truncated, count_if(prior IS NOT NULL AND prior || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM q GROUP BY g),
e AS (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS g FROM conversations),
z AS (SELECT g, CAST(0 AS BIGINT) AS i, struct_pack(c := CAST(0 AS BIGINT), s := '', r := '') AS a0, struct_pack(c := CAST({_FAR} AS BIGINT), s := '', r := '') AS a1,
    struct_pack(c := CAST({_FAR} AS BIGINT), s := '', r := '') AS a2, struct_pack(c := CAST({_FAR} AS BIGINT), s := '', r := '') AS a3 FROM e
  UNION ALL
  SELECT g, i,
    {_cheapest(("a0", 4, "D", ""))} AS a0,
    {_cheapest(("a1", 4, "D", ""), ("a0", _KEEPS("s"), "K", _OWN))} AS a1,
    {_cheapest(("b2", 4, "D", ""), *[x for b in ("a0", "a1", "b3") for x in ((b, _KEEPS("u"), "K", _OWN), (b, "3 + stay", "R", "'user:' || text"))])} AS a2,
    {_cheapest(("b3", 4, "D", ""), ("b2", _KEEPS("a"), "K", _OWN), ("b2", "3 + stay", "R", "'assistant:' || text"))} AS a3
  FROM (SELECT * REPLACE ({_cheapest(("b2", 0, "", ""), ("a3", 3, "I", _ASKS))} AS b2), {_cheapest(("a3", 0, "", ""), ("b2", 3, "I", _TELLS))} AS b3
    FROM (SELECT z.g, q.i, role, text, ini, stay, a0, a1, a3, {_cheapest(("a2", 0, "", ""), ("a0", 3, "I", _ASKS), ("a1", 3, "I", _ASKS))} AS b2
      FROM z JOIN q ON q.g = z.g AND q.i = z.i + 1))),
f AS (SELECT z.g, list_min([a0, a3, {_cheapest(("a2", 3, "I", _TELLS))}, struct_pack(c := a1.c + 6, s := a1.s || 'II',
    r := a1.r || CASE WHEN a1.r = '' THEN '' ELSE chr(10) END || 'user:' || chr(10) || 'assistant:')]) AS best FROM z LEFT JOIN c ON c.g = z.g WHERE i = coalesce(n, 0))
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, best.c AS cost, best.s AS audit, sha256(best.r) AS repaired_sha256
FROM e JOIN f ON f.g = e.g LEFT JOIN c ON c.g = e.g"""


@query("op12_conversation_repair", REPAIR_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(damaged(read(spark, sf_dir, "conversations")), live=F.col("live"))


@query("op13_quality_classifier")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
