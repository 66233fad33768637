"""Repair of damaged conversations at least cost, by Hirschberg's divide and conquer.

A conversation's rows, by turn, may be kept, given another role, deleted, or completed by
empty messages, so that their role initials read ``(s?(ua)+)?``.  That pattern has four
states (``START``, after s, after u, after a), and from each state an inserted message or a
new role has one choice, so a row is a table of the cheapest edits between states
(``MOVES``).  A blank row and a repeated one must be deleted; a truncated row that stays
costs more.

``crossings`` finds the states between the rows in linear space: a forward vector of four
costs, each with the rank of its audit, meets a backward vector of four costs in the
middle; the cheapest crossing is taken, the audit-least of several, and both halves
are solved in the same way.  An audit up to a row ends with that row's own edit, so none
begins another, and the order of ranks is that of whole audits.

1. Rows are range-partitioned by conversation and turn, so a conversation of any size is
   cut between tasks.  Each task reads its rows in order.  A conversation that lies between
   two others in a task is whole and is solved there (at most ``BLOCK_ROWS`` rows and
   ``BLOCK_BYTES``).  The first and last of a task, and larger ones, leave it as blocks.
2. Blocks find the rows whose role and text came in an earlier block by their digests,
   one for each block and digest.
3. Each block becomes one table of four times four costs and ranks, which is a move like
   that of a row; ``crossings`` over a conversation's blocks gives each its end states, and
   each block is then solved alone.
4. The hash of a repaired conversation is one chain, so its blocks stream through one task
   in order, a block at a time in memory; only the audit, a letter an edit, is gathered.

Null roles and texts count as one space, which no state accepts as a role; an empty role
fits none either.  Null turns come first and count for no gap.  Rows of one turn are ordered
by role, then by the MD5 of their text; equal rows are one first and its repeats.  A null
conversation id is a conversation.  A conversation all of whose rows are marked as lost has
zeros, an empty audit and the hash of nothing; an empty table gives an empty one.  Texts of
any length stay whole.  Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .util import few

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK_ROWS = 4096
BLOCK_BYTES = 4 << 20
SHORT = 24                  # rows of conversations whose solution is remembered
REMEMBERED = 1 << 16

START, S, U, A = range(4)
ONWARD = {START: U, S: U, U: A, A: U}                       # of an inserted or changed message
ROLE = {U: "user", A: "assistant"}
ACCEPTS = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
CLOSING = {START: "", S: "II", U: "I", A: ""}               # what a conversation's end inserts
INITIALS = "sua"                                            # any other is the fourth
SOUND, GONE, CUT = range(3)                                 # faults of a row: none, to be deleted, truncated
WHITE = " \t\n\v\f\r"
LEGAL = {"su", "ua", "au"}


def _moves(initial: str, fault: int) -> dict[int, dict[int, tuple[int, str]]]:
    """state -> {state after the row: (cost, edits)}, the least edits of the least cost."""
    out = {}
    for start in range(4):
        best: dict[int, tuple[int, str]] = {}
        state, cost, edits = start, 0, ""
        for _ in range(3):  # a third insertion comes back to the state after the first
            more = TRUNCATED * (fault == CUT)
            options = [(state, DELETE, "D")]
            if fault != GONE:
                options.append((ONWARD[state], REROLE + more, "R"))
                if (state, initial) in ACCEPTS:
                    options.append((ACCEPTS[state, initial], KEEP + more, "K"))
            for after, price, edit in options:
                best[after] = min(best.get(after, (1 << 30, "")), (cost + price, edits + edit))
            state, cost, edits = ONWARD[state], cost + INSERT, edits + "I"
        out[start] = best
    return out


MOVES = [_moves(initial, fault) for initial in (*INITIALS, "") for fault in range(3)]


def forward(moves: Sequence[dict], start: int) -> tuple[dict[int, int], dict[int, int]]:
    """Least cost of each state after the moves, and the rank of its least audit."""
    cost, rank = {start: 0}, {start: 0}
    for move in moves:
        best: dict[int, tuple] = {}
        for state, so_far in cost.items():
            for after, (price, edits) in move[state].items():
                found = (so_far + price, rank[state], edits)
                if after not in best or found < best[after]:
                    best[after] = found
        cost = {state: found[0] for state, found in best.items()}
        rank = {state: i for i, state in enumerate(sorted(best, key=lambda state: best[state][1:]))}
    return cost, rank


def backward(moves: Sequence[dict], end: int | None) -> dict[int, int]:
    """Least cost from each state to ``end``, or with None to a closed conversation."""
    cost = {state: INSERT * len(edits) for state, edits in CLOSING.items()} if end is None else {end: 0}
    for move in reversed(moves):
        cost = {state: min(options) for state in move
                if (options := [price + cost[after] for after, (price, _) in move[state].items() if after in cost])}
    return cost


def meet(moves: Sequence[dict], start: int, middle: int, end: int | None) -> int:
    """The state at ``middle`` of the audit-least cheapest way from ``start`` to ``end``."""
    cost, rank = forward(moves[:middle], start)
    rest = backward(moves[middle:], end)
    return min((state for state in cost if state in rest), key=lambda state: (cost[state] + rest[state], rank[state]))


def crossings(moves: Sequence[dict], start: int = START, end: int | None = None) -> list[int]:
    """States before, between and after the moves."""
    n = len(moves)
    states = [start] * (n + 1)
    states[n] = meet(moves, start, n, None) if end is None else end
    todo = [(0, n)]
    while todo:
        lo, hi = todo.pop()
        if hi - lo > 1:
            middle = (lo + hi) // 2
            states[middle] = meet(moves[lo:hi], states[lo], middle - lo, states[hi])
            todo += [(lo, middle), (middle, hi)]
    return states


def solve(kinds: bytes, start: int = START, end: int | None = None) -> tuple[int, list[str]]:
    """Cost and edits of each row; the last entry closes the conversation."""
    moves = [MOVES[kind] for kind in kinds]
    states = crossings(moves, start, end)
    chosen = [move[a][b] for move, a, b in zip(moves, states, states[1:])]
    closing = CLOSING[states[-1]] if end is None else ""
    return sum(price for price, _ in chosen) + INSERT * len(closing), [edits for _, edits in chosen] + [closing]


remembered = lru_cache(REMEMBERED)(solve)


def messages(rows: Sequence[tuple], edits: Sequence[str], start: int = START) -> list[tuple[str, str]]:
    """Role and text of the repaired rows (role, text)."""
    state, out = start, []
    for (role, text), row_edits in zip([*rows, ("", "")], edits):
        for edit in row_edits:
            if edit in "IR":
                state = ONWARD[state]
                out.append((ROLE[state], "" if edit == "I" else text))
            elif edit == "K":
                state = ACCEPTS[state, role[:1]]
                out.append((role, text))
    return out


def faults(rows: Sequence[tuple], late: Sequence[int] = ()) -> tuple[bytes, list[int]]:
    """A kind for each row (role, text), and the counts of blank, repeated and truncated rows.
    ``late`` lists rows that repeat one of an earlier block."""
    seen, late, kinds, count = set(), set(late), bytearray(), [0, 0, 0]
    for i, (role, text) in enumerate(rows):
        body = text.rstrip(WHITE)
        fault = SOUND
        if not body:
            fault, count[0] = GONE, count[0] + 1
        elif (role, text) in seen or i in late:
            fault, count[1] = GONE, count[1] + 1
        elif body[-1] not in ".!?":
            fault, count[2] = CUT, count[2] + 1
        seen.add((role, text))
        initial = INITIALS.find(role[0]) if role else -1
        kinds.append(3 * (initial if initial >= 0 else 3) + fault)
    return bytes(kinds), count


def illegal(initials: Sequence[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def gaps(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else high - low + 1 - distinct


def lines(found: Sequence[tuple[str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for role, text in found).encode()


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_RESULT = ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
_ROWS = pa.list_(pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]))
_MESSAGES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], list(types))


def _turns(rows: Sequence[tuple]) -> tuple[int | None, int | None, int]:
    """Least, largest and number of turns of ordered rows."""
    turns = [r[0] for r in rows if r[0] is not None]
    return (turns[0], turns[-1], 1 + sum(a != b for a, b in zip(turns, turns[1:]))) if turns else (None, None, 0)


def whole(rows: Sequence[tuple]) -> tuple[tuple, list[tuple[str, str]]]:
    """Result columns and messages of a conversation's rows (turn, role, text)."""
    pairs = [r[1:] for r in rows]
    kinds, count = faults(pairs)
    cost, edits = (remembered if len(kinds) <= SHORT else solve)(kinds)
    found = messages(pairs, edits)
    return (gaps(*_turns(rows)), *count, illegal([p[0][:1] for p in pairs]), cost, "".join(edits), sha256(lines(found)).hexdigest()), found


def _cut(sorted_rows: DataFrame, with_messages: bool, block_rows: int, block_bytes: int) -> DataFrame:
    """Results of the conversations that are whole in a task; blocks of the others."""
    kind = sorted_rows.schema["conv"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    types = {"g": pa.string(), "conv": to_arrow_type(kind), "part": pa.int64(), "no": pa.int64(), "rows": _ROWS,
             **{c: pa.int64() for c in _COUNTS}, "audit": pa.string(), "repaired_sha256": pa.string(), "messages": _MESSAGES}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, out = TaskContext.get().partitionId(), 0, []
        g, conv, own, size, edge = None, None, [], 0, True  # the first conversation may begin in another task

        def block() -> tuple:
            rows = [dict(zip(("turn", "role", "text"), r)) for r in own]
            return (g, conv, part, no, rows, *[None] * (len(types) - 5))

        for batch in batches:
            for g2, conv2, turn, role, text, live in zip(*(c.to_pylist() for c in batch.columns)):
                full = len(own) >= block_rows or size >= block_bytes
                if g is not None and (g2 != g or full):
                    if g2 == g or edge:
                        out.append(block())
                        edge = g2 == g
                    else:
                        result, found = whole(own)
                        out.append((g, conv, part, no, None, *result, [dict(zip(("role", "text"), m)) for m in found] if with_messages else None))
                    no, own, size = no + 1, [], 0
                g, conv = g2, conv2
                if live:
                    own.append((turn, role, text))
                    size += len(text)
            yield _batch(out, types)
            out = []
        if g is not None:
            yield _batch([block()], types)

    schema = (f"g string, conv {kind.simpleString()}, part long, no long, rows array<struct<turn: long, role: string, text: string>>, "
              f"{_RESULT}, messages array<struct<role: string, text: string>>")
    return sorted_rows.mapInArrow(run, schema)


def _late(blocks: DataFrame) -> DataFrame:
    """(part, no, late): rows of a block whose role and text an earlier block of the conversation has."""
    rows = blocks.select("g", "part", "no", F.posexplode("rows").alias("at", "row"))
    digest = F.sha2(F.concat(F.octet_length("row.role").cast("string"), F.lit(":"), "row.role", "row.text"), 256)
    first = rows.groupBy("g", digest.alias("digest"), "part", "no").agg(F.min("at").alias("at"))
    first = materialize(first)
    shared = first.groupBy("g", "digest").agg(F.min(F.struct("part", "no")).alias("first"), F.count("*").alias("n")).where("n > 1")
    late = first.join(shared, ["g", "digest"]).where(F.struct("part", "no") > F.col("first"))
    return late.groupBy("part", "no").agg(F.collect_list("at").alias("late"))


_TABLE = "cost array<int>, rank array<int>"


def _summaries(blocks: DataFrame) -> DataFrame:
    """A move for each block, and what its conversation's counts need."""
    types = {"g": pa.string(), "part": pa.int64(), "no": pa.int64(), "cost": pa.list_(pa.int32()), "rank": pa.list_(pa.int32()),
             "count": pa.list_(pa.int64()), "low": pa.int64(), "high": pa.int64(), "distinct": pa.int64(), "ends": pa.list_(pa.string())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.select(["g", "part", "no", "rows", "late"]).to_pylist():
                rows = [(r["turn"], r["role"], r["text"]) for r in row["rows"]]
                pairs = [r[1:] for r in rows]
                kinds, count = faults(pairs, row["late"] or ())
                cost, rank = [], []
                for start in range(4):  # -1: the block leads to no such state
                    prices, ranks = forward([MOVES[k] for k in kinds], start)
                    cost += [prices.get(after, -1) for after in range(4)]
                    rank += [ranks.get(after, -1) for after in range(4)]
                initials = [p[0][:1] for p in pairs]
                out.append((row["g"], row["part"], row["no"], cost, rank, [*count, illegal(initials)], *_turns(rows), [*initials[:1], *initials[-1:]]))
            yield _batch(out, types)

    schema = f"g string, part long, no long, {_TABLE}, count array<long>, low long, high long, distinct long, ends array<string>"
    return blocks.select("g", "part", "no", "rows", "late").mapInArrow(run, schema)


def _join_blocks(summaries: DataFrame) -> DataFrame:
    """(part, no, start, end, last, counts) of each block; one row a block, so a conversation's
    rows here are its rows divided by those of a block."""
    def run(table: pa.Table) -> pa.Table:
        blocks = table.sort_by([("part", "ascending"), ("no", "ascending")]).to_pylist()
        moves = [{start: {after: (b["cost"][4 * start + after], b["rank"][4 * start + after]) for after in range(4) if b["cost"][4 * start + after] >= 0}
                  for start in range(4)} for b in blocks]
        states = crossings(moves)
        total = sum(m[a][b][0] for m, a, b in zip(moves, states, states[1:])) + INSERT * len(CLOSING[states[-1]])
        counts = [sum(b["count"][i] for b in blocks) for i in range(4)]
        ends = [b["ends"] for b in blocks if b["ends"]]
        counts[3] += sum(a[-1] + b[0] not in LEGAL for a, b in zip(ends, ends[1:]))
        timed = [b for b in blocks if b["low"] is not None]
        distinct = sum(b["distinct"] for b in timed) - sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
        gap = gaps(timed[0]["low"], timed[-1]["high"], distinct) if timed else 0
        n = len(blocks)
        return pa.Table.from_arrays([pa.array([b["part"] for b in blocks], pa.int64()), pa.array([b["no"] for b in blocks], pa.int64()),
                                     pa.array(states[:-1], pa.int32()), pa.array(states[1:], pa.int32()), pa.array([i == n - 1 for i in range(n)]),
                                     pa.array([[gap, *counts, total]] * n, pa.list_(pa.int64()))], names=["part", "no", "start", "end", "last", "counts"])

    return summaries.groupBy("g").applyInArrow(run, "part long, no long, start int, end int, last boolean, counts array<long>")


def _solve_blocks(blocks: DataFrame, with_messages: bool) -> DataFrame:
    """(g, conv, part, no, counts, audit, bytes, messages): each block repaired between its states."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = blocks.schema["conv"].dataType
    types = {"g": pa.string(), "conv": to_arrow_type(kind), "part": pa.int64(), "no": pa.int64(), "counts": pa.list_(pa.int64()), "audit": pa.string(),
             "bytes": pa.binary(), "messages": _MESSAGES}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                pairs = [(r["role"], r["text"]) for r in row["rows"]]
                kinds, _ = faults(pairs, row["late"] or ())
                _, edits = solve(kinds, row["start"], row["end"])
                if row["last"]:
                    edits[-1] += CLOSING[row["end"]]
                found = messages(pairs, edits, row["start"])
                out.append((row["g"], row["conv"], row["part"], row["no"], row["counts"], "".join(edits), lines(found) if found else None,
                            [dict(zip(("role", "text"), m)) for m in found] if with_messages else None))
            yield _batch(out, types)

    return blocks.select("g", "conv", "part", "no", "rows", "late", "start", "end", "last", "counts").mapInArrow(
        run, f"g string, conv {kind.simpleString()}, part long, no long, counts array<long>, audit string, bytes binary, "
             "messages array<struct<role: string, text: string>>")


def _chain(solved: DataFrame) -> DataFrame:
    """One result for each conversation from its blocks, which stream in order."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = solved.schema["conv"].dataType
    types = {"conv": to_arrow_type(kind), **{c: pa.int64() for c in _COUNTS}, "audit": pa.string(), "repaired_sha256": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv, counts, state, audit, begun, out = None, None, None, sha256(), [], False, []
        for batch in batches:
            for g, conv2, counts2, edits, data in zip(*(c.to_pylist() for c in batch.columns)):
                if g != now:
                    if now is not None:
                        out.append((conv, *counts, "".join(audit), state.hexdigest()))
                    now, conv, counts, state, audit, begun = g, conv2, counts2, sha256(), [], False
                audit.append(edits)
                if data is not None:
                    state.update(b"\n" * begun + data)
                    begun = True
            yield _batch(out, types)
            out = []
        if now is not None:
            yield _batch([(conv, *counts, "".join(audit), state.hexdigest())], types)

    dealt = solved.repartition("g").sortWithinPartitions("g", "part", "no").select("g", "conv", "counts", "audit", "bytes")
    return dealt.mapInArrow(run, f"conv {kind.simpleString()}, {_RESULT}")


def _solved(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, live: Column | None, with_messages: bool,
            block_rows: int, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Whole conversations, and blocks of the others, both repaired."""
    slim = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
                     F.coalesce(F.col(text_col), F.lit(" ")).alias("text"), (live if live is not None else F.lit(True)).alias("live"))
    key = F.when(F.col("conv").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv").cast("string")))
    slim = slim.withColumn("g", key).withColumn("order", F.md5("text")).withColumn("tie", F.monotonically_increasing_id())
    order = ["g", "turn", "role", "order", "tie"]
    dealt = slim.repartitionByRange(*order).sortWithinPartitions(*order).select("g", "conv", "turn", "role", "text", "live")
    cut = materialize(_cut(dealt, with_messages, block_rows, block_bytes))
    blocks = cut.where("rows is not null").select("g", "conv", "part", "no", "rows")
    blocks = materialize(blocks.join(few(materialize(_late(blocks))), ["part", "no"], "left"))
    states = materialize(_join_blocks(_summaries(blocks)))
    return cut.where("rows is null"), _solve_blocks(blocks.join(few(states), ["part", "no"]), with_messages)


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           live: Column | None = None, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each
    conversation.  Rows that are not ``live`` are lost: they only name their conversation."""
    done, blocks = _solved(df, conv_col, turn_col, role_col, text_col, live, False, block_rows, block_bytes)
    columns = ["conv", *_COUNTS, "audit", "repaired_sha256"]
    return done.select(*columns).unionByName(_chain(blocks).select(*columns)).withColumnRenamed("conv", conv_col)


def repaired_rows(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                  live: Column | None = None, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, part, no, at, role, text): the repaired messages; the three numbers order those of a conversation."""
    done, blocks = _solved(df, conv_col, turn_col, role_col, text_col, live, True, block_rows, block_bytes)
    columns = ["conv", "part", "no", "messages"]
    both = done.select(*columns).unionByName(blocks.select(*columns))
    return both.select(F.col("conv").alias(conv_col), "part", "no", F.posexplode("messages").alias("at", "m")).select(
        conv_col, "part", "no", "at", F.col("m.role").alias(role_col), F.col("m.text").alias(text_col))
