"""Merkle manifest of a table, with SHA midstates.

A leaf is the SHA-256 of a row: each of its fields as ``-`` if null, else its number of
UTF-8 bytes, ``:`` and its value.  The leaves of a group (a language) ascend by id, and
every ``FANOUT`` consecutive nodes of a level become the hash of their hex digests, until
one remains, the group's subroot; subroots, in the order of their groups, become the root
in the same way.

A parent keeps a copy of its hash state before each child's slot (``Parent``).  To fold a
changed child into the root, the state of its slot is copied, and the replacement and the
siblings to the right are added; what lies to the left is never hashed again.

1. Leaves are hashed in the tasks that read the texts; only digests are shuffled.
2. Rows get their place in their group by range partitions, so a group of any size, or
   many equal rows, are cut into even parts.
3. ``CHUNK`` consecutive leaves, three levels of the tree, are one bounded group; a chunk's
   root is a node of the next round, which has ``CHUNK`` times fewer of them.  The rounds'
   tables give each chunk the children of all its ancestors, a few KB.
4. Each chunk's rows meet that one line, and their proofs and folds are made there.

Null ids come first; rows of an id are ordered by their leaves, so repeated rows have
equal leaves and one place each.  The null group comes before the others (an empty string
is a group of its own, after it).  Null texts are a field ``-``, and replacing leaves them
null.  A row's null in the mark of replaced rows counts as not marked.  A group of one row
has its leaf as subroot; an empty table gives an empty one.  Texts are hashed as they lie
in the batch, of any length.  Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .util import few, ranked, utf8

FANOUT = 8
HEIGHT = 3                  # levels of a chunk
CHUNK = FANOUT ** HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<slot: int, children: array<string>>>"


class Parent:
    """A node with the hash state before each child's slot."""

    def __init__(self, children: Sequence[bytes]):
        self.children, self.states = children, []
        state = sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()
        self.right = [b"".join(children[slot + 1:]) for slot in range(len(children))]

    def fold(self, slot: int, replacement: bytes) -> bytes:
        state = self.states[slot].copy()
        state.update(replacement + self.right[slot])
        return state.hexdigest().encode()

    def siblings(self, slot: int) -> bytes:
        return b"".join(self.children[:slot]) + self.right[slot]


def levels(nodes: Sequence[bytes], size: int) -> list[list[Parent]]:
    """Parents of a chunk's nodes, level by level; ``size`` nodes are in the whole group."""
    out = []
    while size > 1 and len(out) < HEIGHT:
        out.append([Parent(nodes[at:at + FANOUT]) for at in range(0, len(nodes), FANOUT)])
        nodes = [p.digest for p in out[-1]]
        size = -(-size // FANOUT)
    return out


def field(value: bytes | None) -> bytes:
    return b"-" if value is None else b"%d:%b" % (len(value), value)


def leaves(df: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", marked: Column | None = None,
           change: Callable[[bytes], bytes] = bytes.lower) -> DataFrame:
    """(g, id, leaf, changed) of each row, by id and text as first and last of ``fields``.
    ``changed`` is the leaf of marked rows with ``change`` on their text, else null."""
    mark = F.coalesce(marked, F.lit(False)) if marked is not None else F.lit(False)
    key = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    slim = df.select(F.col(fields[0]).alias("id"), key.alias("g"), mark.alias("mark"),
                     *[F.col(c).cast("string").alias(f"f{i}") for i, c in enumerate(fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *short, texts = batch.columns[3:]
            offsets, data = utf8(texts)
            heads = [b"".join(field(None if v is None else v.encode()) for v in row) for row in zip(*(c.to_pylist() for c in short))]
            leaf, changed = [], []
            for i, (head, null, mark) in enumerate(zip(heads, texts.is_null().to_pylist(), batch.column(2).to_pylist())):
                text = None if null else data[offsets[i]:offsets[i + 1]].tobytes()
                leaf.append(sha256(head + field(text)).hexdigest())
                other = change(text) if mark and text is not None else text
                changed.append(None if not mark else leaf[-1] if other == text else sha256(head + field(other)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(0), pa.array(leaf, pa.string()), pa.array(changed, pa.string())],
                                             ["g", "id", "leaf", "changed"])

    return slim.mapInArrow(run, f"g string, id {slim.schema['id'].dataType.simpleString()}, leaf string, changed string")


def _digests(column: pa.ChunkedArray) -> list[bytes]:
    return [x.encode() for x in column.to_pylist()]


def _chunks(nodes: DataFrame):
    return nodes.withColumn("chunk", F.floor(F.col("i") / CHUNK)).groupBy("g", "chunk")


def climb(nodes: DataFrame, paths: bool) -> DataFrame:
    """One round: the root of each chunk of ``nodes`` (g, i, n, h) as (g, i, n, h) with a null
    ``path``, and with ``paths`` each node (g, i, null, null) with its path to it."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("i")
        group, size, at = table["g"][0].as_py(), table["n"][0].as_py(), table["i"].to_pylist()
        own = _digests(table["h"])
        tree = levels(own, size)
        root = tree[-1][0].digest if tree else own[0]
        rows = [(group, at[0] // CHUNK, -(-size // CHUNK), root.decode(), None)]
        for i in at if paths else ():
            up, place = [], i % CHUNK
            for parents in tree:
                place, slot = divmod(place, FANOUT)
                up.append({"slot": slot, "children": [c.decode() for c in parents[place].children]})
            rows.append((group, i, None, None, up))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["g", "i", "n", "h", "path"])

    types = [pa.string(), pa.int64(), pa.int64(), pa.string(),
             pa.list_(pa.struct([("slot", pa.int32()), ("children", pa.list_(pa.string()))]))]
    return _chunks(nodes.select("g", "i", "n", "h")).applyInArrow(run, f"g string, i long, n long, h string, path {_PATH}")


def ancestors(nodes: DataFrame) -> DataFrame:
    """(g, i, path, top) of stored ``nodes``: the children of all ancestors, and the group's root."""
    rounds = []
    while nodes.where("n > 1").limit(1).count():
        both = materialize(climb(nodes, True))
        rounds.append(both.where("path is not null").select("g", "i", "path"))
        nodes = both.where("path is null").drop("path")
    out = nodes.select("g", "i", F.array().cast(_PATH).alias("path"), F.col("h").alias("top"))
    for own in reversed(rounds):
        above = out.select("g", F.col("i").alias("chunk"), F.col("path").alias("above"), "top")
        out = own.withColumn("chunk", F.floor(F.col("i") / CHUNK)).join(above, ["g", "chunk"])
        out = materialize(out.select("g", "i", F.concat("path", "above").alias("path"), "top"))
    return out


def manifest(df: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", marked: Column | None = None,
             change: Callable[[bytes], bytes] = bytes.lower, with_proof: bool = False) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified[, proof]) of each row.

    ``folded_root`` folds the changed leaf of marked rows, else the leaf itself, with the
    siblings of the unchanged table; ``verified`` says that it equals ``root``.  ``proof``
    lists the slot and the siblings of each level up to the root."""
    rows = ranked(materialize(leaves(df, fields, group, marked, change)), "g", ["id", "leaf"])
    rows = materialize(rows)
    chunks = materialize(climb(rows.withColumn("h", F.col("leaf")), False).drop("path"))
    below = ancestors(chunks)
    # subroots in the order of their groups are the leaves of the upper tree
    tops = ranked(below.where("i = 0").select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("top").alias("h")), "g", ["name"])
    tops = materialize(tops)
    upper = tops.select("i", "name").join(ancestors(tops.drop("name")), "i")
    upper = materialize(upper.select(F.col("name").alias("g"), F.col("path").alias("above"), F.col("top").alias("root")))
    paths = below.join(few(upper), "g").select("g", F.col("i").alias("chunk"), F.concat("path", "above").alias("path"), F.col("top").alias("subroot"), "root")
    kind = rows.schema["id"].dataType.simpleString()

    def run(own: pa.Table, up: pa.Table) -> pa.Table:
        own = own.sort_by("i")
        leaf, changed = _digests(own["leaf"]), own["changed"].to_pylist()
        tree = levels(leaf, own["n"][0].as_py())
        subroot, root = up["subroot"][0].as_py(), up["root"][0].as_py()
        over = [(x["slot"], Parent([c.encode() for c in x["children"]])) for x in up["path"][0].as_py()]
        shared = b"".join(p.siblings(slot) for slot, p in over)
        proofs, folded, steps = [], [], []
        for i, (h, other) in enumerate(zip(leaf, changed)):
            h, place, siblings, step = h if other is None else other.encode(), i, [], []
            for parents in tree:
                place, slot = divmod(place, FANOUT)
                siblings.append(parents[place].siblings(slot))
                h = parents[place].fold(slot, h)
                step.append((slot, parents[place]))
            for slot, parent in over:
                h = parent.fold(slot, h)
            proofs.append(sha256(b"".join(siblings) + shared).hexdigest())
            folded.append(h.decode())
            if with_proof:
                steps.append([{"slot": slot, "children": [c.decode() for c in (*p.children[:slot], *p.children[slot + 1:])]} for slot, p in step + over])
        n = len(leaf)
        columns = [own["id"].combine_chunks(), own["leaf"].combine_chunks(), pa.array([subroot] * n), pa.array([root] * n), pa.array(proofs), pa.array(folded),
                   pa.array([x == root for x in folded])]
        return pa.Table.from_arrays(columns + [pa.array(steps, path)] * with_proof, names=names)

    path = pa.list_(pa.struct([("slot", pa.int32()), ("children", pa.list_(pa.string()))]))
    names = [fields[0], "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *["proof"] * with_proof]
    schema = f"`{fields[0]}` {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _chunks(rows).cogroup(paths.groupBy("g", "chunk")).applyInArrow(run, schema + f", proof {_PATH}" * with_proof)
