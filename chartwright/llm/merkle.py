"""Merkle dataset manifest (13): path-copying versions of a tree built in aligned blocks.

1. **Leaves.**  A digest of each row's fields, in the JVM; for the rows to be tampered
   with, the digest of the tampered row beside it.
2. **Order.**  Leaves are range-sorted by (group, id) and numbered by running sums,
   so a group of a third of all rows is spread over many tasks.
3. **Up.**  Nodes meet in aligned blocks of ``FANOUT ** LEVELS`` nodes, one block at a
   time in a task; a block gives its root to the next round, until each group
   has one node.  The groups' nodes, in their order, form the tree on top in
   the same way.
4. **Down.**  From the top, each block receives the path above its root (at most
   ``FANOUT - 1`` siblings a level) and hands paths to its nodes.
5. **Versions.**  A leaf block is a persistent tree: a new leaf digest copies the
   leaf's ancestors in the block and shares every other node with the other
   versions.  Its upper versions go on from the block's root along the path
   handed down, in the same task, so versions of one upper block do not meet.

Rounds are written between, so lost executors cost no earlier round.

Defined cases: a null field is ``-``, an empty one ``0:``.  A null group comes
first, as do null ids.  Rows with one id keep the order of their leaf digests,
equal rows are leaves of their own.  Without rows there is no tree and no row.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartwright.llm.ranges import running
from chartwright.plans.session import materialize

FANOUT = 8
#: Levels of a block.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


# -- leaves ----------------------------------------------------------------
def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: list[Column]) -> Column:
    """Digest of a row's fields."""
    return F.sha2(F.concat(*map(field, fields)).cast("binary"), 256)


# -- one block -------------------------------------------------------------
@dataclass(frozen=True, slots=True)
class Node:
    """An immutable node; a leaf has no children."""

    digest: str
    children: tuple[Node, ...] = ()


def over(children: tuple[Node, ...]) -> Node:
    return Node(_hash("".join([c.digest for c in children])), children)


def build(digests: list[str], levels: int) -> Node:
    """The root of ``levels`` levels over the digests; every run of FANOUT nodes, and a last one of fewer, gets a parent."""
    nodes = [Node(d) for d in digests]
    for _ in range(levels):
        nodes = [over(tuple(nodes[i : i + FANOUT])) for i in range(0, len(nodes), FANOUT)]
    (root,) = nodes
    return root


def slots(place: int, levels: int) -> list[int]:
    """Which child leads from the root to the leaf, level by level."""
    return [place // FANOUT**level % FANOUT for level in range(levels - 1, -1, -1)]


def siblings(root: Node, turns: list[int]) -> list[tuple[str, str]]:
    """(digests left, digests right) of the path's node in each run, from the leaf upward."""
    found = []
    for turn in turns:
        own = [c.digest for c in root.children]
        found.append(("".join(own[:turn]), "".join(own[turn + 1 :])))
        root = root.children[turn]
    return found[::-1]


def version(root: Node, turns: list[int], digest: str) -> Node:
    """The root of a version with another leaf: its ancestors are copied, all other nodes are shared."""
    if not turns:
        return root if root.digest == digest else Node(digest)
    child = version(root.children[turns[0]], turns[1:], digest)
    if child is root.children[turns[0]]:
        return root
    return over((*root.children[: turns[0]], child, *root.children[turns[0] + 1 :]))


def levels_of(n: int) -> int:
    """Levels over n nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


# -- blocks of a table -----------------------------------------------------
# A stream is sorted by (grp, block, kind, pos): of each block first the path above it (kind 0), then its nodes (kind 1).
_STREAM = ("grp", "block", "kind", "pos", "digest", "n", "path", "mark", "changed", "id")
_PATH = "path array<struct<l:string,r:string>>"


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str | None, int, dict | None, list[dict]]]:
    """(group, block, the row of its path, its nodes) of each block of a sorted stream; a block is all that is held."""
    key, above, nodes = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = (row["grp"], row["block"])
            if own != key:
                if nodes:
                    yield *key, above, nodes
                key, above, nodes = own, None, []
            if row["kind"] == 0:
                above = row
            else:
                nodes.append(row)
    if nodes:
        yield *key, above, nodes


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


_PAIRS = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))
_NODE = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("digest", pa.string()), ("n", pa.int64())])
_HANDED = pa.schema([("grp", pa.string()), ("pos", pa.int64()), ("path", _PAIRS), ("mark", pa.string())])


def _up_task(levels: int):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for grp, block, _, nodes in _blocks(batches):
                n = nodes[0]["n"]
                own = min(levels, levels_of(n))
                yield grp, block, build([r["digest"] for r in nodes], own).digest, -(-n // FANOUT**own)

        return _batches(rows(), _NODE)

    return task


def _paths(levels: int, above: dict, nodes: list[dict]) -> Iterator[tuple[dict, Node, list[int], list[tuple[str, str]]]]:
    """(row, block root, turns to its node, path up to the top) of every node of a block."""
    own = min(levels, levels_of(nodes[0]["n"]))
    root = build([r["digest"] for r in nodes], own)
    rest = [(p["l"], p["r"]) for p in above["path"]]
    for i, row in enumerate(nodes):
        turns = slots(i, own)
        yield row, root, turns, siblings(root, turns) + rest


def _down_task(levels: int):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for grp, _, above, nodes in _blocks(batches):
                for row, _, _, path in _paths(levels, above, nodes):
                    yield grp, row["pos"], [{"l": a, "r": b} for a, b in path], above["mark"]

        return _batches(rows(), _HANDED)

    return task


_OUT = pa.schema([("id", pa.int64()), *((c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_())])


def _leaf_task(levels: int, top: str):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for _, _, above, nodes in _blocks(batches):
                rest = [(p["l"], p["r"]) for p in above["path"]]
                for row, root, turns, path in _paths(levels, above, nodes):
                    proof = _hash("".join([a + b for a, b in path]))
                    folded = version(root, turns, row["changed"] or row["digest"]).digest
                    for a, b in rest:  # the version's upper nodes
                        folded = _hash(a + folded + b)
                    yield row["id"], row["digest"], above["mark"], top, proof, folded, folded == top

        return _batches(rows(), _OUT)

    return task


def _stream(nodes: DataFrame, above: DataFrame | None, levels: int) -> DataFrame:
    """Nodes, and paths above their blocks, block by block."""
    size = F.lit(FANOUT**levels)
    blank = {"path": f"cast(null as {_PATH.split(' ', 1)[1]})", "mark": "cast(null as string)", "changed": "cast(null as string)", "id": "cast(null as long)"}
    rows = nodes.withColumn("block", F.floor(F.col("pos") / size).cast("long")).withColumn("kind", F.lit(1))
    rows = rows.select(*[F.col(c) if c in rows.columns else F.expr(blank[c]).alias(c) for c in _STREAM])
    if above is not None:
        rows = rows.unionByName(above.select(
            "grp", F.col("pos").alias("block"), F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("digest"),
            F.lit(None).cast("long").alias("n"), "path", "mark", F.lit(None).cast("string").alias("changed"), F.lit(None).cast("long").alias("id")))
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "kind", "pos")


def up(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes (grp, pos, digest, n) of each round, first the given ones; the last has one node a group."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        roots = _stream(rounds[-1], None, levels).mapInArrow(_up_task(levels), "grp string, pos long, digest string, n long")
        rounds.append(materialize(roots, "roots"))
    return rounds


def down(rounds: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """The paths (grp, pos, path, mark) above the blocks of the first of the rounds."""
    for nodes in rounds[:0:-1]:
        above = materialize(_stream(nodes, above, levels).mapInArrow(_down_task(levels), f"grp string, pos long, {_PATH}, mark string"), "paths")
    return above


# -- the operator ----------------------------------------------------------
RESULT = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, tampered: Column, changed: dict[str, Column], *, id_col: str = "doc_id", group_col: str = "lang",
             fields: tuple[str, ...] = FIELDS, levels: int = LEVELS) -> DataFrame:
    """Rows (id, leaf, subroot, root, proof_sha256, folded_root, verified), one for each row.

    ``tampered``: which rows get other fields, ``changed`` what these are.  ``folded_root`` comes from
    that row's leaf and the siblings of the untampered tree; ``verified``: it equals the root.
    """
    other = F.when(F.coalesce(tampered, F.lit(False)), leaf([changed.get(c, F.col(c)) for c in fields]))
    leaves = materialize(docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(group_col).cast("string").alias("grp"), leaf([F.col(c) for c in fields]).alias("digest"),
        other.alias("changed"), F.monotonically_increasing_id().alias("row")), "leaves")
    placed, _ = running(leaves, ["grp", "id", "digest", "row"], name="order")
    sizes = materialize(placed.groupBy("grp").agg(F.min("start").alias("first"), F.count("*").alias("n")), "sizes")
    same = placed["grp"].eqNullSafe(sizes["grp"])
    nodes = materialize(
        placed.join(sizes, same).select(placed["grp"], (F.col("start") - F.col("first")).alias("pos"), "digest", "n", "changed", "id"), "nodes")
    rounds = up(nodes, levels)
    ordered, groups = running(rounds[-1].select("grp", "digest"), ["grp"], start="pos", name="tops")
    tops = materialize(ordered.select(F.lit("").alias("grp"), "pos", "digest", F.lit(groups).cast("long").alias("n"), F.col("grp").alias("name")), "tops")
    upper = up(tops.select("grp", "pos", "digest", "n"), levels)
    top = upper[-1].first()
    if top is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    root = top["digest"]
    crown = docs.sparkSession.createDataFrame([("", 0, [], None)], f"grp string, pos long, {_PATH}, mark string")
    blocks = down(upper, crown, levels)  # the paths above the blocks of subroots
    handed = _stream(tops.select("grp", "pos", "digest", "n"), blocks, levels).mapInArrow(_down_task(levels), f"grp string, pos long, {_PATH}, mark string")
    named = handed.select("pos", "path").join(tops.select("pos", "name", "digest"), "pos").select(
        F.col("name").alias("grp"), F.lit(0).cast("long").alias("pos"), "path", F.col("digest").alias("mark"))
    above = down(rounds, materialize(named, "paths"), levels)
    return _stream(nodes, above, levels).mapInArrow(_leaf_task(levels, root), RESULT)
