"""Merkle manifest against a plain statement of the tree, and the persistent tree's sharing."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartwright.llm import merkle

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("source", "lang")),
                       T.StructField("n_chars", T.LongType()), T.StructField("text", T.StringType()),
                       *(T.StructField(c, T.StringType()) for c in ("id", "grp", "pos", "digest", "n", "path", "row", "start"))])


def H(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row) -> str:
    doc, source, lang, n, text = row
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, n, text)))


def tree(nodes):
    """All levels, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def path(levels, at):
    for nodes in levels[:-1]:
        run = at // 8 * 8
        yield nodes[run:at], nodes[at + 1 : run + 8]
        at //= 8


def expected(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    names = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for own in by_lang.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {x: tree([leaf(r) for r in own]) for x, own in by_lang.items()}
    top = tree([trees[x][-1][0] for x in names])
    out = []
    for k, x in enumerate(names):
        for i, r in enumerate(by_lang[x]):
            around = [*path(trees[x], i), *path(top, k)]
            fold = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                fold = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            d = leaf(fold)
            for left, right in around:
                d = H(*left, d, *right)
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[x][-1][0], root, H(*(c for a, b in around for c in (*a, *b))), d, d == root))
    return sorted(out, key=str)


def found(spark, rows, levels=2):
    docs = spark.createDataFrame([(*r, *["clash"] * 8) for r in rows], SCHEMA)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    made = merkle.manifest(docs, tampered, {"text": F.translate("text", merkle.UPPER, merkle.LOWER)}, levels=levels)
    return sorted((tuple(r) for r in made.collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2])
def test_against_a_plain_tree(spark, levels):
    """Groups of 1 to 600 leaves, among them powers of eight and one more; more groups than a run."""
    rows, at = [], 0
    for lang, n in ((None, 3), ("de", 1), ("en", 600), ("fr", 8), ("es", 9), ("it", 64), ("pl", 65), ("zh", 2), ("ä", 7), ("", 5)):
        for i in range(n):
            rows.append((at, f"s{i % 3}" if i % 4 else None, lang, i if i % 5 else None, f"Text NUMBER {i} Ünïcode" if i % 6 else None))
            at += 1
    got = found(spark, rows, levels)
    assert got == expected(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_edge_rows(spark):
    rows = [(None, None, None, None, None), (None, "", "", 0, ""), (1, "s", "en", 1, "A"), (1, "s", "en", 1, "A"), (1, "s", "en", 2, "B"),
            (-5, "s", "en", 1, "MINUS"), (7, "s", "en", 9, "Long " * 100_000), (8, "s", None, 9, " ")]
    assert found(spark, rows) == expected(rows)
    assert found(spark, []) == []
    assert found(spark, rows[2:3]) == expected(rows[2:3])  # one leaf is its own root
    assert found(spark, rows[2:3])[0][1] == found(spark, rows[2:3])[0][3]


def test_versions_share_untouched_nodes():
    digests = [H(str(i)) for i in range(100)]
    root = merkle.build(digests, 3)
    turns = merkle.slots(42, 3)
    new = merkle.version(root, turns, H("other"))
    assert new.digest == merkle.build([*digests[:42], H("other"), *digests[43:]], 3).digest
    old_nodes, copied, node, other = [root], 0, root, new
    for turn in turns:
        assert len(node.children) == len(other.children)
        for i, (a, b) in enumerate(zip(node.children, other.children, strict=True)):
            assert (a is b) == (i != turn)
        node, other, copied = node.children[turn], other.children[turn], copied + 1
    assert copied == 3 and old_nodes[0].digest == merkle.build(digests, 3).digest
    assert merkle.version(root, turns, digests[42]) is root
