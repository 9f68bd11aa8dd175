from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from checks import TABLES, duck, duck_rows, spark_rows
from pyspark.sql import functions as F

from loadgrain.llm.merkle import (
    BLOCK_LEAVES,
    FANOUT,
    LOWER,
    UPPER,
    addresses,
    build,
    build_block,
    fold,
    layout,
    leaf_digest,
    levels_of,
    lowest_blocks,
    merkle_manifest,
    nodes,
    prove,
    rows_of_block,
    siblings,
)
from loadgrain.llm.oracle import ORACLE
from loadgrain.llm.queries import QUERIES


def h(*parts):
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def plain_levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def plain_path(levels, i):
    out = []
    for row in levels[:-1]:
        a = i - i % 16
        out.append((b"".join(row[a:i]), b"".join(row[i + 1 : a + 16])))
        i //= 16
    return out


def plain_order(height, depth=0, index=0):
    """Nodes (depth, index) of a block in the order of van Emde Boas, written out."""
    if height == 1:
        return [(depth, index)]
    upper = height // 2
    out = plain_order(upper, depth, index)
    below = FANOUT**upper
    for child in range(below):
        out += plain_order(height - upper, depth + upper, index * below + child)
    return out


@pytest.mark.parametrize("levels", [0, 1, 2, 3])
def test_addresses(levels):
    order = plain_order(levels + 1)
    assert len(order) == nodes(levels + 1)
    place = {node: i for i, node in enumerate(order)}
    for depth in range(levels + 1):
        found = addresses(levels, depth, np.arange(FANOUT**depth))
        assert found.tolist() == [place[depth, i] for i in range(FANOUT**depth)]


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 300, 4095, 4096])
def test_block(n):
    leaves = [h(str(i).encode()) for i in range(n)]
    expected = plain_levels(leaves)
    levels = levels_of(n)
    stored, root = build_block(leaves, levels)
    assert root == expected[-1][0]
    assert sorted(np.concatenate(layout(n, levels)).tolist()) == list(range(len(stored) // 64))
    rows = rows_of_block(n, levels, stored)
    for i in {0, n // 2, n - 1}:
        path = siblings(rows, i)
        assert path == plain_path(expected, i)
        assert fold(leaves[i], path) == root


@pytest.mark.parametrize("n", [4097, 2 * BLOCK_LEAVES, 70_000])
def test_rounds(spark, n):
    """Trees of several rounds beside small ones; paths from the stored blocks equal those of the plain tree."""
    leaves = spark.range(n).select(F.lit("large").alias("tree"), F.col("id").alias("rank"))
    leaves = leaves.union(spark.range(18).select(F.lit("small"), "id")).union(spark.range(1).select(F.lit(None).cast("string"), "id"))
    leaves = leaves.withColumn("digest", F.sha2(F.concat_ws("/", "tree", "rank"), 256))
    trees = build(leaves, "test-merkle")
    assert len(trees.rounds) == 2
    plain = {
        "large": plain_levels([h(f"large/{i}".encode()) for i in range(n)]),
        "small": plain_levels([h(f"small/{i}".encode()) for i in range(18)]),
        None: plain_levels([h(b"0")]),
    }
    roots = {r["tree"]: r["root"] for r in trees.roots.collect()}
    assert roots == {t: p[-1][0].decode() for t, p in plain.items()}
    ends = trees.roots.select("tree", F.expr("array(named_struct('left', binary('l'), 'right', binary('r')))").alias("path"))
    seen = 0
    for row in lowest_blocks(trees, ends, "test-paths").collect():
        levels = rows_of_block(row["n"], row["levels"], row["nodes"])
        for i in {0, row["n"] - 1}:
            path = siblings(levels, i) + [(bytes(p["left"]), bytes(p["right"])) for p in row["path"]]
            assert path == plain_path(plain[row["tree"]], row["block"] * BLOCK_LEAVES + i) + [(b"l", b"r")]
        seen += row["n"]
    assert seen == n + 19


def field(value):
    return b"-" if value is None else str(len(str(value).encode())).encode() + b":" + str(value).encode()


def plain_manifest(rows):
    """Rows of the query for (doc_id, source, lang, n_chars, text)."""
    lower = bytes.maketrans(UPPER.encode(), LOWER.encode())
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, h(*map(field, r)), r))
    for leaves in trees.values():
        leaves.sort(key=lambda x: x[:3])
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {s: plain_levels([x[2] for x in trees[s]]) for s in order}
    top = plain_levels([levels[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(trees[s]):
            path = plain_path(levels[s], i) + plain_path(top, k)
            claim = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                claim = h(*map(field, (*r[:4], r[4].encode().translate(lower).decode())))
            for left, right in path:
                claim = h(left, claim, right)
            proof = h(*(side for pair in path for side in pair))
            root = top[-1][0]
            out.append((r[0], *(x.decode() for x in (leaf, levels[s][-1][0], root, proof, claim)), claim == root))
    return sorted(out, key=str)


def of_rows(spark, rows):
    table = spark.createDataFrame(
        [(*r, 1, "clash") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, rank int, tree string"
    )
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    claimed = F.when(tampered, leaf_digest(F.translate("text", UPPER, LOWER)))
    found = prove(merkle_manifest(table, claimed)).withColumn("proof_sha256", F.sha2("proof", 256))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in found.select(*names).collect()), key=str)


def test_manifest_of_mixed_rows(spark):
    rng = random.Random(3)
    sources = [None, "", "a", "Z", "é", "日本", "hot", "hot", "hot", "hot"]
    texts = [None, "", "Some Capitals", "none here", "Ünïcode ÄÖ X", "long " * 20_000]
    rows = [(i, rng.choice(sources), rng.choice([None, "en"]), rng.choice([None, 5]), rng.choice(texts)) for i in range(400)]
    rows += [(None, "a", None, None, None), (None, "a", None, None, "X"), (7, "hot", "en", 1, "again"), (7, "hot", "en", 1, "again")]
    rng.shuffle(rows)
    assert of_rows(spark, rows) == plain_manifest(rows)


@pytest.mark.parametrize("rows", [[(5, None, None, None, "Only One")], [(i, "s", "en", 1, "X") for i in range(17)]])
def test_few_rows(spark, rows):
    assert of_rows(spark, rows) == plain_manifest(rows)


def test_no_rows(spark):
    assert of_rows(spark, []) == []


def test_one_change_is_noticed(spark):
    """Whatever field is claimed otherwise, only that row fails."""
    rows = [(i, "s", "en", 3, "abc") for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    claimed = F.when(F.col("doc_id") == 17, leaf_digest(F.lit("abd")))
    found = prove(merkle_manifest(table, claimed)).filter("not verified").select("doc_id").collect()
    assert [r[0] for r in found] == [17]


def test_query_and_sql(spark):
    sf = str(TABLES / "sf0.001")
    assert spark_rows(QUERIES["op12_merkle_veb"](spark, sf)) == duck_rows(duck(sf), ORACLE["op12_merkle_veb"])
