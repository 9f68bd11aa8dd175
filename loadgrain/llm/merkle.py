"""A Merkle manifest of a dataset: trees of hashes in blocks, each laid out after van Emde Boas.

A tree has one leaf per row and joins 16 nodes in a row to one. It is stored as aligned subtrees of ``BLOCK_LEVELS``
levels, one row of a table each, and the roots of a round's blocks are the leaves of the next, so a tree
of n leaves takes log(n) rounds to the base 4,096. Inside a block the nodes stand in the order of van Emde Boas: the block is cut
at half its height, the upper part comes first, then the lower parts from left to right, each cut again in the same way.
Building a block and reading the siblings along a path use that address arithmetic alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadgrain.llm.buckets import whole_buckets
from loadgrain.llm.common import written

FANOUT = 16
# levels of joins in a block; it has at most 16**3 leaves
BLOCK_LEVELS = 3
BLOCK_LEAVES = FANOUT**BLOCK_LEVELS
DIGEST = 64

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def addresses(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` below the root in a complete block of ``levels`` levels of joins.

    A block of h levels of nodes is an upper block of h // 2 of them, followed by a lower block for each child of its
    last level. Only the level sought is followed down, so a place takes log(h) steps of arithmetic.
    """
    place = np.zeros(len(index), np.int64)
    height = levels + 1
    while height > 1:
        upper = height // 2
        if depth < upper:
            height = upper
            continue
        below = FANOUT ** (depth - upper)
        place += nodes(upper) + (index // below) * nodes(height - upper)
        index = index % below
        depth -= upper
        height -= upper
    return place


def nodes(height: int) -> int:
    """Nodes of a complete block with ``height`` levels of nodes."""
    return (FANOUT**height - 1) // (FANOUT - 1)


@lru_cache(maxsize=10_000)
def layout(n: int, levels: int) -> tuple[np.ndarray, ...]:
    """For each level of joins from the leaves to the root, where its nodes stand in the stored block.

    Nodes that a block with fewer leaves lacks are left out; the others keep their order.
    """
    width = [n]
    for _ in range(levels):
        width.append(-(-width[-1] // FANOUT))
    places = [addresses(levels, levels - k, np.arange(w)) for k, w in enumerate(width)]
    present = np.sort(np.concatenate(places))
    return tuple(np.searchsorted(present, p) for p in places)


def joined(parts: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def build_block(leaves: list[bytes], levels: int) -> tuple[bytes, bytes]:
    """The stored nodes and the root of a block."""
    out = np.zeros(sum(map(len, layout(len(leaves), levels))), f"S{DIGEST}")
    row = leaves
    for level, place in enumerate(layout(len(leaves), levels)):
        if level:
            row = [joined(row[i : i + FANOUT]) for i in range(0, len(row), FANOUT)]
        out[place] = row
    return out.tobytes(), row[0]


def rows_of_block(n: int, levels: int, stored: bytes) -> list[list[bytes]]:
    """The digests of each level below the root, read from their addresses."""
    all_nodes = np.frombuffer(stored, f"S{DIGEST}")
    return [all_nodes[place].tolist() for place in layout(n, levels)[:levels]]


def siblings(rows: list[list[bytes]], leaf: int) -> list[tuple[bytes, bytes]]:
    """What stands left and right of a leaf's path in each level of a block."""
    out = []
    for row in rows:
        begin = leaf - leaf % FANOUT
        out.append((b"".join(row[begin:leaf]), b"".join(row[leaf + 1 : begin + FANOUT])))
        leaf //= FANOUT
    return out


def fold(digest: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for left, right in path:
        digest = joined([left, digest, right])
    return digest


def levels_of(n: int) -> int:
    """Levels of joins that ``n`` nodes need to become one."""
    levels = 0
    while FANOUT**levels < n:
        levels += 1
    return levels


@dataclass(frozen=True)
class Trees:
    """Trees stored in blocks: one table for each round from the leaves up, and ``tree``, ``root`` of each."""

    rounds: tuple[DataFrame, ...]
    roots: DataFrame


@dataclass(frozen=True)
class Manifest:
    """Trees over the rows of each source, the tree over their roots, and the root of all (null without rows).

    ``leaves`` has ``doc_id``, ``tree`` (the source), ``leaf``, ``claim`` and ``rank``; ``sources`` has ``source`` and its ``rank``.
    """

    leaves: DataFrame
    trees: Trees
    sources: DataFrame
    top: Trees
    root: str | None


def numbered(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0) within each tree, by ``order``.

    Rows are sorted over all tasks, so a tree may be far larger than a task. Each task numbers its own rows and they are
    written with its number; what stands before a task's part of a tree comes from the counts of the parts. Equal rows may
    take each other's place.
    """
    spread = F.xxhash64(F.monotonically_increasing_id())  # deals rows that are equal in all else
    dealt = rows.withColumn("_spread", spread).repartitionByRange(tree, *order, "_spread")
    dealt = dealt.sortWithinPartitions(tree, *order).drop("_spread")
    schema = T.StructType([*dealt.schema.fields, T.StructField("_task", T.IntegerType()), T.StructField("_at", T.LongType())])
    at_tree = dealt.columns.index(tree)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column(at_tree).dictionary_encode(null_encoding="encode").indices.to_numpy()
            begins = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            size = np.diff(np.append(begins, len(codes)))
            at = np.arange(len(codes)) - np.repeat(begins, size)
            if last == (batch.column(at_tree)[0].as_py(),):
                at[: size[0]] += n
            last, n = (batch.column(at_tree)[-1].as_py(),), int(at[-1]) + 1
            more = [pa.array(np.full(len(codes), task, np.int32)), pa.array(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.names)

    done = written(dealt.mapInArrow(number, schema), name)
    # tasks hold consecutive rows, so most trees lie in one task; the others have a row for each of their tasks here
    parts = done.groupBy(F.col(tree).alias("_tree"), F.col("_task").alias("_part")).agg(F.count("*").alias("_n"))
    along = Window.partitionBy("_tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.withColumn("_before", F.sum("_n").over(along)).filter(F.col("_before").isNotNull()).drop("_n")
    same = F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("_task") == F.col("_part"))
    # a task holds the rest of one tree at most, so these are no more rows than tasks
    ranked = done.join(F.broadcast(before), same, "left")
    return ranked.select(*rows.columns, (F.col("_at") + F.coalesce("_before", F.lit(0))).alias("rank"))


def build(leaves: DataFrame, name: str) -> Trees:
    """The trees over ``leaves`` (``tree``, ``rank`` from 0 on, ``digest``), each round's blocks written.

    Only a tree of one block has a block of fewer levels; all others have ``BLOCK_LEVELS``, however few their leaves.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_buckets(batches, ["tree", "block"]):
            digests = table.column("digest").combine_chunks().cast(pa.binary()).to_pylist()
            heads = table.select(["tree", "block"]).take(pa.array(bounds[:-1])).combine_chunks()
            n = np.diff(bounds)
            number = heads.column("block").to_numpy()
            levels = [BLOCK_LEVELS if b else levels_of(int(m)) for b, m in zip(number, n, strict=True)]
            made = [build_block(digests[a : a + m], k) for a, m, k in zip(bounds[:-1], n, levels, strict=True)]
            arrays = [
                *(heads.column(c).combine_chunks() for c in ("tree", "block")),
                pa.array(n.astype(np.int64)),
                pa.array(levels, pa.int32()),
                pa.array([m[0] for m in made], pa.binary()),
                pa.array([m[1].decode() for m in made], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["tree", "block", "n", "levels", "nodes", "root"])

    rounds, finished = [], []
    while True:
        rows = leaves.select("tree", F.floor(F.col("rank") / BLOCK_LEAVES).alias("block"), "rank", "digest")
        dealt = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")
        schema = "tree string, block long, n long, levels int, nodes binary, root string"
        blocks = written(dealt.mapInArrow(make, schema), f"{name}-{len(rounds)}")
        rounds.append(blocks.drop("root"))
        last = blocks.groupBy("tree").agg(F.max("block").alias("last"), F.min_by("root", "block").alias("root"))
        finished.append(last.filter("last = 0").select("tree", "root"))
        more = last.filter("last > 0").select(F.col("tree").alias("_tree"))
        leaves = blocks.join(more, F.col("tree").eqNullSafe(F.col("_tree")), "left_semi")
        leaves = leaves.select("tree", F.col("block").alias("rank"), F.col("root").alias("digest"))
        if more.isEmpty():
            return Trees(tuple(rounds), written(reduce(DataFrame.union, finished), f"{name}-roots"))


PATH = "array<struct<left: binary, right: binary>>"
PATH_ARROW = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))


def _with_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    got = paths.select(F.col("tree").alias("_tree"), F.col("block").alias("_block"), "path")
    same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block"))
    return blocks.join(got, same).drop("_tree", "_block")


def _handed_down(blocks: DataFrame, name: str) -> DataFrame:
    """``tree``, ``rank`` and ``path`` from there on, for every leaf of ``blocks`` that have a ``path``; written.

    A leaf here is a whole block or tree below, so a row of some kilobytes stands for many leaves of those.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                levels = rows_of_block(row["n"], row["levels"], row["nodes"])
                paths = [
                    [{"left": a, "right": b} for a, b in siblings(levels, i)] + row["path"] for i in range(row["n"])
                ]
                ranks = row["block"] * BLOCK_LEAVES + np.arange(row["n"])
                arrays = [pa.array([row["tree"]] * row["n"], pa.string()), pa.array(ranks), pa.array(paths, PATH_ARROW)]
                yield pa.RecordBatch.from_arrays(arrays, names=["tree", "rank", "path"])

    return written(blocks.mapInArrow(each, f"tree string, rank long, path {PATH}"), name)


def lowest_blocks(trees: Trees, above: DataFrame, name: str) -> DataFrame:
    """The blocks of the first round with ``path``: the siblings from the block's root on, and then those of ``above``.

    ``above`` has ``tree`` and ``path``, what follows the tree's own root. Rounds are gone through from the last.
    """
    ends = above.select("tree", F.lit(0).cast("long").alias("block"), "path")
    paths = ends
    for number in reversed(range(1, len(trees.rounds))):
        below = _handed_down(_with_paths(trees.rounds[number], paths), f"{name}-{number}")
        below = below.withColumnRenamed("rank", "block")
        # trees of fewer rounds begin here
        got = below.filter("block = 0").select(F.col("tree").alias("_tree"))
        paths = below.unionByName(ends.join(got, F.col("tree").eqNullSafe(F.col("_tree")), "left_anti"))
    return _with_paths(trees.rounds[0], paths)


def _field(name: str) -> Column:
    text = F.col(name).cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def leaf_digest(text: Column | None = None) -> Column:
    """SHA-256 of the fields of a row, each ``-`` if null, else its length in bytes, ``:`` and its text."""
    parts = {c: _field(c) for c in FIELDS}
    if text is not None:
        parts["text"] = F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return F.sha2(F.concat(*parts.values()), 256)


def merkle_manifest(docs: DataFrame, claimed: Column | None = None) -> Manifest:
    """The manifest of ``docs`` (``FIELDS``; other columns play no part).

    Rows of a source are leaves in the order of ``doc_id``, null first, rows of one ``doc_id`` in that of their digests;
    sources are ordered bytewise, null first. ``claimed`` is a digest to be checked against each row's, null where it is
    the row's own. Null and empty texts differ. A table without rows has no root.
    """
    claim = F.lit(None).cast("string") if claimed is None else claimed
    rows = docs.select("doc_id", F.col("source").alias("tree"), leaf_digest().alias("leaf"), claim.alias("claim"))
    rows = written(rows, "merkle-leaves")
    leaves = numbered(rows, "tree", ["doc_id", "leaf"], "merkle-ranked")
    trees = build(leaves.select("tree", "rank", F.col("leaf").alias("digest")), "merkle-blocks")
    sources = trees.roots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("root").alias("digest"))
    sources = numbered(sources, "tree", ["source"], "merkle-sources")
    top = build(sources.select("tree", "rank", "digest"), "merkle-top")
    found = top.roots.first()
    return Manifest(leaves, trees, sources.select("source", "rank"), top, found["root"] if found else None)


def prove(manifest: Manifest) -> DataFrame:
    """Per row: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof`` (all siblings in a row), ``folded_root``, ``verified``.

    ``folded_root`` is what the claimed digest, or the row's own, gives with the siblings of the stored blocks;
    ``verified`` tells whether it is the root. A block, the path behind it and its rows meet in one task, so that
    no path is shuffled for a single row.
    """
    spark = manifest.leaves.sparkSession
    no_path = F.array().cast(PATH)
    ends = spark.range(1).select(F.lit("").alias("tree"), no_path.alias("path"))
    tops = _handed_down(lowest_blocks(manifest.top, ends, "merkle-top-paths"), "merkle-source-paths")
    above = manifest.sources.join(tops.select("rank", "path"), "rank").select(F.col("source").alias("tree"), "path")
    blocks = lowest_blocks(manifest.trees, above, "merkle-paths").withColumn("rank", F.lit(-1).cast("long"))
    blocks = _with_subroots(blocks, manifest.trees.roots)
    rows = manifest.leaves.withColumn("block", F.floor(F.col("rank") / BLOCK_LEAVES))
    both = rows.unionByName(blocks, allowMissingColumns=True)
    dealt = both.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")
    root = manifest.root

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        goal = (root or "").encode()
        for table, bounds in whole_buckets(batches, ["tree", "block"]):
            leaf, claim = (table.column(c).to_pylist() for c in ("leaf", "claim"))
            ids = table.column("doc_id").combine_chunks()
            for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                block = table.slice(begin, 1).select(["n", "levels", "nodes", "path", "subroot"]).to_pylist()[0]
                levels = rows_of_block(block["n"], block["levels"], block["nodes"])
                rest = [(p["left"], p["right"]) for p in block["path"]]
                proofs, folded = [], []
                for at in range(end - begin - 1):
                    path = siblings(levels, at) + rest
                    proofs.append(b"".join([side for pair in path for side in pair]).decode())
                    folded.append(fold((claim[begin + 1 + at] or leaf[begin + 1 + at]).encode(), path))
                n = len(proofs)
                arrays = [
                    ids.slice(begin + 1, n),
                    pa.array(leaf[begin + 1 : end], pa.string()),
                    pa.array([block["subroot"]] * n, pa.string()),
                    pa.array([root] * n, pa.string()),
                    pa.array(proofs, pa.string()),
                    pa.array([f.decode() for f in folded], pa.string()),
                    pa.array([f == goal for f in folded], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(
                    arrays, names=["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
                )

    schema = "doc_id long, leaf string, subroot string, root string, proof string, folded_root string, verified boolean"
    return dealt.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(check, schema)


def _with_subroots(blocks: DataFrame, roots: DataFrame) -> DataFrame:
    of = roots.select(F.col("tree").alias("_tree"), F.col("root").alias("subroot"))
    return blocks.join(of, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
