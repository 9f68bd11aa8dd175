"""Repeated passages by a compacted de Bruijn graph of words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loadgrain.llm.common import runs, steps, written
from loadgrain.llm.repeats import (
    BASE,
    ROWS,
    Hashes,
    anchor_runs,
    batch_rows,
    covered,
    flat_lists,
    mix,
    one_key,
    repeated,
    texts_of,
    with_ranges,
)
from loadgrain.llm.suffixes import UNITS
from loadgrain.llm.words import joined_words


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """A hash for each word of all texts, each text's first word, and the words as ``joined_words`` has them."""
    data, begins, ends, first = joined_words(texts, lower=False)
    hashes = Hashes(UNITS[data]).stretch(begins, ends)
    return mix(hashes + (ends - begins).astype(np.uint64) * np.uint64(BASE)), first, data, begins, ends


def compact(edges: DataFrame, name: str) -> DataFrame:
    """Join the edges of every nonbranching path: ``key``, ``low``, ``high`` of each path's occurrences.

    ``edges`` has the occurrences of repeated edges: ``key``, ``low`` and ``high`` (the windows that the edge
    spans there) and ``edge``. The edge behind it begins at ``high + 1``. An edge with one edge behind it, which has
    one edge before it, is followed without a choice; such links become paths by doubling: in each round every
    edge joins with the edge it points to and takes over that one's pointer and distance. Edges on a circle
    point to no head; they stay paths of their own. The coordinates in the sources then verify each
    occurrence: edges of a path join only where they follow each other without a gap.
    """
    # as long as one document's own edges; what lies within an edge before it adds nothing
    here = Window.partitionBy("key").orderBy("low", F.desc("high"))
    reach = F.max("high").over(here.rowsBetween(Window.unboundedPreceding, -1))
    edges = edges.withColumn("reach", reach).filter("reach is null or high > reach").drop("reach")
    after = F.lead(F.struct("low", "edge")).over(here)
    steps_ = edges.withColumn("after", after).filter(F.col("after.low") == F.col("high") + 1)
    steps_ = steps_.select("edge", F.col("after.edge").alias("next"), (F.col("high") - F.col("low") + 1).alias("size"))
    steps_ = steps_.groupBy("edge", "next").agg(F.min("size").alias("size"))
    ahead = steps_.groupBy("edge").agg(F.count("*").alias("n"), F.min("next").alias("next"), F.min("size").alias("size"))
    behind = steps_.groupBy("next").agg(F.count("*").alias("m"))
    links = ahead.filter("n = 1").join(behind.filter("m = 1"), "next").filter("edge <> next")
    now = written(links.select(F.col("next").alias("edge"), F.col("edge").alias("head"), F.col("size").alias("far")), name)
    rounds = max(int(now.count()), 1).bit_length() + 1
    left = None
    for _ in range(rounds):
        up = now.select(F.col("edge").alias("head"), F.col("head").alias("top"), F.col("far").alias("more"))
        now = now.join(up, "head", "left")
        now = now.select(
            "edge",
            F.coalesce("top", "head").alias("head"),
            (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"),
            F.col("top").isNotNull().alias("moved"),
        )
        now = written(now, name)
        moved = now.filter("moved").count()
        now = now.drop("moved")
        if moved in (0, left):
            break
        left = moved
    heads = now.select(F.col("edge").alias("head"), F.lit(True).alias("inner")).distinct()
    now = now.join(heads, "head", "left").filter("inner is null").select("edge", "head", "far")  # no circles
    placed = edges.join(now, "edge", "left").select(
        "key",
        F.coalesce("head", "edge").alias("path"),
        (F.col("low") - F.coalesce("far", F.lit(0))).alias("at"),
        "low",
        "high",
    )
    spans = placed.groupBy("key", "path", "at").agg(
        F.min("low").alias("first"),
        F.max("high").alias("last"),
        F.sum(F.col("high") - F.col("low") + 1).alias("spanned"),
        F.collect_list(F.struct("low", "high")).alias("own"),
    )
    whole = F.col("spanned") == F.col("last") - F.col("first") + 1
    joined = F.array(F.struct(F.col("first").alias("low"), F.col("last").alias("high")))
    return spans.select("key", F.explode(F.when(whole, joined).otherwise(F.col("own"))).alias("span")).select("key", "span.*")


def remove_repeated_passages(docs: DataFrame, window: int = 35, q: int = 15) -> DataFrame:
    """Remove every word in ``window`` consecutive words which also start at any other place of any document.

    Words are what stands between blanks, unchanged; windows are judged on the input. Result: ``doc_id``,
    ``n_words``, ``n_removed`` and ``kept``, the remaining words joined by one blank.

    Windows of ``window`` words are the edges of a de Bruijn graph. Edges in a row with a common anchor of ``q``
    words travel as one (see ``repeats``); where the runs of an anchor branch they are taken apart into
    single edges. Edges met twice stay, nonbranching paths of them are compacted, and the coordinates of each
    path in the documents are verified (``compact``).

    Null, empty and blank texts have no words and nothing removed. Rows of the same or null ``doc_id`` are
    documents of their own. An empty table gives no rows. Other columns are ignored.
    """
    if not 0 < q <= window <= q + 255:
        raise ValueError("q must lie between 1 and window, and at most 255 below it")

    def sample(batches):
        for batch in steps(batches):
            units, starts, *_ = word_hashes(batch.column(1))
            key = batch.column(0).to_numpy()
            seg, first, last, bucket, kind, right = anchor_runs(Hashes(units), starts, window, q)
            yield batch_rows(key[seg], first - starts[seg], last - starts[seg], bucket, kind, right, earliest=False)

    def single_edges(batches):
        half = window // 2
        for batch in texts_of(batches):
            units, starts, *_ = word_hashes(batch.column(2))
            if len(units) < window:
                continue
            hashes = Hashes(units)
            low, count = flat_lists(batch.column(3))
            high, _ = flat_lists(batch.column(4))
            size = high - low + 1
            doc = np.repeat(np.repeat(np.arange(len(count)), count), size)
            place = np.repeat(low, size) + runs(size)
            at = starts[doc] + place
            here, there = hashes.stretch(at, at + half), hashes.stretch(at + half, at + window)
            yield batch_rows(batch.column(0).to_numpy()[doc], place, place, mix(here), mix(there), None, earliest=False)

    def cut(batches):
        for batch in texts_of(batches):
            _, starts, data, begins, ends = word_hashes(batch.column(2))
            low, count = flat_lists(batch.column(3))
            high, _ = flat_lists(batch.column(4))
            base = np.repeat(starts[:-1], count)
            gone = covered(len(begins), base + low, base + high + window)
            keep = np.repeat(~gone, ends - begins + 1)  # with the blank after each word
            done = np.concatenate([[0], np.cumsum(np.where(gone, 0, ends - begins + 1))])[starts]
            text = data[keep].tobytes()
            kept = [text[a : max(b - 1, a)] for a, b in zip(done[:-1], done[1:], strict=True)]
            lost = np.concatenate([[0], np.cumsum(gone)])[starts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    pa.array(np.diff(starts).astype(np.int64)),
                    pa.array(np.diff(lost).astype(np.int64)),
                    pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    docs = one_key(docs.select(F.col("doc_id").cast("long"), "text"), "passage-documents")
    found = written(repeated(docs.select("key", "text").mapInArrow(sample, ROWS), earliest=False, apart=True), "passage-runs")
    branching = with_ranges(docs, found.filter("task = 1"), "inner")
    single = repeated(branching.mapInArrow(single_edges, ROWS), earliest=False, apart=False)
    columns = ["key", "low", "high", "edge"]
    edges = found.filter("task = 0").select(columns).union(single.select(columns))
    edges = written(edges, "passage-edges")
    whole = with_ranges(docs, compact(edges, "passage-paths"), "left")
    return whole.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept binary")
