"""Approximate nearest neighbours by a forest of random-projection trees and exact reranking.

*Index.*  Each tree cuts the space by hyperplanes with random directions, at the median of a bounded
sample (``FIT_ROWS`` rows chosen by hash, collected once to the driver).  Every vector is put into one leaf of every tree.
*Search.*  A query opens the leaves of all trees through one shared priority queue: the side it lies on at
once, the other side when its distance to the hyperplanes passed on the wrong side (squares added) comes up.  A leaf is a block of vectors; a block
with many vectors or many queries is split by hash, so no task holds more than ``BLOCK`` x ``BLOCK_QUERIES``.
Within a block cosines are exact, in double precision, on the original vectors; the best of all opened
blocks are ranked.

Equal vectors are one class with its few smallest ids, so a vector that fills a third of the table is
indexed and searched once; the result is the same, as ties go to the smaller id.

Rows with a null id, and vectors that are null, zero, hold null or non-finite components, or have another
length than most vectors, take no part as query or candidate.  Rows that repeat an id with equal vectors count once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctiers.llm.runtime import stored

FIT_ROWS = 20_000
BLOCK = 20_000
BLOCK_QUERIES = 4_000
LEAF_ROWS = 16  # sample rows in a leaf at least; fewer rows make shallower trees
LEAST_ROWS = 8_000  # vectors of the leaves that a query opens at least
STEP = 256  # queries of one matrix product


@dataclass
class Forest:
    """``directions[t, i]`` and ``cuts[t, i]`` of inner node i of tree t; children of i are 2i+1 and 2i+2."""

    directions: np.ndarray
    cuts: np.ndarray
    depth: int

    def leaves(self, unit: np.ndarray) -> np.ndarray:
        """Leaf number by vector and tree."""
        out = np.zeros((len(unit), len(self.cuts)), np.int64)
        rows = np.arange(len(unit))
        for t in range(len(self.cuts)):
            if not self.depth:
                continue
            side = unit @ self.directions[t].T > self.cuts[t]
            node = np.zeros(len(unit), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + side[rows, node]
            out[:, t] = node - self.cuts.shape[1]
        return out

    def search(self, unit: np.ndarray, probes: int) -> list[tuple[int, int]]:
        """The first ``probes`` (tree, leaf) of one vector in the order of the shared queue."""
        inner = self.cuts.shape[1]
        margins = [d @ unit - c for d, c in zip(self.directions, self.cuts, strict=True)]
        queue, found = [(0.0, t, 0) for t in range(len(self.cuts))], []
        while queue and len(found) < probes:
            far, t, node = heapq.heappop(queue)
            while node < inner:
                margin = margins[t][node]
                right = margin > 0
                heapq.heappush(queue, (far + margin * margin, t, 2 * node + 1 + (not right)))
                node = 2 * node + 1 + right
            found.append((t, int(node - inner)))
        return found


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by their largest entry so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest entry near 1: cosines stay bit for bit, squares in range."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def plant(sample: np.ndarray, trees: int, depth: int, seed: int = 11) -> Forest:
    rng = np.random.default_rng(seed)
    inner = (1 << depth) - 1
    directions = rng.standard_normal((trees, inner, sample.shape[1]))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True) if inner else 1
    cuts = np.zeros((trees, inner))
    for t in range(trees):
        parts = [np.arange(len(sample))]
        for i in range(inner):
            rows = parts[i]
            along = sample[rows] @ directions[t, i]
            cuts[t, i] = np.median(along) if len(rows) else 0.0
            right = along > cuts[t, i]
            parts += [rows[~right], rows[right]]
            parts[i] = None
    return Forest(directions, cuts, depth)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _as_lists(rows: np.ndarray) -> pa.Array:
    flat = pa.array(rows.ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), flat)


def _assign(shared, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = shared.value.leaves(unit_rows(matrix(batch["vector"], dim)))
                yield pa.RecordBatch.from_arrays([batch["class"], batch["vector"], _as_lists(leaves)], names=["class", "vector", "leaves"])

    return run


def _probe(shared, dim: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.search(v, probes) for v in unit_rows(matrix(batch["vector"], dim))] if batch.num_rows else []
            counts = np.repeat(np.arange(batch.num_rows), [len(f) for f in found])
            flat = np.array([x for f in found for x in f], np.int64).reshape(-1, 2)
            rows = pa.array(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[:, 0].astype(np.int32)), pa.array(flat[:, 1]), batch["class"].take(rows), batch["vector"].take(rows)],
                names=["tree", "leaf", "query", "vector"],
            )

    return run


def _rank_block(dim: int, keep: int):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query": [], "class": [], "score": []}
        if vectors.num_rows and queries.num_rows:
            v, q = scaled(matrix(vectors["vector"], dim)), scaled(matrix(queries["vector"], dim))
            ids, names = vectors["class"].to_numpy(), queries["query"].to_numpy()
            v_size, q_size = np.sqrt((v * v).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
            for low in range(0, len(q), STEP):
                scores = (q[low : low + STEP] @ v.T) / (q_size[low : low + STEP, None] * v_size[None, :])
                for i, row in enumerate(scores):
                    best = np.arange(len(row))
                    if len(row) > keep:
                        best = np.flatnonzero(row >= row[np.argpartition(-row, keep - 1)[keep - 1]])
                    best = best[np.lexsort((ids[best], -row[best]))][:keep]
                    out["query"].append(np.full(len(best), names[low + i]))
                    out["class"].append(ids[best])
                    out["score"].append(row[best])
        columns = {k: np.concatenate(x) if x else np.empty(0, np.float64 if k == "score" else np.int64) for k, x in out.items()}
        return pa.table(columns)

    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector array<double>) of the rows that take part."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0.0))


def neighbours(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    trees: int = 16,
    depth: int = 8,
    share: float = 0.035,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose id is divisible by ``every``.

    ``share`` of all leaves are opened for a query, and in small tables as many as hold ``LEAST_ROWS`` vectors.
    Recall follows from the number of trees, the share and from how clustered the vectors are.  For nearly uniform
    vectors of 64 components the defaults keep it above 0.9 at 0.56 cosines per row and query; clustered vectors need
    a smaller share.
    """
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    rows = usable(vectors, id_col, vector_col)
    common = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        return spark.createDataFrame([], schema)
    dim = common["dim"]
    rows = rows.where(F.size("vector") == dim)

    # the smallest ids of each distinct vector; the limit works below the shuffle
    first = rows.distinct().withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("place") <= k + 1)
    classes = stored(
        first.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("class"), "ids", "vector"),
        "vectors",
    )
    asked = rows.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "vector").distinct()
    queries = stored(
        asked.join(classes.select("class", "vector"), "vector").select("query_id", F.col("class").alias("query")), "queries"
    )
    asked_vectors = classes.join(queries.select(F.col("query").alias("class")).distinct(), "class", "left_semi")

    sample = classes.orderBy(F.xxhash64("class"), "class").limit(FIT_ROWS).select("class", "vector").toArrow().sort_by("class")
    depth = min(depth, max(0, (sample.num_rows // LEAF_ROWS).bit_length() - 1))
    forest = plant(unit_rows(matrix(sample["vector"], dim)), trees, depth)
    shared = spark.sparkContext.broadcast(forest)
    leaves = trees * (1 << depth)
    in_leaf = max(1.0, classes.count() / (1 << depth))
    probes = min(leaves, max(1, round(share * leaves), round(LEAST_ROWS / in_leaf)))

    placed = (
        classes.select("class", "vector")
        .mapInArrow(_assign(shared, dim), "class bigint, vector array<double>, leaves array<bigint>")
        .select("class", "vector", F.posexplode("leaves").alias("tree", "leaf"))
    )
    probing = asked_vectors.select("class", "vector").mapInArrow(
        _probe(shared, dim, probes), "tree int, leaf bigint, query bigint, vector array<double>"
    )
    # one row per leaf, a fixed number: into how many blocks its vectors and its queries are split
    blocks = (
        placed.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
        .join(probing.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("query_parts")), ["tree", "leaf"])
    )
    key = ["tree", "leaf", "part", "query_part"]
    left = placed.join(F.broadcast(blocks), ["tree", "leaf"]).select(
        "tree", "leaf", F.pmod(F.xxhash64("class"), "parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1)).alias("query_part"), "class", "vector",
    )
    right = probing.join(F.broadcast(blocks), ["tree", "leaf"]).select(
        "tree", "leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("query"), "query_parts").cast("int").alias("query_part"), "query", "vector",
    )
    keep = 2 * k + 2
    ranked = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_rank_block(dim, keep), "query bigint, class bigint, score double")

    best = Window.partitionBy("query").orderBy(F.desc("score"), "class")
    top = (
        ranked.groupBy("query", "class").agg(F.max("score").alias("score"))
        .withColumn("place", F.row_number().over(best)).where(F.col("place") <= keep)
        .join(classes.select("class", "ids"), "class")
        .groupBy("query")
        .agg(F.array_sort(F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("far"), i.alias("id")))))).alias("found"))
    )
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    return (
        queries.join(top, "query")
        .select("query_id", F.posexplode(others).alias("at", "hit"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.far")).alias("score"))
    )
