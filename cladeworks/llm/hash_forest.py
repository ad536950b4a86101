"""Approximate nearest neighbours with a forest of hash prefixes.

Each tree sorts the vectors by a string of 59 random-hyperplane bits. A query descends in every
tree to its longest matching prefix, then all trees ascend together, a bit at a time, and the vectors
under the prefixes join the candidates until there are enough. Candidates are ranked by exact cosine in
double precision.

The index is sharded by rows: each shard holds the sorted arrays of its own vectors, so building and
memory are bounded by ``SHARD_ROWS``; a query set goes to the shards in blocks and each shard returns its
k best. ``LEAST_SHARE`` of a shard's rows is the number of candidates at which the ascent ends; vectors
without near neighbours (cosines near 0.4 in 64 dimensions) differ so little from the rest that a
recall of 0.9 needs that many, while close clusters are found within the first prefixes.

Defined results: vectors that are null, empty, zero, or hold nulls or non-finite numbers take no part,
as queries or as candidates; so do rows with a null id; rows with the query's own id are no candidates;
vectors of another length than the query are not compared; ties go to the smaller id; with fewer than k
candidates all are returned; a repeated id is listed once, by its nearest vector, and never for a query of that id; query rows of one id
with different vectors are answered apart, equal ones once; an empty table gives an empty result; only id and vector are read, so other
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeworks.runtime import materialize, read_table

#: Trees, a power of two; bits hashed for each.
TREES, BITS = 32, 64
TREE_BITS = TREES.bit_length() - 1
#: Rows of a shard; small tables still get up to ``LEAST_SHARDS`` of ``LEAST_ROWS`` for parallel work.
SHARD_ROWS, LEAST_SHARDS, LEAST_ROWS = 8192, 8, 512
LEAST_SHARE, LEAST_CANDIDATES = 0.55, 400
NEIGHBOURS = 5
QUERY_EVERY = 50


@cache
def _planes(dims: int) -> np.ndarray:
    return np.random.default_rng([7, dims]).standard_normal((dims, TREES * BITS))


def hash_strings(vectors: np.ndarray) -> np.ndarray:
    """``TREES`` 64-bit strings a row, as unsigned integers whose top bit is the first of the string."""
    signs = vectors @ _planes(vectors.shape[1]) > 0
    packed = np.packbits(signs.reshape(len(vectors), TREES, BITS), axis=2, bitorder="big")
    return np.ascontiguousarray(packed).view(">u8")[:, :, 0].astype(np.uint64)


def tree_keys(strings: np.ndarray) -> np.ndarray:
    """The tree's number in the first bits, then its string; the last bits of the string give way."""
    return strings >> np.uint64(TREE_BITS) | np.arange(TREES, dtype=np.uint64) << np.uint64(64 - TREE_BITS)


class Forest:
    """Sorted hash strings of the vectors of one shard: the trees' arrays end to end, told apart by the first bits."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.repeats = len(np.unique(ids)) < len(ids)
        keys = tree_keys(hash_strings(vectors))
        self.order = np.argsort(keys, axis=0, kind="stable").T.reshape(-1)
        self.sorted = np.sort(keys, axis=0).T.reshape(-1)

    def longest(self, keys: np.ndarray) -> int:
        """Bits of the longest prefix that any tree shares with the query."""
        at = np.searchsorted(self.sorted, keys)
        shared = np.minimum(self.sorted[np.maximum(at - 1, 0)] ^ keys, self.sorted[np.minimum(at, len(self.sorted) - 1)] ^ keys)
        return max(0, 64 - int(shared.min()).bit_length() - TREE_BITS)

    def ranges(self, keys: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """For each tree, where the strings that share ``depth`` bits with the query's begin and end."""
        rest = np.uint64(64 - TREE_BITS - depth)
        low = keys >> rest << rest
        return np.searchsorted(self.sorted, low, side="left"), np.searchsorted(self.sorted, low | ((np.uint64(1) << rest) - np.uint64(1)), side="right")

    def candidates(self, keys: np.ndarray, enough: int) -> np.ndarray:
        """Synchronous ascent: every tree goes up a bit at a time until enough vectors are under the prefixes."""
        depth = self.longest(keys)
        while True:
            begin, end = self.ranges(keys, depth)
            if depth == 0 or (end - begin).sum() >= enough:
                marked = np.zeros(len(self.ids), dtype=bool)
                marked[np.concatenate([self.order[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)])] = True
                if depth == 0 or np.count_nonzero(marked) >= enough:
                    return np.flatnonzero(marked)
            depth -= 1

    def nearest(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        found = self.candidates(tree_keys(hash_strings(query[None, :]))[0], max(LEAST_CANDIDATES, int(LEAST_SHARE * len(self.ids))))
        found = found[self.ids[found] != query_id]
        scores = cosines(self.vectors[found], self.norms[found], query)
        if len(found) > k and not self.repeats:
            bound = np.partition(scores, len(scores) - k)[len(scores) - k]
            keep = scores >= bound
            found, scores = found[keep], scores[keep]
        best = np.lexsort((self.ids[found], -scores))
        if self.repeats:  # an id counts by its nearest vector
            best = best[np.sort(np.unique(self.ids[found[best]], return_index=True)[1])]
        best = best[:k]
        return self.ids[found[best]], scores[best]


def cosines(vectors: np.ndarray, norms: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Row sums in a fixed order, so that a pair has one score wherever it is computed."""
    return (vectors * query).sum(axis=1) / (norms * np.sqrt((query * query).sum()))


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return df.select(F.col(id_col).cast("long").alias("_nn_id"), v.alias("_nn_v")).where(F.col("_nn_id").isNotNull() & F.col("_nn_v").isNotNull() & finite & some)


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows of a shard come together, its vectors before its queries."""
    shard, waiting, forests = None, [], {}

    def build() -> dict[int, Forest]:
        by_dims: dict[int, list] = {}
        for i, v in waiting:
            by_dims.setdefault(len(v), []).append((i, v))
        return {d: Forest(np.array([i for i, _ in rows]), np.array([v for _, v in rows])) for d, rows in by_dims.items()}

    for batch in batches:
        out = []
        vectors, marks = batch.column(3), batch.column(4)
        for row, (where, query, i) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
            if where != shard:
                shard, waiting, forests = where, [], None
            v = vectors[row].values.to_numpy(zero_copy_only=False)
            if not query:
                waiting.append((i, v))
                continue
            if forests is None:
                forests, waiting = build(), []
            if len(v) in forests:
                ids, scores = forests[len(v)].nearest(i, v, k)
                out += [(i, marks[row].as_py(), int(n), float(s)) for n, s in zip(ids, scores, strict=True)]
        if out:
            q, mark, n, s = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(mark, pa.int64()), pa.array(n, pa.int64()), pa.array(s, pa.float64())], ["query_id", "mark", "vec_id", "score"])


def search(index: DataFrame, queries: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``; both inputs have ``_nn_id`` and ``_nn_v`` as ``usable`` gives them."""
    rows = index.count()
    shards = max(1, -(-rows // SHARD_ROWS), min(LEAST_SHARDS, -(-rows // LEAST_ROWS)))
    spread = F.pmod(F.xxhash64("_nn_id", "_nn_v"), F.lit(shards))
    mark = F.xxhash64("_nn_v").alias("mark")  # tells query rows of one id apart
    held = index.select(spread.alias("shard"), F.lit(0).alias("query"), "_nn_id", "_nn_v", mark)
    asked = queries.distinct().select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.lit(1).alias("query"), "_nn_id", "_nn_v", mark)
    together = held.unionByName(asked).repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "query", "_nn_id")
    found = together.mapInArrow(lambda it: _search(it, k), "query_id long, mark long, vec_id long, score double")
    # A query's candidates from all shards: k a shard, so no group grows with the table's copies.
    found = found.groupBy("query_id", "mark", "vec_id").agg(F.max("score").alias("score"))
    nth = F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", nth).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = materialize(usable(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding"))
    return search(vectors, vectors.where(F.col("_nn_id") % QUERY_EVERY == 0))
