"""Nearest neighbours by largest inner product with a hash-prefix forest.

Vectors are dealt to blocks.  In a block every tree is a sorted array of long
hash strings: signs of random projections, of vectors padded by one component so
that all have one length and the inner product orders them as the angle does.
A query descends in every tree to its longest matching prefixes and then
ascends in all trees at once, one level at a time.  All vectors under the
reached prefixes are candidates; levels are never cut short.  It stops as soon as a
vector as near as the k-th best candidate would have been met with
probability ``recall``.  Candidates are scored exactly, in double precision, when they are first
met; no product of a vector that wasn't met is worked out.

Every query meets every block, so work grows with queries times vectors; cells
of a block and a bounded number of queries keep each task bounded.  How much of
a block is looked at depends on the data: if near vectors stand out it is a
small part, among vectors without structure it is most of it.

Defined results: vectors that are null, empty or zero, or hold null or
non-finite components, take no part, nor do rows without an id.  Rows repeated
for one id count once, with the least of their vectors.  A query is compared
with vectors of its own length only.  Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.llm.jaccard_join import _groups

TREES = 40
LENGTH = 20
RECALL = 0.95
#: Vectors of a block on average, and queries that meet it in one cell at most (about).
BLOCK = 4096
CELL_QUERIES = 16_384
_QUERIES_AT_ONCE = 256

SCHEMA = "query_id long, vec_id long, score double"


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, vector, length)`` of the vectors that take part."""
    vector = F.col(vector_col).cast("array<double>")
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    good = rows.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).filter(
        F.col("vec_id").isNotNull() & F.coalesce(whole & some, F.lit(False))
    )
    once = good.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return once.withColumn("length", F.size("vector"))


class Forest:
    """Sorted hash strings of the vectors of a block."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, length: int = LENGTH) -> None:
        self.vectors, self.trees, self.length = vectors, trees, length
        self.products = 0  # inner products worked out so far
        norms = np.linalg.norm(vectors, axis=1)
        self.longest = norms.max()
        self.planes = np.random.default_rng(4).standard_normal((vectors.shape[1] + 1, trees * length))
        rest = np.sqrt(np.clip(1 - (norms / self.longest) ** 2, 0, None))
        codes = self._codes(np.concatenate([vectors / self.longest, rest[:, None]], axis=1)).T
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(codes, self.order, axis=1))

    def _codes(self, padded: np.ndarray) -> np.ndarray:
        """One hash string for each vector and tree, as a number."""
        bits = (padded @ self.planes > 0).reshape(len(padded), self.trees, self.length)
        return bits @ (1 << np.arange(self.length - 1, -1, -1, dtype=np.int64))

    def _level(self, kth: np.ndarray, recall: float) -> np.ndarray:
        """The longest prefix under which a vector with this cosine is met in some tree with probability ``recall``."""
        together = np.maximum(1 - np.arccos(np.clip(kth, -1, 1)) / np.pi, 1e-12)
        each = 1 - (1 - recall) ** (1 / self.trees)  # what one tree must give
        with np.errstate(divide="ignore", invalid="ignore"):
            level = np.floor(np.log(each) / np.log(together))
        return np.clip(np.where(together >= 1, self.length, level), 0, self.length).astype(np.int64)

    def _matching(self, codes: np.ndarray, wanted: int) -> np.ndarray:
        """For each query the longest level, in steps of four, at which its trees hold ``wanted`` vectors, counted apart."""
        out = np.zeros(len(codes), dtype=np.int64)
        for level in range(self.length, 0, -4):
            shift = self.length - level
            total = np.zeros(len(codes), dtype=np.int64)
            for tree in range(self.trees):
                prefix = codes[:, tree] >> shift
                total += np.searchsorted(self.sorted[tree], (prefix + 1) << shift) - np.searchsorted(self.sorted[tree], prefix << shift)
            out = np.where((out == 0) & (total >= wanted), level, out)
            if out.all():
                break
        return out

    def candidates(self, queries: np.ndarray, own: np.ndarray, k: int, recall: float) -> tuple[np.ndarray, np.ndarray]:
        """Which vectors are met for each query, and their inner products with it; those of all others are never
        worked out and stand as -inf.  ``own`` marks a query's own vector.

        The k-th best score so far tells how short the prefixes must become.
        It only grows as they get shorter, so levels far above that can't be
        enough and are passed over.
        """
        n, norms = len(self.vectors), np.linalg.norm(queries, axis=1)
        codes = self._codes(np.concatenate([queries / norms[:, None], np.zeros((len(queries), 1))], axis=1))
        scores, met, active = np.full((len(queries), n), -np.inf), own.copy(), np.arange(len(queries))
        low, high = np.empty((2, self.trees, len(queries)), dtype=np.int64)
        level = self._matching(codes, 2 * k)
        while len(active):
            shift = self.length - level[active]
            for tree in range(self.trees):
                prefix = codes[active, tree] >> shift
                low[tree, active] = np.searchsorted(self.sorted[tree], prefix << shift)
                high[tree, active] = np.searchsorted(self.sorted[tree], (prefix + 1) << shift)
            for query in active.tolist():
                reached = np.zeros(n, dtype=bool)
                for order, a, b in zip(self.order, low[:, query].tolist(), high[:, query].tolist(), strict=True):
                    if b > a:
                        reached[order[a:b]] = True
                new = np.flatnonzero(reached & ~met[query])
                scores[query, new] = self.vectors[new] @ queries[query]
                met[query, new] = True
                self.products += len(new)
            kth = np.partition(scores[active], n - k, axis=1)[:, n - k] if n >= k else np.full(len(active), -np.inf)
            known = np.isfinite(kth)
            wanted = self._level(np.where(known, kth, 0) / (norms[active] * self.longest), recall)
            more = (level[active] > 0) & (~known | (level[active] > wanted))
            # first one level above what the score asks for: the candidates met there may raise it
            further = np.where(known, np.minimum(level[active] - 1, wanted + 1), level[active] - 1)
            level[active] = np.where(more, further, level[active])
            active = active[more]
        return met & ~own, scores


def _search(k: int, recall: float):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell in _groups(batches, ["length", "block", "part"]):
            is_query = cell["query"]
            if is_query.all() or not is_query.any():
                continue
            ids, vectors = cell["vec_id"][~is_query], np.stack(cell["vector"][~is_query])
            asked, queries = cell["vec_id"][is_query], np.stack(cell["vector"][is_query])
            forest = Forest(vectors)
            for start in range(0, len(asked), _QUERIES_AT_ONCE):
                some, their = asked[start : start + _QUERIES_AT_ONCE], queries[start : start + _QUERIES_AT_ONCE]
                met, products = forest.candidates(their, some[:, None] == ids[None, :], k, recall)
                query_ids, vec_ids, all_scores = [], [], []
                for row, (query_id, query) in enumerate(zip(some.tolist(), their, strict=True)):
                    at = np.flatnonzero(met[row])
                    if len(at) > k:  # keep what may stand among the first k once scored alike
                        near = products[row, at]
                        kth = np.partition(near, len(at) - k)[len(at) - k]
                        at = at[near >= kth - 1e-9 * (abs(kth) + forest.longest * np.linalg.norm(query))]
                    scores = (vectors[at] * query).sum(axis=1)
                    best = np.lexsort((ids[at], -scores))[:k]
                    query_ids.append(np.full(len(best), query_id))
                    vec_ids.append(ids[at][best])
                    all_scores.append(scores[best])
                yield pd.DataFrame({
                    "query_id": np.concatenate(query_ids), "vec_id": np.concatenate(vec_ids), "score": np.concatenate(all_scores),
                })

    return search


def nearest(rows: DataFrame, is_query: Column, k: int = 20, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for each row that ``is_query`` (over ``vec_id``) names."""
    spark = rows.sparkSession
    vectors = usable(rows, id_col, vector_col)
    n, asked = vectors.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    blocks, parts = max(1, -(-n // BLOCK)), max(1, -(-asked // CELL_QUERIES))

    def every(number: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))

    def one_of(number: int, seed: str) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(number)).cast("int")

    common = ["length", "vec_id", "vector"]
    held = vectors.select(*common, F.lit(False).alias("query"), one_of(blocks, "block").alias("block"), every(parts).alias("part"))
    asking = vectors.filter(is_query).select(*common, F.lit(True).alias("query"), every(blocks).alias("block"), one_of(parts, "part").alias("part"))
    keys = ["length", "block", "part"]
    cells = held.union(asking.select(held.columns)).repartition(
        max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(2 * blocks * parts, 10_000)), *keys
    )
    found = cells.sortWithinPartitions(*keys, "query", "vec_id").mapInPandas(_search(k, recall), SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
