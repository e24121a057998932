"""Exact top-k by inner product: MaxScore over sharded postings, shards merged."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 1024
SHARD_ROWS = 65_536  # most candidates of a shard, which one task holds
LEAST_ROWS = 4096  # of a shard, where there are fewer shards than tasks
LARGEST = 1 << 62


def quantized(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector): each component x as floor(1024 * x), of the vectors that can take part.

    Null vectors, vectors with a null or non-finite component and rows without id take no part. A component that
    does not fit a long fails the job. Rows that repeat an id stay.
    """
    x = F.col(vector_column).cast("array<double>")
    able = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    too_large = F.raise_error(F.lit("a component is too large for a long")).cast("bigint")
    return vectors.where(F.col(id_column).isNotNull() & F.coalesce(able, F.lit(False))).select(
        F.col(id_column).cast("bigint").alias("vec_id"),
        F.transform(x, lambda v: F.when(F.abs(v * SCALE) < LARGEST, F.floor(v * SCALE)).otherwise(too_large)).alias("vector"))


def _rows(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as a matrix, shorter vectors filled up with zeros."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    lengths = np.diff(offsets)
    if (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


class _Shard:
    """Postings of one shard: a term is a dimension and a sign, an impact the magnitude of the component."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        order = np.argsort(ids)
        self.ids, self.matrix = ids[order], matrix[order]
        self.columns = np.ascontiguousarray(self.matrix.T)
        self.greatest = {1: np.maximum(self.columns.max(axis=1), 0), -1: np.maximum(-self.columns.min(axis=1), 0)}
        self.rows = {sign: [np.flatnonzero(sign * c > 0) for c in self.columns] for sign in (1, -1)}
        self.widest = float(np.abs(self.matrix).max(initial=0))
        self.scored = 0  # candidates whose exact scores were needed, over all queries

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and scores of the best k, ties to smaller ids.

        A query component of one sign gains only from components of the same sign; its bound is its magnitude
        times the greatest impact. Terms are non-essential while the bounds of all smaller ones stay below the
        threshold: what occurs in none of the essential postings cannot reach it. The others are probed term by
        term, essential ones first, and dropped when their gains so far and the open bounds fall short.
        """
        terms = np.flatnonzero(query)
        signs = np.sign(query[terms])
        bounds = np.abs(query[terms]) * np.where(signs > 0, self.greatest[1][terms], self.greatest[-1][terms])
        order = np.argsort(-bounds, kind="stable")
        terms, signs, bounds = terms[order], signs[order], bounds[order]
        open_after = np.concatenate([np.cumsum(bounds[::-1])[::-1][1:], [0]]) if len(bounds) else bounds
        own = self.ids != query_id
        if self.widest * float(np.abs(query).max(initial=0)) * max(1, len(query)) >= LARGEST:
            return self._wide(query, np.flatnonzero(own), k)
        threshold = self._seed(query, terms, signs, own, k)
        if threshold is None:  # fewer than k others: all of them are the result
            rows = np.flatnonzero(own)
        else:
            essential = int(np.searchsorted(-(open_after + bounds), -threshold, side="right"))
            found = np.zeros(len(self.ids), bool)
            for term, sign in zip(terms[:essential], signs[:essential], strict=True):
                found[self.rows[int(sign)][term]] = True
            if threshold <= 0:
                found[:] = True  # a score of a row without any gain may still reach it
            rows = np.flatnonzero(found & own)
            gains = np.zeros(len(rows), np.int64)
            for term, sign, rest in zip(terms, signs, open_after, strict=True):
                gains += np.maximum(self.columns[term][rows] * query[term], 0)
                still = gains + rest >= threshold
                if not still.all():
                    rows, gains = rows[still], gains[still]
        self.scored += len(rows)
        scores = self.matrix[rows] @ query
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][best], scores[best]

    def _wide(self, query: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for numbers whose sums may leave 64 bits: all rows, in integers of any size."""
        self.scored += len(rows)
        scores = self.matrix[rows].astype(object) @ query.astype(object)
        best = sorted(range(len(rows)), key=lambda i: (-scores[i], self.ids[rows[i]]))[:k]
        if any(abs(scores[i]) >= 1 << 63 for i in best):
            raise OverflowError("a score does not fit a long")
        return self.ids[rows][best], np.array([scores[i] for i in best], np.int64)

    def _seed(self, query: np.ndarray, terms: np.ndarray, signs: np.ndarray, own: np.ndarray, k: int) -> int | None:
        """The k-th score among the rows of greatest gain in the strongest terms: a lower bound of the true one."""
        if own.sum() < k:
            return None
        lead = terms[:16]
        gain = query[lead] @ self.columns[lead] if len(lead) else np.zeros(len(self.ids), np.int64)
        gain = np.where(own, gain, -np.iinfo(np.int64).max)
        rows = np.argpartition(-gain, k - 1)[:k]
        return int((self.matrix[rows] @ query).min())


FOUND = "query_id bigint, vec_id bigint, score bigint, scored bigint"


def _searched(batches: Iterator[pa.RecordBatch], dims: int, k: int) -> Iterator[pa.RecordBatch]:
    """The best of each shard for each query. A shard's candidates come first; queries stream past them."""
    current, parts, shard = None, [], None
    for batch in batches:
        shards, queried = batch.column("shard").to_numpy(), batch.column("is_query").to_numpy(zero_copy_only=False)
        ids, rows = batch.column("vec_id").to_numpy(), _rows(batch.column("vector"), dims)
        cuts = np.flatnonzero((np.diff(shards) != 0) | (np.diff(queried.astype(int)) != 0)) + 1
        found: list[tuple] = []
        for i, j in zip([0, *cuts], [*cuts, len(ids)], strict=True):
            if i == j:
                continue
            if shards[i] != current:
                current, parts, shard = shards[i], [], None
            if not queried[i]:
                parts.append((ids[i:j], rows[i:j]))
                continue
            if shard is None and parts:
                shard, parts = _Shard(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])), []
            for query_id, query in zip(ids[i:j].tolist(), rows[i:j], strict=True):
                if shard is not None:
                    before = shard.scored
                    best, scores = shard.search(query_id, query, k)
                    found.append((np.full(len(best), query_id), best, scores, np.full(len(best), shard.scored - before)))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score", "scored"])


def search(candidates: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k greatest inner products of each query with all rows of other ids.

    Both frames have (vec_id, vector of integers); a shorter vector counts as filled up with zeros. Every candidate
    goes to one shard, once; every query passes all shards, whose tasks hold a bounded number of candidates and
    read the queries as a stream behind them. Each shard returns k rows for a query, and they are merged by
    rank. Candidates that repeat an id are all in the search; of queries that repeat one the least vector counts.
    An empty side gives an empty result. A score that leaves a long fails the job.
    """
    counted = candidates.agg(F.count("*"), F.max(F.size("vector"))).first()
    dims = max(counted[1] or 0, queries.agg(F.max(F.size("vector"))).first()[0] or 0)
    tasks = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-counted[0] // SHARD_ROWS), min(tasks, -(-counted[0] // LEAST_ROWS)))
    # A shard's number is a hash of id and vector, so that rows that repeat an id fill no shard beyond the others.
    left = candidates.select(F.pmod(F.xxhash64("vec_id", "vector", F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard"),
                             F.lit(False).alias("is_query"), "vec_id", "vector")
    once = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    right = once.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("is_query"), "vec_id", "vector")
    dealt = left.unionByName(right).repartition("shard").sortWithinPartitions("shard", "is_query")
    found = dealt.mapInArrow(partial(_searched, dims=dims, k=k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def by_id(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """``search`` with the rows whose vec_id is divisible by ``every`` as queries."""
    able = quantized(vectors, "vec_id", "embedding")
    return search(able, able.where(F.col("vec_id") % every == 0), k)
