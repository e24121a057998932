"""Packing of token sequences into batches of little padding: optimal length buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm import tokens
from sensorloom.llm.common import staged

LENGTH = 2048  # greatest sequence; longer texts are cut into several
BUCKETS = 16
BATCH_TOKENS = 65_536  # of a batch, padding included
SHARD_BATCHES = 100  # batches that one sorting group of a bucket makes, on average


def boundaries(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """The lengths to pad to, at most ``buckets`` of them, that need the least padding for all sequences.

    best[j] after k turns is the least padding of all lengths up to the j-th in k buckets: the last bucket
    holds the lengths after some i, padded to the j-th. Ties go to the fewest buckets and the smallest i.
    """
    lengths = np.array(sorted(histogram), np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[int(n)] for n in lengths], np.int64)
    rows = np.concatenate([[0], np.cumsum(counts)])
    sums = np.concatenate([[0], np.cumsum(counts * lengths)])
    n = len(lengths)
    far = np.iinfo(np.int64).max // 4
    # cost[i, j]: lengths i .. j-1 padded to that of j-1
    cost = np.full((n + 1, n + 1), far, np.int64)
    for j in range(1, n + 1):
        cost[:j, j] = lengths[j - 1] * (rows[j] - rows[:j]) - (sums[j] - sums[:j])
    best = np.full(n + 1, far, np.int64)
    best[0] = 0
    choices, last = [], None
    for _ in range(min(buckets, n)):
        total = best[:, None] + cost
        choices.append(total.argmin(axis=0))
        best = total.min(axis=0)
        if last is not None and best[n] >= last:
            choices.pop()
            break
        last = best[n]
    cuts, j = [], n
    for chosen in reversed(choices):
        cuts.append(int(lengths[j - 1]))
        j = int(chosen[j])
    return cuts[::-1]


def _lengths(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = tokens.count_column(batch.column("text"), tokenizer) + 1
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array(sizes)], names=["doc_id", "tie", "n"])


def pack(documents: DataFrame, tokenizer: str, length: int = LENGTH, buckets: int = BUCKETS,
         batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """doc_id, piece, n_tokens, bucket, shard, batch, slot: a row for each sequence of at most ``length`` tokens.

    A text and its end id make one sequence, or several that follow each other (piece 0, 1, ..) if longer. The
    histogram of all sequences' lengths gives the buckets; a sequence is in the bucket of the smallest boundary
    not below its length, where it is padded to it. Inside a bucket, sequences are dealt to shards by a hash and
    batched there in order of (doc_id, text hash, piece): ``batch_tokens // bucket`` sequences to a batch, the
    last of a shard with what is left. (bucket, shard, batch) names a batch, ``slot`` the place in it.

    A null or empty text is the end id alone, of length 1. Rows without doc_id and repeated rows are packed like
    all others. An empty table gives no row.
    """
    sizes = documents.select("doc_id", F.xxhash64("text").alias("tie"), "text").mapInArrow(
        lambda batches: _lengths(batches, tokenizer), "doc_id bigint, tie bigint, n bigint")
    pieces = staged(sizes, "lengths").select(
        "doc_id", "tie", F.posexplode(F.expr(
            f"transform(sequence(0, cast((n - 1) div {length} as int)), i -> least({length}, n - i * {length}))"
        )).alias("piece", "n_tokens"))
    counted = pieces.groupBy("n_tokens").count().collect()  # at most ``length`` rows
    histogram = {row["n_tokens"]: row["count"] for row in counted}
    bounds = boundaries(histogram, buckets)
    bucket, shards = F.lit(None).cast("bigint"), F.lit(1)
    for low, bound in reversed(list(zip([0, *bounds], bounds, strict=False))):
        rows = sum(n for size, n in histogram.items() if low < size <= bound)
        of_batch = max(1, batch_tokens // bound)
        bucket = F.when(F.col("n_tokens") <= bound, F.lit(bound).cast("bigint")).otherwise(bucket)
        shards = F.when(F.col("n_tokens") <= bound, F.lit(-(-rows // (of_batch * SHARD_BATCHES)))).otherwise(shards)
    group = Window.partitionBy("bucket", "shard").orderBy("doc_id", "tie", "piece")
    at: Column = F.row_number().over(group) - 1
    of_batch = F.greatest(F.lit(1), F.expr(f"{batch_tokens} div bucket"))
    return (
        pieces.withColumn("bucket", bucket)
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", "tie", "piece"), shards).cast("int"))
        .withColumn("at", at)
        .select("doc_id", "piece", "n_tokens", "bucket", "shard",
                F.floor(F.col("at") / of_batch).alias("batch"), (F.col("at") % of_batch).cast("int").alias("slot"))
    )
