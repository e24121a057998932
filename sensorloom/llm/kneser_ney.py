"""Quality by perplexity: an interpolated modified Kneser-Ney model of bytes, trained on trusted texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm import common
from sensorloom.llm.common import staged

ORDER = 4  # bytes of an n-gram, at most 7
START, END = 0xFF, 0xFE  # bytes that UTF-8 does not use
SYMBOLS = 257  # what may follow: any byte or the end
BLOCK_BYTES = 8 << 20  # of text in a scoring group
HELD_OUT = 3  # one trusted text in so many is not trained on, but used for the thresholds
QUANTILE = 0.995  # of the held-out trusted texts of a language, that are to stay
SLICE = 1 << 19  # positions counted at a time
SCORE_UNIT = 1000  # scores are whole thousandths of a bit per byte


def _grams(text: bytes, order: int) -> np.ndarray:
    """The n-grams that end at each byte of the text and at its end, packed into integers, latest byte lowest."""
    data = np.frombuffer(bytes([START]) * (order - 1) + text + bytes([END]), np.uint8)
    n = len(data) - order + 1
    keys = np.zeros(n, np.int64)
    for i in range(order):
        keys = (keys << 8) | data[i:n + i]
    return keys


def _counted(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2


def _packed(batches: Iterator[pa.RecordBatch], bits: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """doc_id, lang, tie and the compressed text; with ``bits`` only those whose doc_id may be in the filter."""
    compress = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        if bits is not None:
            ids = batch.column("doc_id")
            held = common.may_hold(bits, ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64))
            batch = batch.filter(pa.array(held & ids.is_valid().to_numpy(zero_copy_only=False)))
        texts = [compress((text.as_py() or "").encode()) for text in batch.column("text")]
        others = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(texts, pa.binary())],
                                         names=[*others, "packed"])


def _count_texts(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    decompress = zstandard.ZstdDecompressor().decompress
    waiting, size = [], 0

    def counted() -> pa.RecordBatch:
        keys, n = _counted(waiting)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

    for batch in batches:
        for packed in batch.column("packed"):
            waiting.append(_grams(decompress(packed.as_py()), order))
            size += len(waiting[-1])
            if size >= SLICE:
                yield counted()
                waiting, size = [], 0
    yield counted()


def _suffix(key: str, level: int) -> Column:
    return F.col(key).bitwiseAND((1 << (8 * level)) - 1)


def discounts(counts: list[int]) -> tuple[float, float, float]:
    """The discounts of counts 1, 2 and 3 or more, from how many n-grams occur once, twice, 3 and 4 times."""
    n1, n2, n3, n4 = counts
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(found))


def model(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(level, key, p, backoff) from the counts (key, n) of n-grams of ``order``.

    ``p`` is the interpolated probability of the last byte after the others, for each n-gram seen at its level;
    ``backoff`` is the weight that a context leaves to the shorter one. Levels below the highest count the
    distinct bytes in front of an n-gram. Each level is a grouped aggregation of the one above and two joins by
    key, spread over the cluster by the n-grams; only the counts of counts, four numbers a level, are collected.
    """
    levels = {order: staged(counts.groupBy("key").agg(F.sum("n").alias("n")).where("n > 0"), "ngrams")}
    for level in range(order - 1, 0, -1):
        levels[level] = staged(
            levels[level + 1].groupBy(_suffix("key", level).alias("key")).agg(F.count("*").alias("n")), "ngrams")
    entries, below = [], None
    for level in range(1, order + 1):
        grams = levels[level]
        d1, d2, d3 = discounts(list(grams.agg(*[F.count(F.when(F.col("n") == i, 1)) for i in range(1, 5)]).first()))
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        contexts = grams.groupBy(F.shiftright("key", 8).alias("context")).agg(
            F.sum("n").alias("total"), (F.sum(discount) / F.sum("n")).alias("backoff"))
        own = grams.withColumn("context", F.shiftright("key", 8)).join(contexts, "context")
        seen = F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total")
        if below is None:
            own = own.select("key", (seen + F.col("backoff") / SYMBOLS).alias("p"))
        else:
            own = own.withColumn("shorter", _suffix("key", level - 1)).join(
                below.select(F.col("key").alias("shorter"), F.col("p").alias("q")), "shorter"
            ).select("key", (seen + F.col("backoff") * F.col("q")).alias("p"))
        below = staged(own, "level")
        entries.append(below.select(F.lit(level).alias("level"), "key", "p", F.lit(None).cast("double").alias("backoff")))
        entries.append(contexts.select(
            F.lit(level - 1).alias("level"), F.col("context").alias("key"), F.lit(None).cast("double").alias("p"), "backoff"))
    whole = entries[0]
    for entry in entries[1:]:
        whole = whole.union(entry)
    return staged(whole.groupBy("level", "key").agg(F.max("p").alias("p"), F.max("backoff").alias("backoff")), "model")


def _block_keys(block: pd.DataFrame, order: int) -> pd.DataFrame:
    """The n-grams of a block at all levels, and the contexts, each once."""
    decompress = zstandard.ZstdDecompressor().decompress
    found, waiting, size = np.zeros(0, np.int64), [], 0
    for packed in block["packed"]:
        waiting.append(_grams(decompress(packed), order))
        size += len(waiting[-1])
        if size >= SLICE:
            found, waiting, size = np.unique(np.concatenate([found, *waiting])), [], 0
    found = np.unique(np.concatenate([found, *waiting]))
    keys = {order: found}
    for level in range(order - 1, 0, -1):
        mask = (1 << (8 * level)) - 1
        keys[level] = np.unique(np.concatenate([keys[level + 1] & mask, keys[level + 1] >> 8]))
    keys[0] = np.zeros(1, np.int64)
    return pd.DataFrame({
        "block": block["block"].iloc[0], "level": np.concatenate([np.full(len(k), n, np.int32) for n, k in keys.items()]),
        "key": np.concatenate(list(keys.values()))})


def _block_scores(block: pd.DataFrame, entries: pd.DataFrame, order: int) -> pd.DataFrame:
    """Bits of each text of a block under the model: seen n-grams by table, others through the shorter ones."""
    decompress = zstandard.ZstdDecompressor().decompress
    tables = {}
    for level, part in entries.sort_values("key").groupby("level"):
        tables[level] = (part["key"].to_numpy(), part["p"].to_numpy(), part["backoff"].to_numpy())
    none = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))

    def look(level: int, keys: np.ndarray, column: int) -> np.ndarray:
        table = tables.get(level, none)
        if not len(table[0]):
            return np.full(len(keys), np.nan)
        at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
        return np.where(table[0][at] == keys, table[column][at], np.nan)

    def probability(keys: np.ndarray) -> np.ndarray:
        p = np.full(len(keys), 1.0 / SYMBOLS)
        for level in range(1, order + 1):
            own = keys & ((1 << (8 * level)) - 1)
            left = np.nan_to_num(look(level - 1, own >> 8, 2), nan=1.0)
            seen = look(level, own, 1)
            p = np.where(np.isnan(seen), left * p, seen)
        return p

    bits, sizes = [], []
    for packed in block["packed"]:
        keys, total = _grams(decompress(packed), order), 0.0
        for at in range(0, len(keys), SLICE):
            distinct, n = np.unique(keys[at:at + SLICE], return_counts=True)
            total -= float(np.log2(probability(distinct)) @ n)
        bits.append(total)
        sizes.append(len(keys) - 1)
    return pd.DataFrame({"doc_id": block["doc_id"], "lang": block["lang"], "n_bytes": sizes, "bits": bits})


def _trusted(labels: DataFrame) -> DataFrame:
    """doc_ids all of whose label rows say good quality and not toxic."""
    good = (F.coalesce("quality", F.lit(0)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return labels.where("doc_id is not null").groupBy("doc_id").agg(F.every(good).alias("good")).where("good").select("doc_id")


def _is_held_out() -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(HELD_OUT)) == 0


def classify(documents: DataFrame, labels: DataFrame, quantile: float = QUANTILE, order: int = ORDER) -> DataFrame:
    """doc_id, lang, n_bytes, score, perplexity, threshold, keep for each row of ``documents`` (doc_id, text, lang).

    The model is trained on two thirds of the trusted texts, by a hash of doc_id; ``score`` is the bits per byte
    in thousandths, ``perplexity`` is per byte. A language's threshold is the score that the given quantile of its
    held-out trusted texts does not exceed; a language without any takes that of all languages. A text
    is kept up to its threshold, or if there is no trusted text at all (threshold null).

    To score, texts are dealt to blocks of bounded size; a block's distinct n-grams are joined with the model by
    key and come back to the block's texts. A null text counts as empty; an empty text is scored by its end alone
    (as one byte). Rows without doc_id are scored but never trusted; repeated rows get equal results; a label
    whose doc_id does not occur has no effect.
    """
    documents = documents.select("doc_id", "lang", "text")
    context = documents.sparkSession.sparkContext
    trusted = _trusted(labels)
    bits = context.broadcast(common.bit_filter(trusted, "doc_id"))
    likely = documents.mapInArrow(lambda batches: _packed(batches, bits.value), "doc_id bigint, lang string, packed binary")
    counts = likely.join(trusted, "doc_id").where(~_is_held_out()).select("packed").mapInArrow(
        lambda batches: _count_texts(batches, order), "key bigint, n bigint")
    entries = model(counts, order)
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = total // BLOCK_BYTES + 1
    packed = documents.mapInArrow(
        lambda batches: _packed(batches, None), "doc_id bigint, lang string, packed binary"
    ).withColumn("block", F.pmod(F.xxhash64("doc_id", "packed"), F.lit(blocks)))

    def keys(block: pd.DataFrame) -> pd.DataFrame:
        return _block_keys(block, order)

    def scores(block: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        return _block_scores(block, found, order)

    needed = packed.groupBy("block").applyInPandas(keys, "block bigint, level int, key bigint").join(
        entries, ["level", "key"])
    scored = packed.groupBy("block").cogroup(needed.groupBy("block")).applyInPandas(
        scores, "doc_id bigint, lang string, n_bytes bigint, bits double")
    scored = staged(scored.withColumn(
        "score", F.floor(SCORE_UNIT * F.col("bits") / F.greatest("n_bytes", F.lit(1))).cast("bigint")), "scores")
    return _judged(scored, trusted, quantile)


def _limits(held: DataFrame, quantile: float) -> DataFrame:
    """(lang, threshold): the smallest score that the quantile of the language's rows does not exceed, exactly."""
    counts = held.groupBy("lang", "score").agg(F.count("*").alias("n"))
    return (
        counts.withColumn("below", F.sum("n").over(Window.partitionBy("lang").orderBy("score")))
        .withColumn("total", F.sum("n").over(Window.partitionBy("lang")))
        .where(F.col("below") >= quantile * F.col("total"))
        .groupBy("lang").agg(F.min("score").alias("threshold"))
    )


def _judged(scored: DataFrame, trusted: DataFrame, quantile: float) -> DataFrame:
    """Thresholds from the whole-number scores of held-out trusted texts, then the decision."""
    held = scored.where(_is_held_out()).join(trusted, "doc_id").select("lang", "score")
    whole = _limits(held.select(F.lit("all").alias("lang"), "score"), quantile).first()
    limit = F.lit(whole["threshold"] if whole else None).cast("bigint")
    return (
        scored.join(_limits(held.where("lang is not null"), quantile), "lang", "left")
        .withColumn("threshold", F.coalesce("threshold", limit))
        .select("doc_id", "lang", "n_bytes", "score", F.pow(F.lit(2.0), F.col("score") / SCORE_UNIT).alias("perplexity"),
                "threshold", F.coalesce(F.col("score") <= F.col("threshold"), F.lit(True)).alias("keep"))
    )
