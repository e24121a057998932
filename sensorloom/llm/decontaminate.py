"""Benchmark decontamination by greedy string tiling on shared-token seeds."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm import common
from sensorloom.llm.common import free_name, staged

SEED = 5  # words of a seed, and of the shortest tile
COVERAGE = 0.5  # of an item's words in tiles, from which a document is contaminated

# Bytes of words: letters, digits and everything that is not ASCII. Case and punctuation do not count.
_WORD = np.zeros(256, bool)
_WORD[[*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, and where each row's begin."""
    data, offsets = common.text_bytes(column)
    data = _LOWER[data]
    starts, ends = common.runs(_WORD[data], np.union1d(offsets, _single(data)) if len(data) else offsets)
    return common.word_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def _single(data: np.ndarray) -> np.ndarray:
    """Where letters of scripts without spaces begin and end: each is a word."""
    lead = np.flatnonzero(data >= 0xE0)
    if not len(lead):
        return lead
    second = data[np.minimum(lead + 1, len(data) - 1)]
    first = data[lead]
    three = ((first >= 0xE3) & (first <= 0xE9)) | ((first == 0xE0) & (second >= 0xB8) & (second <= 0xBB)) | (
        (first == 0xE1) & (((second >= 0x80) & (second <= 0x82)) | (second == 0x9E) | (second == 0x9F)))
    four = (first == 0xF0) & (second >= 0xA0) & (second <= 0xB3)
    begins, sizes = lead[three | four], np.where(four, 4, 3)[three | four]
    return np.union1d(begins, np.minimum(begins + sizes, len(data)))


def _rows(bounds: np.ndarray, width: int) -> Iterator[tuple[int, int, int]]:
    for row, (first, last) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        yield row, first, max(first, last - width + 1)


def _windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows of a size; those of other sizes than SEED are told apart."""
    return common.window_hashes(words, size) ^ np.uint64(0 if size == SEED else size)


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item_id, its words, and its seeds: the windows of SEED words, or one of all words if there are fewer."""
    for batch in batches:
        words, bounds = _words(batch.column("text"))
        ids, texts, seeds = [], [], []
        for row, (first, last) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if last > first:
                own = words[first:last]
                ids.append(batch.column("item_id")[row].as_py())
                texts.append(own.view(np.int64))
                seeds.append(_windows(own, min(SEED, len(own))).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(texts, pa.list_(pa.int64())), pa.array(seeds, pa.list_(pa.int64()))],
            names=["item_id", "words", "seeds"])


def _seeded(batches: Iterator[pa.RecordBatch], bits: np.ndarray, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """text_key of the texts that may share a seed of one of the sizes, with their words and those seeds."""
    for batch in common.slices(batches):
        words, bounds = _words(batch.column("text"))
        found: dict[int, list[np.ndarray]] = {}
        for size in sizes:
            windows = _windows(words, size)
            hits = common.may_hold(bits, windows)
            for row, first, last in _rows(bounds, size):
                if hits[first:last].any():
                    found.setdefault(row, []).append(windows[first:last][hits[first:last]])
        rows = sorted(found)
        texts = [words[bounds[row]:bounds[row + 1]].view(np.int64) for row in rows]
        seeds = [np.unique(np.concatenate(found[row])).view(np.int64) for row in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("text_key").take(pa.array(rows, pa.int64())), pa.array(texts, pa.list_(pa.int64())),
             pa.array(seeds, pa.list_(pa.int64()))], names=["text_key", "words", "seeds"])


def _hashed_windows(words: np.ndarray, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Karp-Rabin hashes of the windows of ``length`` words that hold no marked word, with their starts.

    The hash is a polynomial over 64 bits; the windows' values come from prefix sums, so that any length costs the same.
    """
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    powers = common._powers(common._BASE, len(words))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers)])
    inverse = common._powers(pow(common._BASE, -1, 1 << 64), len(words))
    marked = np.concatenate([[0], np.cumsum(~free)])
    starts = np.flatnonzero(marked[length:] == marked[:n])
    return (sums[starts + length] - sums[starts]) * inverse[starts], starts


def tiles(document: np.ndarray, item: np.ndarray, shortest: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in document, start in item, length) of tiles, longest first, none overlapping.

    Each turn finds the greatest length at which unmarked windows of both agree, by their Karp-Rabin hashes and
    then word by word, marks them from left to right, and goes on until no match of ``shortest`` words is left.
    Windows of the item wait in a queue for each hash, so that repetitive texts cost no more than others.
    """
    free_d, free_i, found = np.ones(len(document), bool), np.ones(len(item), bool), []

    def meets(length: int) -> bool:
        return bool(np.isin(_hashed_windows(item, free_i, length)[0], _hashed_windows(document, free_d, length)[0]).any())

    def mark(length: int) -> None:
        """From left to right, each window of the document with the leftmost free one of the item that agrees."""
        places: dict[int, deque[int]] = {}
        for value, start in zip(*(x.tolist() for x in _hashed_windows(item, free_i, length)), strict=True):
            places.setdefault(value, deque()).append(start)
        here, begins = _hashed_windows(document, free_d, length)
        shared = np.isin(here, np.fromiter(places, np.uint64, len(places)))
        end = 0
        for value, d in zip(here[shared].tolist(), begins[shared].tolist(), strict=True):
            waiting = places[value]
            if d < end or not waiting:
                continue
            while waiting and not (free_i[waiting[0]] and free_i[waiting[0]:waiting[0] + length].all()):
                waiting.popleft()  # a window with a marked word is never free again
            if waiting and np.array_equal(document[d:d + length], item[waiting[0]:waiting[0] + length]):
                i, end = waiting.popleft(), d + length
                free_d[d:end] = free_i[i:i + length] = False
                found.append((d, i, length))

    longest = min(len(document), len(item))
    while longest >= shortest:
        low, high, best = shortest, longest, 0
        while low <= high:  # a match of some length implies one of every smaller length
            middle = (low + high) // 2
            if meets(middle):
                low, best = middle + 1, middle
            else:
                high = middle - 1
        if not best:
            break
        mark(best)
        longest = best - 1  # no two windows of that length are left
    return found


def _tiled(batches: Iterator[pd.DataFrame], coverage: float) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for key, item_id, document, item in zip(
                batch["text_key"], batch["item_id"], batch["words"], batch["item_words"], strict=True):
            document, item = (np.asarray(w, np.int64).view(np.uint64) for w in (document, item))
            found = tiles(document, item, min(SEED, len(item)))
            covered = sum(t[2] for t in found) / len(item)
            if covered >= coverage:
                out.append((key, item_id, len(found), covered))
        yield pd.DataFrame(out, columns=["text_key", "item_id", "n_tiles", "coverage"])


def leaks(documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, n_tiles, coverage: the pairs in which the document holds ``coverage`` of the item's words.

    Words are runs of letters and digits, ASCII letters in lower case. Seeds of five words that occur in both
    are joined; an item whose words in shared seeds do not reach the coverage is left out, as tiles consist of
    such words; the others are tiled on whole texts, in whatever order their passages stand. Each distinct text
    is tiled once, for all rows that hold it.

    An item of fewer than five words is found where all of it stands in a row. In scripts that write no spaces
    (Chinese, Japanese, Thai, Lao, Burmese, Khmer) each letter is a word. Null or empty texts are in no pair.
    Rows without doc_id are in the result with a null one; rows that repeat an item_id with another text are items of their own.
    """
    found = _leaking_texts(documents, benchmark, coverage)
    keyed = documents.select("doc_id", F.md5("text").alias("text_key"))
    return keyed.join(found, "text_key").select("doc_id", "item_id", "n_tiles", "coverage")


def _leaking_texts(documents: DataFrame, benchmark: DataFrame, coverage: float) -> DataFrame:
    items = staged(
        benchmark.select("item_id", "text").mapInArrow(
            _item_words, "item_id bigint, words array<bigint>, seeds array<bigint>")
        .withColumn("item_key", F.xxhash64("item_id", "words")).dropDuplicates(["item_key"]), "items")
    at_item = items.select("item_key", F.posexplode("seeds").alias("at", "seed"))
    spark = documents.sparkSession
    bits = spark.sparkContext.broadcast(common.bit_filter(at_item, "seed"))  # 8 MB for any benchmark
    size = F.least(F.lit(SEED), F.size("words")).alias("size")
    sizes = sorted(r["size"] for r in items.select(size).distinct().collect())  # 1 to SEED
    texts = staged(
        documents.where("text is not null").select(F.md5("text").alias("text_key"), "text")
        .mapInArrow(lambda batches: _seeded(batches, bits.value, sizes),
                    "text_key string, words array<bigint>, seeds array<bigint>")
        .dropDuplicates(["text_key"]), "texts")
    reached = (
        texts.select("text_key", F.explode("seeds").alias("seed")).join(at_item, "seed")
        .groupBy("text_key", "item_key").agg(F.sort_array(F.collect_set("at")).alias("at"))
    )
    # Words of the item in shared seeds: each start adds SEED words less what the next start covers again.
    bound = F.aggregate(
        "at", F.struct(F.lit(-SEED).alias("last"), F.lit(0).alias("n")),
        lambda s, a: F.struct(a.alias("last"), (s["n"] + F.least(F.lit(SEED), a - s["last"])).alias("n")), lambda s: s["n"])
    able = (
        reached.withColumn("bound", bound)
        .join(items.select("item_key", "item_id", F.col("words").alias("item_words")), "item_key")
        .where(F.col("bound") >= coverage * F.size("item_words"))
        .select("text_key", "item_id", "item_words")
    )
    pairs = able.join(texts.select("text_key", "words"), "text_key").select("text_key", "item_id", "words", "item_words")
    return staged(pairs.mapInPandas(
        partial(_tiled, coverage=coverage), "text_key string, item_id bigint, n_tiles bigint, coverage double"), "leaks")


def without_leaks(documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The documents that are in no pair of ``leaks``; rows with a null text stay. Columns stay as they are."""
    leaking = free_name(documents, "leaking")
    gone = _leaking_texts(documents, benchmark, coverage).select(F.col("text_key").alias(leaking)).distinct()
    return documents.join(gone, F.md5("text") == F.col(leaking), "left_anti")
