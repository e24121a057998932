"""Near duplicates: fast similarity sketches, banding, and an exact check on the full shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm import common
from sensorloom.llm.common import bit_filter, free_name, may_hold, mix, staged
from sensorloom.llm.graph import components

SHINGLE = 5
BINS = 512  # coordinates of a sketch
MISSED = 1e-8  # greatest chance that two sets at the similarity bound share no band
BLOCK_SHINGLES = 1_000_000  # of one side of a verifying task
VALUE_BITS = 50

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = common.text_bytes(column)
    data = _LOWER[data]
    starts, ends = common.runs(~_SPACE[data], offsets)
    words = common.word_hashes(data, starts, ends)
    bounds = np.searchsorted(starts, offsets)
    windows = common.window_hashes(words, SHINGLE)
    sets = []
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        if last - first >= SHINGLE:
            sets.append(np.unique(windows[first:last - SHINGLE + 1]))
        elif last > first:
            sets.append(common.window_hashes(words[first:last], last - first) ^ np.uint64(last - first))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A fast similarity sketch for each set, none of them empty.

    Round i < BINS throws every element into a hashed bin, round BINS + k throws all into bin k; a bin keeps
    the least value of the first round that reached it. So every bin is filled after 2 * BINS rounds at most,
    usually after few, and sets drop out as soon as theirs are full.
    """
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    sketch = np.full((len(sets), BINS), full)
    flat = sketch.reshape(-1)
    active = np.arange(len(sets))
    sizes = np.array([len(s) for s in sets], np.int64)
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owners = np.repeat(active, sizes)
    low = np.uint64((1 << VALUE_BITS) - 1)
    for turn in range(2 * BINS):
        if not len(active):
            break
        hashed = mix(elements ^ mix(np.uint64([turn + 1])))
        if turn < BINS:
            bins = (hashed >> np.uint64(64 - 9)).astype(np.int64)
            slot, value = owners * BINS + bins, (hashed & low) | np.uint64(turn << VALUE_BITS)
        else:
            open_bin = sketch[owners, turn - BINS] == full
            slot = owners[open_bin] * BINS + turn - BINS
            value = (hashed[open_bin] & low) | np.uint64(turn << VALUE_BITS)
        np.minimum.at(flat, slot, value)
        still = (sketch[active] == full).any(axis=1)
        if not still.all():
            active = active[still]
            chosen = np.zeros(len(sets), bool)
            chosen[active] = True
            keep = chosen[owners]
            elements, owners = elements[keep], owners[keep]
    return sketch


def rows_per_band(percent: int) -> int:
    """The longest bands that still meet MISSED: 8 rows for 85 percent, 6 for 80."""
    able = [r for r in range(1, 17) if (1 - (percent / 100) ** r) ** (BINS // r) <= MISSED]
    return max(able, default=1)


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    bands = BINS // rows
    parts = sketch[:, :bands * rows].reshape(len(sketch), bands, rows)
    key = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key


def _signed(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        sets = shingle_sets(batch.column("text"))
        filled = [i for i, s in enumerate(sets) if len(s)]
        keys: list = [None] * len(sets)
        for i, row in zip(filled, band_keys(sketches([sets[i] for i in filled]), rows), strict=True):
            keys[i] = row.view(np.int64)
        digests = [hashlib.md5(s.tobytes(), usedforsecurity=False).digest() if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
            names=["doc_id", "text_key", "n_shingles", "digest", "keys"])


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        packed = [s.tobytes() for s in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("candidate"), batch.column("node"), batch.column("blocks"), pa.array(packed, pa.binary())],
            names=["candidate", "node", "blocks", "shingles"])


def _forest(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Verified links of one block pair that join its documents, at most one less than there are documents."""
    rows = [(node, block, np.frombuffer(s, np.uint64))
            for node, block, s in zip(group["node"], group["block"], group["shingles"], strict=True)]
    rows.sort(key=lambda r: (len(r[2]), r[0]))
    nodes = np.array([r[0] for r in rows], np.int64)
    sizes = np.array([len(r[2]) for r in rows], np.int64)
    values, flat = np.unique(np.concatenate([r[2] for r in rows]), return_inverse=True)
    owners = np.repeat(np.arange(len(rows)), sizes)
    order = np.argsort(flat, kind="stable")
    postings, begins = owners[order], np.searchsorted(flat[order], np.arange(len(values) + 1))
    ends_of = np.cumsum(sizes)
    parent = np.arange(len(rows))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for i in range(1, len(rows)):
        low = int(np.searchsorted(sizes, -(-sizes[i] * percent // 100)))  # shorter sets cannot reach the similarity
        if low >= i:
            continue
        mine = flat[ends_of[i] - sizes[i]:ends_of[i]]
        found = np.concatenate([postings[begins[v]:begins[v + 1]] for v in mine])
        shared = np.bincount(found[(found >= low) & (found < i)] - low, minlength=i - low)
        for j in np.flatnonzero(100 * shared >= percent * (sizes[i] + sizes[low:i] - shared)) + low:
            a, b = root(i), root(int(j))
            if a != b:
                parent[a] = b
                links.append((nodes[i], nodes[j]))
    return pd.DataFrame(links, columns=["a", "b"]).astype("int64")


def groups(documents: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``documents`` (doc_id, text, any others).

    A set holds the distinct word 5-grams of the whole text; documents are linked when their sets' similarity is
    at least ``percent``, checked on the full sets. Texts of equal sets are one class, of which only the one with the
    smallest doc_id goes on. All classes that share a band are candidates of each other; each set of candidates
    is checked in pairs of blocks of bounded size, and only the links that join it are kept.

    Null or empty texts have no shingles and stand alone, as do rows without doc_id (their component is null).
    A row is judged by its own text, so repeated rows get the same result, and rows that share an id but no text
    are linked apart.
    """
    return _grouped(documents, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _grouped(documents: DataFrame, percent: int) -> DataFrame:
    """The rows of ``groups`` with ``text_key``, a hash of the text, and ``group``, which names the component.

    A node of the graph is a class: the smallest doc_id of its rows, or, where that is another class's as well
    because rows repeat an id with other texts, a hash of its set.
    """
    def forest(group: pd.DataFrame) -> pd.DataFrame:
        return _forest(group, percent)

    documents = documents.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    signed = staged(documents.mapInArrow(
        partial(_signed, rows=rows_per_band(percent)),
        "doc_id bigint, text_key bigint, n_shingles bigint, digest binary, keys array<bigint>"), "signed")
    able = signed.where("doc_id is not null and digest is not null")
    same_id = Window.partitionBy("least").orderBy("digest")
    classes = staged(
        able.groupBy("digest").agg(F.min("doc_id").alias("least")).withColumn("turn", F.row_number().over(same_id))
        .select("digest", "least", F.when(F.col("turn") == 1, F.col("least")).otherwise(F.xxhash64("digest")).alias("node")), "named")
    first = (
        able.select("digest", F.col("doc_id").alias("least"), "text_key", "n_shingles", "keys").join(classes, ["digest", "least"])
        .dropDuplicates(["digest", "least"])
    )
    first = staged(first.select("node", "least", "text_key", "n_shingles", "keys"), "classes")
    banded = first.select("node", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot < last")
    near = components(banded.join(shared.drop("last"), "key").select("node", "pivot"))
    candidates = staged(near.withColumnRenamed("component", "candidate"), "candidates")
    sized = candidates.join(first.select("node", F.col("least").alias("doc_id"), "text_key", "n_shingles"), "node")
    blocks = sized.groupBy("candidate").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    member = sized.drop("n_shingles").join(blocks, "candidate")
    sets = (
        documents.join(member, ["doc_id", "text_key"]).select("candidate", "node", "blocks", "text")
        .mapInArrow(_with_sets, "candidate bigint, node bigint, blocks int, shingles binary")
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    )
    links = sets.select("candidate", "i", "j", "node", "block", "shingles").groupBy("candidate", "i", "j").applyInPandas(
        forest, "a bigint, b bigint")
    joined = staged(components(links), "joined")
    least = joined.join(classes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("component_id"))
    return (
        signed.select("doc_id", "text_key", "n_shingles", "digest").join(classes, "digest", "left")
        .join(joined.join(least, "component"), "node", "left")
        .select("doc_id", "text_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node")).alias("group"),
                F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "least", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def keep_first(documents: DataFrame, percent: int = 80) -> DataFrame:
    """One document of each group of near duplicates: the one of smallest doc_id. Columns stay as they are.

    A row is judged by its id and text together, so that rows which share an id but no text are judged apart; of
    several texts of a group under its smallest id, one stays. Rows that repeat both id and text stay once, by the
    least hash of all columns. Texts without words stand alone, as do rows without id. Only rows that go or repeat,
    found by a bit filter of fixed size, are shuffled with their texts.
    """
    judged = staged(_grouped(documents, percent), "judged")
    keepers = judged.where("kept and group is not null").groupBy("group").agg(F.min("text_key").alias("keeper"))
    stays = F.col("group").isNull() | (F.col("kept") & (F.col("text_key") == F.col("keeper")))
    marked = judged.join(keepers, "group", "left").groupBy("doc_id", "text_key").agg(
        F.count("*").alias("n"), F.max(stays).alias("stays")).where("n > 1 or not stays")
    key, stay, turn, its_id, its_key = (free_name(documents, name) for name in ("text_key", "stays", "turn", "its_id", "its_key"))
    marked = staged(marked.select(F.col("doc_id").alias(its_id), F.col("text_key").alias(its_key), F.col("stays").alias(stay)), "marked")
    places = marked.select(F.xxhash64(its_id, its_key).alias("place"))
    bits = documents.sparkSession.sparkContext.broadcast(bit_filter(places, "place"))

    @F.pandas_udf("boolean")
    def maybe(place: pd.Series) -> pd.Series:
        return pd.Series(may_hold(bits.value, place.to_numpy().view(np.uint64)))

    keyed = documents.withColumn(key, F.xxhash64("text"))
    asked = maybe(F.xxhash64("doc_id", key))
    on = F.col("doc_id").eqNullSafe(F.col(its_id)) & (F.col(key) == F.col(its_key))
    same = Window.partitionBy("doc_id", key).orderBy(F.xxhash64(*documents.columns))
    rest = (
        keyed.where(asked).join(marked, on, "left").where(F.coalesce(stay, F.lit(True)))
        .withColumn(turn, F.row_number().over(same)).where(F.col(turn) == 1)
    )
    return keyed.where(~asked).select(*documents.columns).union(rest.select(*documents.columns))
