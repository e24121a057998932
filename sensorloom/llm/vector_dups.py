"""Near duplicates of embeddings: spherical k-means cells, blocked cosine products within them, one kept a group."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import staged
from sensorloom.llm.graph import components

SIMILARITY = 0.93
CELL_ROWS = 4096  # wanted in a cell; more only where the centres would outgrow CENTRE_BYTES
CENTRE_BYTES = 16 << 20  # of all centres, which every task holds
SAMPLE = 16  # vectors a centre that the fit sees on average
ROUNDS = 10
SIGMAS = 4.0
BLOCK_ROWS = 2048
CHUNK_ROWS = 256
SLACK = 1e-6  # of angles that decide without a product

CORE, NEAR, FAR = 0, 1, 2


def _dense(column: pa.Array, dims: int) -> np.ndarray:
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    lengths = np.diff(offsets)
    if (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims))
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def _units(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """Each vector at length 1, shorter ones filled up with zeros, and a digest of it and its label; none for zero."""
    for batch in batches:
        x = _dense(batch.column("embedding"), dims)
        greatest = np.abs(x).max(axis=1, initial=0)
        able = greatest > 0
        x = x / np.where(able, greatest, 1)[:, None]  # no square leaves the range of doubles
        x = x / np.where(able, np.sqrt((x * x).sum(axis=1)), 1)[:, None] + 0.0
        units = [row.tobytes() if ok else None for row, ok in zip(x, able, strict=True)]
        digests = [hashlib.md5(label.encode() + b"\0" + u, usedforsecurity=False).digest() if u is not None else None
                   for u, label in zip(units, batch.column("label").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), batch.column("label"), pa.array(digests, pa.binary()), pa.array(units, pa.binary())],
            names=["vec_id", "label", "digest", "unit"])


def fit(sample: np.ndarray, k: int, similarity: float = SIMILARITY, seed: int = 0) -> np.ndarray:
    """At most k centres of length 1 by spherical k-means, from distinct vectors of the sample.

    Centres as similar as linked vectors become one, so that no group of close copies is cut up.
    """
    pick = np.random.default_rng(seed)
    centres = sample[pick.permutation(len(sample))[:k]]
    for _ in range(ROUNDS):
        home = np.concatenate([(sample[i:i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
        order = np.argsort(home, kind="stable")
        filled, first, sizes = np.unique(home[order], return_index=True, return_counts=True)
        sums = np.add.reduceat(sample[order], first, axis=0)
        length = np.sqrt((sums * sums).sum(axis=1))
        moved = centres.copy()
        moved[filled[length > 0]] = sums[length > 0] / length[length > 0][:, None]
        rank = np.zeros(len(moved), np.int64)
        rank[filled] = sizes
        moved = _apart(moved[np.argsort(-rank, kind="stable")], similarity)
        if moved.shape == centres.shape and np.allclose(moved, centres, atol=1e-6):
            break
        centres = moved
    return centres


def _apart(centres: np.ndarray, similarity: float) -> np.ndarray:
    """The centres without those that are as similar as that to an earlier one that stays."""
    close = centres @ centres.T >= similarity
    stays = np.ones(len(centres), bool)
    for i in range(len(centres)):
        if stays[i]:
            stays[i + 1:] &= ~close[i, i + 1:]
    return centres[stays]


def _margin(dims: int, similarity: float) -> float:
    """How near the plane between two cells a vector must be to be compared in both.

    Linked vectors are at most a chord apart. If none of two linked vectors is within half that chord of the
    plane, both are on one side, so that much is exact in any number of dimensions. Where it is less, the
    margin is SIGMAS standard deviations of a chord's share in one of many directions.
    """
    chord = np.sqrt(2 - 2 * similarity)
    return chord / 2 * min(1.0, SIGMAS / np.sqrt(max(1, dims)))


def _assigned(batches: Iterator[pa.RecordBatch], centres: dict[str, np.ndarray], dims: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """A row for each vector in its home cell and one for each cell that it visits, with its zone there.

    Zones go by the angle to the cell's centre: half the angle of a link makes a vector of the core, as any two
    of these are linked for sure; beyond three halves (FAR) none of the core can be linked with it.
    """
    link = np.arccos(similarity)
    margin = _margin(dims, similarity)
    gaps = {label: np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0)) for label, c in centres.items()}
    for batch in batches:
        labels = np.array(batch.column("label").to_pylist(), object)
        units = np.frombuffer(b"".join(batch.column("unit").to_pylist()), np.float64).reshape(-1, dims)
        parts = []
        for label in set(labels):
            rows = np.flatnonzero(labels == label)
            if label not in centres:
                parts.append((rows, np.zeros(len(rows), int), np.zeros(len(rows), int), np.full(len(rows), FAR), [[]] * len(rows)))
                continue
            near = units[rows] @ centres[label].T
            home = near.argmax(axis=1)
            best = near[np.arange(len(rows)), home][:, None]
            visits = best - near <= margin * gaps[label][home]
            visits[np.arange(len(rows)), home] = False
            visited = [np.flatnonzero(v).tolist() for v in visits]
            angle = np.arccos(np.clip(near, -1, 1))
            zone = np.where(angle <= link / 2 - SLACK, CORE, np.where(angle <= 1.5 * link + SLACK, NEAR, FAR))
            parts.append((rows, home, home, zone[np.arange(len(rows)), home], visited))
            guest, cell = np.nonzero(visits)
            parts.append((rows[guest], home[guest], cell, np.maximum(zone[guest, cell], NEAR), [[]] * len(guest)))
        rows, home, cell, zone = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, int) for i in range(4))
        visited = [v for p in parts for v in p[4]]
        kept = batch.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*(kept.column(c) for c in ("label", "digest", "node", "weight", "unit")), pa.array(home, pa.int32()), pa.array(cell, pa.int32()),
             pa.array(zone, pa.int32()), pa.array(visited, pa.list_(pa.int32()))],
            names=["label", "digest", "node", "weight", "unit", "home", "cell", "zone", "visits"])


def _united(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The forest ``roots`` (each index to its smallest) with the links a-b added."""
    while True:
        x, y = roots[a], roots[b]
        if (x == y).all():
            return roots
        np.minimum.at(roots, np.maximum(x, y), np.minimum(x, y))
        while not (roots == roots[roots]).all():
            roots = roots[roots]


FOUND = "digest binary, links bigint, a bigint, b bigint"


def _compared(group: pd.DataFrame, dims: int, similarity: float) -> pd.DataFrame:
    """Links between the two blocks of the group (or in its only one), as counts and a spanning forest.

    Two guests of a cell are compared at home. A pair in which both visit each other's cell counts in the
    smaller one.
    """
    group = group.sort_values("node", kind="stable", ignore_index=True)
    units = np.frombuffer(b"".join(group["unit"]), np.float64).reshape(-1, dims)
    cell, home, weight = int(group["cell"].iloc[0]), group["home"].to_numpy(), group["weight"].to_numpy()
    left = np.flatnonzero(group["side"].to_numpy() == 0)
    right = np.flatnonzero(group["side"].to_numpy() == 1)
    single = not group["two"].iloc[0]
    if single:
        right = left
    links, roots = np.zeros(len(group), np.int64), np.arange(len(group))
    elsewhere = {h: np.array([h in v for v in group["visits"]]) for h in np.unique(home) if h < cell}
    for i in range(0, len(left), CHUNK_ROWS):
        mine = left[i:i + CHUNK_ROWS]
        linked = units[mine] @ units[right].T >= similarity
        if single:
            linked &= right[None, :] > mine[:, None]
        linked &= (home[mine] == cell)[:, None] | (home[right] == cell)[None, :]
        for h, there in elsewhere.items():
            linked &= ~(there[mine][:, None] & (home[right] == h)[None, :])
            linked &= ~((home[mine] == h)[:, None] & there[right][None, :])
        links[mine] += linked @ weight[right]
        links[right] += weight[mine] @ linked
        a, b = np.nonzero(linked)
        roots = _united(roots, mine[a], right[b])
    found = links > 0
    node = group["node"].to_numpy()
    return pd.DataFrame({"digest": group["digest"][found], "links": links[found], "a": node[found], "b": node[roots[found]]})


def _blocks(n: Column) -> Column:
    return F.greatest(F.ceil(n / BLOCK_ROWS), F.lit(1)).cast("int")


def _dealt(rows: DataFrame, kind: int, mine: str, others: str, pairs: bool) -> DataFrame:
    """Each row of one side once for every block of the other side (of its own, where ``pairs``)."""
    own = F.pmod(F.xxhash64("digest"), F.col(mine)).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.expr(f"sequence(0, {others} - 1)"))).withColumn("kind", F.lit(kind))
    if pairs:
        return dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"), "two": F.col("own") != F.col("other"),
                                  "side": (F.col("own") > F.col("other")).cast("int")})
    core = F.col("zone") == CORE
    return dealt.withColumns({"i": F.when(core, F.col("own")).otherwise(F.col("other")), "j": F.when(core, F.col("other")).otherwise(F.col("own")),
                              "two": F.lit(True), "side": (~core).cast("int")})


def groups(vectors: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label, any others).

    Rows are linked when their labels are equal and their cosine, in double precision, is at least ``similarity``.
    Null, empty or zero vectors, those with a null or non-finite entry, and rows without label or vec_id link with
    nothing (without vec_id the component is null). A shorter vector counts as filled up with zeros. Equal
    vectors of a label are one class, compared once and counted as often as they occur; repeated rows are
    vectors of their own. The component is the smallest vec_id reachable, and its row is kept.

    Labels with more than CELL_ROWS classes are cut into cells; centres are fitted on a sample of about SAMPLE
    classes a centre and CENTRE_BYTES in all, and every class is assigned. Classes near the plane between two cells
    visit the other one. Cores of cells need no product: a group of close copies of any size costs one sum. All
    others are compared in pairs of blocks of about BLOCK_ROWS.
    """
    x = F.col("embedding").cast("array<double>")
    able = (
        F.coalesce(F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))) & (F.size(x) > 0), F.lit(False))
        & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    )
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.when(able, x).alias("embedding"))
    whole, alone = rows.where("embedding is not null"), rows.where("embedding is null").select("vec_id")
    dims = whole.agg(F.max(F.size("embedding"))).first()[0] or 1
    signed = staged(whole.mapInArrow(partial(_units, dims=dims), "vec_id bigint, label string, digest binary, unit binary"), "units")
    classes = staged(
        signed.where("digest is not null").groupBy("digest")
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("unit").alias("unit")),
        "vector-classes")
    centres = _centres(classes, dims, similarity)
    placed = staged(classes.mapInArrow(
        partial(_assigned, centres=centres, dims=dims, similarity=similarity),
        "label string, digest binary, node bigint, weight bigint, unit binary, home int, cell int, zone int, visits array<int>"), "cells")
    found = staged(_links(placed, dims, similarity), "vector-links")
    links = found.groupBy("digest").agg(F.sum("links").alias("links"))
    joined = components(found.select("a", "b"))
    result = (
        signed.select("vec_id", "digest").join(classes.select("digest", "node", "weight"), "digest", "left")
        .join(links, "digest", "left").join(joined, "node", "left")
        .select("vec_id", F.coalesce(F.col("weight") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links"),
                F.coalesce("component", "node", "vec_id").alias("component_id"))
        .unionByName(alone.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")))
    )
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _centres(classes: DataFrame, dims: int, similarity: float) -> dict[str, np.ndarray]:
    """The centres of the labels that have more than one cell: CENTRE_BYTES at most, whatever the input."""
    total = classes.count()
    rows = max(CELL_ROWS, -(-2 * total * dims * 8 // CENTRE_BYTES))
    wanted = classes.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") > rows)
    wanted = wanted.withColumn("k", F.ceil(F.col("n") / rows).cast("int"))  # at most 2 * total / rows centres in all
    share = F.pmod(F.xxhash64("digest"), F.lit(1 << 20)) < F.least(F.col("k") * SAMPLE / F.col("n"), F.lit(1.0)) * (1 << 20)
    sample = classes.select("label", "digest", "unit").join(wanted, "label").where(share)

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("digest")
        units = np.frombuffer(b"".join(ordered["unit"]), np.float64).reshape(-1, dims)
        return pd.DataFrame({"label": [group["label"].iloc[0]], "centres": [fit(units, int(group["k"].iloc[0]), similarity).tobytes()]})

    found = sample.groupBy("label").applyInPandas(fitted, "label string, centres binary").toArrow().to_pylist()
    return {r["label"]: np.frombuffer(r["centres"], np.float64).reshape(-1, dims) for r in found}


def _links(placed: DataFrame, dims: int, similarity: float) -> DataFrame:
    """Counts and forests of the links in all cells, cores by their sums and the others by products."""
    cell = ["label", "cell"]
    counts = placed.groupBy(*cell).agg(
        F.count_if(F.col("zone") != CORE).alias("n_outer"), F.count_if(F.col("zone") == NEAR).alias("n_near"),
        F.count_if(F.col("zone") == CORE).alias("n_core"), F.sum(F.when(F.col("zone") == CORE, F.col("weight"))).alias("core_weight"),
        F.min(F.when(F.col("zone") == CORE, F.col("node"))).alias("core_node"))
    counts = staged(counts, "cell-sizes")
    cores = placed.where(F.col("zone") == CORE).select(*cell, "digest", "node", "weight").join(counts, cell)
    sure = cores.where("n_core > 1").select("digest", (F.col("core_weight") - F.col("weight")).alias("links"),
                                            F.col("node").alias("a"), F.col("core_node").alias("b"))
    sized = placed.join(counts.select(*cell, "n_near", "n_core", _blocks(F.col("n_outer")).alias("outer_blocks"),
                                      _blocks(F.col("n_near")).alias("near_blocks"), _blocks(F.col("n_core")).alias("core_blocks")), cell)
    outer = sized.where(F.col("zone") != CORE)
    rim = sized.where("n_near > 0 and n_core > 0")
    keys = [*cell, "kind", "i", "j"]
    dealt = (
        _dealt(outer, 0, "outer_blocks", "outer_blocks", True)
        .unionByName(_dealt(rim.where(F.col("zone") == CORE), 1, "core_blocks", "near_blocks", False))
        .unionByName(_dealt(rim.where(F.col("zone") == NEAR), 1, "near_blocks", "core_blocks", False))
        .select(*keys, "two", "side", "digest", "node", "weight", "unit", "home", "visits")
    )

    def compared(group: pd.DataFrame) -> pd.DataFrame:
        return _compared(group, dims, similarity)

    return sure.unionByName(dealt.groupBy(*keys).applyInPandas(compared, FOUND))
