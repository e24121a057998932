"""Secrets in whole texts: three patterns, and high-entropy strings by sliding windows. Built-in functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import free_name

PLACEHOLDER = "[SECRET]"
BLOCK = 256  # matches whose positions are added up in one list; lists of lists keep long results linear

# The kinds and patterns of the query's contract, in its order.
KEYWORDS = ("password", "passwd", "secret", "token")


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" for c in word)


ASSIGN = (
    f"({'|'.join(map(_either_case, KEYWORDS))}|{_either_case('api')}_?{_either_case('key')})"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 8
# A maximal run matched by `+` and then held against a least length is the run of at least that length.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"

# Character classes of candidate strings: kind, characters, window, least entropy in bits per character.
CLASSES = (
    ("entropy_hex", "0-9A-Fa-f", 20, 3.0),
    ("entropy_base64", "A-Za-z0-9+/_-", 24, 4.0),
)
KINDS = ("assign", "access", "hex", *(c[0] for c in CLASSES))
SCALE = 1_000_000  # c * log2(c) in whole millionths, so that sums are exact

# Strings that look random and are known not to be secret. A candidate that one of them matches is left out.
ALLOWED = (
    "^[A-Za-z+/_-]*$",  # no digit: words, paths
    "^[0-9+/_-]*$",  # no letter: numbers, dates
    "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",  # UUID
    "^(0123456789abcdef|0123456789ABCDEF)+$",
    "EXAMPLE|example",  # keys of documentation
)


def _terms(window: int) -> list[int]:
    return [round(c * math.log2(c) * SCALE) if c else 0 for c in range(window + 1)]


def _limit(window: int, bits: float) -> int:
    """The greatest sum of c * log2(c) over a window's counts c at which its entropy still is ``bits``."""
    return math.floor(window * (math.log2(window) - bits) * SCALE)


def _positions(text: Column, pattern: str) -> Column:
    """(start, end) of each match, from the lengths of the matches and of the pieces between them."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(found, F.slice(between, 1, F.size(found)),
                       lambda m, p: F.struct(F.length(p).alias("gap"), F.length(m).alias("len")))
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(state: Column, x: Column) -> Column:
        start = state["pos"] + x["gap"]
        return F.struct((start + x["len"]).alias("pos"), F.array_append(
            state["spans"], F.struct(start.alias("start"), (start + x["len"]).alias("end"))).alias("spans"))

    def block(state: Column, at: Column) -> Column:
        inner = F.aggregate(F.slice(steps, at, BLOCK), F.struct(state["pos"].alias("pos"), empty.alias("spans")), step)
        return F.struct(inner["pos"].alias("pos"), F.array_append(state["lists"], inner["spans"]).alias("lists"))

    starts = F.sequence(F.lit(1), F.size(steps), F.lit(BLOCK))
    begin = F.struct(F.lit(0).alias("pos"), F.array().cast("array<array<struct<start:int,end:int>>>").alias("lists"))
    return F.flatten(F.aggregate(starts, begin, block)["lists"])


def _kinded(kind: str, spans: Column, present: Column) -> Column:
    order = KINDS.index(kind)
    listed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))
    return F.coalesce(F.when(present, listed), F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>"))


def _hot(candidate: Column, characters: str, window: int, bits: float) -> Column:
    """Start of the first and of the last window of high entropy, null if there is none.

    The state holds the count of each character in the window and the sum of c * log2(c); one step lets a
    character in and, from the second window on, one out.
    """
    terms = F.array(*[F.lit(t) for t in _terms(window)])

    def step(s: Column, i: Column) -> Column:
        enter = F.ascii(F.substring(candidate, i, F.lit(1)))
        leave = F.when(i > window, F.ascii(F.substring(candidate, i - window, F.lit(1)))).otherwise(-1)
        kept = F.when(leave >= 0, s["sum"] + F.get(terms, F.get(s["counts"], leave) - 1)
                      - F.get(terms, F.get(s["counts"], leave))).otherwise(s["sum"])
        before = F.get(s["counts"], enter) - F.when(leave == enter, 1).otherwise(0)
        total = kept + F.get(terms, before + 1) - F.get(terms, before)
        counts = F.transform(s["counts"], lambda c, k: c + F.when(k == enter, 1).otherwise(0)
                             - F.when(k == leave, 1).otherwise(0))
        hot = (i >= window) & (total <= _limit(window, bits))
        return F.struct(
            counts.alias("counts"), total.alias("sum"),
            F.coalesce(s["first"], F.when(hot, i - window)).alias("first"),
            F.when(hot, i - window).otherwise(s["last"]).alias("last"))

    begin = F.struct(
        F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0).cast("int").alias("sum"),
        F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))
    return F.aggregate(F.sequence(F.lit(1), F.length(candidate)), begin, step)


def _entropy_spans(text: Column, characters: str, window: int, bits: float) -> Column:
    """Spans from the first to the end of the last window of high entropy, in runs of one character class."""
    pattern = _candidates(characters, window)
    runs = F.zip_with(_positions(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                      lambda p, m: F.struct(p["start"].alias("start"), m.alias("text")))
    open_runs = F.filter(runs, lambda r: ~r["text"].rlike("|".join(ALLOWED)))
    windows = F.transform(open_runs, lambda r: F.struct(
        r["start"].alias("start"), _hot(r["text"], characters, window, bits).alias("hot")))
    return F.transform(
        F.filter(windows, lambda w: w["hot"]["first"].isNotNull()),
        lambda w: F.struct((w["start"] + w["hot"]["first"]).alias("start"),
                           (w["start"] + w["hot"]["last"] + window).alias("end")))


def _candidates(characters: str, window: int) -> str:
    """Maximal runs of the class that hold a digit (without one they are on the allow-list)."""
    return f"(?<![{characters}])(?=[{characters.replace('0-9', '')}]*[0-9])[{characters}]{{{window},}}"


def scan(documents: DataFrame, into: str = "secrets") -> DataFrame:
    """``documents`` with the column ``into``: (base, added), arrays of (start, rank, end, kind) in code points.

    ``base`` holds the matches of the three patterns, leftmost and non-overlapping for each kind. ``added``
    holds the windows of high entropy that lie in no base span. A null text counts as empty, so both arrays
    are empty for it, as for every text without a secret; no row is dropped, and repeated rows get equal results.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assign = F.transform(
        F.filter(F.zip_with(_positions(text, ASSIGN), values, lambda p, v: F.struct(
            p["start"].alias("start"), p["end"].alias("end"), F.length(v).alias("n"))), lambda s: s["n"] >= ASSIGN_VALUE),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    base = F.array_sort(F.concat(
        _kinded("assign", assign, text.rlike(ASSIGN)),
        _kinded("access", _positions(text, ACCESS), text.rlike(ACCESS)),
        _kinded("hex", _positions(text, HEX), text.rlike(HEX))))
    entropy = F.array_sort(F.concat(*[
        _kinded(kind, _entropy_spans(text, characters, window, bits), text.rlike(_candidates(characters, window)))
        for kind, characters, window, bits in CLASSES]))
    found = documents.withColumn(into, F.struct(base.alias("base"), entropy.alias("entropy")))
    base = F.col(into)["base"]
    return found.withColumn(into, F.struct(base.alias("base"), F.filter(F.col(into)["entropy"], lambda e: ~F.exists(
        base, lambda b: (b["start"] <= e["start"]) & (e["end"] <= b["end"]))).alias("added")))


def _all_spans(secrets: Column) -> Column:
    return F.array_sort(F.concat(secrets["base"], secrets["added"]))


def redact(documents: DataFrame) -> DataFrame:
    """The documents with each span of ``scan`` replaced by PLACEHOLDER, overlapping spans by one, and n_chars anew.

    Rows without a span stay as they are, with their null text or n_chars.
    """
    into, text = free_name(documents, "secrets"), F.coalesce(F.col("text"), F.lit(""))

    def step(state: Column, s: Column) -> Column:
        cut = F.concat(F.substring(text, state["pos"] + 1, s["start"] - state["pos"]), F.lit(PLACEHOLDER))
        return F.struct(
            F.greatest(state["pos"], s["end"]).alias("pos"),
            F.when(s["start"] >= state["pos"], F.array_append(state["out"], cut)).otherwise(state["out"]).alias("out"))

    begin = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))
    spans = _all_spans(F.col(into))
    cut = F.aggregate(spans, begin, step, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substring(text, s["pos"] + 1, F.length(text))))
    return (
        scan(documents, into)
        .withColumn(into, F.when(F.size(spans) > 0, cut))
        .withColumn("n_chars", F.coalesce(F.length(into).cast("bigint"), "n_chars"))
        .withColumn("text", F.coalesce(into, "text"))
        .select(*documents.columns)
    )


def digest(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: the contract's columns from ``scan``."""
    secrets = F.col("secrets")

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(secrets["base"], lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return scan(documents.select("doc_id", "text")).select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(listed(secrets["base"]), 256).alias("base_sha256"), listed(_all_spans(secrets)).alias("spans"))
