"""Language identification: text likelihood, declared language, address suffix and host prior in one posterior."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm import common
from sensorloom.llm.common import free_name, staged

TRAINING_DOCUMENTS = 2000  # of each language, on average, for the text model
LANGUAGES = 256  # most that a model tells apart: bounds its table to 32 MB. Rarer ones are part of the background
SLOTS = 1 << 15  # of hashed byte trigrams
EVIDENCE = 60  # a text counts as so many independent trigrams at most
CERTAIN = 20  # trigrams from which a text's own language counts for the statistics of hosts
PRIOR_ROWS = 5.0  # weight of the level above in a host's or domain's prior
KEEP = 0.5  # least posterior

# Bytes of letters; everything else separates words.
_LETTER = np.full(256, 32, np.uint8)
_LETTER[[*b"abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)]] = [*b"abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)]
_LETTER[[*range(ord("A"), ord("Z") + 1)]] = range(ord("a"), ord("z") + 1)


@dataclass
class TextModel:
    """Log probabilities of hashed trigrams, a row for each language and behind them one for the background.

    The background stands for all other languages and for what is none: all trigrams alike, and half of it by the
    trigrams of the languages that are too rare to be told apart, if there are any.
    """

    languages: list[str]
    table: np.ndarray


def _trigrams(column: pa.Array) -> Iterator[np.ndarray]:
    """The slots of each row's byte trigrams that hold a letter in the middle."""
    data, offsets = common.text_bytes(column)
    data = _LETTER[data]
    for first, last in zip(offsets[:-1], offsets[1:], strict=True):
        own = np.concatenate([[32], data[first:last], [32]]).astype(np.uint64)
        key = (own[:-2] << np.uint64(16)) | (own[1:-1] << np.uint64(8)) | own[2:]
        yield (common.mix(key[own[1:-1] != 32]) % np.uint64(SLOTS)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        totals: dict[str, np.ndarray] = {}
        for lang, slots in zip(batch.column("lang").to_pylist(), _trigrams(batch.column("text")), strict=True):
            counts = totals.setdefault(lang, np.zeros(SLOTS, np.int64))
            counts += np.sqrt(np.bincount(slots, minlength=SLOTS)).astype(np.int64)
        for lang, counts in totals.items():
            slots = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(slots), pa.string()), pa.array(slots), pa.array(counts[slots])],
                names=["lang", "slot", "n"])


def train(labelled: DataFrame, per_language: int = TRAINING_DOCUMENTS) -> TextModel:
    """A text model from rows (doc_id, text, lang), of which about ``per_language`` of each language are used.

    They are chosen by a hash of doc_id, whole texts each. A text counts a trigram by the root of how often it has it,
    in whole numbers, so that one long repetitive text is not what a language looks like. Rows without text or language are not used. Without
    any usable row the model has no language and every text is unknown. Of more than LANGUAGES languages the most
    frequent are told apart (ties by name), and the others are part of the background.
    """
    able = labelled.where("text is not null and lang is not null")
    counts = able.groupBy("lang").count()
    totals = {row["lang"]: row["count"] for row in counts.orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()}
    languages = sorted(totals)
    if not languages:
        return TextModel([], np.zeros((0, SLOTS), np.float32))
    n_others = counts.agg(F.sum("count")).first()[0] - sum(totals.values())
    share: Column = F.lit(int(1e6 * min(1.0, per_language / max(1, n_others))) + 1)
    for lang, n in totals.items():
        share = F.when(F.col("lang") == lang, int(1e6 * min(1.0, per_language / n)) + 1).otherwise(share)
    sample = able.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share).select(
        F.when(F.col("lang").isin(languages), F.col("lang")).alias("lang"), "text")
    counted = sample.mapInArrow(_counted, "lang string, slot bigint, n bigint").groupBy("lang", "slot").agg(
        F.sum("n").alias("n")).toArrow()  # at most (LANGUAGES + 1) * SLOTS rows
    rows = np.array([len(languages) if i is None else i for i in pc.index_in(
        counted["lang"], value_set=pa.array(languages)).to_pylist()], np.int64)
    found = np.full((len(languages) + 1, SLOTS), 0.5)
    found[rows, counted["slot"].to_numpy()] += counted["n"].to_numpy()
    found /= found.sum(axis=1, keepdims=True)
    chance = np.full(SLOTS, 1 / SLOTS)
    found[-1] = (found[-1] + chance) / 2 if n_others else chance
    return TextModel(languages, np.log(found).astype(np.float32))


def _text_evidence(rows: DataFrame, model: TextModel, n_grams: str, scores: str) -> DataFrame:
    """``rows`` with the number of trigrams and the log likelihood of each language, tempered to EVIDENCE trigrams."""
    shared = rows.sparkSession.sparkContext.broadcast(model.table)
    others = [c for c in rows.columns if c != "text"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            sizes, likelihoods = [], []
            for slots in _trigrams(batch.column("text")):
                total = np.zeros(len(table))
                for at in range(0, len(slots), 1 << 20):
                    total += table[:, slots[at:at + (1 << 20)]].sum(axis=1, dtype=np.float64)
                sizes.append(len(slots))
                likelihoods.append(total * (min(1.0, EVIDENCE / len(slots)) if len(slots) else 0.0))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array(sizes, pa.int64()), pa.array(likelihoods, pa.list_(pa.float64()))],
                names=[*others, n_grams, scores])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.select(*others, "text").mapInArrow(score, f"{kinds}, {n_grams} bigint, {scores} array<double>")


def identify(rows: DataFrame, model: TextModel) -> DataFrame:
    """(id, text, declared, suffix, domain, host) to (id, lang, posterior, n_grams, text_lang, keep).

    The posterior of a language is proportional to the likelihood of the text's trigrams, the probability of the
    declared language and of the address suffix given the language, and the prior of the host. The last three come
    from grouped counts of the languages that the texts alone show: a host's prior is smoothed towards its
    domain's, and that towards the one of all rows. Evidence that is null adds nothing. A row without any trigram
    is rejected (lang null, posterior null), and so is one of posterior below KEEP; nothing else is. The background takes
    part in the posterior but is no answer: a text in another language has a ``lang`` of low posterior, and no ``text_lang``.

    Repeated rows and ids are judged one by one. All probabilities are of the model's languages and the background.
    """
    n_langs = len(model.table)
    scored = staged(_text_evidence(rows.select("id", "text", "declared", "suffix", "domain", "host"), model,
                                   "n_grams", "scores"), "language")
    if not n_langs:
        return scored.select("id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("posterior"),
                             "n_grams", F.lit(None).cast("string").alias("text_lang"), F.lit(False).alias("keep"))
    top = F.array_position("scores", F.array_max("scores")).cast("int")
    scored = scored.withColumn("top", F.when(F.col("n_grams") > 0, top))
    sure = scored.where(F.col("n_grams") >= CERTAIN)

    def counts() -> Column:
        return F.array(*[F.count(F.when(F.col("top") == i + 1, 1)) for i in range(n_langs)])

    whole = sure.agg(counts().alias("n")).first()["n"]
    base = F.array(*[F.lit((n + 1.0) / (sum(whole) + n_langs)) for n in whole])

    def prior(key: str, above: Column) -> Column:
        total = F.aggregate(key, F.lit(0).cast("bigint"), lambda s, n: s + n)
        return F.coalesce(
            F.zip_with(key, above, lambda n, p: (n + PRIOR_ROWS * p) / (total + PRIOR_ROWS)), above)

    def likelihood(key: str) -> DataFrame:
        """P(value | language) with one row of each language spread over the values."""
        values = sure.where(F.col(key).isNotNull()).groupBy(key).agg(counts().alias("n"))
        n_values = values.count() + 1
        of_all = F.array(*[F.lit(float(n)) for n in whole])
        return values.select(key, F.zip_with("n", of_all, lambda n, t: F.log((n + 1.0 / n_values) / (t + 1.0))).alias(f"{key}_log"))

    hosts = sure.where("host is not null").groupBy("host").agg(F.max("domain").alias("domain"), counts().alias("host_n"))
    domains = sure.where("domain is not null").groupBy("domain").agg(counts().alias("domain_n"))
    hosts = hosts.join(domains, "domain", "left").withColumn("host_prior", prior("host_n", prior("domain_n", base))).select(
        "host", "host_prior")
    nothing = F.array_repeat(F.lit(0.0), n_langs)
    joined = (
        scored.join(hosts, "host", "left").join(domains, "domain", "left")
        .join(likelihood("declared"), "declared", "left").join(likelihood("suffix"), "suffix", "left")
        .withColumn("prior", F.coalesce("host_prior", prior("domain_n", base)))
    )
    logs = F.transform("prior", lambda p: F.log(p))
    for part in (F.col("scores"), F.coalesce("declared_log", nothing), F.coalesce("suffix_log", nothing)):
        logs = F.zip_with(logs, part, lambda a, b: a + b)
    names = F.array(*[F.lit(name) for name in model.languages], F.lit(None).cast("string"))
    best = F.array_max("logs")
    known = F.slice("logs", 1, n_langs - 1)
    likely = F.array_max(known)
    return (
        joined.withColumn("logs", logs)
        .withColumn("lang", F.when(F.col("n_grams") > 0, F.get(names, F.array_position(known, likely).cast("int") - 1)))
        .withColumn("posterior", F.when(F.col("n_grams") > 0, F.exp(likely - best) / F.aggregate(
            "logs", F.lit(0.0), lambda s, x: s + F.exp(x - best))))
        .select("id", "lang", "posterior", "n_grams", F.get(names, F.col("top") - 1).alias("text_lang"),
                F.coalesce(F.col("posterior") >= KEEP, F.lit(False)).alias("keep"))
    )


def page_evidence(pages: DataFrame) -> DataFrame:
    """The evidence of web pages (page_id, url, html): text without markup, html lang, and parts of the address."""
    host = F.lower(F.nullif(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1), F.lit("")))
    declared = F.lower(F.nullif(F.regexp_extract(
        "html", r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})""", 1), F.lit("")))
    text = F.regexp_replace("html", r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|&#?\w+;", " ")
    return pages.select(
        F.col("page_id").alias("id"), text.alias("text"), declared.alias("declared"),
        F.nullif(F.regexp_extract(host, r"\.([a-z0-9-]+)$", 1), F.lit("")).alias("suffix"),
        F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")).alias("domain"), host.alias("host"))


def keep_identified(documents: DataFrame) -> DataFrame:
    """The documents whose language is found, by a model trained on a sample of them and their ``lang``.

    ``lang`` is the declared language and ``source`` the host. Rows with a null, empty or letterless text go, and
    those in none of the model's languages.
    Columns stay as they are. The decision is joined by doc_id and text, so that repeated rows share it.
    """
    model = train(documents)
    key = F.struct("doc_id", F.xxhash64("text"))
    rows = documents.select(
        key.alias("id"), "text", F.col("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"),
        F.lit(None).cast("string").alias("domain"), F.col("source").alias("host"))
    doc, tie, at = (free_name(documents, name) for name in ("rejected", "rejected_tie", "tie"))
    gone = identify(rows, model).where("not keep").select("id.*").distinct().toDF(doc, tie)
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(at) == F.col(tie))
    return documents.withColumn(at, F.xxhash64("text")).join(gone, same, "left_anti").select(*documents.columns)
