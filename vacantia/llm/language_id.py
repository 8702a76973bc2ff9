"""Language of texts by Bayesian fusion of evidence.

Four kinds of evidence are multiplied: how likely the text's character trigrams are in each language, the language that the
markup declares, the suffix of the address, and what other texts of the same host turned out to be. Host priors are
smoothed along the hierarchy table, suffix, domain, host: each level's shares are those of its texts with ``strength``
pseudo-texts of the level above, and a text's own share is taken out of its host's. How far declarations are to be trusted
is counted too, from how often each goes with each language. All of this comes from grouped sums over the whole table.

``und`` stands for any other language: its trigrams are all equally likely. A text is kept if its language is one of the
``languages`` with a probability of ``least`` or more.

Null or empty texts have no trigrams, so the other evidence decides. Null declarations and addresses are values like any other.
Repeated rows are judged each for itself and count each in the sums. Tables without rows give tables without rows, and
without texts to learn from all languages are equally likely.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vacantia.llm.common import in_parts, lean, staged

UND = "und"
# Country suffixes and the language most used there.
SUFFIX_LANGUAGE = {"uk": "en", "us": "en", "au": "en", "ie": "en", "nz": "en", "fr": "fr", "de": "de", "at": "de", "es": "es",
                   "mx": "es", "ar": "es", "co": "es", "cl": "es", "pe": "es"}
CHUNK = 1 << 18


@dataclass(frozen=True)
class Evidence:
    languages: tuple[str, ...] = ("en", "fr", "de", "es")
    gram_bits: int = 14
    smoothing: float = 0.5
    strength: float = 20.0  # texts of the level above in a host's shares
    suffix_texts: float = 50.0  # that a country suffix counts for
    trust: float = 10.0  # texts for which a declaration counts before any is seen
    least: float = 0.5

    @property
    def all(self) -> tuple[str, ...]:
        return (*self.languages, UND)


def _grams(texts: Sequence[str], bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: the number of the first, the hashed trigrams, and the text of each, counted from the first."""
    run, size, first = [], 0, 0
    for i, text in enumerate([*texts, None]):
        if text is None or run and size + len(text) > CHUNK:
            joined = " " + " ".join(run) + " "
            points = np.frombuffer(joined.lower().encode("utf-32-le"), np.uint32).astype(np.uint64)
            of = np.repeat(np.arange(len(run)), [len(t.lower()) + 1 for t in run])[:max(len(points) - 2, 0)]
            code = (points[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ points[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
                    ^ points[2:] * np.uint64(0x165667B19E3779F9)) * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(64 - bits)
            letters = points[1:-1] > 0x40  # trigrams around a letter, roughly
            yield first, code[:len(of)][letters[:len(of)]].astype(np.int64), of[letters[:len(of)]]
            run, size, first = [], 0, i
        if text is not None:
            run.append(text)
            size += len(text)


def learn_trigrams(labelled: DataFrame, settings: Evidence = Evidence(), text: str = "text", lang: str = "lang") -> np.ndarray:
    """Log probabilities of hashed trigrams, a column for each language and one for ``und``.

    Tasks count; the driver gets a sum for each bucket and language, however large the table.
    """
    languages, buckets = settings.languages, 1 << settings.gram_bits
    bits = settings.gram_bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), buckets), np.int64)
        for batch in batches:
            of_text, at = np.array([languages.index(x) for x in batch.column(1).to_pylist()], np.int64), 0
            for part in in_parts(batch.column(0), 4 * CHUNK):
                for first, grams, of in _grams(part.to_pylist(), bits):
                    total += np.bincount(of_text[of + first + at] * buckets + grams, minlength=total.size).reshape(total.shape)
                at += len(part)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["at", "n"])

    rows = labelled.where(F.col(lang).isin(*languages)).select(text, lang).mapInArrow(count, "at bigint, n bigint")
    sums = rows.groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(languages) * buckets)
    counts[sums["at"].to_numpy(np.int64)] = sums["n"]
    counts = counts.reshape(len(languages), buckets) + settings.smoothing
    known = np.log(counts / counts.sum(axis=1, keepdims=True))
    return np.vstack([known, np.full(buckets, -np.log(buckets))]).T.copy()


def text_evidence(text: Column, table: np.ndarray, settings: Evidence = Evidence()) -> Column:
    """Log likelihoods by language. Trigrams overlap and repeat, so n of them count as the square root of n."""
    bits, width = settings.gram_bits, len(settings.all)

    @F.arrow_udf("array<double>")
    @lean
    def compute(texts: pa.Array) -> pa.Array:
        out, at = np.zeros((len(texts), width)), 0
        for part in in_parts(texts, 4 * CHUNK):
            for first, grams, of in _grams(part.to_pylist(), bits):
                n = int(of[-1]) + 1 if len(of) else 0
                counts = np.maximum(np.bincount(of, minlength=n), 1)
                for k in range(width):
                    out[at + first:at + first + n, k] = np.bincount(of, table[grams, k], n) / np.sqrt(counts)
            at += len(part)
        ends = pa.array(np.arange(len(out) + 1, dtype=np.int32) * width)
        return pa.ListArray.from_arrays(ends, pa.array(out.ravel()))

    return compute(text)


def normalised(logs: Column) -> Column:
    """Probabilities from logs."""
    shifted = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(shifted, lambda x: x / F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b))


def address_parts(url: Column) -> dict[str, Column]:
    """host, domain (its last two labels) and suffix of an address; empty for a null."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return {"host": host, "domain": F.substring_index(host, ".", -2), "suffix": F.substring_index(host, ".", -1)}


def declared_language(html: Column) -> Column:
    """The first subtag of the lang attribute of the html element; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1))


def visible_text(html: Column) -> Column:
    """The text outside of scripts, styles, comments and tags."""
    out = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(out, r"(?s)<[^>]*>", " "), r"&#?\w+;", " ")


def _sums(df: DataFrame, by: list[str], width: int, name: str) -> DataFrame:
    """Summed shares by language, as an array."""
    return df.groupBy(*by).agg(F.array(*[F.sum(F.col("__share")[k]) for k in range(width)]).alias(name))


def _smoothed(own: Column, above: Column, strength: float) -> Column:
    """Shares of a level's own counts with ``strength`` counts of the level above."""
    own = F.coalesce(own, F.transform(above, lambda x: F.lit(0.0)))
    total = F.aggregate(own, F.lit(float(strength)), lambda a, b: a + b)
    return F.transform(F.zip_with(own, above, lambda c, p: c + F.lit(float(strength)) * p), lambda x: x / total)


def host_priors(evidence: DataFrame, settings: Evidence) -> DataFrame:
    """(host, domain, suffix, __own, __above): summed shares of each host, and the smoothed shares of what is above it.

    ``evidence`` has these columns and __share, the shares by language that a text gives itself.
    """
    width = len(settings.all)
    hosts = staged(_sums(evidence, ["host", "domain", "suffix"], width, "__own"), "hosts")

    def level(by: list[str], name: str) -> DataFrame:
        return hosts.groupBy(*by).agg(F.array(*[F.sum(F.col("__own")[k]) for k in range(width)]).alias(name))

    whole = level([], "n").first()["n"]  # a number for each language
    even = [1.0 / width] * width
    sums = [x or 0.0 for x in whole]
    top = [(x + settings.strength * e) / (sum(sums) + settings.strength) for x, e in zip(sums, even)]
    above = F.array(*[F.lit(float(x)) for x in top])
    country = F.array(*[F.coalesce(*[F.when(F.col("suffix") == s, F.lit(settings.suffix_texts)) for s, of in SUFFIX_LANGUAGE.items() if of == x],
                                   F.lit(0.0)) for x in settings.all])
    suffixes = level(["suffix"], "__n").withColumn("__n", F.zip_with("__n", country, lambda a, b: a + b))
    suffixes = suffixes.select("suffix", _smoothed(F.col("__n"), above, settings.strength).alias("__suffix"))
    domains = level(["domain", "suffix"], "__n").join(suffixes, "suffix").select(
        "domain", "suffix", _smoothed(F.col("__n"), F.col("__suffix"), settings.strength).alias("__above"))
    return staged(hosts.join(domains, ["domain", "suffix"]), "host-priors")


def declaration_table(evidence: DataFrame, settings: Evidence) -> dict[str, list[float]]:
    """For each declaration the log probability of it in each language. Other declarations are one, as are none."""
    width, kinds = len(settings.all), (*settings.languages, "other", "")
    rows = _sums(evidence.withColumn("__kind", declaration_kind(settings)), ["__kind"], width, "n").collect()  # few kinds
    seen = {r["__kind"]: r["n"] for r in rows}
    counts = np.array([seen.get(k, [0.0] * width) for k in kinds])
    for i, kind in enumerate(kinds):
        for j, language in enumerate(settings.all):
            counts[i, j] += settings.trust if kind == language else settings.trust / len(kinds) / 2
    logs = np.log(counts / counts.sum(axis=0, keepdims=True))
    return {k: logs[i].tolist() for i, k in enumerate(kinds)}


def declaration_kind(settings: Evidence) -> Column:
    said = F.coalesce("declared", F.lit(""))
    return F.when(said.isin(*settings.languages, ""), said).otherwise(F.lit("other"))


def fused(evidence: DataFrame, priors: DataFrame, declarations: dict[str, list[float]], settings: Evidence) -> DataFrame:
    """The rows with language, probability and kept. Needs __text, __share, declared, host, domain and suffix.

    The join is on the host: Spark broadcasts the priors if their file is small and splits a host that holds much of the table.
    """
    kind = declaration_kind(settings)
    said = F.coalesce(*[F.when(kind == k, F.array(*[F.lit(float(x)) for x in logs])) for k, logs in declarations.items()])
    names = evidence.columns
    joined = evidence.join(priors, ["host", "domain", "suffix"], "left")
    rest = F.zip_with("__own", "__share", lambda c, s: F.greatest(c - s, F.lit(0.0)))
    joined = joined.withColumn("__prior", _smoothed(rest, F.col("__above"), settings.strength))
    logs = F.zip_with(F.zip_with("__text", said, lambda a, b: a + b), "__prior", lambda a, p: a + F.log(F.greatest(p, F.lit(1e-12))))
    joined = joined.withColumn("__logs", logs).withColumn("__posterior", normalised(F.col("__logs")))
    best = F.array_max("__posterior")
    language = F.get(F.array(*[F.lit(x) for x in settings.all]), (F.array_position("__posterior", best) - 1).cast("int"))
    out = joined.withColumns({"language": language, "probability": best})
    kept = (F.col("language") != UND) & (F.col("probability") >= settings.least)
    return out.withColumn("kept", kept).select(*names, "language", "probability", "kept")


def identify_pages(pages: DataFrame, labelled: DataFrame, settings: Evidence = Evidence()) -> DataFrame:
    """page_id, host, declared, text_language (by the text alone), language, probability, kept for each page.

    ``labelled`` (text, lang) teaches the trigrams. Pages are read once; their evidence goes to the shared folder.
    """
    table = learn_trigrams(labelled, settings)
    read = pages.select("page_id", declared_language(F.col("html")).alias("declared"),
                        *[c.alias(k) for k, c in address_parts(F.col("url")).items()],
                        text_evidence(visible_text(F.col("html")), table, settings).alias("__text"))
    evidence = staged(read.withColumn("__share", normalised(F.col("__text"))), "evidence")
    out = fused(evidence, host_priors(evidence, settings), declaration_table(evidence, settings), settings)
    alone = F.get(F.array(*[F.lit(x) for x in settings.all]), (F.array_position("__share", F.array_max("__share")) - 1).cast("int"))
    return out.select("page_id", "host", "declared", alone.alias("text_language"), "language", "probability", "kept")


def keep_identified(docs: DataFrame, settings: Evidence = Evidence()) -> DataFrame:
    """The documents whose language is one of the accepted ones, with their columns.

    The column lang is the declaration and teaches the trigrams; the source stands for the host. Texts are read twice, so that
    none is shuffled.
    """
    table = learn_trigrams(docs, settings)

    def with_evidence(df: DataFrame) -> DataFrame:
        source = F.coalesce("__source", F.lit(""))
        read = df.withColumns({"__text": text_evidence(F.col("__body"), table, settings)})
        return read.withColumns({"__share": normalised(F.col("__text")), "declared": F.lower(F.coalesce("__lang", F.lit(""))),
                                 "host": source, "domain": source, "suffix": F.lit("")})

    def narrow(*more: Column) -> DataFrame:
        return docs.select(*more, F.col("lang").alias("__lang"), F.col("source").alias("__source"), F.col("text").alias("__body"))

    seen = staged(with_evidence(narrow()).select("__share", "declared", "host", "domain", "suffix"), "evidence")
    whole = narrow(F.struct(*docs.columns).alias("__row"))
    out = fused(with_evidence(whole).drop("__lang", "__source", "__body"), host_priors(seen, settings),
                declaration_table(seen, settings), settings)
    return out.where("kept").select("__row.*")
