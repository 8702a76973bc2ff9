"""Quality rules whose limits follow the data: quantile sketches for each language and source, then a joined filter.

A document fails the base if it has fewer than 50 words, or if more than half of its words lie in three-word windows that it
has twice. Of those that pass, four measures are sketched for each language and source: symbols, repeated words and
repeated lines in thousandths, and the mean length of a word in hundredths. A sketch is a histogram of whole numbers with
buckets of at most 1/32 of their value, so a quantile has at most that error. Sketches merge by adding counts: partial counts
before the shuffle, and the sketches of sources into those of a language and of the whole table. A source with fewer than
``least_rows`` documents takes the limits of its language, a language with fewer those of the table.

The upper limit of a measure is Q3 + ``reach`` * max(Q3 - Q1, ``floor``), the lower one of the word length Q1 less as much. The
floor is the spread that counts as ordinary where most documents have none of a thing at all.

Null texts count as empty: no words, so the base fails. Null languages and sources are a group like any other. Repeated
rows are judged each for itself, and further columns stay as they are. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from vacantia.llm.common import in_parts, lean, staged

SYMBOLS = "#*$%&|<>"
BYTES_AT_ONCE = 1 << 20
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
MEASURES = ("symbols", "repeats", "dup_lines", "word_length")
EXACT_BITS = 6  # numbers of so many bits have buckets of their own


@dataclass(frozen=True)
class Rules:
    least_words: int = 50
    most_repeats: int = 50  # of a hundred words
    reach: int = 3
    least_rows: int = 100
    floor_symbols: int = 100
    floor_repeats: int = 160
    floor_dup_lines: int = 200
    floor_word_length: int = 100


def _kinds(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_BLANK, _SYMBOL = _kinds("\t\n\v\f\r "), _kinds(SYMBOLS)
_LEAD = (np.arange(256) & 0xC0) != 0x80  # bytes that start a character


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs twice or more."""
    codes, values = pd.factorize(keys)
    return np.bincount(codes, minlength=len(values))[codes] > 1


def count_texts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The base counts of some texts, side by side."""
    n = len(texts)
    data = np.frombuffer(b"".join(pc.cast(texts, pa.binary()).to_pylist()), np.uint8)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[edges])

    ink = ~_BLANK[data]
    out = {"n_symbols": per_text(_SYMBOL[data]), "word_chars": per_text(ink & _LEAD[data])}

    split = pc.ascii_split_whitespace(texts)
    words, of = split.flatten(), np.repeat(np.arange(n), np.diff(split.offsets.to_numpy()))
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[real]
    of = of[real]
    out["n_words"] = np.bincount(of, minlength=n)
    new = ~pd.Series(of * (len(words) + 1) + codes).duplicated().to_numpy()
    out["n_distinct_words"] = np.bincount(of, new, n).astype(np.int64)
    inside = np.zeros(len(codes), bool)
    if len(codes) > 2:
        kinds = int(codes.max()) + 1
        pairs = pd.factorize(codes[:-1] * kinds + codes[1:])[0]
        triples = pd.factorize(pairs[:-1] * kinds + codes[2:])[0]
        at = np.flatnonzero(of[:-2] == of[2:])
        again = at[_repeats(of[at] * (len(triples) + 1) + triples[at])]
        for i in range(3):
            inside[again + i] = True
    out["n_repeat_words"] = np.bincount(of, inside, n).astype(np.int64)

    split = pc.split_pattern(texts, "\n")
    lines, of = split.flatten(), np.repeat(np.arange(n), np.diff(split.offsets.to_numpy()))
    real = pc.not_equal(pc.ascii_trim_whitespace(lines), "").to_numpy(zero_copy_only=False)
    codes = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[real]
    of = of[real]
    out["n_lines"] = np.bincount(of, minlength=n)
    seen = pd.Series(of * (len(lines) + 1) + codes).duplicated().to_numpy()
    out["n_dup_lines"] = np.bincount(of, seen, n).astype(np.int64)
    return out


def base_counts(text: Column) -> Column:
    """struct of the base counts, as bigint."""
    @F.arrow_udf("struct<" + ",".join(f"{c}: bigint" for c in COUNTS) + ">")
    @lean
    def count(texts: pa.Array) -> pa.Array:
        parts = [count_texts(part) for part in in_parts(texts, BYTES_AT_ONCE)]
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate([p[c] for p in parts] or [np.zeros(0)]).astype(np.int64)) for c in COUNTS], list(COUNTS))

    return count(text)


def with_counts(df: DataFrame, rules: Rules, text: str = "text", into: str = "__q") -> DataFrame:
    """The table with a struct of base counts, measures (null without words) and base_failed."""
    counted = df.withColumn(into, base_counts(F.col(text)))
    c = {k: F.col(into)[k] for k in COUNTS}
    words = F.when(c["n_words"] > 0, c["n_words"])
    measures = {"symbols": F.lit(1000) * c["n_symbols"], "repeats": F.lit(1000) * c["n_repeat_words"],
                "word_length": F.lit(100) * c["word_chars"]}
    by_words = {k: F.floor(v / words).cast("bigint") for k, v in measures.items()}
    by_lines = F.floor(F.lit(1000) * c["n_dup_lines"] / F.when(c["n_lines"] > 0, c["n_lines"])).cast("bigint")
    failed = (c["n_words"] < rules.least_words) | (100 * c["n_repeat_words"] > rules.most_repeats * c["n_words"])
    fields = [*[c[k].alias(k) for k in COUNTS], *[v.alias(k) for k, v in by_words.items()], by_lines.alias("dup_lines"),
              failed.alias("base_failed")]
    return counted.withColumn(into, F.struct(*fields))


def bucket(value: Column) -> Column:
    """The least number of a value's bucket: the value with all but its first ``EXACT_BITS`` bits cleared."""
    drop = F.greatest(F.length(F.bin(value)) - EXACT_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(counted: DataFrame, into: str = "__q") -> DataFrame:
    """(lang, source, measure, bucket, n) over the documents that pass the base."""
    measures = F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(into)[m]).alias("bucket")) for m in MEASURES])
    each = counted.where(~F.col(into)["base_failed"]).select("lang", "source", F.explode(measures).alias("m"))
    return each.groupBy("lang", "source", "m.measure", "m.bucket").agg(F.count("*").alias("n"))


def quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """(by.., measure, rows, q1, q3) of sketches merged by some columns."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    up_to = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = merged.withColumns({"up_to": up_to, "rows": F.sum("n").over(group)})
    return ranked.groupBy(*by, "measure").agg(
        F.max("rows").alias("rows"), F.min(F.when(4 * F.col("up_to") >= F.col("rows"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("up_to") >= 3 * F.col("rows"), F.col("bucket"))).alias("q3"))


def limits(counted: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The low and high limits of each measure, a row for each language and source in the table."""
    sketch = staged(sketches(counted), "sketches")
    out = counted.select(F.col("lang").alias("__of_lang"), F.col("source").alias("__of_source")).distinct()
    for level, by in (("__pair", ["lang", "source"]), ("__language", ["lang"])):
        wide = _wide(quartiles(sketch, by), by, level).where(F.col("rows") >= rules.least_rows).drop("rows")
        match = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in by]
        out = out.join(wide, match, "left").drop(*by)
    of_table = _wide(quartiles(sketch, []), [], "all").first()["all"]  # eight numbers
    table = {m: [F.lit(x).cast("bigint") for x in (of_table[m] if of_table else (None, None))] for m in MEASURES}
    chosen = F.coalesce("__pair", "__language")
    cols = []
    for m in MEASURES:
        q1, q3 = (F.coalesce(chosen[m][q], t) for q, t in zip(("q1", "q3"), table[m]))
        reach = rules.reach * F.greatest(q3 - q1, F.lit(getattr(rules, f"floor_{m}")))
        cols.append((q3 + reach).alias(f"__high_{m}"))
        if m == "word_length":
            cols.append((q1 - reach).alias(f"__low_{m}"))
    return staged(out.select("__of_lang", "__of_source", *cols), "limits")


def _wide(quarts: DataFrame, by: list[str], name: str) -> DataFrame:
    """(by.., rows, a struct of the quartiles of each measure)."""
    one = [F.struct(*[F.max(F.when(F.col("measure") == m, F.col(q))).alias(q) for q in ("q1", "q3")]).alias(m) for m in MEASURES]
    return quarts.groupBy(*by).agg(F.max("rows").alias("rows"), F.struct(*one).alias(name))


def judged(counted: DataFrame, limit: DataFrame, into: str = "__q") -> DataFrame:
    """The counted table with ``__kept``. Limits are few rows; Spark broadcasts them if their files are small."""
    q = F.col(into)
    within = F.lit(True)
    for m in MEASURES:
        within = within & F.coalesce(q[m] <= F.col(f"__high_{m}"), F.lit(True))
    within = within & F.coalesce(q["word_length"] >= F.col("__low_word_length"), F.lit(True))
    same = F.col("lang").eqNullSafe(F.col("__of_lang")) & F.col("source").eqNullSafe(F.col("__of_source"))
    return counted.join(limit, same, "left").select(*counted.columns, (~q["base_failed"] & within).alias("__kept"))


def quality_verdicts(docs: DataFrame, rules: Rules = Rules(), doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's base counts, base_failed and kept. Texts are read once; counts go to the shared folder."""
    counted = staged(with_counts(docs.select(doc, "lang", "source", text), rules, text).drop(text), "counts")
    out = judged(counted, limits(counted, rules))
    wanted = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return out.select(doc, *[F.col("__q")[c].alias(c) for c in wanted], F.col("__kept").alias("kept"))


def keep_good(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """The rows of documents that pass, with their columns. Counts are taken twice, so that no text is shuffled."""
    first = staged(with_counts(docs.select("lang", "source", text), rules, text).drop(text), "counts")
    counted = with_counts(docs, rules, text)
    return judged(counted, limits(first, rules)).where("__kept").select(*docs.columns)
