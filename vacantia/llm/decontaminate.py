"""Benchmark decontamination by winnowing, in DataFrame functions alone.

Texts become words. The hashes of all k-grams of words are winnowed: of each ``window`` consecutive ones the least is
kept. A span of ``span = k + window - 1`` words shared by two texts has the same hashes in both, so its least one is kept
on both sides: every shared span of that length gives a common fingerprint. Fingerprints of documents that occur among
those of the benchmark are extended to all word windows around them, and the windows are compared word by word, so the
result is exact. Items shorter than a span are one window each; their hash is looked up at every word of a document.

The join of fingerprints has three steps. Bitmaps of the benchmark's fingerprints, of fixed size for a window length whatever the
size of the benchmark, drop most fingerprints before any shuffle: ``COARSE`` numbers of 64 bits where they are made, ``SLOTS``
broadcast. What passes is joined by its window's words, an equi join that Spark may split by key. Fuller bitmaps pass more
rows, never fewer.

Nulls and texts without words have no windows: such documents are clean, such items are never found. Rows are grouped
by id and text, so repeated rows give one row, and texts that share an id, or have none, give one row each. Other columns are
not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from vacantia.llm.common import ascii_lower, sha256_hex, staged, without

NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SLOTS = 1 << 16  # of 64 bits: the rows a bitmap has at most
SLOT_BITS = 48  # the bits of a hash right of its slot
COARSE = 1 << 10  # slots of the coarse bitmap
SLOT_STEP = 6  # bits of a slot that the coarse one drops


@dataclass(frozen=True)
class Winnowing:
    """k-grams of ``k`` words, ``window`` of them to one fingerprint at least."""

    k: int = 4
    window: int = 7

    @property
    def span(self) -> int:
        return self.k + self.window - 1


def words_of(text: Column) -> Column:
    """Words in lower case (A-Z only), in order; none for a null."""
    return F.filter(F.split(F.coalesce(ascii_lower(text), F.lit("")), NOT_A_WORD), lambda w: w != "")


def gram_hashes(hashes: Column, length: int) -> Column:
    """A hash for each run of ``length`` words."""
    runs = F.transform(hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, length)]))
    return F.slice(runs, 1, F.greatest(F.size(hashes) - (length - 1), F.lit(0)))


def winnowed(grams: Column, window: int) -> Column:
    """The least hash of each ``window`` consecutive ones, each value once."""
    return F.when(F.size(grams) >= window, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(grams) - (window - 1)), lambda i: F.array_min(F.slice(grams, i, window))))
    ).otherwise(F.array().cast("array<bigint>"))



def bitmap(windows: DataFrame) -> DataFrame:
    """(length, slot, bits): for each window length a bit for each hash looked up, ``SLOTS`` rows at most, however many
    windows there are. Sixteen bits of a hash name the slot, six more the bit."""
    hashes = windows.select("length", F.explode("keys").alias("hash"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(F.col("hash")))
    return hashes.groupBy("length", _slot(F.col("hash")).alias("slot")).agg(F.bit_or(bit).alias("bits"))


def _slot(hash_: Column) -> Column:
    return F.shiftrightunsigned(hash_, SLOT_BITS).cast("int")


def _bit(hash_: Column) -> Column:
    return hash_.bitwiseAND(63).cast("int")


def benchmark_windows(benchmark: DataFrame, settings: Winnowing, item: str = "item_id", text: str = "text") -> DataFrame:
    """Every distinct window of the items: its words, its length, the items that hold it, and what is looked up for it.

    A window of full length is looked up by its winnowed fingerprints, a shorter one by the hash of all its words.
    """
    span = settings.span
    items = benchmark.select(F.col(item).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    size = F.size("words")
    length = F.least(size, F.lit(span))
    per_item = items.where(size > 0).select("item", F.explode(F.transform(
        F.sequence(F.lit(1), size - length + 1), lambda i: F.slice("words", i, length))).alias("window"))
    one = per_item.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
    hashes = F.transform("window", lambda w: F.xxhash64(w))
    keys = F.when(F.size("window") >= span, winnowed(gram_hashes(F.col("hashes"), settings.k), settings.window)
                  ).otherwise(F.array(F.xxhash64("hashes")))
    return one.withColumn("hashes", hashes).select(
        F.array_join("window", " ").alias("window"), F.size("window").alias("length"), "items", keys.alias("keys"))


def coarse_bits(windows: DataFrame, length: int) -> Column:
    """A coarser bitmap of a window length as one value of ``COARSE`` numbers, small enough to stand in each row."""
    held = bitmap(windows.where(F.col("length") == length)).groupBy(F.shiftright("slot", SLOT_STEP).alias("slot")).agg(F.bit_or("bits").alias("bits"))
    slots = windows.sparkSession.range(COARSE).select(F.col("id").cast("int").alias("slot")).join(held, "slot", "left")
    listed = slots.agg(F.sort_array(F.collect_list(F.struct("slot", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")))).alias("all"))
    return listed.select(F.transform("all", lambda x: x["bits"])).scalar()


def _may_be_known(bits: Column, hash_: Column) -> Column:
    return F.call_function("getbit", F.get(bits, F.shiftright(_slot(hash_), SLOT_STEP)), _bit(hash_)) == 1


def _lesser(values: Column, step: int) -> Column:
    """Of each value and the one ``step`` places further the lesser, where there is one."""
    return F.transform(values, lambda x, i: F.least(x, F.get(values, i + step)))


LOOK = "struct<length:int,hash:bigint,start:int,context:array<string>>"


def _short_looks(hashes: Column, length: int, bits: Column) -> Column:
    """Where a window of less than full length may stand."""
    places = F.filter(F.sequence(F.lit(1), F.size(hashes)), lambda i: _may_be_known(bits, F.get(hashes, i - 1)))
    return F.when(F.size(hashes) > 0, F.transform(places, lambda i: F.struct(
        F.lit(length).alias("length"), F.get(hashes, i - 1).alias("hash"), i.alias("start"), F.slice("words", i, length).alias("context"))))


def hit_windows(docs: DataFrame, windows: DataFrame, settings: Winnowing, key: list[str], text: str = "text") -> DataFrame:
    """Each occurrence of a benchmark window in a document: key columns, n_words, position, length, items.

    A document without any gives one row with nulls, and an occurrence may come twice. Hashes are first looked up in a coarse
    bitmap inside the document's row; those that pass become rows, with the words around them, and meet the finer one.
    """
    lengths = [r[0] for r in windows.select("length").distinct().collect()]  # at most ``span`` numbers
    span = settings.span
    rows = docs.select(*key, words_of(F.col(text)).alias("words"))
    rows = rows.select(*key, "words", F.size("words").alias("n_words"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    looks = [F.array(F.lit(None).cast(LOOK))]  # keeps a row for each document
    if span in lengths:
        rows = rows.withColumn("grams", gram_hashes(F.col("hashes"), settings.k)).withColumn("least", F.col("grams"))
        reach = 1
        while reach < settings.window:  # the least of twice as many grams at each step; the last steps overlap
            step = min(reach, settings.window - reach)
            rows = rows.withColumn("least", _lesser(F.col("least"), step))
            reach += step
        kept = F.array_distinct(F.slice("least", 1, F.greatest(F.size("least") - (settings.window - 1), F.lit(0))))
        rows = rows.withColumn("bits", coarse_bits(windows, span)).withColumn("least", F.filter(kept, lambda h: _may_be_known(F.col("bits"), h)))

        def around(i: Column) -> Column:
            start = F.greatest(i - (span - settings.k), F.lit(1))
            return F.struct(F.lit(span).alias("length"), F.get("grams", i - 1).alias("hash"), start.alias("start"), F.slice("words", start, i + span - start).alias("context"))

        places = F.filter(F.sequence(F.lit(1), F.size("grams")), lambda i: F.array_contains("least", F.get("grams", i - 1)))
        looks.append(F.when(F.size("least") > 0, F.transform(places, around)))
    for n in (x for x in lengths if x < span):
        rows = rows.withColumns({f"runs{n}": gram_hashes(F.col("hashes"), n), f"bits{n}": coarse_bits(windows, n)})
        looks.append(_short_looks(F.col(f"runs{n}"), n, F.col(f"bits{n}")))
    none = F.array().cast(f"array<{LOOK}>")
    rows = rows.select(*key, "n_words", F.explode(F.concat(looks[0], *[F.coalesce(x, none) for x in looks[1:]])).alias("look"))
    rows = rows.select(*key, "n_words", "look.*", _slot(F.col("look.hash")).alias("slot"))
    known = F.col("hash").isNull() | (F.call_function("getbit", "bits", _bit(F.col("hash"))) == 1)
    rows = rows.join(F.broadcast(bitmap(windows)), ["length", "slot"], "left").where(known)
    found = F.transform(F.sequence(F.lit(0), F.size("context") - F.col("length")), lambda o: F.struct(
        (F.col("start") + o).alias("at"), F.array_join(F.slice("context", o + 1, F.col("length")), " ").alias("window")))
    rows = rows.select(*key, "n_words", F.explode_outer(F.when(F.col("length").isNotNull(), found)).alias("found"))
    # A document's row without a window has a join key of its own, so that such rows are dealt out evenly.
    alone = F.concat(F.lit(" "), F.xxhash64(*key).cast("string"))
    rows = rows.select(*key, "n_words", "found.at", F.coalesce("found.window", alone).alias("window"))
    return rows.join(windows.select("window", "length", "items"), "window", "left").drop("window")


def decontaminate(docs: DataFrame, benchmark: DataFrame, settings: Winnowing = Winnowing(), text: str = "text",
                  doc: str = "doc_id") -> DataFrame:
    """Per document: n_words, n_hit (words inside any benchmark window), items (sorted ids as text), spans (position and
    length of the stretches hit, counted in words from 1).

    The windows of the benchmark are written to the shared folder once.
    """
    return _by_text(docs, benchmark, settings, text, doc).drop("text_key")


def text_key(text: str) -> Column:
    """Tells texts apart that share an id, or have none."""
    return F.xxhash64(text)


def _by_text(docs: DataFrame, benchmark: DataFrame, settings: Winnowing, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """What ``decontaminate`` gives, with the key of the text."""
    windows = staged(benchmark_windows(benchmark, settings), "windows")
    docs = docs.select(F.col(doc).alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    hits = hit_windows(docs, windows, settings, ["doc_id", "text_key"])
    hit = F.when(F.col("length").isNotNull(), F.struct("at", (F.col("at") + F.col("length")).alias("end")))
    grouped = hits.groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"), F.sort_array(F.collect_set(hit)).alias("hits"), F.collect_set("items").alias("items"))
    start = F.array().cast("array<struct<at:int,end:int>>")
    merged = F.aggregate("hits", start, lambda spans, h: F.when(
        (F.size(spans) > 0) & (F.element_at(spans, -1)["end"] >= h["at"]),
        F.concat(F.slice(spans, 1, F.size(spans) - 1), F.array(F.struct(
            F.element_at(spans, -1)["at"].alias("at"),
            F.greatest(F.element_at(spans, -1)["end"], h["end"]).alias("end"))))
    ).otherwise(F.concat(spans, F.array(h))))
    out = grouped.select("doc_id", "text_key", "n_words", F.size("hits").alias("__n"), merged.alias("merged"),
                         F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))
    covered = F.aggregate("merged", F.lit(0).cast("bigint"), lambda n, s: n + (s["end"] - s["at"]))
    return out.select("doc_id", "text_key", F.col("n_words").cast("long").alias("n_words"), covered.alias("n_hit"), "items",
                      F.transform("merged", lambda s: F.struct(s["at"].alias("at"), (s["end"] - s["at"]).alias("length"))
                                  ).alias("spans"))


def contamination_report(docs: DataFrame, benchmark: DataFrame, settings: Winnowing = Winnowing()) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, digest of the sorted item ids, contaminated."""
    found = decontaminate(docs, benchmark, settings)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        sha256_hex(F.array_join("items", ",")).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def contaminated_ids(docs: DataFrame, benchmark: DataFrame, settings: Winnowing = Winnowing()) -> DataFrame:
    """The ids of documents with a word inside a benchmark window, each once."""
    return decontaminate(docs, benchmark, settings).where("n_hit > 0").select("doc_id").distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, settings: Winnowing = Winnowing()) -> DataFrame:
    """The documents without a word inside a benchmark window. Each row goes by its own text: one that shares its id with a
    contaminated row, or has none as that one, stays if its text is clean."""
    found = staged(_by_text(docs, benchmark, settings).where("n_hit > 0").select(
        F.col("doc_id").alias("__id_gone"), F.col("text_key").alias("__text_gone")), "contaminated")
    keyed = docs.withColumns({"__id": F.col("doc_id"), "__text": text_key("text")})
    return without(keyed, found, ["__id", "__text"], "_gone").select(docs.columns)
