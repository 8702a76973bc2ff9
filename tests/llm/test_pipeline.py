import math
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_decontaminate import plain as plain_hits
from test_language_id import SOUNDS, plain_fusion
from test_quality_rules import plain_kept
from test_simhash import plain_groups, plain_print

import corpus_pipeline
from vacantia.llm import byte_bpe, language_id
from vacantia.llm.queries import ORACLE, QUERIES


def sentence(lang, n, rng):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 5))) + (f"{rng.randrange(99)}" if rng.random() < 0.05 else "") for _ in range(n))


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(12)
    items = [(i, sentence("en", rng.randrange(4, 30), rng)) for i in range(12)] + [(50, None)]
    rows, i = [], 0
    for g in range(45):
        lang = rng.choice(sorted(SOUNDS))
        text, source = sentence(lang, rng.randrange(60, 200), rng), f"s{rng.randrange(3)}"
        if g % 9 == 4:
            text += "\n" + items[g % 12][1]
        if g % 9 == 6:
            text = text.replace(" ", "%% ")
        for c in range(1 + (g % 4 == 0) * rng.randrange(4)):
            rows.append((i * 13 % 997, text if c % 2 == 0 else text + " more", lang, source))
            i += 1
    rows += [(2000, None, "en", "s0"), (2001, "", None, None), (2002, "short text", "en", "s0"), rows[0], rows[3],
             (2003, "".join(chr(0x4E00 + k * 37 % 5000) + (" " if k % 3 == 0 else "") for k in range(300)), "zh", "far"),
             (2004, sentence("en", 20_000, rng), "en", "s1")]
    rng.shuffle(rows)
    return rows, items


def plain_language(rows, settings=language_id.Evidence()):
    """What the language stage keeps, from counts of each text alone."""
    buckets = 1 << settings.gram_bits
    grams = [next(iter(language_id._grams([t or ""], settings.gram_bits)))[1] for _, t, _, _ in rows]
    counts = np.full((len(settings.languages), buckets), settings.smoothing)
    for g, (_, _, lang, _) in zip(grams, rows):
        if lang in settings.languages:
            np.add.at(counts[settings.languages.index(lang)], g, 1)
    table = np.vstack([np.log(counts / counts.sum(axis=1, keepdims=True)), np.full(buckets, -math.log(buckets))]).T
    evidence = []
    for g, (_, _, lang, source) in zip(grams, rows):
        text = (table[g].sum(axis=0) / math.sqrt(max(len(g), 1))).tolist()
        weights = np.exp(np.array(text) - max(text))
        evidence.append(((weights / weights.sum()).tolist(), text, (lang or "").lower(), source or "", source or "", ""))
    out = []
    for row, p in zip(rows, plain_fusion(evidence, settings)):
        best = max(p)
        if settings.all[p.index(best)] != "und" and best >= settings.least:
            out.append(row)
    return out


def plain_run(rows, items):
    sizes = [len(rows)]
    rows = [r for r, k in zip(rows, plain_kept([r[1:] for r in rows])) if k]
    sizes.append(len(rows))
    rows = plain_language(rows)
    sizes.append(len(rows))
    groups, first = plain_groups([plain_print(r[1]) for r in rows]), {}
    for r, g in zip(rows, groups):
        first[g] = min(first.get(g, r), r, key=lambda x: x[0])
    rows = list(first.values())
    sizes.append(len(rows))
    hits = plain_hits([r[:2] for r in rows], items)
    rows = [r for r in rows if not hits[r[0]][1]]
    sizes.append(len(rows))
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.merger(path).ranks, special_tokens={})
    return sorted((*r, library.encode_ordinary(r[1])) for r in rows), sizes


def test_run_as_brute_force(spark, documents, tables, tmp_path):
    rows, items = tables
    documents(rows).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    want, sizes = plain_run(rows, items)
    assert all(a > b for a, b in zip(sizes, sizes[1:])), sizes  # each stage has something to do
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.text, r.lang, r.source, r.ids) for r in got) == want


def test_stages_keep_all_columns(spark, documents, tables, tmp_path):
    rows, items = tables
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_decontamination_alone(spark, documents, tmp_path):
    passage = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents([(1, "x " + passage), (2, "clean"), (3, None), (None, passage), (4, "")])
    kept = corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in kept) == [2, 3, 4]


def test_decontamination_by_row(spark, documents, tmp_path):
    """Rows without an id, or with one id, are told apart by their texts; equal rows have one fate."""
    passage = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = [(None, "clean"), (None, "also clean"), (None, None), (7, "clean"), (8, passage[:20]), (8, passage[:20])]
    docs = documents(clean + [(None, passage), (None, "x " + passage), (7, passage + " y"), (9, passage), (9, passage)])
    kept = corpus_pipeline.decontamination(spark, docs.repartition(3), str(tmp_path))
    assert kept.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, clean))


def test_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} and set(ORACLE) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_copies", "decontamination", "tokens"]
