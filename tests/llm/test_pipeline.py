"""The pipeline's stages against plain versions of what each must keep, change and return."""

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import plain_components, plain_spans, plain_targets, plain_words

import corpus_pipeline
from cellweave.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """The rows before the first stage and after each."""
    folder, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(None, "words without an id, but words", "en", "src0", 30), (900001, None, "en", "src0", 0), (900002, "123 456", None, None, 7), (900003, docs.first()["text"], None, None, 5)], docs.schema)
    docs = docs.unionByName(extra)
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        seen.append(docs)
    return seen


def rows(df):
    return df.collect()


def test_stages_return_the_columns_of_documents(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "private_data", "mixing", "packing"]
    assert all(df.columns == stages[0].columns and df.dtypes == stages[0].dtypes for df in stages[:-1])


def test_language_drops_texts_without_letters_only(stages):
    before, after = rows(stages[0]), rows(stages[1])
    want = [r for r in before if r["text"] is not None and re.search(r"[^\W\d_]", r["text"])]
    assert collections.Counter(map(tuple, after)) == collections.Counter(map(tuple, want)) and len(want) < len(before)


def test_language_drops_unlearned_languages_and_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = np.random.default_rng(3)
    junk = " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(60))
    foreign = [(-1, junk, None), (-2, "Привет, мир: это текст на языке, которого здесь нет", None), (-3, "漢字だけの文章です", None)]
    german = docs.where("lang = 'de'").select("doc_id", "text", F.lit(None).cast("string").alias("lang"))
    others = docs.where("lang <> 'de'")
    left = [r["doc_id"] for r in corpus_pipeline.known_language(spark, others.unionByName(german).unionByName(spark.createDataFrame(foreign, docs.schema)), "").select("doc_id").collect()]
    clean = {r["doc_id"] for r in others.collect() if r["text"] is not None and re.search(r"[^\W\d_]", r["text"])}
    dropped = {r["doc_id"] for r in german.collect()} - set(left)
    assert clean <= set(left) and not set(left) & {-1, -2, -3} and len(dropped) >= 0.9 * german.count()


def test_one_document_of_each_group_stays(stages):
    before, after = rows(stages[1]), rows(stages[2])
    component = plain_components([(r["doc_id"], r["text"]) for r in before], 80)
    want = [r for r in before if r["doc_id"] is None or component[r["doc_id"]] == r["doc_id"]]
    assert collections.Counter(map(tuple, after)) == collections.Counter(map(tuple, want)) and len(want) < len(before)


def test_base_spans_are_replaced_and_clean_texts_stay(stages):
    before, after = {r["doc_id"]: r for r in rows(stages[2])}, {r["doc_id"]: r for r in rows(stages[3])}
    assert set(before) == set(after)
    touched = 0
    for ident, r in before.items():
        keys = [("secret", *m.span(1)) for m in re.finditer('token = "([0-9a-f]{40})"', r["text"])]
        base = plain_spans(r["text"])
        spans, out, done = sorted((a, b, k) for k, a, b in base + [x for x in keys if not any(a < x[2] and x[1] < b for _, a, b in base)]), [], 0
        for a, b, k in spans:
            if a >= done:
                out += [r["text"][done:a], f"<{k.upper()}>"]
            done = max(done, b)
        want = "".join([*out, r["text"][done:]])
        assert after[ident]["text"] == want and after[ident]["n_chars"] == len(want)
        touched += bool(spans)
    assert touched


def test_mixing_repeats_and_drops_whole_documents(stages):
    before, after = rows(stages[3]), collections.Counter(map(tuple, rows(stages[4])))
    known = {tuple(r): r for r in before}
    assert set(after) <= set(known) and all(n <= 2 for n in after.values())
    sizes, taken = collections.Counter(), collections.Counter()
    for t, r in known.items():
        n = len(plain_words(r["text"]))
        sizes[r["source"]] += n
        taken[r["source"]] += n * after[t]
    want, largest = plain_targets(dict(sizes), (3, 1, 2), 1.5, 2), collections.Counter()
    for r in before:
        largest[r["source"]] = max(largest[r["source"]], len(plain_words(r["text"])))
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)


def test_every_kept_document_is_packed(stages):
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(tokenizer_path())
    want = collections.Counter()
    for r in rows(stages[4]):
        ids = [*bpe.encode(r["text"], add_special_tokens=False).ids, 0]
        head = len(ids) % 2048 if len(ids) > 2048 else len(ids)
        cuts = [0, *([head] if head else []), *range(head + 2048, len(ids) + 1, 2048)]
        want.update((r["doc_id"], i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)))
    got = rows(stages[5])
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    fill = collections.Counter()
    for r in got:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 2048 and len(fill) <= -(-sum(fill.values()) // 2048) + 2


def test_run_applies_all_stages(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0 and "sequence_id" in out.columns and corpus_pipeline.ORACLE_SQL is None


def test_an_empty_corpus_stays_empty_and_other_columns_stay(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0
    wide = spark.createDataFrame([(i, f"word{i} some words of a text", "en", "s", 1, "copies", i) for i in range(8)], "doc_id long, text string, lang string, source string, n_chars long, _copies string, component_id long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns, wide = wide.columns, stage(spark, wide, sf)
        assert wide.columns == columns
    assert {r["_copies"] for r in wide.collect()} == {"copies"}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == 0
