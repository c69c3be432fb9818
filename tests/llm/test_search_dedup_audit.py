"""Ranked search, exact deduplication and the divergence audit against SQL, brute force and awkward rows."""

import collections
import hashlib
import math
import random
import re

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.llm import common, divergence, exact_dedup, ranked_search
from cellweave.llm.queries import QUERIES, SQL

SCHEMA = "doc_id long, text string, lang string, source string, digest string, item string, rank int, file string, `_n` int"
LONG = " ".join(random.Random(5).choice(["alpha", "beta", "gamma", "été", "x1"]) for _ in range(60_000))
ROWS = [
    (1, "Alpha  beta\tgamma", "en", "a", "x", "x", 1, "f", 1),
    (2, "Alpha beta gamma", "en", "b", None, "x", 1, "f", 1),
    (2, "Alpha beta gamma", "en", "b", None, "x", 1, "f", 1),
    (3, "alpha beta gamma", "en", None, "x", None, 1, "f", 1),
    (4, None, None, None, None, None, None, None, None),
    (5, "", "en", "a", "x", "x", 1, "f", 1),
    (6, " \n", "en", "a", "x", "x", 1, "f", 1),
    (7, "  ", "de", "a", "x", "x", 1, "f", 1),
    (None, "Été ÉTÉ été 42 beta-beta", "fr", "a", "x", "x", 1, "f", 1),
    (None, "Alpha beta gamma", "en", "c", "x", "x", 1, "f", 1),
    (8, LONG, "en", "a", "x", "x", 1, "f", 1),
    (9, "漢字 𝒳 alpha", "zh", "a", "x", "x", 1, "f", 1),
    (10, "beta", "en", "c", "x", "x", 1, "f", 1),
    (11, "beta", "en", "c", "x", "x", 1, "f", 1),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_exact_copies", "op13_divergence"])
def test_equals_sql(spark, sf, con, name):
    assert compare.mismatch(QUERIES[name](spark, sf), con, SQL[name]) is None


# ranked search


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))


def plain_search(docs, items, k):
    """(item_id, rank, doc_id, score), by scoring every document for every item."""
    counts = [(d, collections.Counter(terms_of(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, total = len(counts), sum(c.total() for _, c in counts)
    df = collections.Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in set(items):
        scored = []
        for d, c in counts:
            m = 10 + (90 * c.total() * n) // total
            score = sum(weight[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms_of(text)) if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_search_of_awkward_rows(spark, awkward):
    items = [(1, "ALPHA beta"), (1, "ALPHA beta"), (2, None), (3, "?!"), (4, "nowhere"), (None, "été 𝒳"), (5, "gamma x1"), (5, "beta")]
    asked = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, doc_id string, score int")
    found = ranked_search.search(awkward, asked, k=3).select("item_id", "rank", "doc_id", "score").collect()
    assert ordered(found) == ordered(plain_search([(r[0], r[1]) for r in ROWS], [x for x in items if x[1]], 3))


def test_search_of_empty_tables(spark, awkward):
    items = spark.createDataFrame([(1, "alpha")], "item_id long, text string")
    assert ranked_search.search(awkward.where("false"), items).count() == 0
    assert ranked_search.search(awkward, items.where("false")).count() == 0
    assert ranked_search.search(awkward, items).columns == ["item_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize("seed", range(4))
def test_small_blocks_and_groups_change_nothing(spark, monkeypatch, seed):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    docs = [(i // 2, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 25)))) for i in range(12)]
    monkeypatch.setattr(ranked_search, "GROUP_TERMS", 40)
    source = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = ranked_search.search(source, spark.createDataFrame(items, "item_id long, text string"), k=5).collect()
    assert ordered(found) == ordered(plain_search(docs, items, 5))


@pytest.mark.parametrize("pool", [1, 1 << 24])
def test_treaps_find_what_scoring_all_finds(monkeypatch, pool):
    """With many equal impacts, impacts that rise with the document, and a pool that takes the latest states first."""
    monkeypatch.setattr(ranked_search, "POOL", pool)
    rng = np.random.default_rng(pool)
    docs, kinds = 500, 12
    tf = np.where(rng.random((docs, kinds)) < rng.random(kinds) ** 2, rng.integers(1, 4, (docs, kinds)), 0)
    tf[:, 0] = 1
    m = 10 + 3 * np.arange(docs)[::-1]
    owner, term = np.nonzero(tf)
    treaps = ranked_search.Treaps(owner, term, tf[owner, term], m)
    impact = np.where(tf > 0, (1_000_000_000 * tf) // (1000 * tf + 8 * m[:, None]), 0)
    for trial in range(20):
        chosen = np.flatnonzero(rng.random(kinds) < 0.6)
        weights = rng.integers(0, 3000, len(chosen))
        score = (impact[:, chosen] * weights).sum(1)
        order = np.lexsort((np.arange(docs), -score))[:7]
        order = order[score[order] > 0]
        got, scores = treaps.best(chosen, weights, 7)
        assert got.tolist() == order.tolist() and scores.tolist() == score[order].tolist()
        if len(order) == 7:
            again, _ = treaps.best(chosen, weights, 7, int(score[order[3]]))
            assert again[:4].tolist() == order[:4].tolist()


def test_treaps_prune(monkeypatch):
    rng = np.random.default_rng(1)
    docs = 20_000
    rare = rng.choice(docs, 40, replace=False)
    owner = np.concatenate([np.arange(docs), rare])
    term = np.concatenate([np.zeros(docs, int), np.ones(40, int)])
    treaps = ranked_search.Treaps(owner, term, np.ones(len(owner), int), rng.integers(10, 300, docs))
    seen = []
    split = treaps.split
    monkeypatch.setattr(treaps, "split", lambda x, *a: seen.append(len(x)) or split(x, *a))
    treaps.best(np.array([0, 1]), np.array([50, 8000]), 10)
    assert sum(seen) < 1500


def test_terms_of_long_texts_are_cut_at_gaps(monkeypatch):
    monkeypatch.setattr(ranked_search, "PIECE", 7)
    text = "Alpha ÉtÉ alpha--x1 " * 50 + "tail"
    assert {k.decode(): v for k, v in ranked_search.counted(text).items()} == dict(collections.Counter(terms_of(text)))


# exact deduplication


def plain_copies(docs):
    groups = collections.defaultdict(list)
    for d, t in docs:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    out = []
    for text, ids in groups.items():
        ids = sorted(ids, key=lambda d: (d is None, d or 0))
        out += [(d, ids[0], len(ids), i == 0, hashlib.sha256(text.encode()).hexdigest()) for i, d in enumerate(ids)]
    return out


@pytest.mark.parametrize("bits", [256, 8])
def test_copies_of_awkward_rows(spark, awkward, bits):
    """Also with a digest of 8 bits, which different texts share."""
    docs = [(r[0], r[1]) for r in ROWS] + [(100 + i % 60, f"text {i % 70}") for i in range(400)]
    more = spark.createDataFrame(docs, "doc_id long, text string").withColumn("digest", F.lit("x"))
    assert ordered(exact_dedup.deduplicate(more, bits=bits).collect()) == ordered(plain_copies(docs))
    assert ordered(exact_dedup.deduplicate(awkward).collect()) == ordered(plain_copies([(r[0], r[1]) for r in ROWS]))


def test_no_copies_of_no_rows(spark, awkward):
    out = exact_dedup.deduplicate(awkward.where("false"))
    assert out.count() == 0 and out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_state_goes_on_with_new_files(spark):
    """Files that come later meet what is retained; taking the same files in again changes nothing."""
    path, at = common.fresh_path(spark, "corpus"), common.fresh_path(spark, "exact")
    first, later = [(5, "a b"), (6, "c"), (7, "c")], [(1, "a  b"), (8, "d"), (9, "c")]
    for docs in (first, later):
        spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.mode("append").parquet(path)
        for _ in range(2):
            exact_dedup.ingest(spark, path, at)
    assert ordered(exact_dedup.decided(spark, path, at).collect()) == ordered(plain_copies(first + later))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_bitmaps_keep_what_they_hold(spark):
    keys = spark.range(3000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("key"), "id")
    maps = exact_dedup.bitmaps(keys.where("id % 3 = 0"))
    found = {r["id"] for r in exact_dedup.maybe_in(keys, maps).collect()}
    assert found >= set(range(0, 3000, 3)) and len(found) < 1050
    assert exact_dedup.maybe_in(keys, exact_dedup.bitmaps(keys.where("false"))).count() == 0


# divergence


def plain_audit(docs, least_docs, top):
    counts, held, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))
        counts.update((lang, source, t) for t in found)
        held.update((lang, t) for t in set(found))
    out = []
    for lang in {g[0] for g in groups}:
        sources, kept = sorted(s for x, s in groups if x == lang), sorted(t for (x, t), n in held.items() if x == lang and n >= least_docs)
        rate = lambda n, total: 1 + 10**9 * (n + 5) // (total + 5 * len(kept))  # noqa: B023, E731
        per = {s: [counts[lang, s, t] for t in kept] for s in sources}
        p = {s: [rate(n, sum(per[s])) for n in per[s]] for s in sources}
        whole = [sum(per[s][i] for s in sources) for i in range(len(kept))]
        q = [rate(n, sum(whole)) for n in whole]
        for s in sources:
            pairs = sorted((-sum(abs(a - b) for a, b in zip(p[s], p[o], strict=True)), o.encode(), o) for o in sources if o != s)
            terms = sorted((q[i] - p[s][i], t.encode(), t) for i, t in enumerate(kept) if per[s][i] and p[s][i] > q[i])
            out += [(lang, s, part, x[2], -x[0], i + 1) for part, found in (("pair", pairs), ("term", terms[:top])) for i, x in enumerate(found)]
    return out


@pytest.mark.parametrize(("least", "top"), [(1, 2), (2, 50), (30, 50)])
def test_audit_of_awkward_rows(spark, awkward, least, top):
    found = divergence.audit(awkward, least_docs=least, top_terms=top).select("lang", "source", "part", "item", "value", "rank").collect()
    assert ordered(found) == ordered(plain_audit([(r[1], r[2], r[3]) for r in ROWS], least, top))


def test_audit_of_no_rows(spark, awkward):
    assert divergence.audit(awkward.where("false")).count() == 0


def test_shares_are_exact_beyond_64_bits(spark):
    n, total = 40_000_000_007, 90_000_000_000_001
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(77)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (n + 5) // (total + 5 * 77)
