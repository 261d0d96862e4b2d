"""Source divergence, ranked lexical search and top-k search against brute force, and odd rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollbook.llm import divergence, lexical_search, vector_search
from rollbook.llm import text as tx

DOCS = "doc_id long, text string, lang string, source string"
ITEMS = "item_id long, text string"
VECTORS = "vec_id long, embedding array<float>"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = ("docs", "n", "p", "term", "block", "rank", "score", "item", "x", "dim", "best", "terms", "q")


def clashing(df):
    """The same rows with extra columns whose names the operators use themselves."""
    return df.select("*", *[F.lit("own").alias(c) for c in CLASHING])


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# -- pointer sort and divergence -----------------------------------------------------------

def test_words_are_sorted_and_told_apart():
    rng = random.Random(5)
    words = ["a", "ab", "abcdefgh", "abcdefghi", "abcdefghij", "abcdefgh" * 3, "abcdefgh" * 3 + "x", "é", "ß" * 9]
    text = [rng.choice(words) for _ in range(3000)]
    texts = tx.texts_of(pa.array([" ".join(text[:1000]), None, " ".join(text[1000:])]))
    spans = tx.runs(texts, divergence.LETTER[texts.data])
    order, run = divergence.sort_words(texts.data, spans.begin, spans.end)
    encoded = [w.encode() for w in text]
    assert [encoded[i] for i in order] == sorted(encoded)
    assert len(set(run.tolist())) == len(words)
    for r in set(run.tolist()):
        same = order[run == r]
        assert (np.diff(same) > 0).all() and len({encoded[i] for i in same}) == 1


def divergences(docs, min_docs, top):
    """The contract, said in dictionaries."""
    held = [((r["lang"] or ""), (r["source"] or ""), re.findall(
        r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r["text"] or "").translate(LOWER))) for r in docs]
    df, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in held:
        df[lang].update(set(words))
        counts[lang, source].update(words)
    out = Counter()
    for lang in {h[0] for h in held}:
        kept = sorted(t for t, n in df[lang].items() if n >= min_docs)
        sources = sorted(s for x, s in counts if x == lang)

        def shares(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            near = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            more = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(near)), ("term", sorted(more)[:top])):
                for rank, (value, _, item) in enumerate(found, 1):
                    out[lang, s, part, item, -value, rank] += 1
    return out


@pytest.fixture(scope="module")
def audited(spark):
    rng = random.Random(3)
    words = ["the", "The", "über", "naïve", "x1y", "don't", "a" * 20, "日本", "abcdefgh", "abcdefghi", "zed", "q\x00r"]
    docs = [
        (i, " ".join(rng.choices(words, weights=range(1, 13), k=rng.randrange(40))), rng.choice(["en", "de", None]),
         "hot" if i % 3 == 0 else rng.choice([f"s{j}" for j in range(9)] + [None, "é"]))
        for i in range(400)
    ]
    docs += [(1, "repeated row", "en", "s1")] * 2 + [(None, None, "fr", "a"), (None, "", "fr", "b"), (5, None, None, None)]
    docs += [(7, "word " * 50_000 + "w" * 200_000, "en", "s2")]
    return spark.createDataFrame(docs, DOCS).repartition(5)


def test_divergence_equals_brute_force(spark, audited):
    want = divergences(audited.collect(), 30, 50)
    assert rows(divergence.audit(spark, audited)) == want
    assert any(k[0] == "fr" and k[4] == 0 for k in want)  # a language that keeps no term


def test_divergence_in_small_tiles_and_slices(spark, audited, monkeypatch):
    want = divergences(audited.collect(), 3, 2)
    assert rows(divergence.audit(spark, clashing(audited), 3, 2, tile_sources=3, tile_terms=2)) == want
    monkeypatch.setattr(divergence, "SLICE_BYTES", 100)
    whole = tx.texts_of(pa.array(["b a a", "a"]))
    group, terms, docs, n = divergence.slice_counts(whole, np.array([0, 1]), 2)
    assert sorted(zip(group.tolist(), terms, docs.tolist(), n.tolist())) == [
        (0, b"a", 1, 2), (0, b"b", 1, 1), (1, b"a", 1, 1)]


def test_divergence_of_nothing(spark):
    none = divergence.audit(spark, spark.createDataFrame([], DOCS))
    assert none.columns == ["lang", "source", "part", "item", "value", "rank"] and none.count() == 0


# -- lexical search ------------------------------------------------------------------------

def ranking(docs, items, top):
    """Every document scored for every item."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    words = [(r["doc_id"], re.findall(pattern, (r["text"] or "").translate(LOWER))) for r in docs]
    words = [(i, w) for i, w in words if w]
    n, total = len(words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = Counter()
    for item_id, text in {(r["item_id"], r["text"]) for r in items}:
        asked = set(re.findall(pattern, (text or "").translate(LOWER)))
        found = []
        for doc_id, w in words:
            m, tf = 50 + 50 * len(w) * n // total, Counter(w)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m))
                for t in asked
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, missing, doc_id) in enumerate(sorted(found)[:top], 1):
            out[item_id, rank, None if missing else doc_id, -score] += 1
    return out


@pytest.fixture(scope="module")
def searched(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)] + ["Über", "naïve", "日本"]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([3, 30, 300])))) for i in range(600)]
    docs += [(600 + i, docs[7][1]) for i in range(150)]  # copies: ties by doc_id
    docs += [(3, docs[7][1]), (None, docs[7][1]), (None, None), (900, ""), (901, "... !"), (902, "w1 " * 30_000)]
    items = [(i, docs[7 * i][1].upper()) for i in range(12)]
    items += [(1, "other text w5"), (50, None), (51, ""), (52, "?!"), (None, "w1 w2 w3"), (53, "nowhere"), (54, "w1")]
    items += [items[0]]  # a repeated row
    frame = spark.createDataFrame([(*d, "en", "s") for d in docs], DOCS).repartition(4)
    return frame, spark.createDataFrame(items, ITEMS)


def test_lexical_search_equals_brute_force(spark, searched):
    docs, items = searched
    found = lexical_search.rank_documents(spark, docs, items)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(found) == ranking(docs.collect(), items.collect(), 50)


def test_lexical_search_in_blocks_and_buckets(spark, searched, monkeypatch):
    docs, items = searched
    monkeypatch.setattr(lexical_search, "ITEMS", 5)
    found = lexical_search.rank_documents(spark, clashing(docs), clashing(items), top=3)
    assert rows(found) == ranking(docs.collect(), items.collect(), 3)


def test_lexical_bounds_drop_documents_but_none_that_count():
    rng = np.random.default_rng(2)
    weights = rng.integers(1, 4000, 400)
    item = np.arange(30)
    holds = rng.random((2000, 400)) < 0.1
    holds[:25, :30] = True  # some documents hold the whole item
    impacts = np.where(holds, rng.integers(400_000, 900_000, (2000, 400)), 0)
    columns = {t: (place, impacts[place, t]) for t in range(400) if len(place := np.flatnonzero(holds[:, t]))}
    lengths = np.sqrt((weights * impacts.astype(float) ** 2).sum(axis=1))
    score = (weights[item] * impacts[:, item]).sum(axis=1)
    least = np.sort(score)[-20]
    alive = lexical_search.survivors(item, weights, float(least), columns, lengths)
    assert alive[score >= least].all() and alive.sum() < 500
    assert lexical_search.survivors(item, weights, 0.0, columns, lengths).all()


def test_lexical_search_of_nothing(spark, searched):
    docs, items = searched
    assert lexical_search.rank_documents(spark, docs.limit(0), items).count() == 0
    assert lexical_search.rank_documents(spark, docs, items.limit(0)).count() == 0
    assert lexical_search.rank_documents(spark, docs.filter("doc_id IN (900, 901)"), items).count() == 0


# -- vector search ---------------------------------------------------------------------------

def neighbours(vectors, k, every):
    """All products of Python integers."""
    whole = [
        (i, r["vec_id"], [math.floor(256 * float(np.float64(x))) for x in r["embedding"]])
        for i, r in enumerate(vectors)
        if r["embedding"] is not None and all(x is not None and math.isfinite(x) for x in r["embedding"])
    ]
    out = Counter()
    for i, query_id, q in whole:
        if query_id is None or query_id % every:
            continue
        scored = sorted(
            (-max(-(2**63 - 1), min(2**63 - 1, sum(a * b for a, b in zip(q, v)))), vec_id is None, vec_id or 0)
            for j, vec_id, v in whole if j != i and len(v) == len(q)
        )
        for rank, (score, missing, vec_id) in enumerate(scored[:k], 1):
            out[query_id, rank, None if missing else vec_id, -score] += 1
    return out


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    points = [(centres[i % 6] + 0.1 * rng.normal(size=8)).tolist() for i in range(900)]
    data = [(i, p) for i, p in enumerate(points)]
    data += [(1000 + i, points[3]) for i in range(300)]  # one vector with a third of the rows
    data += [(50, points[50]), (50, points[50]), (100, points[7])]  # repeated rows and ids
    data += [(None, points[1]), (-50, points[2]), (1400, None), (1450, [1.0, None] * 4), (1500, [float("nan")] * 8),
             (1550, [float("inf")] * 8), (1600, []), (1601, []), (1650, [1.0, -0.0]), (1651, [2.0, 0.0]),
             (1700, [3e30, -3e30, 1e30]), (1701, [1e30, 1.0, 0.5]), (1702, [-1.0, 3.0, 2.0])]
    return spark.createDataFrame(data, VECTORS).repartition(4)


def test_vector_search_equals_brute_force(spark, vectors):
    found = vector_search.nearest(spark, vectors)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert rows(found) == neighbours(vectors.collect(), 5, 50)


def test_vector_search_by_shards_waves_and_blocks(spark, vectors, monkeypatch):
    for name, value in (("SHARD_ROWS", 40), ("LEAF_ROWS", 7), ("SECOND", 3), ("BLOCK_BYTES", 8 * 8 * 30), ("CHUNK", 11)):
        monkeypatch.setattr(vector_search, name, value)
    want = neighbours(vectors.collect(), 3, 10)
    assert rows(vector_search.nearest(spark, clashing(vectors), k=3, every=10)) == want
    monkeypatch.setattr(vector_search, "MOST_SHARDS", 4)  # shards are cut into parts by hash
    assert rows(vector_search.nearest(spark, vectors, k=3, every=10)) == want


def test_vector_bounds_skip_leaves_of_clustered_data():
    rng = np.random.default_rng(1)
    centres = 500 * rng.normal(size=(16, 8))
    x = np.floor(centres[rng.integers(0, 16, 4000)] + rng.normal(size=(4000, 8)))
    balls, leaves = vector_search.grown(x)
    held, tested = [], []
    for leaf, path in leaves:
        held.append(vector_search.Leaf(path, balls[path], x[leaf], leaf, np.zeros(len(leaf), bool), np.zeros(len(leaf), int)))
    original = vector_search.products
    vector_search.products = lambda q, y: tested.append(len(q) * len(y)) or original(q, y)
    try:
        found = vector_search.search_tree(x[:50], np.full(50, np.iinfo(np.int64).min), held, 5)
    finally:
        vector_search.products = original
    scores = np.sort(x[:50] @ x.T, axis=1)[:, :-6:-1]
    assert (found.score.reshape(50, 5) == scores).all()
    assert sum(tested) < 0.4 * 50 * 4000  # of all products


def test_vector_search_of_nothing(spark, vectors):
    assert vector_search.nearest(spark, vectors.limit(0)).count() == 0
    assert vector_search.nearest(spark, vectors.filter("vec_id = 7")).count() == 0  # no query
    alone = vector_search.nearest(spark, vectors.filter("vec_id = 150"))
    assert alone.count() == 0 and alone.columns == ["query_id", "rank", "vec_id", "score"]
