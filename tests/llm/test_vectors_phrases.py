"""Phrase mining, top-k search and clustering against plain versions."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from cases import AWKWARD, documents
from pyspark.sql import types as T

from yearloom.llm import centroids, phrases, topk_search

VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        # Names that operators use themselves.
        *[T.StructField(c, T.StringType()) for c in ("row", "key", "ints", "query", "a.b", "cluster", "rank")],
    ]
)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, *"1234567") for i, v in rows], VECTORS)


def numbers(rng, n, scale=0.3):
    return [float(np.float32(x)) for x in rng.normal(0, scale, n)]


def whole(vector):
    return [math.floor(1024 * x) for x in vector]


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def vector_rows(dimensions):
    """Clusters, copies, repeated ids and rows, ties, and what takes no part."""
    rng = np.random.default_rng(3)
    middle = [numbers(rng, dimensions, 1.0) for _ in range(4)]
    rows = [(i, [float(np.float32(m + d)) for m, d in zip(middle[i % 4], numbers(rng, dimensions, 0.2))]) for i in range(230)]
    rows += [(1000 + i, middle[0]) for i in range(40)] + [(100, middle[1]), (100, middle[1]), (5, middle[2])]
    bad = list(middle[0])
    bad[1] = None
    rows += [(2000, None), (2001, bad), (2002, [math.nan] * dimensions), (2003, [math.inf] + middle[0][1:])]
    return rows + [(2004, []), (2005, middle[3][:5]), (2006, middle[3] + [0.5]), (None, middle[0])]


@pytest.mark.parametrize("nodes, k", [(1, 3), (2, 10), (4, 10), (3, 500)])
def test_top_matches_are_those_of_all_pairs(spark, monkeypatch, nodes, k):
    monkeypatch.setattr(topk_search, "_FRAGMENT", 50)
    monkeypatch.setattr(topk_search, "_CHUNK", 2)
    rows = vector_rows(12)
    kept = [(i, whole(v)) for i, v in rows if usable(v)]
    expected = Counter()
    for at, (q, a) in enumerate(kept):
        if q is None or q % 100:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b)), math.inf if i is None else i) for n, (i, b) in enumerate(kept) if n != at]
        for rank, (score, i) in enumerate(sorted(scores)[:k], 1):
            expected[q, rank, None if i == math.inf else i, -score] += 1
    found = topk_search.top_matches(vectors(spark, rows).repartition(5), k, nodes=nodes)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(tuple(r) for r in found.collect()) == expected


def test_top_matches_of_large_and_few_numbers(spark):
    large = [(0, [3e5, -2e5]), (1, [1e5, 1e5]), (2, [-5e4, 7e5])]
    found = {tuple(r) for r in topk_search.top_matches(vectors(spark, large), 5).collect()}
    a, *others = [whole(v) for _, v in large]
    scores = [(sum(x * y for x, y in zip(a, b)), i) for i, b in enumerate(others, 1)]
    assert found == {(0, n, i, s) for n, (s, i) in enumerate(sorted(scores, reverse=True), 1)}
    for rows in ([], [(0, None)], [(0, [1.0])], [(1, [1.0]), (2, [1.0])]):
        assert topk_search.top_matches(vectors(spark, rows)).count() == 0


def plain_lloyd(rows, k, rounds, dimensions):
    kept = [(i, whole(v)) for i, v in rows if i is not None and usable(v) and len(v) == dimensions]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    middle = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(middle))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for n in range(len(middle)):
            own = [v for (_, v), m in zip(kept, of) if m == n]
            if own:
                middle[n] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    sums = Counter()
    for _, n, d in found:
        sums[n] += d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return Counter((i, n, d, sums[n], sum(sums.values()), names[n]) for i, n, d in found)


@pytest.mark.parametrize("blocks, dimensions", [(1, 12), (4, 12), (5, 12)])
def test_clusters_are_those_of_a_plain_loop(spark, monkeypatch, blocks, dimensions):
    monkeypatch.setattr(centroids, "_PACK", 16)
    rows = vector_rows(dimensions)
    found = centroids.clustered(
        vectors(spark, rows).repartition(5), rounds=4, dimensions=dimensions, blocks=blocks
    )
    assert Counter(tuple(r) for r in found.collect()) == plain_lloyd(rows, 8, 4, dimensions)


def test_clusters_of_few_and_equal_vectors(spark):
    same = [(i, [0.5, -0.25]) for i in range(9)]
    for rows in (same, same[:3], [(1, [2e5, -3e5]), (2, [-2e5, 1.0]), (3, [2e5, -2.9e5])]):
        found = centroids.clustered(vectors(spark, rows), rounds=2, dimensions=2, blocks=2)
        assert Counter(tuple(r) for r in found.collect()) == plain_lloyd(rows, 8, 2, 2)
    assert centroids.clustered(vectors(spark, [(1, None)]), dimensions=2).count() == 0


def plain_collocations(rows, least, top, absorbed):
    found, totals = {1: Counter(), 2: Counter(), 3: Counter()}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        totals[lang] += 0
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size, counts in found.items():
                counts.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    frequent = {size: {g: n for g, n in found[size].items() if n >= least} for size in (2, 3)}
    longer = Counter()
    for (lang, a, b, c), n in frequent[3].items():
        for part in ((lang, a, b), (lang, b, c)):
            longer[part] = max(longer[part], n)
    result = []
    for size in (2, 3):
        for g, a in frequent[size].items():
            if g in longer and 100 * longer[g] >= absorbed * a:
                continue
            cuts = []
            for k in range(1, size):
                left, right = found[k][g[: k + 1]], found[size - k][(g[0], *g[k + 1 :])]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            result.append((g[0], -score, -a, " ".join(g[1:]).encode(), left, right))
    rows, ranks = [], Counter()
    for lang, score, a, phrase, left, right in sorted(result):
        ranks[lang] += 1
        if ranks[lang] <= top:
            rows.append((lang, ranks[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return rows


def phrase_rows():
    rng = np.random.default_rng(11)
    words = ["New", "york", "the", "of", "a", "É", "straße", "日本", "x" * 300]
    rows = []
    for i in range(120):
        text = " ".join(rng.choice(words, rng.integers(0, 60), p=[0.2, 0.2, 0.2, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05]))
        for mark in ".,\n\t;":
            at = int(rng.integers(0, len(text) + 1))
            text = text[:at] + mark + text[at:]
        rows.append((i, text, [None, "en", "de"][i % 3]))
    rows += [(500, "in the long run " * 4000, "en"), (501, None, "fr"), (502, "", "it"), (503, "b" * 5000, "en")]
    return rows + [rows[3]] * 5


@pytest.mark.parametrize("chunk, held, sample", [(1 << 20, 1 << 18, 0.25), (64, 40, 0.0), (200, 40, 1.0)])
def test_collocations_are_those_of_all_counts(spark, monkeypatch, chunk, held, sample):
    monkeypatch.setattr(phrases, "_CHUNK", chunk)
    monkeypatch.setattr(phrases, "_HELD", held)
    monkeypatch.setattr(phrases, "_BITS", 16)
    rows = phrase_rows()
    docs = spark.createDataFrame(
        [(i, t, g, "k", 1, "x") for i, t, g in rows],
        "doc_id long, text string, lang string, kind string, n int, `a.b` string",
    )
    found = phrases.collocations(docs.repartition(4), top=40, sample=sample)
    assert sorted(tuple(r) for r in found.collect()) == sorted(plain_collocations(rows, 10, 40, 50))


def test_collocations_of_awkward_and_no_documents(spark):
    docs = documents(spark, AWKWARD)
    texts = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    found = phrases.collocations(docs, least=2)
    assert sorted(tuple(r) for r in found.collect()) == sorted(plain_collocations(texts, 2, 2000, 50))
    assert phrases.collocations(docs.limit(0)).count() == 0
