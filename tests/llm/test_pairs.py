"""Operators that compare documents, against plain computations on small tables."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import AWKWARD, documents, prose
from compare import differences, oracle_connection
from conftest import TESTDATA
from pyspark.sql import functions as F

from yearloom.llm import (
    decontamination,
    jaccard_join,
    line_dedup,
    queries,
    rows,
    shingles,
    substring_dedup,
    url_filter,
)


def near_copies():
    """Groups of near copies, a chain of links and short texts."""
    rng, rows = np.random.default_rng(7), []
    for group in range(6):
        words = prose(40 + 25 * group, 1000 * group).split()
        for k in range(8):
            own = list(words)
            for i in rng.integers(0, len(own), k % 4):
                own[i] = f"new{group}x{k}x{i}"
            rows.append((100 * (group + 1) + k, " ".join(own)))
    chain = prose(100, 50_000).split()
    rows += [(900 + k, " ".join(chain[2 * k : 2 * k + 60])) for k in range(10)]
    rows += [(950 + k, prose(5 + k, 60_000)) for k in range(8)]
    return rows + AWKWARD


def word_set(text):
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans(upper, lower)))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("scan_cost", [0.01, 4.0, 1000.0])
def test_components_are_those_of_all_pairs(spark, scan_cost):
    docs = documents(spark, near_copies())
    rows = [(r.doc_id, word_set(r.text)) for r in docs.collect()]
    part = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    least = {p: min((rows[i][0] for i, q in enumerate(part) if q == p and rows[i][0] is not None), default=None) for p in part}
    expected = Counter(
        (i, len(s), least[part[k]] if s else i) for k, (i, s) in enumerate(rows)
    )
    found = jaccard_join.with_components(docs, jaccard_join.Settings(scan_cost=scan_cost))
    assert Counter(tuple(r) for r in found.collect()) == expected


def test_one_of_each_and_empty_tables(spark):
    docs = documents(spark, near_copies())
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and {3, 4, 5} <= set(ids)
    assert jaccard_join.with_components(docs.limit(0)).count() == 0


def test_boundary_follows_the_cost():
    sizes = {n: 10 for n in range(5, 200)}
    assert jaccard_join.boundary(sizes, 80, 0.01) < jaccard_join.boundary(sizes, 80, 50.0)


def edited_copies(copies, edits):
    """Copies of one text, each with so many words changed at places of its own."""
    rng, base, rows = np.random.default_rng(11), prose(150).split(), []
    for k in range(copies):
        own = list(base)
        for i in rng.choice(len(own), edits[k % len(edits)], replace=False):
            own[i] = f"new{k}x{i}"
        rows.append((k, " ".join(own)))
    return rows


def test_last_round_leaves_out_copies_that_cannot_be_similar(spark):
    rows = edited_copies(80, [1, 6, 7, 8])
    texts = spark.createDataFrame([(jaccard_join._signature(jaccard_join._set_of(t.encode(), 5)), t) for _, t in rows], "class long, text string")
    made = jaccard_join._whole_sets(jaccard_join.Settings())
    sets = texts.select("class", F.col("text").cast("binary").alias("text")).mapInArrow(
        made, "class long, n long, own binary, sketch binary, short array<long>"
    )
    one = sets.agg(F.min("class")).first()[0]
    placed = sets.select(F.lit(1).alias("key"), "class", "n", F.col("class").alias("component"), F.lit(one).alias("main"))
    found = {frozenset(r) for r in jaccard_join._all_pairs(placed, sets, 80).collect()}
    own = {c: word_set(t) for c, t in texts.collect()}
    similar = {frozenset((a, b)) for a in own for b in own if a < b and 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b])}
    assert similar <= found
    assert len(found) < 2 * len(similar) < 80 * 79 / 2 / 4
    verified = jaccard_join._verified(jaccard_join._all_pairs(placed, sets, 80), sets, 80)
    assert {frozenset(r) for r in verified.collect()} == similar


@pytest.mark.parametrize("sent", [0, 1_000_000])
def test_only_the_sets_of_pairs_are_read(spark, sent, monkeypatch):
    monkeypatch.setattr(jaccard_join, "_SENT", sent)
    sets = spark.createDataFrame([(k, k) for k in range(9)], "class long, n long")
    pairs = spark.createDataFrame([(1, 2), (2, 5), (1, 5)], "a long, b long")
    found = {r["class"] for r in jaccard_join._only(sets, pairs).collect()}
    assert found == ({1, 2, 5} if sent else set(range(9)))


def test_batches_of_sets_are_small_and_arrow_gives_back(monkeypatch):
    given = []
    pool = type("Pool", (), {"release_unused": lambda self: given.append(1)})()
    monkeypatch.setattr(rows.pa, "default_memory_pool", lambda: pool)
    texts = [prose(30_000, 40_000 * k).encode() for k in range(40)]
    names = [jaccard_join._signature(jaccard_join._set_of(t, 5)) for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(names), pa.array(texts, pa.binary())], names=["class", "text"])
    made = list(jaccard_join._whole_sets(jaccard_join.Settings())([batch]))
    assert [x for b in made for x in b["class"].to_pylist()] == names
    assert len(made) > 1 and max(b.nbytes for b in made) < 2 * jaccard_join._BATCH
    assert given == [1]
    started = jaccard_join._whole_sets(jaccard_join.Settings())([batch])
    next(started)
    started.close()
    assert given == [1, 1]


def test_word_hashes_do_not_depend_on_chunks(monkeypatch):
    text = ("Hello  the World\n foo É bar\t" * 30).encode()
    whole = shingles.word_hashes(text)
    assert len(set(whole.tolist())) == 6
    monkeypatch.setattr(shingles, "_CHUNK", 17)
    assert (shingles.word_hashes(text) == whole).all()
    assert not (shingles.word_hashes(text, lower=False) == whole).all()


def test_overlaps_survive_substitutions(spark):
    item = prose(30).split()
    cases = {}
    for k, places in enumerate([(), (5,), (3, 9), (0, 29), (12, 13)]):
        words = [f"x{k}" if i in places else w for i, w in enumerate(item)]
        cases[10 + k] = prose(7 + k, 3000) + " " + " ".join(words) + " " + prose(9, 4000)
    for at in range(0, 17):  # exactly one stretch of 13 words with two substitutions
        words = item[at : at + 13]
        words[3] = words[10] = "other"
        cases[100 + at] = prose(at, 5000) + " " + " ".join(words) + " " + prose(8, 6000)
    clean = {200: " ".join(item[:10]) + " " + prose(40, 7000), 201: " ".join(reversed(item))}
    docs = documents(spark, [*cases.items(), *clean.items(), *[r for r in AWKWARD if r[0] in (3, 4, 5, 6)]])
    marks = [(1, " ".join(item)), (1, " ".join(item)), (2, None), (3, ""), (None, prose(20, 90_000)), (4, "a b")]
    bench = spark.createDataFrame(marks, "item_id long, text string")
    found = decontamination.contaminated(docs, bench).collect()
    assert {r.doc_id for r in found} == set(cases)
    assert {r.item_id for r in found} == {1}
    assert all(r.equal_words == 30 - n for r, n in ((r, [0, 1, 2, None, 2][r.doc_id - 10]) for r in found if r.doc_id < 20) if n is not None)
    kept = decontamination.without_benchmark(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - len(cases)
    assert decontamination.contaminated(docs.limit(0), bench).count() == 0
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0


def all_placements(docs, items):
    """The pairs that overlap at any placement, by comparing all words at each."""
    found = set()
    for doc, text in docs:
        d = (text or "").lower().split()
        for item, other in items:
            b = (other or "").lower().split()
            needed = min(13, len(b))
            allowed = 2 if len(b) >= 13 else 1 if len(b) >= 8 else 0
            for shift in range(-len(b), len(d)):
                equal = [x == d[i + shift] for i, x in enumerate(b) if 0 <= i + shift < len(d)]
                runs = range(len(equal) - needed + 1) if b else ()
                if any(sum(equal[s : s + needed]) >= needed - allowed for s in runs):
                    found.add((doc, item))
                    break
    return found


def test_short_items_are_found_at_every_place(spark):
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(1, 16)] + [(0, " "), (99, None)]
    docs, number = [], 0
    for n, text in items[:15]:
        for before in range(4):
            for changed in [(), (0,), (n - 1,), (n // 2,), (0, n - 1), (n // 2 - 1, n // 2)]:
                words = ["other" if i in changed else w for i, w in enumerate(text.split())]
                number += 1
                docs.append((number, " ".join([*prose(before, 100).split(), *words, *prose(n % 3, 200).split()])))
    docs += [(9000, prose(3) + " " + items[11][1]), (9001, None), (9002, ""), (9003, items[6][1].upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contaminated(documents(spark, docs), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == all_placements(docs, items)
    kept = decontamination.without_benchmark(documents(spark, docs), bench)
    flagged = {d for d, i in all_placements(docs, [(n, t) for n, t in items if n >= 8])}
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - flagged


def test_repeated_lines(spark):
    rows = [
        (1, "a\nb\nc\nd"), (2, "x\n a \nb\n\nc\ny"), (3, "a\nb"), (4, None), (5, ""), (6, "a\nb\nc"),
        (6, "a\nb\nc"), (None, "p\nq\nr"), (7, "p\nq\nr\ns"), (8, "k\nk\nk\nk"),
    ]
    docs = documents(spark, rows)
    found = line_dedup.remove_repeated(docs, "removed")
    assert found.columns == [*docs.columns, "removed"]
    got = Counter((r.doc_id, r.text, tuple(r.removed)) for r in found.collect())
    assert got == Counter([
        (1, "a\nb\nc\nd", ()), (2, "x\ny", (1, 2, 3, 4)), (3, "a\nb", ()), (4, None, ()), (5, "", ()),
        (6, "", (0, 1, 2)), (6, "", (0, 1, 2)), (None, "p\nq\nr", ()), (7, "s", (0, 1, 2)),
        (8, "k", (1, 2, 3)),
    ])
    stage = line_dedup.without_repeated_windows(docs)
    assert stage.columns == docs.columns
    assert {(r.doc_id, r.n_chars) for r in stage.collect() if r.doc_id in (2, 5, 6)} == {(2, 3), (5, 0)}
    assert line_dedup.remove_repeated(docs.limit(0)).count() == 0


@pytest.mark.parametrize("index_bytes", [1, 1 << 20])
def test_repeated_bytes(spark, index_bytes):
    rng = np.random.default_rng(2)
    base = bytes(rng.integers(97, 123, 3000, np.uint8)).decode()
    texts = [(1, base), (2, "Z" + base[200:900] + "Y"), (3, base[:1500] + "é" + base[1500:]), (4, "ab" * 300),
             (5, None), (6, ""), (7, "q" * 399), (8, "q" * 401), (None, base[-500:]), (9, base[:399])]
    docs = documents(spark, [*texts, (1, base)])
    data = [(i, (t or "").encode()) for i, t in texts]
    starts = Counter(t[k : k + 400] for _, t in data for k in range(len(t) - 399))
    expected = {}
    for i, t in data:
        out = np.zeros(len(t), bool)
        for k in range(len(t) - 399):
            if starts[t[k : k + 400]] > 1:
                out[k : k + 400] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~out])
        runs = int((np.diff(out.astype(int), prepend=0) == 1).sum())
        expected[i] = (len(t), int(out.sum()), runs, hashlib.sha256(kept).hexdigest())
    settings = substring_dedup.Settings(index_bytes=index_bytes)
    found = substring_dedup.summary(substring_dedup.remove_repeated(docs, settings)).collect()
    assert len(found) == len(texts) + 1
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == expected
    assert substring_dedup.remove_repeated(docs.limit(0)).count() == 0


def test_spans_are_cut_to_what_others_can_repeat():
    rng = np.random.default_rng(6)

    def letters(n):
        return rng.integers(97, 123, n, np.uint8)

    def minimizer_of(data, at):
        sums = substring_dedup._prefix_sums(data, substring_dedup._BYTES)
        return substring_dedup._hashes(sums, np.array([at]), np.array([at + substring_dedup.K]))[0]

    common, texts = letters(520), []
    for own in (100, 200, 260, 520):  # so much is equal around a minimizer at place 330
        for _ in range(2):
            t, half = letters(700), own // 2
            t[346 - half : 346 + half] = common[260 - half : 260 + half]
            texts.append(t)
    minimizers = np.array([minimizer_of(t, 330) for t in texts])
    assert len(set(minimizers.tolist())) == 1
    first, last = substring_dedup._reaches(texts, minimizers, 400)
    assert (last[:6] == -1).all()  # the minimizer alone, or too little around it
    # Windows 86 to 206 of the last two are equal.
    assert (first[6:] <= 86).all() and (last[6:] >= 206).all() and (last[6:] - first[6:] < 121 + 2 * 47).all()
    names = ["minimizer", "one", "two", "bytes"]
    keys = [pa.array(minimizers.view(np.int64)), pa.array(range(8)), pa.array(range(8))]
    table = pa.table([*keys, pa.array([t.tobytes() for t in texts])], names=names)
    made = substring_dedup._index(400)(table)["again"].to_pylist()
    assert made[:6] == [b""] * 6 and [np.frombuffer(m, "<i4").tolist() for m in made[6:]] == [[86, 206]] * 2


def test_edited_copies_lose_what_occurs_twice(spark):
    rng = np.random.default_rng(8)
    base, texts = rng.integers(97, 123, 2500, np.uint8), []
    for k in range(12):
        t = base.copy()
        t[rng.choice(2500, 2 * k % 9, replace=False)] = 65 + k
        texts.append((k, t[rng.integers(0, 300) : 2500 - rng.integers(0, 300)].tobytes()))
    starts = Counter(t[k : k + 400] for _, t in texts for k in range(len(t) - 399))
    docs = spark.createDataFrame([(i, t.decode()) for i, t in texts], "doc_id long, text string")
    found = {r.doc_id: r.removed for r in substring_dedup.remove_repeated(docs).collect()}
    for i, t in texts:
        out = np.zeros(len(t), bool)
        for k in range(len(t) - 399):
            if starts[t[k : k + 400]] > 1:
                out[k : k + 400] = True
        edge = np.flatnonzero(np.diff(out.astype(int), prepend=0, append=0)).tolist()
        assert [(r.start, r.end) for r in found[i]] == list(zip(edge[::2], edge[1::2]))


def test_passages_of_many_words_go_from_400_bytes_on(spark):
    rng = np.random.default_rng(11)

    def letters(n):
        return bytes(rng.integers(98, 123, n, np.uint8)).decode()

    texts, expected = [letters(2000)], [0]
    for size, last in ((399, "a"), (400, "a"), (901, "a"), (399, "é"), (401, "é")):
        passage = " ".join(letters(4) for _ in range(60))
        passage = f" {passage}{last * ((size - 301) // len(last.encode()))} "
        assert len(passage.split()) == 60 and len(passage.encode()) == size
        texts += [f"{letters(300)}{c}{passage}{c}{letters(300)}" for c in "XY"]
        expected += [size if size >= 400 else 0] * 2
    docs = documents(spark, list(enumerate(texts)))
    found = sorted(substring_dedup.summary(substring_dedup.remove_repeated(docs)).collect())
    assert [r.n_removed for r in found] == expected
    assert [r.n_spans for r in found] == [int(n > 0) for n in expected]
    assert [r.n_bytes for r in found] == [len(t.encode()) for t in texts]


def test_run_index_statistics():
    rng = np.random.default_rng(4)
    for _ in range(20):
        texts = [bytes(rng.integers(97, 99, rng.integers(1, 40), np.uint8)) for _ in range(rng.integers(1, 7))]
        symbols = np.concatenate([np.append(np.frombuffer(t, np.uint8).astype(np.int16) + 1, 0) for t in texts])
        found, at = substring_dedup.RunIndex(symbols).statistics(), 0
        for length in (3, 7):
            counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
            at = 0
            for t in texts:
                for i in range(len(t) - length + 1):
                    assert (found[at + i] >= length) == (counts[t[i : i + length]] > 1)
                at += len(t) + 1


def test_urls(spark):
    urls = [
        "http://A.Example.com/en/1", "https://www.example.com/en/x?q#f", "http://example.com/en/", "ftp://shop.net/fr/a",
        "http://notnet/es/", "http://x.net/es", "nothing", None, "", "http://x.org/a://b", "http://com?x/", "http://com/",
    ]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)] + [(None, urls[0], None)], "page_id long, url string, host string")
    rows = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert len(rows) == len(urls) + 1
    assert (rows[0].host, rows[0].path, rows[0].rule, rows[0].verdict) == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert (rows[1].path, rows[1].rule, rows[1].verdict) == ("/en/x", "www.example.com/en/", "allow")
    assert [rows[k].rule for k in (2, 3, 4, 5, 11)] == ["example.com/en/", "net/fr/", None, None, "com/"]
    assert [(rows[k].host, rows[k].path) for k in (6, 7, 8, 9, 10)] == [("", ""), ("", ""), ("", ""), ("x.org", "/a://b"), ("com", "")]
    assert {r.verdict for r in rows.values()} <= {"allow", "block"}
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_rare_substrings_count_at_every_size(spark):
    texts = [(f"\x02{'a' * 30}{k}/x\x03", 1) for k in range(2000)]
    texts += [("\x02qz\x03", 1), ("\x02yz\x03", 0), ("\x02aay\x03", 0)]
    examples = spark.createDataFrame(texts, "text string, accepted int")
    weights, unknown = url_filter._model(examples, url_filter.Settings())
    assert weights.filter("s = '\x02qz\x03'").count() == 1
    table = examples.select("text")
    sent, joined = [
        sorted(url_filter._scores(table, weights, unknown, url_filter.Settings(most_sent=most, hot_share=1e-3)).collect())
        for most in (10**9, 0)
    ]
    assert sent == joined and len(sent) == len(texts)


def test_url_weights_are_those_of_the_models(spark):
    texts = [("\x02ab\x03", 1), ("\x02abab\x03", 1), ("\x02cb\x03", 0), ("\x02ca\x03", 0)]
    settings = url_filter.Settings(order=2, min_share=0.0)
    examples = spark.createDataFrame(texts, "text string, accepted int")
    weights, unknown = url_filter._model(examples, settings)
    table = spark.createDataFrame([(t,) for t, _ in texts] + [("\x02zb\x03",)], "text string")
    scores = {r.text: r.score for r in url_filter._scores(table, weights, unknown, settings).collect()}

    def loss(text, side):
        own, total = [t for t, a in texts if a == side], 0.0
        count = lambda s: sum(sum(t.startswith(s, i) for i in range(len(t))) for t in own)
        n, m = sum(len(t) - 1 for t in own), settings.mass
        for i in range(1, len(text)):
            p = (count(text[i]) + m / settings.alphabet) / (n + m)
            for k in range(1, min(settings.order, i) + 1):
                context = text[i - k : i]
                after = sum(count(context + c) for c in {c for t in texts for c in t[0]})
                p = (count(context + text[i]) + m * p) / (after + m)
            total += np.log(p)
        return total

    for text, score in scores.items():
        assert score == pytest.approx((loss(text, 1) - loss(text, 0)) / (len(text) - 1), abs=1e-4)


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    sf_dir = str(TESTDATA / "sf0.001")
    con = oracle_connection(sf_dir)
    try:
        assert differences(queries.queries()[name](spark, sf_dir), con, queries.oracle_sql()[name]) == []
    finally:
        con.close()


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf_dir = str(TESTDATA / "sf0.001")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept, columns = docs, docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sf_dir)
        assert kept.columns == columns
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in kept.select("doc_id").collect()}
    assert 0 < len({p.doc_id for p in pieces}) < docs.count()
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())
