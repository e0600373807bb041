"""Operators on single documents against plain computations."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import AWKWARD, documents, prose

from yearloom.llm import fertility, lm_scoring, packing, toxicity, warc

P = pytest.importorskip("public_tokenizers")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_toxicity_learns_and_scores_every_row(spark):
    clean = [(i, prose(20, 7 * i)) for i in range(100, 180)]
    toxic = [(i, prose(20, 7 * i) + " wretched") for i in range(200, 280)]
    marks = [(i, 1, 0) for i, _ in clean] + [(i, 1, 1) for i, _ in toxic] + [(None, 1, 1), (999, None, None)]
    docs = documents(spark, clean + toxic + AWKWARD)
    rows = toxicity.score_documents(docs, labels(spark, marks)).collect()
    assert len(rows) == docs.count()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == held(r.doc_id)
    found = {r.doc_id: r.predicted for r in rows if r.doc_id and r.doc_id >= 100}
    assert np.mean([found[i] == 0 for i, _ in clean]) > 0.95
    assert np.mean([found[i] == 1 for i, _ in toxic]) > 0.95
    kept = toxicity.without_toxic(docs, labels(spark, marks))
    assert kept.columns == docs.columns
    assert 3 in {r.doc_id for r in kept.collect()}


def test_toxicity_without_examples(spark):
    docs = documents(spark, AWKWARD)
    scores = toxicity.score_documents(docs, labels(spark, [(1, 1, 0)])).collect()
    assert {r.predicted for r in scores} == {0}
    assert toxicity.score_documents(docs.limit(0), labels(spark, [])).count() == 0


def test_fertility_figures(spark):
    text = "a b c\na b c\nx # y\n \na b c"
    own = fertility.Pieces(P.path("piece_bpe_32k.model"))
    n_words, chars, symbols, lines, repeated, tokens, *_ = fertility.measures(text, own)
    assert (n_words, chars, symbols, lines, repeated) == (12, 12, 1, 2, 9)
    ids = own.ids(text.split())
    counts = np.array(list(Counter(ids.tolist()).values())) / len(ids)
    assert tokens == len(ids)
    assert fertility.measures(text, own)[-1] == pytest.approx(-(counts * np.log2(counts)).sum())
    assert fertility.script_of("привет, hi") == "Cyrillic"
    assert fertility.measures("\U000f0000" * 8, own)[8] > 0.9
    docs = documents(spark, AWKWARD)
    rows = fertility.judge(docs, P.path("piece_bpe_32k.model")).collect()
    assert len(rows) == len(AWKWARD)
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    assert fertility.judge(docs.limit(0), P.path("piece_bpe_32k.model")).count() == 0


def test_losses_are_those_of_a_plain_model(spark):
    # A model that still holds the document that it scores.
    settings = lm_scoring.Settings(leave_out=False)
    docs = documents(spark, AWKWARD)
    given = labels(spark, [(1, 1, 0), (6, 0, 0), (1, 1, 0), (None, 1, 0)])
    scored = lm_scoring.score_documents(docs, given, settings)
    rows = scored.collect()
    assert len(rows) == len(AWKWARD)
    assert all((r.difference is None) == (r.n_words == 0) for r in rows)
    text = next(t for i, t in AWKWARD if i == 1)
    words = [w.lower() for w in text.split()]
    single, pairs = Counter(words), Counter(zip(words, words[1:]))
    size, losses = 1 << settings.word_bits, []
    for before, word in zip([None, *words], words):
        p1 = (single[word] + settings.added) / (len(words) + settings.added * size)
        weight = settings.pair_weight if before else 0.0
        p2 = pairs[before, word] / single[before] if before else 0.0
        losses.append(-np.log2(weight * p2 + (1 - weight) * p1))
    mine = next(r for r in rows if r.doc_id == 1)
    assert mine.target_loss == pytest.approx(np.mean(losses), rel=1e-5)
    assert lm_scoring.score_documents(docs.limit(0), labels(spark, [])).count() == 0


def test_rare_script_has_its_own_bands(spark):
    rng = np.random.default_rng(3)
    latin, han = [f"word{k}" for k in range(300)], [chr(0x4E00 + k) + chr(0x4E80 + k) for k in range(100)]
    text = lambda words: " ".join(rng.choice(words, 80).tolist())
    rows = [(k, "en", text(latin)) for k in range(150)]
    rows += [(1000 + k, "zh", text(han)) for k in range(12)] + [(2000 + k, None, text(han)) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    found = fertility.judge(docs, P.path("piece_bpe_32k.model")).collect()
    assert all(r.kept for r in found if r.doc_id >= 1000)
    assert sum(r.kept for r in found) > 155
    assert fertility.script_of("’ hi") == fertility.script_of("") == "Latin"


def plain_losses_left_out(texts, good, settings):
    """As ``plain_losses``, with models made anew without each text."""
    lists = [t.lower().split() for t in texts]
    size = max(len({w for words in lists for w in words}), 1 << settings.word_bits)
    for left, words in enumerate(lists):
        sides = []
        for chosen in (good, range(len(texts))):
            single, pairs = Counter(), Counter()
            for k in chosen:
                if k != left:
                    single.update(lists[k])
                    pairs.update(zip(lists[k], lists[k][1:]))
            sides.append((single, pairs))
        n_good, n_all = (sum(single.values()) for single, _ in sides)
        means = []
        for (single, pairs), share in zip(sides, (1.0, n_good / n_all)):
            losses = []
            for before, word in zip([None, *words], words):
                p1 = (share * single[word] + settings.added) / (n_good + settings.added * size)
                weight = settings.pair_weight * (1 - (1 - share) ** single[before])
                p2 = pairs[before, word] / max(single[before], 1)
                losses.append(-np.log2(weight * p2 + (1 - weight) * p1))
            means.append(np.mean(losses))
        yield means


def test_own_counts_are_left_out(spark):
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{int(k)}" for k in rng.zipf(1.4, 90) % 500) for _ in range(40)] + ["same text here"] * 2
    good = list(range(0, 42, 4))
    docs = documents(spark, list(enumerate(texts))).repartition(3)
    settings = lm_scoring.Settings(word_bits=5)
    found = lm_scoring.score_documents(docs, labels(spark, [(k, 1, 0) for k in good]), settings).collect()
    for r, expected in zip(sorted(found), plain_losses_left_out(texts, good, settings), strict=True):
        assert (r.target_loss, r.background_loss) == pytest.approx(expected, rel=1e-9)


def test_a_label_does_not_make_a_document_familiar(spark):
    rng = np.random.default_rng(8)
    kinds = [[f"g{k}" for k in range(80)], [f"b{k}" for k in range(80)]]
    texts = [" ".join(rng.choice(kinds[i % 3 == 0], 60)) for i in range(150)]
    good = [i for i in range(150) if i % 3]
    labelled = set(good[::2])
    found = lm_scoring.score_documents(
        documents(spark, list(enumerate(texts))), labels(spark, [(k, 1, 0) for k in labelled])
    ).collect()
    scores = {r.doc_id: r.difference for r in found}
    told = np.median([scores[k] for k in labelled])
    held = np.median([scores[k] for k in good if k not in labelled])
    bad = np.median([scores[k] for k in range(0, 150, 3)])
    assert abs(told - held) < 0.1 * (bad - held)


def plain_losses(texts, good, settings):
    """Both mean losses of every text by exact counts, with a dictionary of words."""
    sides, lists = [], [t.lower().split() for t in texts]
    for chosen in (good, range(len(texts))):
        single, pairs = Counter(), Counter()
        for k in chosen:
            single.update(lists[k])
            pairs.update(zip(lists[k], lists[k][1:]))
        sides.append((single, pairs))
    size = max(len(sides[1][0]), 1 << settings.word_bits)
    n_good, n_all = (sum(single.values()) for single, _ in sides)
    for words in lists:
        means = []
        for (single, pairs), share in zip(sides, (1.0, n_good / n_all)):
            losses = []
            for before, word in zip([None, *words], words):
                p1 = (share * single[word] + settings.added) / (n_good + settings.added * size)
                weight = settings.pair_weight * (1 - (1 - share) ** single[before])
                p2 = pairs[before, word] / max(single[before], 1)
                losses.append(-np.log2(weight * p2 + (1 - weight) * p1))
            means.append(np.mean(losses))
        yield means


def test_losses_with_more_words_than_the_least_vocabulary(spark):
    rng = np.random.default_rng(5)
    settings = lm_scoring.Settings(word_bits=6, leave_out=False)
    texts = [" ".join(f"W{int(k)}" for k in rng.zipf(1.3, 120) % 4000) for _ in range(60)]
    good = list(range(0, 60, 3))
    docs = documents(spark, list(enumerate(texts))).repartition(5)
    found = lm_scoring.score_documents(docs, labels(spark, [(k, 1, 0) for k in good]), settings).collect()
    for r, expected in zip(sorted(found), plain_losses(texts, good, settings), strict=True):
        assert (r.target_loss, r.background_loss) == pytest.approx(expected, rel=1e-9)


def test_background_is_counted_on_every_document(spark):
    rows = [(k, prose(40)) for k in range(3)] + [(k, prose(40, 100 * k)) for k in range(10, 50)]
    found = lm_scoring.score_documents(documents(spark, rows), labels(spark, [(k, 1, 0) for k in range(3)]))
    # Documents that are alike but for their words, whatever their id.
    losses = [r.background_loss for r in found.collect() if r.doc_id >= 10]
    assert len(losses) == 40 and max(losses) == pytest.approx(min(losses))


@pytest.mark.parametrize(
    "folder, kind, path",
    [
        ("file:///a/b", "local", "/a/b"),
        ("/a/b", "local", "/a/b"),
        ("dbfs:/a/b", "local", "/dbfs/a/b"),
        ("s3a://bucket/a/b?region=eu-west-1", "s3", "bucket/a/b"),
    ],
)
def test_folders_of_stores(folder, kind, path):
    files, base = warc._opened(folder)
    assert (files.type_name, base) == (kind, path)


def test_archives_come_back(spark):
    big = "x" * 300_000 + "é\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://a/ b", "same"), (5, None, "same"), (5, "u", "same"), (3, "http://c", big),
            (4, "d", None), (6, "e", ""), (None, "f", "same"), (None, None, "alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = warc.scratch_dir(spark, "test-warc")
    archives = warc.write_archives(pages, folder)
    chunks = warc.read_chunks(archives, folder, chunk_bytes=1000).cache()
    whole = chunks.filter("record_id = '<urn:page:3>'").orderBy("chunk").collect()
    assert b"".join(bytes(c.payload) for c in whole) == big.encode()
    digest = hashlib.sha1()
    for c in whole:
        digest.update(bytes(c.payload))
        assert len(c.payload) <= 1000 and c.digest == base64.b32encode(digest.digest()).decode()
    assert [c.last for c in whole] == [False] * (len(whole) - 1) + [True]
    assert chunks.filter("record_type = 'response' AND last AND digest <> stated_digest").count() == 0
    found = warc.round_trip(pages).collect()
    assert len(found) == len(rows)
    refers = sorted((r.page_id or 0, r.record_type, r.refers_to or 0, r.payload_bytes) for r in found)
    assert refers == [
        (0, "response", 0, 5), (0, "revisit", 5, 4), (1, "revisit", 5, 4),
        (3, "response", 0, len(big.encode())), (4, "revisit", 6, 0), (5, "response", 0, 4),
        (5, "response", 0, 4), (6, "response", 0, 0),
    ]
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_fullest_is_the_best_subset():
    rng = np.random.default_rng(1)
    for _ in range(60):
        have = {int(n): int(c) for n, c in zip(rng.integers(1, 12, 4), rng.integers(1, 4, 4))}
        target = int(rng.integers(1, 30))
        sums = {0}
        for n, c in have.items():
            sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= target}
        taken = packing.fullest(have, target)
        assert sum(n * c for n, c in taken.items()) == max(sums)
        assert all(c <= have[n] for n, c in taken.items())


def test_packed_pieces_are_whole_and_gapless(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = P.path("word_bpe_49k.json")
    docs = documents(spark, AWKWARD + [(100 + k, prose(9 + k % 5, 13 * k)) for k in range(60)])
    pieces = packing.pack(docs, path, capacity=64).collect()
    full, by_sequence = tokenizers.Tokenizer.from_file(path), {}
    texts = Counter()
    for i, t in [(r.doc_id, r.text) for r in docs.collect()]:
        ids = np.array([*full.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        texts[i] += len(ids) // 4
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    short = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
        short += at < 64
    assert short <= 1
    totals = Counter()
    for p in pieces:
        totals[p.doc_id] += p.length
    assert totals == texts
    text = docs.filter("doc_id = 7").first().text
    ids = b"".join(bytes(p.ids) for p in sorted((p for p in pieces if p.doc_id == 7), key=lambda p: p.start))
    assert ids == np.array([*full.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes()
    assert packing.pack(docs.limit(0), path).count() == 0


def test_word_ids_are_those_of_the_whole_text():
    tokenizers = pytest.importorskip("tokenizers")
    from yearloom.llm.tokens import WordTokenizer

    path = P.path("word_bpe_49k.json")
    whole, own = tokenizers.Tokenizer.from_file(path), WordTokenizer(path)
    texts = ["", "It's we'll, don't.. A1b2 12,5 x-y", "İstanbul. İ, ΑΣ Σ", "J̌ é É ß ẞ,", "\ta\r\n b  c", "a" * 400 + "."]
    for t in texts:
        assert own.ids(t) == np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_plain_words_are_merged_without_the_patterns():
    tokenizers = pytest.importorskip("tokenizers")
    from yearloom.llm.tokens import WordTokenizer

    path = P.path("word_bpe_49k.json")
    whole, own = tokenizers.Tokenizer.from_file(path), WordTokenizer(path)
    full, cut = own._encode, []
    own._encode = lambda words, **more: cut.extend(words) or full(words, **more)
    ids = lambda texts: [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    plain = ["alpha Été, gamma***", "", "beta. alpha, été*** ß\nÿ..."]
    assert own.ids_of(plain) == ids(plain)
    assert sorted(cut) == ["***", ",", ".", "..."]
    odd = ["dogs' don't x'. 's a's.", "a<|endoftext|> <|endoftext|>. b", "e\u0301té <\u0338 ª ﬁn", "a.b (c) d\u00a0e", "\x1c"]
    assert own.ids_of(odd) == ids(odd)
    assert own.ids_of([]) == []


def plain_verdicts(texts, pieces, settings):
    """Whether each (text, language) is kept, with bands from all sound ones."""
    names, failed, figures = [], [], []
    for text, lang in texts:
        n_words, _, _, _, repeated, _, *own = fertility.measures(text, pieces)
        script = fertility.script_of(text or "")
        names.append((lang or f"script {script}", script))
        failed.append(n_words < 50 or 100 * repeated > 50 * n_words)
        figures.append(own)

    def quartiles(of):
        rows = [[round(x, 3) for x in own] for own, f, n in zip(figures, failed, names) if not f and of in n]
        return len(rows), np.percentile(np.array(rows), [25, 75], axis=0).T if rows else None

    for (lang, script), own, bad in zip(names, figures, failed):
        (n, mine), (of_script, theirs) = quartiles(lang), quartiles(script)
        kept = not bad
        for k, slack in enumerate(settings.slack if kept else ()):
            low, high = (n * mine[k] + settings.prior * theirs[k]) / (n + settings.prior)
            around = (high - low) * settings.reach + slack * (1 + (settings.prior / of_script) ** 0.5)
            kept = kept and low - around <= own[k] <= high + around
        yield kept


def test_bands_are_those_of_plain_quartiles(spark):
    rng = np.random.default_rng(4)
    words = {
        "en": "the quick brown fox jumps over lazy dogs and then runs home".split(),
        "ru": "быстрая коричневая лиса прыгает через ленивую собаку домой".split(),
        None: "παντα ρει και ουδεν μενει ποταμος δις εμβαιη".split(),
    }
    texts = []
    for lang, own in words.items():
        for i in range(40):
            text = " ".join(f"{a}{b}" for a, b in zip(rng.choice(own, 80), rng.choice(own, 80)))
            texts.append((text, lang))
        texts += [(" ".join(f"{k:x}q{k * 7919:x}" for k in range(90)), lang), (" ".join(own * 30), lang)]
    texts += [("\U000f0000 " * 60, "en"), (None, "en"), ("few words", "ru")]
    model = P.path("piece_bpe_32k.model")
    rows = [(i, t, g) for i, (t, g) in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r.kept for r in fertility.judge(docs, model).collect()}
    expected = list(plain_verdicts(texts, fertility.Pieces(model), fertility.Settings()))
    assert [found[i] for i in range(len(texts))] == expected
    assert 0 < sum(expected) < len(texts)
