"""Phrases that stand together more often than their words, mined by Toivonen's method.

A sample of the documents proposes the words and phrases that are probably
frequent. One pass over all documents then counts these proposals exactly, and
with them the negative border: phrases that were not proposed while both phrases
of one word less that they hold were. A phrase of the border that turns out
frequent has not been counted by itself yet and may be part of longer ones, so
it joins the proposals and another pass follows, until no border fails.

Proposals are sets of bits of a fixed size that every task gets; a phrase that
shares its bit with another is counted for nothing, never the reverse. The
border is much larger than what is frequent. Its phrases are counted in shared
counters, by a hash of 32 bits and more: the sum of a counter is exact and at
least the count of every phrase in it, so a counter below the limit proves that
its phrases are infrequent. The phrases of the other counters count as failures
and get a count of their own in the next pass. Every number that is returned is
a count of its own.

Words stand as 64-bit hashes, mixed with the language, until the result.
"""

import re
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearloom.llm.rows import quoted
from yearloom.llm.shingles import mixed
from yearloom.operators import skew_safe_join
from yearloom.scratch import remove, scratch_dir, settled

# What ends a word, and what of that ends a piece.
_BLANKS, _STOPS = b" \t", b".,;:!?\n\x0b\x0c\r"
_GAP, _STOP = np.zeros(256, bool), np.zeros(256, bool)
_GAP[[*_BLANKS, *_STOPS]] = True
_STOP[[*_STOPS]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_GAP_BYTE = re.compile(rb"[ \t.,;:!?\n-\r]")
_TWO_WORDS = re.compile(rb"[ \t]*[^ \t.,;:!?\n-\r]+(?:[ \t]+[^ \t.,;:!?\n-\r]+)?")

#: Bytes of text looked at together, and entries held before they are passed on.
_CHUNK, _HELD = 1 << 20, 1 << 18
#: Bits of a set of proposals at most, as a power of two, and the bytes of text
#: for each range of hashes.
_BITS, _RANGE = 27, 4 << 20
#: Kinds of entries beside the phrases of 1 to 3 words: totals, and shared counters.
_TOTAL, _SHARED = 0, 10

_ENTRIES = "r long, kind int, keys binary, n binary, lang string, word string"
_ENTRIES_ARROW = pa.schema(
    [("r", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("n", pa.binary())]
    + [("lang", pa.string()), ("word", pa.string())]
)
_COUNTS = "kind int, w1 long, w2 long, w3 long, n long, lang string, word string"
_COUNTS_ARROW = pa.schema(
    [("kind", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64()), ("w3", pa.int64())]
    + [("n", pa.int64()), ("lang", pa.string()), ("word", pa.string())]
)


def _chunks(texts: Iterator[tuple[str, bytes]]) -> Iterator[tuple[list[bytes], list[str], int]]:
    """Texts put together to chunks; of a longer text, parts that overlap by two words.

    With each chunk comes the place before which a phrase has to begin to count.
    """
    held, langs, size = [], [], 0
    for lang, text in texts:
        start = 0
        while len(text) - start > _CHUNK:
            gap = _GAP_BYTE.search(text, start + _CHUNK)
            cut = gap.start() if gap else len(text)
            more = _TWO_WORDS.match(text, cut)
            yield [text[start : more.end() if more else cut]], [lang], cut - start
            start = cut
        held.append(text[start:] if start else text)
        langs.append(lang)
        size += len(held[-1]) + 1
        if size >= _CHUNK:
            yield held, langs, size
            held, langs, size = [], [], 0
    if held:
        yield held, langs, size


class _Words:
    """The words of a chunk in order: hashes, places and the pieces they are in."""

    def __init__(self, texts: list[bytes], langs: list[str], seeds: dict[str, np.uint64]):
        self.bytes = b"\n".join(texts)
        data = np.frombuffer(self.bytes, np.uint8)
        gap = _GAP[data]
        edge = np.flatnonzero(np.diff(gap, prepend=True, append=True))
        self.starts, self.ends = edge[::2], edge[1::2]
        lengths = self.ends - self.starts
        if not len(lengths):
            self.hashes = np.zeros(0, np.uint64)
            self.piece = self.text = np.zeros(0, np.int64)
            return
        first = np.cumsum(lengths) - lengths
        letters = _BYTES[_LOWER[data[~gap]]]
        power = np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        letters *= power[np.arange(len(letters)) - np.repeat(first, lengths)]
        own = np.add.reduceat(letters, first)
        sizes = np.array([len(t) + 1 for t in texts])
        self.text = np.searchsorted(np.cumsum(sizes), self.starts, "right")
        seed = np.array([seeds[x] for x in langs], np.uint64)[self.text]
        self.hashes = mixed(mixed(own + lengths.astype(np.uint64)) + seed)
        self.piece = np.cumsum(_STOP[data], dtype=np.int32)[self.starts]

    def word(self, i: int) -> str:
        data = self.bytes[self.starts[i] : self.ends[i]]
        return data.translate(bytes(_LOWER)).decode("utf-8", "replace")


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hashes of phrases from those of their parts."""
    return mixed(left * _STEP + right)


def _has(bits: bytes | None, keys: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.zeros(len(keys), bool)
    held = np.frombuffer(bits, np.uint64)
    slot = keys & np.uint64(64 * len(held) - 1)
    return (held[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


class _Held:
    """Entries of a task, equal ones added up, until there are many."""

    def __init__(self, ranges: int):
        self.ranges, self.size = np.uint64(ranges), 0
        self.phrases: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.words: dict[int, int] = {}
        self.names: dict[int, tuple[str, str]] = {}
        self.totals: dict[str, int] = {}

    def add_totals(self, found: _Words, core: int, langs: list[str]) -> None:
        for i, count in enumerate(np.bincount(found.text[:core], minlength=len(langs)).tolist()):
            self.totals[langs[i]] = self.totals.get(langs[i], 0) + count

    def add_words(self, found: _Words, places: np.ndarray, langs: list[str]) -> None:
        keys, first, n = np.unique(found.hashes[places], return_index=True, return_counts=True)
        for key, i, count in zip(keys.tolist(), places[first].tolist(), n.tolist()):
            if key in self.words:
                self.words[key] += count
            else:
                self.words[key] = count
                self.names[key] = (langs[found.text[i]], found.word(i))

    def add(self, kind: int, columns: list[np.ndarray], key: np.ndarray) -> None:
        """Phrases by the hashes of their words, or by nothing but their own."""
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        rows = np.column_stack([key[first], *[c[first] for c in columns]])
        self.phrases.setdefault(kind, []).append((rows, n))
        self.size += len(n)

    def _merged(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.concatenate([r for r, _ in self.phrases[kind]])
        n = np.concatenate([n for _, n in self.phrases[kind]])
        _, first, of = np.unique(rows[:, 0], return_index=True, return_inverse=True)
        return rows[first], np.bincount(of, n, minlength=len(first)).astype(np.int64)

    def full(self) -> bool:
        """Whether there are too many entries even when equal ones are added up."""
        if self.size < 2 * _HELD:
            return len(self.words) > _HELD
        self.phrases = {kind: [self._merged(kind)] for kind in self.phrases}
        self.size = sum(len(n) for held in self.phrases.values() for _, n in held)
        return self.size > _HELD

    def passed_on(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """The phrases in packets for each range of hashes; of words, many or the last ones."""
        made = []
        for kind in self.phrases:
            rows, n = self._merged(kind)
            key = rows[:, 0]
            r = (key >> np.uint64(32)) % self.ranges
            order = np.argsort(r, kind="stable")
            rows, n, r = rows[order], n[order], r[order]
            edges = np.flatnonzero(np.diff(r, prepend=np.uint64(2**63), append=np.uint64(2**63)))
            if kind > _SHARED:
                body, n = (rows[:, 0] & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.minimum(n, 255).astype(np.uint8)
            else:
                body = np.ascontiguousarray(rows[:, 1:])
            for a, z in zip(edges, edges[1:]):
                made.append((int(r[a]), kind, body[a:z].tobytes(), n[a:z].tobytes(), None, None))
        self.phrases, self.size = {}, 0
        entries = iter(made)
        if last or len(self.words) > _HELD:
            entries = chain(made, self._words_and_totals())
        while some := list(islice(entries, 4096)):
            columns = zip(*some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _ENTRIES_ARROW)], schema=_ENTRIES_ARROW
            )

    def _words_and_totals(self) -> Iterator[tuple]:
        ranges = int(self.ranges)
        for key, n in self.words.items():
            own = key.to_bytes(8, "little")
            yield (key >> 32) % ranges, 1, own, n.to_bytes(8, "little"), *self.names[key]
        for lang, n in self.totals.items():
            yield hash_of(lang) % ranges, _TOTAL, b"", n.to_bytes(8, "little"), lang, None
        self.words, self.names, self.totals = {}, {}, {}


def hash_of(text: str) -> int:
    """A 64-bit hash of a short text that is the same in every process."""
    data = np.frombuffer(text.encode(), np.uint8)
    own = np.uint64(len(data))
    for byte in _BYTES[data]:
        own = mixed(np.array([own * _STEP + byte], np.uint64))[0]
    return int(own)


def _texts(batches, seeds: dict[str, np.uint64]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            if lang not in seeds:
                with np.errstate(over="ignore"):
                    seeds[lang] = np.uint64(hash_of(lang))
            yield lang, text.as_buffer().to_pybytes() if text.is_valid else b""


def _sampled(ranges: int):
    """Every word and phrase of a task's texts, in shared counters."""

    def scan(batches):
        np.seterr(over="ignore")
        seeds, held = {}, _Held(ranges)
        for texts, langs, end in _chunks(_texts(batches, seeds)):
            found = _Words(texts, langs, seeds)
            w = found.hashes
            core = int(np.searchsorted(found.starts, end))
            held.add(_SHARED + 1, [], w[:core])
            together = found.piece[1:] == found.piece[:-1]
            pairs = _joined(w[:-1], w[1:])
            own = pairs[:core][together[:core]]
            held.add(_SHARED + 2, [], own)
            threes = _joined(pairs[:-1], w[2:])
            own = threes[:core][(together[:-1] & together[1:])[:core]]
            held.add(_SHARED + 3, [], own)
            if held.full():
                yield from held.passed_on()
        yield from held.passed_on(last=True)

    return scan


def _counted(ranges: int, now, before, first: bool):
    """Proposals and borders of a task's texts that no earlier pass has counted.

    ``now`` and ``before`` are broadcast sets of proposals by number of words.
    """

    def scan(batches):
        np.seterr(over="ignore")
        seeds, held = {}, _Held(ranges)
        new, old = ([_unpacked(x) for x in sent.value] for sent in (now, before))
        for texts, langs, end in _chunks(_texts(batches, seeds)):
            found = _Words(texts, langs, seeds)
            w = found.hashes
            core = int(np.searchsorted(found.starts, end))
            known, knew = _has(new[1], w[:core]), _has(old[1], w[:core])
            held.add_words(found, np.flatnonzero(known & ~knew), langs)
            if first:
                held.add_totals(found, core, langs)
                held.add(_SHARED + 1, [], w[:core][~known])
            pairs = _joined(w[:-1], w[1:])
            threes = _joined(pairs[:-1], w[2:])
            together = found.piece[1:] == found.piece[:-1]
            at = {2: together.copy(), 3: together[:-1] & together[1:]}
            parts, keys = {2: w, 3: pairs}, {2: pairs, 3: threes}
            for size in (2, 3):
                at[size][core:] = False
                known, knew = _has(new[size - 1], parts[size]), _has(old[size - 1], parts[size])
                places = np.flatnonzero(at[size] & known[:-1] & known[1:])
                key = keys[size][places]
                could = knew[places] & knew[places + 1]
                proposed = _has(new[size], key)
                own = places[proposed & ~(could & _has(old[size], key))]
                held.add(size, [w[own + k] for k in range(size)], keys[size][own])
                border = key[~proposed & ~could]
                held.add(_SHARED + size, [], border)
            if held.full():
                yield from held.passed_on()
        yield from held.passed_on(last=True)

    return scan


def _added_up(least: int):
    """Of a range of hashes: what occurs ``least`` times or more, and all totals."""

    def frequent(entries: pa.Table) -> pa.Table:
        made = []
        kinds = entries["kind"].to_numpy()
        for kind in np.unique(kinds).tolist():
            own = entries.filter(pa.array(kinds == kind))
            if kind in (_TOTAL, 1):
                made.append(_strings(own, kind, least))
                continue
            width, (key_type, n_type) = kind, (np.uint64, np.int64)
            if kind > _SHARED:
                width, key_type, n_type = 1, np.uint32, np.uint8
            rows = np.frombuffer(b"".join(own["keys"].to_pylist()), key_type).reshape(-1, width)
            n = np.frombuffer(b"".join(own["n"].to_pylist()), n_type).astype(np.int64)
            order = np.lexsort(rows.T[::-1])
            rows, n = rows[order], n[order]
            starts = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)]))
            total = np.add.reduceat(n, starts)
            kept = total >= least
            rows, total = rows[starts[kept]].astype(np.uint64).view(np.int64), total[kept]
            none, zero = pa.nulls(len(total), pa.string()), np.zeros(len(total), np.int64)
            columns = [rows[:, k] if k < width else zero for k in range(3)]
            made.append(
                pa.table([np.full(len(total), kind, np.int32), *columns, total, none, none], schema=_COUNTS_ARROW)
            )
        return pa.concat_tables(made)

    return frequent


def _strings(own: pa.Table, kind: int, least: int) -> pa.Table:
    found: dict[tuple, int] = {}
    for key, n, lang, word in zip(*(own[c].to_pylist() for c in ("keys", "n", "lang", "word"))):
        name = (int.from_bytes(key, "little", signed=True), lang, word)
        found[name] = found.get(name, 0) + int.from_bytes(n, "little")
    rows = [(kind, w, 0, 0, n, lang, word) for (w, lang, word), n in found.items() if n >= least or kind == _TOTAL]
    columns = zip(*rows) if rows else [[]] * len(_COUNTS_ARROW)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _COUNTS_ARROW)], schema=_COUNTS_ARROW)


def _unpacked(bits: bytes | None) -> bytes | None:
    return None if bits is None else zlib.decompress(bits)


def _bits(keys: DataFrame, power: int) -> bytes | None:
    """The packed set of the bits of column ``w1``, or None if there are no rows.

    One row for each 64 bits that are not all empty, 2**21 at most.
    """
    slot = F.col("w1").bitwiseAND(F.lit((1 << power) - 1))
    mask = F.expr("shiftleft(1L, CAST(w1 & 63 AS int))")
    rows = keys.groupBy(F.shiftrightunsigned(slot, 6).alias("at")).agg(F.bit_or(mask).alias("mask")).toArrow()
    if not rows.num_rows:
        return None
    made = np.zeros(1 << (power - 6), np.uint64)
    made[rows["at"].to_numpy()] = rows["mask"].to_numpy().view(np.uint64)
    return zlib.compress(made.tobytes(), 1)


def _either(one: bytes | None, other: bytes | None) -> bytes | None:
    if one is None or other is None:
        return one if other is None else other
    both = (np.frombuffer(zlib.decompress(x), np.uint64) for x in (one, other))
    return zlib.compress(np.bitwise_or(*both).tobytes(), 1)


def frequent_phrases(texts: DataFrame, least: int, sample: float, lowered: float, path: str) -> DataFrame:
    """All words and phrases of 2 and 3 words with ``least`` occurrences, and totals.

    ``texts`` has ``lang`` and ``text``. Gives ``kind`` (the number of words, 0
    for a language's words in all), hashes, ``n``, and texts for words.
    """
    spark = texts.sparkSession
    context = spark.sparkContext
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges, power = max(16, size // _RANGE), min(_BITS, max(16, size.bit_length() - 4))

    def added(texts: DataFrame, scan, least: int, what: str) -> DataFrame:
        entries = texts.mapInArrow(scan, _ENTRIES)
        counts = entries.groupBy("r").applyInArrow(_added_up(least), _COUNTS)
        return settled(counts, "phrases", f"{path}/{what}")

    chosen = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(sample * (1 << 20)))
    likely = max(1, int(least * sample * lowered))
    proposed = added(chosen, _sampled(ranges), likely, "sample")
    now = [None, *(_bits(proposed.filter(F.col("kind") == _SHARED + k), power) for k in (1, 2, 3))]
    before, passes = [None] * 4, []
    while True:
        # None of the sets is longer than 2**27 bits, packed or not.
        sent, told = context.broadcast(now), context.broadcast(before)
        scan = _counted(ranges, sent, told, first=not passes)
        passes.append(added(texts, scan, least, f"pass{len(passes)}"))
        failed = [None, *(_bits(passes[-1].filter(F.col("kind") == _SHARED + k), power) for k in (1, 2, 3))]
        sent.destroy()
        told.destroy()
        if not any(failed):
            break
        before, now = now, [_either(a, b) for a, b in zip(now, failed)]
    return reduce(DataFrame.unionByName, passes).filter(F.col("kind") < _SHARED)


def _cut_score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly, up to 15 digits each."""
    whole = "CAST({} AS decimal(18,0))".format
    return F.expr(f"(CAST(1000000 AS decimal(7,0)) * ({whole(a)} * {whole(a)})) div ({whole(left)} * {whole(right)})")


def collocations(
    documents: DataFrame,
    least: int = 10,
    top: int = 2000,
    absorbed: int = 50,
    sample: float = 0.25,
    lowered: float = 0.8,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The ``top`` phrases of 2 and 3 words of each language that stick together most.

    A to Z count as lower case. Texts are cut into pieces at ``.,;:!?`` and line
    ends and these into words at blanks and tabs; a phrase lies within a piece.
    A phrase with ``a`` occurrences, at least ``least``, is cut in two with ``l``
    and ``r`` occurrences of the parts, where floor(1000000 * a * a / (l * r)) is
    smallest, the earlier of equal cuts; that is its score. It is dropped if a
    longer phrase with ``least`` occurrences holds it and has ``absorbed``
    percent of its occurrences or more. Ordered by score, ``a`` and phrase, with
    ``rank`` from 1, and ``n``, the words of the language.

    ``sample`` is the share of documents that makes the proposals, which are the
    phrases with ``lowered`` of the occurrences to be expected of a frequent
    one. Neither changes the result, only what it takes to get there.

    A null language is ``und``. Null and empty texts and words of other scripts
    need no care; repeated rows count each; an empty table gives no rows, and
    other columns are not looked at.
    """
    spark = documents.sparkSession
    texts = documents.select(
        F.coalesce(F.col(quoted(lang)), F.lit("und")).alias("lang"),
        F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"),
    )
    path = scratch_dir(spark, "phrases")
    try:
        found = frequent_phrases(texts, least, sample, lowered, path)
        return settled(_ranked(found, top, absorbed), "collocations")
    finally:
        remove(spark, path)


def _ranked(found: DataFrame, top: int, absorbed: int) -> DataFrame:
    words = found.filter("kind = 1").select("w1", "n", "word", "lang")
    pairs = found.filter("kind = 2").select("w1", "w2", F.col("n").alias("a"))
    threes = found.filter("kind = 3").select("w1", "w2", "w3", F.col("n").alias("a"))

    def with_word(df: DataFrame, k: int) -> DataFrame:
        names = {"w1": f"w{k}", "n": f"n{k}", "word": f"word{k}"}
        own = words if k == 1 else words.drop("lang")
        return skew_safe_join(df, own.withColumnsRenamed(names), [f"w{k}"])

    held = threes.select("w1", "w2", "a").unionByName(
        threes.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")
    )
    held = held.groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    left_pairs = pairs.join(held, ["w1", "w2"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < absorbed * F.col("a"))
    )
    two = with_word(with_word(left_pairs, 1), 2).select(
        "lang",
        F.concat_ws(" ", "word1", "word2").alias("phrase"),
        "a",
        F.col("n1").alias("l"),
        F.col("n2").alias("r"),
        _cut_score("a", "n1", "n2").alias("score"),
    )
    parts = skew_safe_join(threes, pairs.withColumnRenamed("a", "a12"), ["w1", "w2"])
    ends = pairs.withColumnsRenamed({"w2": "w3", "w1": "w2", "a": "a23"})
    parts = skew_safe_join(parts, ends, ["w2", "w3"])
    for k in (1, 2, 3):
        parts = with_word(parts, k)
    cuts = parts.withColumn("s1", _cut_score("a", "n1", "a23")).withColumn("s2", _cut_score("a", "a12", "n3"))
    early = F.col("s1") <= F.col("s2")
    three = cuts.select(
        "lang",
        F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"),
        "a",
        F.when(early, F.col("n1")).otherwise(F.col("a12")).alias("l"),
        F.when(early, F.col("a23")).otherwise(F.col("n3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Each of many shares of a language gives its best before all are ranked.
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    best = (
        two.unionByName(three)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", share).orderBy(*order)))
        .filter(F.col("rank") <= top)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
        .filter(F.col("rank") <= top)
    )
    totals = found.filter(F.col("kind") == _TOTAL).groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
