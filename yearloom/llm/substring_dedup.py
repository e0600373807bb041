"""Suffix-array dedup: repeated byte strings by run-length indexes.

A byte is removed if a string of ``length`` bytes that covers it starts anywhere
else too. Each window of that length is filed under its minimizer, the smallest
hash of any ``K`` bytes in it; equal windows have equal minimizers at the same
place. Consecutive windows of one minimizer form a span of less than twice the
length. A span that occurs twice as a whole needs no further look, and neither
does one whose minimizer occurs in no other span. What is left is the repetitive
part of the corpus: the different spans of one minimizer. It is dealt to tasks
by minimizer, and each task builds a run-compressed Burrows-Wheeler transform of
its spans. Windows that agree lie alike around their minimizer, so before that
each span is cut to the windows whose middle another span has there too, and
dropped if there are none; what is equal is left to the index. Only at the ends of its runs the length common with the next suffix
is measured and kept; streamed through the text these samples give the matching
statistics of every position, which mark the windows that occur again.

A minimizer with more text than one index may hold is split: its windows are
counted by hash instead, each in a row of its own.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm.rows import text_key
from yearloom.llm.shingles import _BASE, _BYTES, _powers, mixed
from yearloom.scratch import settled


@dataclass(frozen=True)
class Settings:
    """``index_bytes`` is the text of an index; more under one minimizer is counted by hash."""

    length: int = 400
    index_bytes: int = 2 << 20


K = 32
_PART = 1 << 20  # windows looked at together, and less than the places in a minimizer's key
_PLACE = np.uint64(_PART * 2 - 1)
_PIECES = 8  # ranges of places of a window around its minimizer
_OTHER_BYTES = mixed(_BYTES + np.uint64(_BASE))


def _prefix_sums(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * _powers(len(data) + 1)[0][:-1], out=sums[1:])
    return sums


def _hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    inverse = _powers(len(sums))[1]
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row, by least values from block borders."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def spans(data: np.ndarray, length: int):
    """Minimizer, two hashes, first window and number of windows of every span."""
    for begin in range(0, len(data) - length + 1, _PART):
        part = data[begin : begin + _PART + length - 1]
        sums = _prefix_sums(part, _BYTES)
        places = np.arange(len(part) - K + 1)
        grams = _hashes(sums, places, places + K)
        keyed = (grams & ~_PLACE) | places.astype(np.uint64)
        place = (_sliding_least(keyed, length - K + 1) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        count = np.diff(first, append=len(place))
        end = first + count + length - 1
        other = _hashes(_prefix_sums(part, _OTHER_BYTES), first, end)
        yield grams[place[first]], _hashes(sums, first, end), other, first + begin, count


def _find_spans(length: int):
    def run(batches):
        for batch in batches:
            columns, ids = [], []
            for i, text in enumerate(batch.column("text")):
                data = np.frombuffer(text.as_py() or b"", np.uint8)
                for found in spans(data, length):
                    columns.append(found)
                    ids.append(np.full(len(found[0]), i))
            if columns:
                row = pa.array(np.concatenate(ids))
                joined = [np.concatenate(c) for c in zip(*columns)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(row), batch.column("version").take(row),
                     *(pa.array(c.view(np.int64)) for c in joined)],
                    names=["doc_id", "version", "minimizer", "one", "two", "first", "windows"],
                )

    return run


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """The suffixes in order, by ranks of prefixes of doubling length.

    ``symbols`` are 1 to 256 with a 0 behind each text, the last one too. A 0
    ends a suffix, and of suffixes equal up to there the earlier comes first.
    """
    n, done = len(symbols), 7
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(done, np.int64)])
    key, alive = np.zeros(n, np.int64), np.ones(n, bool)
    for k in range(done):
        alive &= padded[k : k + n] > 0
        key = key * 257 + np.where(alive, padded[k : k + n], 0)
    order = np.argsort(key)
    # Suffixes that have ended are told apart by their places alone.
    slots = np.flatnonzero(~alive[order])
    order[slots] = order[slots][np.lexsort((order[slots], key[order[slots]]))]
    sorted_key = key[order]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    new[slots] = True
    # The rank of a suffix is where its group begins in the order.
    rank = np.empty(n, np.int64)
    rank[order] = _run_starts(new)
    open_ones = order[~_alone(new)]
    while len(open_ones):
        after = open_ones + done
        later = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[open_ones] * (n + 1) + later
        by_key = np.argsort(key)
        own, key = open_ones[by_key], key[by_key]
        group = rank[own]
        first = _run_starts(np.concatenate([[True], group[1:] != group[:-1]]))
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[own] = group + _run_starts(new) - first
        open_ones = own[~_alone(new)]
        done *= 2
    order[rank] = np.arange(n)
    return order


def _run_starts(new: np.ndarray) -> np.ndarray:
    """For every element where its run begins."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _alone(new: np.ndarray) -> np.ndarray:
    """Whether an element is a run of its own."""
    return new & np.append(new[1:], True)


def _common(symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols the suffixes at ``a`` and ``b`` share before a separator."""
    step = 32
    padded = np.concatenate([symbols, np.zeros(step, symbols.dtype)])
    shared, active = np.zeros(len(a), np.int64), np.arange(len(a))
    reach = np.arange(step)
    while len(active):
        x = padded[np.minimum(a[active] + shared[active], len(symbols))[:, None] + reach]
        y = padded[np.minimum(b[active] + shared[active], len(symbols))[:, None] + reach]
        differ = (x != y) | (x == 0)
        stop = differ.any(axis=1)
        shared[active] += np.where(stop, differ.argmax(axis=1), step)
        active = active[~stop]
    return shared


class RunIndex:
    """Run-compressed Burrows-Wheeler transform with samples at the ends of its runs.

    ``symbols`` are the texts with 0 behind each and 1 to 256 for their bytes.
    """

    def __init__(self, symbols: np.ndarray):
        order = suffix_order(symbols)
        before = symbols[order - 1]  # of the first place, the last separator
        # What stands before the beginning of two texts is never the same.
        change = (before[1:] != before[:-1]) | (before[1:] == 0)
        heads = np.concatenate([[False], change])
        ends = np.concatenate([change, [False]])
        self.size, self.runs = len(symbols), int(change.sum()) + 1
        self.samples = []
        for marked, step in ((heads, -1), (ends, 1)):
            at = np.flatnonzero(marked)
            own, shared = order[at], _common(symbols, order[at], order[at + step])
            edge = order[0] if step < 0 else order[-1]  # shares nothing with what is not there
            place, shared = np.append(own, edge), np.append(shared, 0)
            sort = np.argsort(place)
            self.samples.append((place[sort], shared[sort]))

    def statistics(self) -> np.ndarray:
        """For every place how much of its suffix occurs at another place too."""
        best = np.zeros(self.size, np.int64)
        for place, shared in self.samples:
            # Between two samples the neighbour moves along, one symbol shorter each step.
            sampled = np.full(self.size, -1, np.int64)
            sampled[place] = np.arange(len(place))
            last = np.maximum.accumulate(sampled)
            known = np.flatnonzero(last >= 0)
            i = last[known]
            best[known] = np.maximum(best[known], shared[i] - (known - place[i]))
        return best


def _middles(texts: list[np.ndarray], minimizers: np.ndarray, length: int):
    """For each range of places which windows a span has in it, and a hash of what they share.

    Places are those of a window's first byte as seen from the minimizer. All
    windows of a span in one range share its bytes from the range's last place
    to the end of a window at its first.
    """
    sizes = np.array([len(t) for t in texts])
    start = np.cumsum(sizes) - sizes
    sums = _prefix_sums(np.concatenate(texts), _BYTES)
    at = np.arange(len(sums) - K)
    grams = _hashes(sums, at, at + K)
    hits = np.flatnonzero(grams == np.repeat(minimizers, sizes)[: len(grams)])
    place = hits[np.searchsorted(hits, start)] - start  # the first one is the minimizer
    last = sizes - length
    step = -(-(length - K + 1) // _PIECES)
    for lowest in range(K - length, 1, step):
        highest = min(lowest + step - 1, 0)
        first_in, last_in = np.maximum(lowest + place, 0), np.minimum(highest + place, last)
        here = np.flatnonzero(first_in <= last_in)
        middle = start[here] + place[here]
        shared = _hashes(sums, middle + highest, middle + lowest + length)
        key = mixed(shared + mixed(minimizers[here] + np.uint64(-lowest)))
        yield here, first_in[here], last_in[here], key


def _reaches(texts: list[np.ndarray], minimizers: np.ndarray, length: int):
    """The first and the last window of every span that another can have; -1 as the last if none.

    Only spans of one minimizer are compared. Nothing that occurs twice is left out.
    """
    spans_of, first_of, last_of, keys = [], [], [], []
    edges = np.flatnonzero(np.diff(np.cumsum([len(t) for t in texts]) // _PART, prepend=-1))
    for a, z in zip(edges, [*edges[1:], len(texts)]):
        for here, first_in, last_in, key in _middles(texts[a:z], minimizers[a:z], length):
            spans_of.append(here + a)
            first_of.append(first_in)
            last_of.append(last_in)
            keys.append(key)
    span, key = np.concatenate(spans_of), np.concatenate(keys)
    _, of, n = np.unique(key, return_inverse=True, return_counts=True)
    again = n[of] > 1
    first, last = np.full(len(texts), np.iinfo(np.int64).max), np.full(len(texts), -1)
    np.minimum.at(first, span[again], np.concatenate(first_of)[again])
    np.maximum.at(last, span[again], np.concatenate(last_of)[again])
    return first, last


def _intervals(again: np.ndarray, first: int) -> bytes:
    """First and last of each run of marked windows, as pairs of 32-bit numbers.

    The windows are counted from ``first`` on.
    """
    edge = np.flatnonzero(np.diff(again.astype(np.int8), prepend=0, append=0)) + first
    return np.stack([edge[::2], edge[1::2] - 1], axis=1).astype("<i4").tobytes()


def _index(length: int):
    def run(table: pa.Table) -> pa.Table:
        texts = [np.frombuffer(t.as_py(), np.uint8) for t in table.column("bytes")]
        minimizers = table.column("minimizer").to_numpy().astype(np.int64).view(np.uint64)
        first, last = _reaches(texts, minimizers, length)
        parts = []
        for t, a, z in zip(texts, first, last):
            if z >= 0:
                parts += [t[a : z + length].astype(np.int16) + 1, np.zeros(1, np.int16)]
        found = RunIndex(np.concatenate(parts)).statistics() if parts else np.zeros(0, np.int64)
        marks, start = [], 0
        for a, z in zip(first, last):
            if z < 0:
                marks.append(b"")
                continue
            marks.append(_intervals(found[start : start + z - a + 1] >= length, a))
            start += z - a + length + 1
        keys = [table.column(c).combine_chunks() for c in ("minimizer", "one", "two")]
        return pa.Table.from_arrays([*keys, pa.array(marks, pa.binary())], names=["minimizer", "one", "two", "again"])

    return run


def _cut_spans(length: int):
    """The bytes of the wanted spans of each document."""

    def run(batches):
        for batch in batches:
            rows = []
            for text, wanted in zip(batch.column("text"), batch.column("wanted")):
                data = text.as_py() or b""
                for w in wanted.as_py():
                    part = data[w["first"] : w["first"] + w["windows"] + length - 1]
                    rows.append((w["minimizer"], w["one"], w["two"], w["shard"], part))
            types = [pa.int64()] * 4 + [pa.binary()]
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["minimizer", "one", "two", "shard", "bytes"],
            )

    return run


def _window_hashes(length: int):
    """A row for every window of a span, by two hashes of its bytes."""

    def run(batches):
        for batch in batches:
            for minimizer, one, two, text in zip(*(batch.column(c) for c in ("minimizer", "one", "two", "bytes"))):
                data = np.frombuffer(text.as_py(), np.uint8)
                starts = np.arange(len(data) - length + 1)
                sides = [_hashes(_prefix_sums(data, t), starts, starts + length) for t in (_BYTES, _OTHER_BYTES)]
                fixed = [pa.array(np.full(len(starts), v.as_py(), np.int64)) for v in (minimizer, one, two)]
                yield pa.RecordBatch.from_arrays(
                    [*fixed, *(pa.array(s.view(np.int64)) for s in sides), pa.array(starts)],
                    names=["minimizer", "one", "two", "left", "right", "at"],
                )

    return run


def _repeated_windows(docs: DataFrame, every: DataFrame, settings: Settings) -> DataFrame:
    """Per different span the windows that occur elsewhere, as packed intervals.

    Whole spans that occur twice have one interval of all their windows.
    """
    key = ["minimizer", "one", "two"]
    length = settings.length
    different = every.groupBy(*key, "windows").agg(
        F.count("*").alias("places"), F.min(F.struct("doc_id", "version", "first")).alias("at")
    )
    different = settled(different, "spans")
    size = F.col("windows") + (length - 1)
    by_minimizer = (
        different.groupBy("minimizer")
        .agg(F.count("*").alias("kinds"), F.sum("places").alias("places"), F.sum(size).alias("bytes"))
        .filter("places > 1")
    )
    by_minimizer = settled(by_minimizer, "minimizers")
    total = by_minimizer.filter("kinds > 1").agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    shards = max(1, -(-int(total) // settings.index_bytes))
    # The whole span occurs twice.
    whole = different.filter("places > 1").select(
        *key, F.lit(None).cast("binary").alias("again")
    )
    open_ones = by_minimizer.filter("kinds > 1").select("minimizer", "bytes")
    shard = F.when(
        F.col("bytes") <= settings.index_bytes, F.pmod(F.xxhash64("minimizer"), F.lit(shards))
    ).otherwise(F.lit(-1))
    wanted = different.join(open_ones.select("minimizer", shard.alias("shard")), "minimizer").select(
        F.col("at.doc_id").alias("own"), F.col("at.version").alias("own_version"),
        F.struct(*key, "shard", F.col("at.first").alias("first"), "windows").alias("span"),
    )
    wanted = wanted.groupBy("own", "own_version").agg(F.collect_list("span").alias("wanted"))
    wanted = settled(wanted, "wanted-spans")
    of_doc = F.col("own").eqNullSafe(F.col("doc_id")) & (F.col("own_version") == F.col("version"))
    texts = docs.join(wanted, of_doc).select("text", "wanted")
    schema = "minimizer long, one long, two long"
    cut = texts.mapInArrow(_cut_spans(length), f"{schema}, shard long, bytes binary")
    cut = settled(cut.dropDuplicates(["minimizer", "one", "two"]), "span-bytes")
    indexed = cut.filter("shard >= 0").groupBy("shard").applyInArrow(
        _index(length), f"{schema}, again binary"
    )
    counted = cut.filter("shard < 0").mapInArrow(
        _window_hashes(length), f"{schema}, left long, right long, at long"
    )
    counted = settled(counted, "window-hashes")
    twice = counted.groupBy("left", "right").count().filter("count > 1").drop("count")
    twice = settled(twice, "repeated-windows")
    pair = F.struct(F.col("at").cast("int").alias("from"), F.col("at").cast("int").alias("to"))
    by_hash = counted.join(twice, ["left", "right"]).groupBy(*key).agg(F.collect_list(pair).alias("pairs"))
    rest = indexed.join(whole.select(*key), key, "left_anti").filter("length(again) > 0")
    packed = rest.unionAll(whole).withColumn("pairs", F.lit(None).cast("array<struct<from:int,to:int>>"))
    by_hash = by_hash.join(whole.select(*key), key, "left_anti")
    return packed.unionByName(by_hash.withColumn("again", F.lit(None).cast("binary")), allowMissingColumns=True)


def _merge(length: int):
    """Removed byte runs, ascending, and what is left of every text."""

    def run(batches):
        for batch in batches:
            removed, kept = [], []
            for text, spans_of in zip(batch.column("text"), batch.column("marks")):
                data = text.as_py() or b""
                starts, ends = [], []
                for s in spans_of.as_py() or ():
                    if s["again"] is not None:
                        pairs = np.frombuffer(s["again"], "<i4").reshape(-1, 2).astype(np.int64)
                    elif s["pairs"] is not None:
                        pairs = np.array([(p["from"], p["to"]) for p in s["pairs"]], np.int64).reshape(-1, 2)
                    else:
                        pairs = np.array([[0, s["windows"] - 1]], np.int64)
                    starts.append(s["first"] + pairs[:, 0])
                    ends.append(s["first"] + pairs[:, 1] + length)
                if starts:
                    start, end = np.concatenate(starts), np.concatenate(ends)
                    order = np.argsort(start, kind="stable")
                    start, end = start[order], np.maximum.accumulate(end[order])
                    new = np.concatenate([[True], start[1:] > end[:-1]])
                    first = start[new]
                    last = end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]
                    runs = list(zip(first.tolist(), last.tolist()))
                else:
                    runs = []
                parts, at = [], 0
                for a, b in runs:
                    parts.append(data[at:a])
                    at = b
                kept.append(b"".join([*parts, data[at:]]))
                removed.append([{"start": a, "end": b} for a, b in runs])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(removed, kind), pa.array(kept, pa.binary())],
                names=["doc_id", "removed", "kept"],
            )

    return run


def remove_repeated(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``removed`` (byte runs from start to before end) and ``kept`` bytes.

    Every row of ``docs`` gives one row. A null text is empty; a text shorter
    than a window loses nothing. Rows equal in id and text count as one document
    and lose the same bytes; copies under another id, or none, repeat it whole.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_key().alias("version"), F.col("text").cast("binary").alias("text"))
    every = rows.mapInArrow(
        _find_spans(settings.length),
        f"doc_id {kind}, version long, minimizer long, one long, two long, first long, windows long",
    )
    # Once for rows that are the same document.
    every = settled(every, "all-spans").distinct()
    again = settled(_repeated_windows(rows, every, settings), "marks")
    marks = every.join(again, ["minimizer", "one", "two"]).select(
        "doc_id", "version", F.struct("first", "windows", "again", "pairs").alias("mark")
    )
    marks = marks.groupBy(F.col("doc_id").alias("own"), F.col("version").alias("own_version")).agg(
        F.collect_list("mark").alias("marks")
    )
    of_doc = F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("version") == F.col("own_version"))
    return rows.join(marks, of_doc, "left").select("doc_id", "text", "marks").mapInArrow(
        _merge(settings.length), f"doc_id {kind}, removed array<struct<start:long,end:long>>, kept binary"
    )


def summary(found: DataFrame) -> DataFrame:
    """Sizes and a digest of what :func:`remove_repeated` found."""
    lost = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return found.select(
        "doc_id",
        (F.octet_length("kept") + lost).cast("long").alias("n_bytes"),
        lost.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
