"""N-gram Jaccard join: size-aware, with subsets for light sets and lists for heavy ones.

A document is the set of its word shingles, and documents of equal sets are one
class. Two sets of a similarity of at least ``t`` have at least ``t`` times the
larger size in common. Both sides order their shingles alike, the rarer first;
of the first ``n - ceil(t * n) + k`` of each, at least ``k`` are then common.

* A light set enumerates the pairs among these for ``k`` = 2 and puts itself
  under each pair, so two light sets meet only where two shingles agree.
* A heavy set is put into the inverted list of each of these for ``k`` = 1, and
  so are the light sets large enough to be similar to a heavy one.

The order is by how many sets hold a shingle, counted over all of them: none but
the set itself, few, more or many. A shingle of one set brings nothing together
and is put nowhere, so a set of new text has hardly an entry.

The boundary between light and heavy is the size with the least cost: the pairs
enumerated below it, and above it the list entries times the length of the list
that such an entry meets, as measured.

What a pair or a list brings together is a candidate. A sketch of each set, a
few bits of parity for each shingle, gives a lower bound of the number of
shingles in one set only; what it does not rule out is verified on the whole
sets. A short sketch of one length goes into the last join itself, so near
copies that are not similar enough never become rows there. Classes already linked need no verification among each other. So
each round verifies the classes outside a list's largest component against a few
members of that component, which settles large groups of near copies without
all their pairs; a last round verifies whatever pairs of different components
are left in any list. Pairs are of sizes that can be similar from the start.
"""

import zlib
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from yearloom.llm.rows import fresh, quoted, released
from yearloom.llm.shingles import mixed, shingle_set, word_hashes
from yearloom.scratch import remove, scratch_dir, settled


@dataclass(frozen=True)
class Settings:
    """``percent`` is the least similarity, ``words`` the length of a shingle.

    ``level_bits`` is the logarithm of the number of bits that tell the shingles
    of several sets at most; fewer do for small tables. Shingles that share a
    bit count as held by as many sets as both, which only costs time.
    ``scan_cost`` is the cost of a list entry in units of an enumerated pair, by
    default the mean length of the lists that entries meet. ``pivots`` has,
    round by round, how many members of a list's largest component the other
    members are verified against.
    """

    percent: int = 80
    words: int = 5
    level_bits: int = 28
    scan_cost: float | None = None
    pivots: tuple[int, ...] = (1, 1, 2, 4)


#: No boundary lies above this size, where pairs cost far more than lists.
_MOST_LIGHT = 400
#: So many sets hold a shingle of each level above the first.
_LEVELS = (2, 8, 64)
#: Lists by which two sets tell whether they have met before.
_NAMED = 64
#: Numbers of 64 parities that stand for a set in the last join.
_SHORT = 16
#: Classes up to which they are sent, with an id at most, to all tasks that read sets or texts.
_SENT = 1_000_000
#: Bytes of sets in a batch.
_BATCH = 4 << 20
#: Shingles counted together in a task, and bytes of text for each range of hashes.
_COUNTED, _RANGE = 1 << 19, 4 << 20


def _set_of(text: bytes, size: int) -> np.ndarray:
    return shingle_set(word_hashes(text), size)


def _signature(own: np.ndarray) -> int:
    """One 64-bit number for a set, as Spark's signed long."""
    place = np.arange(1, len(own) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return int(mixed(np.array([(mixed(own ^ place)).sum()], np.uint64)).view(np.int64)[0])


def _texts(batch: pa.RecordBatch):
    return (t.as_py() or b"" for t in batch.column("text"))


class _Counts:
    """How many sets of a task hold each shingle, in packets for ranges of hashes."""

    def __init__(self, ranges: int):
        self.ranges, self.sets, self.size = np.uint64(ranges), [], 0
        self.counted = (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def add(self, own: np.ndarray) -> None:
        self.sets.append(own)
        self.size += len(own)

    def full(self) -> bool:
        if self.size < _COUNTED:
            return False
        self._merge()
        return len(self.counted[0]) > _COUNTED

    def _merge(self) -> None:
        keys = np.concatenate([self.counted[0], *self.sets])
        n = np.concatenate([self.counted[1], np.ones(len(keys) - len(self.counted[1]), np.int64)])
        keys, of = np.unique(keys, return_inverse=True)
        self.counted = keys, np.bincount(of, n, minlength=len(keys)).astype(np.int64)
        self.sets, self.size = [], 0

    def packets(self):
        self._merge()
        keys, n = self.counted
        r = (keys >> np.uint64(32)) % self.ranges
        order = np.argsort(r, kind="stable")
        keys, n, r = keys[order].astype(np.uint32), np.minimum(n[order], 255).astype(np.uint8), r[order]
        edges = np.flatnonzero(np.diff(r, prepend=np.uint64(2**63), append=np.uint64(2**63)))
        for a, z in zip(edges, edges[1:]):
            yield int(r[a]), keys[a:z].tobytes(), n[a:z].tobytes()
        self.counted = keys[:0].astype(np.uint64), n[:0].astype(np.int64)


def _describe(settings: Settings, ranges: int, kind: pa.DataType):
    """Per document its class and size; per task how many sets hold each shingle."""
    names = ["class", "n", "doc_id", "r", "keys", "counts"]

    def documents(classes, sizes, ids):
        n = len(sizes)
        return pa.RecordBatch.from_arrays(
            [pa.array(classes, pa.int64()), pa.array(sizes, pa.int64()), ids,
             pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
            names=names,
        )

    def packed(counts):
        packets = list(counts.packets())
        for i in range(0, len(packets), 1024):
            some = packets[i : i + 1024]
            r, keys, n = zip(*some)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(r), pa.int64()), pa.nulls(len(r), pa.int64()), pa.nulls(len(r), kind),
                 pa.array(r, pa.int64()), pa.array(keys, pa.binary()), pa.array(n, pa.binary())],
                names=names,
            )

    def run(batches):
        counts, seen = _Counts(ranges), set()  # copies within a task count once
        for batch in batches:
            classes, sizes = [], []
            for text in _texts(batch):
                own = _set_of(text, settings.words)
                classes.append(_signature(own))
                sizes.append(len(own))
                if classes[-1] not in seen:
                    seen.add(classes[-1])
                    counts.add(own)
                if counts.full():
                    yield from packed(counts)
            yield documents(classes, sizes, batch.column("doc_id"))
        yield from packed(counts)

    return released(run)


def _several(packets: pa.Table) -> pa.Table:
    """Of a range of hashes: those held by several sets, and by how many."""
    keys = np.frombuffer(b"".join(packets["keys"].to_pylist()), np.uint32)
    n = np.frombuffer(b"".join(packets["counts"].to_pylist()), np.uint8)
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order].astype(np.int64)
    starts = np.flatnonzero(np.diff(keys.astype(np.int64), prepend=-1))
    total = np.add.reduceat(n, starts)
    kept = total >= _LEVELS[0]
    return pa.table({"slot": keys[starts[kept]].astype(np.int64), "n": total[kept]})


def _level_bits(several: DataFrame, power: int) -> list[bytes]:
    """For each level the bits of the shingles that reach it, packed.

    At most one row for each 64 bits comes to the driver.
    """
    slot = F.col("slot").bitwiseAND(F.lit((1 << power) - 1))
    mask = F.expr("shiftleft(1L, CAST(slot & 63 AS int))")
    bits = [F.bit_or(F.when(F.col("n") >= n, mask)).alias(f"level{i}") for i, n in enumerate(_LEVELS)]
    rows = several.groupBy(F.shiftrightunsigned(slot, 6).alias("at")).agg(*bits).toArrow()
    found, at = [], rows["at"].to_numpy()
    for i in range(len(_LEVELS)):
        held = np.zeros(1 << (power - 6), np.uint64)
        held[at] = rows[f"level{i}"].fill_null(0).to_numpy().view(np.uint64)
        found.append(zlib.compress(held.tobytes(), 1))
    return found


def _level(own: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    slot = own & np.uint64(64 * len(levels[0]) - 1)
    at, bit = slot >> np.uint64(6), slot & np.uint64(63)
    return sum(((held[at] >> bit) & np.uint64(1)).astype(np.int64) for held in levels)


def _prefix(n, percent: int, k: int):
    return n - -(-percent * n // 100) + k


def boundary(sizes: dict[int, int], percent: int, scan_cost: float) -> int:
    """The largest light size with the least cost, by how many sets have each size."""
    best, cheapest = 0, float("inf")
    for x in range(0, _MOST_LIGHT + 1):
        cost = 0.0
        for n, count in sizes.items():
            pair = _prefix(n, percent, 2)
            if n <= x:
                cost += count * pair * (pair - 1) / 2
            if n > x or 100 * n >= percent * (x + 1):
                cost += count * scan_cost * _prefix(n, percent, 1)
        if cost < cheapest:
            best, cheapest = x, cost
    return best


def _keys(own: np.ndarray, level: np.ndarray, settings: Settings, light: int) -> np.ndarray:
    """What a set is found under: hashes of pairs, of single shingles, or both."""
    n = len(own)
    order = np.lexsort((own, level))
    found = []
    if n <= light:
        first = order[: _prefix(n, settings.percent, 2)]
        pairs = np.array(list(combinations(own[first[level[first] > 0]], 2)), np.uint64).reshape(-1, 2)
        found.append(mixed(mixed(pairs[:, 0] + np.uint64(1)) + pairs[:, 1]))
    if n > light or 100 * n >= settings.percent * (light + 1):
        first = order[: _prefix(n, settings.percent, 1)]
        found.append(own[first[level[first] > 0]])
    return np.concatenate(found)


def _place(sent, settings: Settings, light: int):
    """``sent`` broadcasts the bits of the levels."""

    def run(batches):
        levels = [np.frombuffer(zlib.decompress(x), np.uint64) for x in sent.value]
        seen = set()  # copies within a task are placed once
        for batch in batches:
            keys, classes, sizes = [], [], []
            for text in _texts(batch):
                own = _set_of(text, settings.words)
                name = _signature(own)
                if len(own) and name not in seen:
                    seen.add(name)
                    keys.append(_keys(own, _level(own, levels), settings, light))
                    classes.append(name)
                    sizes.append(len(own))
            repeat = [len(k) for k in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([*keys, np.zeros(0, np.uint64)]).view(np.int64)),
                 pa.array(np.repeat(np.array(classes, np.int64), repeat)),
                 pa.array(np.repeat(np.array(sizes, np.int64), repeat))],
                names=["key", "class", "n"],
            )

    return released(run)


def _sketch(own: np.ndarray) -> bytes:
    """Parities of the shingles by the low bits of their hashes, two bits for each."""
    bits = max(64, 1 << (2 * len(own) - 1).bit_length())
    places = (own & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8)).tobytes()


def _short_sketch(own: np.ndarray) -> np.ndarray:
    """Parities of the shingles by the low bits of their hashes, as many for every set."""
    places = (own & np.uint64(64 * _SHORT - 1)).astype(np.int64)
    odd = (np.bincount(places, minlength=64 * _SHORT) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _apart(a: np.ndarray, b: np.ndarray) -> int:
    """At least so many shingles are in one of the sets only, by their sketches."""
    if len(a) > len(b):
        a, b = b, a
    while len(b) > len(a):  # a parity by fewer bits is that of two places together
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count((a ^ b).view(np.uint64)).sum())


def _whole_sets(settings: Settings):
    def batch_of(found, sets):
        short = np.concatenate([_short_sketch(s) for s in sets])
        return pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int64()),
             pa.array([len(s) for s in sets], pa.int64()),
             pa.array([s.tobytes() for s in sets], pa.binary()),
             pa.array([_sketch(s) for s in sets], pa.binary()),
             pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * _SHORT, pa.array(short))],
            names=["class", "n", "own", "sketch", "short"],
        )

    def run(batches):
        # The rows of one class are in one task. Of a repeated id the first with the
        # asked set counts, as other texts may share the id.
        seen = set()
        for batch in batches:
            found, sets, size = [], [], 0
            for name, text in zip(batch.column("class").to_pylist(), _texts(batch)):
                own = _set_of(text, settings.words)
                if name not in seen and _signature(own) == name:
                    seen.add(name)
                    found.append(name)
                    sets.append(own)
                    size += own.nbytes
                if size >= _BATCH:
                    yield batch_of(found, sets)
                    found, sets, size = [], [], 0
            if sets:
                yield batch_of(found, sets)

    return released(run)


def _possible(percent: int):
    def run(batches):
        for batch in batches:
            sizes = batch.column("a_n").to_numpy() + batch.column("b_n").to_numpy()
            most = sizes * (100 - percent) // (100 + percent)
            keep = [
                _apart(np.frombuffer(a.as_buffer(), np.uint8), np.frombuffer(b.as_buffer(), np.uint8)) <= m
                for a, b, m in zip(batch.column("a_sketch"), batch.column("b_sketch"), most)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return released(run)


def _similar(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a_own"), batch.column("b_own")):
                x = np.frombuffer(a.as_buffer(), np.uint64)
                y = np.frombuffer(b.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return released(run)


def _only(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The sets that occur in ``pairs``; the others are left where they are stored.

    Of very many pairs, all sets: most are needed then.
    """
    asked = pairs.select(F.col("a").alias("class")).unionAll(pairs.select("b")).distinct()
    asked = settled(asked, "asked-sets")
    if asked.count() > _SENT:
        return sets
    return sets.join(F.broadcast(asked), "class", "left_semi")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a``, ``b`` whose sets are similar, stored."""

    def beside(pairs: DataFrame, sets: DataFrame, *what: str) -> DataFrame:
        for side in "ab":
            own = sets.select(F.col("class").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in what])
            pairs = pairs.join(own, side)
        return pairs.select("a", "b", *[f"{side}_{c}" for side in "ab" for c in what])

    pairs = settled(pairs, "pairs")
    near = beside(pairs, _only(sets, pairs), "n", "sketch")
    near = settled(near.mapInArrow(_possible(percent), "a long, b long"), "possible-links")
    found = beside(near, _only(sets, near), "own").mapInArrow(_similar(percent), "a long, b long")
    return settled(found, "links")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``class`` and ``component``, the smallest class reachable over the edges ``a``, ``b``.

    Every class takes the smallest label around it and then the label of that
    label, again until nothing changes; each step is stored.
    """
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = settled(both, "edges")
    labels = settled(nodes.select("class", F.col("class").alias("component")), "labels")
    while True:
        around = (
            both.join(labels.withColumnRenamed("class", "b"), "b")
            .groupBy(F.col("a").alias("class"))
            .agg(F.min("component").alias("near"))
        )
        nearest = labels.join(around, "class", "left").select(
            "class", "component", F.least("component", "near").alias("next")
        )
        jump = labels.select(F.col("class").alias("next"), F.col("component").alias("beyond"))
        moved = nearest.join(jump, "next").select(
            "class", F.least("next", "beyond").alias("component"),
            (F.least("next", "beyond") < F.col("component")).alias("moved"),
        )
        moved = settled(moved, "labels")
        if not moved.filter("moved").head(1):
            return labels
        labels = moved.drop("moved")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after the components that ``links`` connect have become one.

    Only the components that a link touches take part.
    """
    for side in "ab":
        own = labels.select(F.col("class").alias(side), F.col("component").alias(f"{side}_part"))
        links = links.join(own, side)
    edges = links.select(F.col("a_part").alias("a"), F.col("b_part").alias("b")).distinct()
    edges = settled(edges.filter("a <> b"), "merged")
    ends = edges.select(F.col("a").alias("class")).unionAll(edges.select("b")).distinct()
    joined = components(ends, edges).select(
        F.col("class").alias("was"), F.col("component").alias("joined")
    )
    after = labels.join(joined, F.col("component") == F.col("was"), "left")
    return settled(after.select("class", F.coalesce("joined", "component").alias("component")), "labels")


def _comparable(percent: int) -> Column:
    """Whether sets of sizes ``a_n`` and ``b_n`` can be similar at all."""
    return F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent


def _open_lists(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The members of lists of several components, beside the largest of these.

    The other lists have nothing to find, now or later. Without ``labels`` each
    class is a component of its own.
    """
    if labels is None:
        known = members.withColumn("component", F.col("class"))
        largest = members.groupBy("key").agg(F.max("class").alias("main"), F.count("*").alias("parts"))
    else:
        known = members.join(labels, "class")
        largest = (
            known.groupBy("key", "component")
            .agg(F.count("*").alias("size"))
            .groupBy("key")
            .agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count("*").alias("parts"))
        )
    largest = settled(largest.filter("parts > 1").drop("parts"), "main-components")
    return settled(known.join(largest, "key"), "open-members")


def _round_pairs(placed: DataFrame, pivots: int, number: int, percent: int) -> DataFrame:
    """Members outside a list's largest component beside some members inside it."""
    order = F.xxhash64(F.lit(number), "class")
    chosen = (
        placed.filter(F.col("component") == F.col("main"))
        .groupBy("key", F.pmod(order, F.lit(pivots)).alias("slot"))
        .agg(F.min_by(F.struct("class", "n"), F.struct(order, "class")).alias("a"))
        .select(F.col("key").alias("list"), F.col("a.class").alias("a"), F.col("a.n").alias("a_n"))
    )
    chosen = settled(chosen, "pivots")
    outside = placed.filter(F.col("component") != F.col("main")).select(
        "key", F.col("class").alias("b"), F.col("n").alias("b_n")
    )
    pairs = outside.join(chosen, (F.col("key") == F.col("list")) & _comparable(percent))
    return pairs.select("a", "b").distinct()


def _close(percent: int) -> Column:
    """Whether the short sketches leave it open that ``a`` and ``b`` are similar."""
    differ = sum(
        (F.bit_count(F.col("a_short")[i].bitwiseXOR(F.col("b_short")[i])) for i in range(_SHORT)), F.lit(0)
    )
    return differ * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent)


def _all_pairs(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components in any list, of which one is outside its largest.

    Pairs that their short sketches rule out are left out. Two sets may meet in
    many lists. They are a pair in the first of those that both name among some
    of their lists, and in all if they name none alike.
    """
    some = placed.groupBy("class").agg(
        F.slice(F.sort_array(F.collect_set("key")), 1, _NAMED).alias("some")
    )
    placed = placed.join(some, "class").join(sets.select("class", "short"), "class")
    placed = settled(placed, "last-members")
    sides = [
        placed.select(
            F.col("key").alias(f"{side}_key"), F.col("class").alias(side), F.col("n").alias(f"{side}_n"),
            F.col("component").alias(f"{side}_part"), F.col("main").alias(f"{side}_main"),
            F.col("some").alias(f"{side}_some"), F.col("short").alias(f"{side}_short"),
        )
        for side in "ab"
    ]
    outside = sides[0].filter(F.col("a_part") != F.col("a_main"))
    first = F.array_min(F.array_intersect("a_some", "b_some"))
    # Two sets outside are beside each other twice.
    once = (F.col("b_part") == F.col("b_main")) | (F.col("a") < F.col("b"))
    apart = (F.col("a_part") != F.col("b_part")) & once & _comparable(percent) & _close(percent)
    pairs = outside.join(
        sides[1],
        (F.col("a_key") == F.col("b_key")) & apart & (first.isNull() | (first == F.col("a_key"))),
    )
    return pairs.select("a", "b").distinct()


def linked_classes(
    docs: DataFrame, settings: Settings = Settings()
) -> tuple[DataFrame, DataFrame]:
    """The documents with their classes, and the classes with their components.

    The first has a row per row of ``docs``: ``doc_id``, ``class``, ``n``. The
    second has ``class``, ``n`` and ``component_id``, the smallest document id
    of the component, for every class with a shingle.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    arrow_kind = to_arrow_type(docs.schema["doc_id"].dataType)
    describe = _describe(settings, max(16, size // _RANGE), arrow_kind)
    spark, scan, every_key = docs.sparkSession, *(scratch_dir(docs.sparkSession, x) for x in ("scan", "keys"))
    described = settled(
        texts.mapInArrow(describe, f"class long, n long, doc_id {kind}, r long, keys binary, counts binary"),
        "scan",
        scan,
    )
    rows = settled(described.filter("r IS NULL").select("class", "n", "doc_id"), "classes")
    packets = described.filter("r IS NOT NULL").select("r", "keys", "counts")
    several = settled(packets.groupBy("r").applyInArrow(_several, "slot long, n long"), "shared-shingles")
    remove(spark, scan)
    classes = settled(
        rows.filter("n > 0").groupBy("class", "n").agg(F.min("doc_id").alias("first_id")), "class-ids"
    )
    levels = _level_bits(several, min(settings.level_bits, max(16, size.bit_length() - 3)))
    scan_cost = settings.scan_cost
    if scan_cost is None:
        # Shingles of many sets stand last in each and hardly come into a list.
        met = several.filter(F.col("n") < _LEVELS[-1]).agg(F.sum(F.col("n") * F.col("n"))).first()[0]
        entries = classes.agg(F.sum("n")).first()[0]
        scan_cost = max(1.0, (met or 0) / (entries or 1))
    sizes = classes.filter(F.col("n") <= 2 * _MOST_LIGHT).groupBy("n").count().collect()
    light = boundary({r["n"]: r["count"] for r in sizes}, settings.percent, scan_cost)

    sent = spark.sparkContext.broadcast(levels)
    placed = texts.select("text").mapInArrow(_place(sent, settings, light), "key long, class long, n long")
    placed = settled(placed, "keys", every_key)
    sent.destroy()
    shared = placed.groupBy("key").agg(F.count("*").alias("places")).filter("places > 1")
    shared = settled(shared.select("key"), "shared-keys")
    members = settled(placed.join(shared, "key").distinct(), "members")
    remove(spark, every_key)  # some keys have one class only
    nodes = settled(members.select("class").distinct(), "nodes")

    # The whole sets of the classes that meet another one, from one document each.
    chosen = settled(nodes.join(classes, "class").select("class", "first_id"), "chosen")
    if chosen.count() <= _SENT:  # the other texts are not shuffled then
        chosen = F.broadcast(chosen)
    own = texts.join(chosen, F.col("doc_id").eqNullSafe(F.col("first_id"))).select("class", "text")
    sets = own.repartition("class").mapInArrow(_whole_sets(settings), "class long, n long, own binary, sketch binary, short array<long>")
    sets = settled(sets, "sets")

    labels = nodes.select("class", F.col("class").alias("component"))
    for number, pivots in enumerate(settings.pivots):
        placed = _open_lists(members, labels if number else None)
        members = placed.select("key", "class", "n")
        pairs = _round_pairs(placed, pivots, number, settings.percent)
        found = _verified(pairs, sets, settings.percent)
        if not found.head(1):
            break
        labels = _merged(labels, found)
    pairs = _all_pairs(_open_lists(members, labels), sets, settings.percent)
    found = _verified(pairs, sets, settings.percent)
    if found.head(1):
        labels = _merged(labels, found)

    of_class = classes.join(labels, "class", "left").select(
        "class", "n", "first_id", F.coalesce("component", "class").alias("component")
    )
    of_class = settled(of_class, "class-components")
    smallest = of_class.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return rows, of_class.join(settled(smallest, "component-ids"), "component").select(
        "class", "n", "component_id"
    )


def with_components(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``.

    A null or blank text has no shingle and is its own component. Rows without
    id are linked as others; a component of such rows only has no id.
    """
    rows, classes = linked_classes(docs, settings)
    own = settled(classes, "components").withColumnsRenamed({"class": "own", "n": "own_n"})
    joined = rows.join(own, (F.col("class") == F.col("own")) & (F.col("n") == F.col("own_n")), "left")
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A corpus stage: of each component the document that gives it its id.

    Documents without shingles stay. Rows of one id stay or go together.
    """
    found = with_components(docs, settings).filter("NOT doc_id <=> component_id")
    own = fresh(docs.columns, "own")
    gone = settled(found.select(F.col("doc_id").alias(own)).distinct(), "near-copies")
    return docs.join(gone, docs[quoted("doc_id")].eqNullSafe(gone[own]), "left_anti")
