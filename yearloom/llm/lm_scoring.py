"""Cross-entropy difference of matched n-gram models.

Two bigram models share one vocabulary, order and smoothing. Words and bigrams
are counted by 64-bit keys, in a stored table that grows with the corpus. The
target model is counted on the documents labelled as good, the background model
on every document. The background is then matched in size: with ``s`` the
target's share of all words, its single words count ``s`` times, and a bigram
weighs as much as it does on average in random parts of that share, that is by
the probability that such a part has its first word. A document's score is the
mean difference of the losses that both models have for each of its words; below
zero it is more like the target than like the corpus. What a document itself has
added to either model is left out when it is scored: its label does not make it
look familiar, while a second copy of it does.

Texts are stored in blocks. A block sends each of its different keys once, with
its counts, to the task that has that range of keys, and gets the counts of the
corpus back in the order of the keys. So a frequent word costs a task no more
than one entry a block, and no task needs more of the table than one range.
"""

from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm.shingles import mixed, word_hashes
from yearloom.scratch import remove, scratch_dir, settled

#: Bytes of text in a block, and bytes of all texts for each range of keys.
_BLOCK, _RANGE = 1 << 23, 1 << 23
_KIND = np.uint64(1)
#: Stored target ids above this number are joined by shuffle; one takes 8 bytes.
BROADCAST_IDS = 2_000_000


@dataclass(frozen=True)
class Settings:
    """``pair_weight`` is the weight of the bigram against the single word.

    ``added`` is added to the count of every word of the vocabulary, which has
    ``2 ** word_bits`` words, or as many as the corpus where that has more.
    ``leave_out`` takes a document's own words and pairs out of both models when
    it is scored.
    """

    word_bits: int = 18
    pair_weight: float = 0.6
    added: float = 0.5
    leave_out: bool = True


def _keys(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words and of the pairs of neighbours: 63 bits of hash, one for the kind."""
    hashes = word_hashes(text or b"")
    pairs = mixed(hashes[:-1] * np.uint64(0xD6E8FEB86659FD93) + hashes[1:])
    return hashes & ~_KIND, pairs | _KIND


def _packed(numbers: np.ndarray) -> bytes:
    """64-bit numbers without the high bytes that all have zero, after how many are left.

    Byte by byte of all numbers, as most of them then compress well.
    """
    width = max(1, (int(numbers.max()).bit_length() + 7) // 8)
    split = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, 8)
    return bytes([width]) + split[:, :width].T.tobytes()


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    width = data[0]
    whole = np.zeros(((len(data) - 1) // width, 8), np.uint8)
    whole[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1).T
    return whole.view(kind).ravel()


def _blocks(batches):
    """Each row with the number of its block."""
    block, size = uuid4().int >> 65, 0
    for batch in batches:
        numbers = []
        for text in batch.column("text"):
            if size > _BLOCK:
                block, size = uuid4().int >> 65, 0
            numbers.append(block)
            size += len(text.as_buffer() or b"")
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), *batch.columns], names=["block", *batch.schema.names]
        )


def _counted(bits: int):
    """A block's different keys and their counts in all and in good documents, by range."""
    schema = pa.schema(
        [("range", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("total", pa.binary()), ("good", pa.binary())]
    )

    def rows(block: int, found: list[list[np.ndarray]]):
        of_good = sum(map(len, found[1]))
        keys, which = np.unique(np.concatenate([*found[1], *found[0]]), return_inverse=True)
        total = np.bincount(which, minlength=len(keys)).astype(np.int64)
        good = np.bincount(which[:of_good], minlength=len(keys)).astype(np.int64)
        ranges = (keys >> np.uint64(64 - bits)).astype(np.int64)
        keys &= np.uint64((1 << (64 - bits)) - 1)  # the range is known
        edges = [0, *(np.flatnonzero(np.diff(ranges)) + 1).tolist(), len(keys)]
        for start, end in zip(edges[:-1], edges[1:]):
            if start < end:
                steps = np.diff(keys[start:end], prepend=np.uint64(0))
                part = [np.array([ranges[start]], np.int32), np.array([block]), [_packed(steps)]]
                part += [[_packed(total[start:end])], [_packed(good[start:end])]]
                columns = [pa.array(v, t) for v, t in zip(part, schema.types)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches):
        block, found = None, [[], []]
        for batch in batches:
            for number, text, good in zip(*(batch.column(c) for c in ("block", "text", "good"))):
                if number.as_py() != block:
                    if any(found):
                        yield from rows(block, found)
                    block, found = number.as_py(), [[], []]
                found[good.as_py()] += _keys(text.as_py())
        if any(found):
            yield from rows(block, found)

    return run


_ANSWER = "range int, block long, total binary, good binary, n_words long, all_words long, good_words long"


def _answered(table: pa.Table) -> pa.Table:
    """The counts of a range's keys in the corpus, for each block that asked.

    The first row also has how many different words the range has, and how often
    they occur in all and in good documents.
    """
    parts = [np.cumsum(_unpacked(k.as_py(), np.uint64), dtype=np.uint64) for k in table.column("keys")]
    keys, which = np.unique(np.concatenate(parts), return_inverse=True)
    sums = []
    for side in ("total", "good"):
        own = np.concatenate([_unpacked(c.as_py(), np.int64) for c in table.column(side)])
        # Doubles hold sums below 2 ** 53 exactly.
        sums.append(np.bincount(which, own, len(keys)).astype(np.int64))
    asked: dict[int, list[np.ndarray]] = {}
    for block, own in zip(table.column("block").to_pylist(), np.split(which, np.cumsum([len(p) for p in parts[:-1]]))):
        asked.setdefault(block, []).append(own)
    words, rows = (keys & _KIND) == 0, []
    for block, own in asked.items():
        # A block read by several tasks asks in parts.
        places = own[0] if len(own) == 1 else np.unique(np.concatenate(own))
        about = (None,) * 3 if rows else (int(words.sum()), *(int(s[words].sum()) for s in sums))
        rows.append((table.column("range")[0].as_py(), block, *(_packed(s[places]) for s in sums), *about))
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 3]
    names = [c.split()[0] for c in _ANSWER.split(", ")]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


@dataclass(frozen=True)
class Sizes:
    """Words of the vocabulary, of all documents and of the good ones."""

    vocabulary: int
    total: int
    good: int


def _losses(words, before, pairs, share: float, sizes: Sizes, settings: Settings) -> np.ndarray:
    """The loss in bits for each word, by the counts of it, the one before and both.

    ``share`` is the part of the counted words to which the model is scaled.
    """
    single = (share * words + settings.added) / (sizes.good + settings.added * sizes.vocabulary)
    # The first word has none before it: its pair weighs nothing.
    weight = settings.pair_weight * (1 - np.power(1 - share, before))
    return -np.log2(weight * pairs / np.maximum(before, 1) + (1 - weight) * single)


def _scored(sizes: Sizes, settings: Settings):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(np.array(answers.column("range"), np.int64))
        texts = [_keys(t.as_py()) for t in docs.column("text")]
        flat = [k for both in texts for k in both]
        keys, which = np.unique(np.concatenate([np.zeros(0, np.uint64), *flat]), return_inverse=True)
        counts = []
        for side in ("total", "good"):
            own = answers.column(side)
            own = [_unpacked(own[int(i)].as_py(), np.int64) for i in order]
            counts.append(np.concatenate([np.zeros(0, np.int64), *own]).astype(np.float64))
            if len(counts[-1]) != len(keys):
                raise ValueError("a block's keys have changed since they were counted")
        rows, at = [], 0
        for (words, pairs), good in zip(texts, docs.column("good").to_pylist()):
            n, end = len(words), at + len(words) + len(pairs)
            here, left, means = which[at:end], sizes, []
            mine = np.zeros(len(here))
            if settings.leave_out:
                _, of, times = np.unique(here, return_inverse=True, return_counts=True)
                mine = times[of].astype(np.float64)
                left = Sizes(sizes.vocabulary, sizes.total - n, sizes.good - n * good)
            share = left.good / left.total if left.total else 0.0
            for count, part, own in ((counts[1], 1.0, mine * good), (counts[0], share, mine)):
                if n:
                    known = count[here] - own
                    before = np.concatenate([np.zeros(1), known[: n - 1]])
                    both = np.concatenate([np.zeros(1), known[n:]])
                    means.append(float(_losses(known[:n], before, both, part, left, settings).mean()))
            rows.append((n, *means, means[0] - means[1]) if n else (0, None, None, None))
            at = end
        columns = list(zip(*rows)) or [[]] * 4
        types = [pa.int64(), *[pa.float64()] * 3]
        return pa.Table.from_arrays(
            [docs.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))],
            names=["doc_id", "n_words", "target_loss", "background_loss", "difference"],
        )

    return run


def score_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``n_words``, both losses in bits a word and their ``difference``.

    The target are the documents of an id labelled with ``quality`` 1, also if
    it is labelled 0 elsewhere; the background are all documents, the target's
    among them. Every row of ``docs`` gives one row. A null text or one without
    words has no losses. Without labelled documents both models are empty and
    differ nowhere.
    """
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("id")).distinct()
    spark = docs.sparkSession
    paths = {what: scratch_dir(spark, what) for what in ("target-ids", "blocks", "counts")}
    try:
        return settled(_scores(docs, good, settings, paths), "losses")
    finally:
        for path in paths.values():
            remove(spark, path)


def _scores(docs: DataFrame, good: DataFrame, settings: Settings, paths: dict[str, str]) -> DataFrame:
    good = settled(good, "target-ids", paths["target-ids"])
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)  # the texts stay where they are
    own = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    own = own.join(good, F.col("doc_id") == F.col("id"), "left")
    own = own.select("doc_id", "text", F.col("id").isNotNull().alias("good"))
    kind = own.schema["doc_id"].dataType.simpleString()
    texts = settled(
        own.mapInArrow(_blocks, f"block long, doc_id {kind}, text binary, good boolean"),
        "blocks",
        paths["blocks"],
    )
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = max(4, (size // _RANGE).bit_length())
    asked = texts.select("block", "text", "good").mapInArrow(
        _counted(bits), "range int, block long, keys binary, total binary, good binary"
    )
    answers = settled(asked.groupBy("range").applyInArrow(_answered, _ANSWER), "counts", paths["counts"])
    found = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_words", "all_words", "good_words")]).first()
    sizes = Sizes(max(1 << settings.word_bits, found[0]), found[1], found[2])
    return (
        texts.select("block", "doc_id", "text", "good")
        .groupBy("block")
        .cogroup(answers.select("block", "range", "total", "good").groupBy("block"))
        .applyInArrow(
            _scored(sizes, settings),
            f"doc_id {kind}, n_words long, target_loss double, background_loss double, difference double",
        )
    )
