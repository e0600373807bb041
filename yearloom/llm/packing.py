"""Packing: documents as token pieces in windows of one capacity, by minimum bin slack.

A document's ids are cut into windows that it fills alone and a remainder. The
remainders matter only by their lengths, so their packing is planned on the
number of remainders of each length: subset sums of the lengths at hand, kept as
bits of one number, show the multiset that fills a window closest to capacity
beside the longest remainder, backtracking gives how often it takes each length,
and it is used for as many windows as there are remainders for. The plan has at
most a few patterns for each length, however many documents there are; Spark
numbers the remainders of each length and every task looks its own ones up.

Lengths for which no multiset fills the window are laid end to end and cut at
the window's capacity, so that only the very last window can be short.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yearloom.llm.rows import released
from yearloom.llm.tokens import WordTokenizer
from yearloom.scratch import settled

CAPACITY = 2048
END_ID = 1
#: Rows of numbering, of 24 bytes each, up to which they are sent to all tasks.
BROADCAST_ROWS = 1_000_000
_PIECE = "doc_id {id}, doc_tokens long, start long, length int, nth long, task int, ids binary"
_PLACED = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_BATCH_BYTES = 4 << 20
_TEXTS_AT_ONCE = 1 << 18


def _reach(lengths: list[int], counts: list[int], target: int) -> list[int]:
    """Subset sums up to ``target`` as bits, before and after each length."""
    mask, sums = (1 << (target + 1)) - 1, [1]
    for length, count in zip(lengths, counts):
        reach, left, step = sums[-1], min(count, target // length), 1
        while left > 0:
            take = min(step, left)
            reach |= (reach << (take * length)) & mask
            left, step = left - take, step * 2
        sums.append(reach)
        if reach >> target & 1:
            break
    return sums


def fullest(available: dict[int, int], target: int) -> dict[int, int]:
    """How often to take each length so that their sum is closest to ``target``.

    ``available`` has the number of pieces by length; the sum never exceeds the
    target. Longer lengths are tried first and of two ways the one with more
    of the shorter lengths is taken.
    """
    lengths = sorted((n for n in available if n <= target and available[n] > 0), reverse=True)
    sums = _reach(lengths, [available[n] for n in lengths], target)
    total, taken = sums[-1].bit_length() - 1, {}
    for i in range(len(sums) - 2, -1, -1):
        length, used = lengths[i], 0
        while not sums[i] >> total & 1:
            used, total = used + 1, total - length
        if used:
            taken[length] = used
    return taken


@dataclass(frozen=True)
class Plan:
    """Where the piece of a given length and number goes.

    ``segments`` has by length the rows (first number, first sequence, pieces of
    the length in each sequence, their first offset); from number ``cut[length]``
    on the pieces lie end to end from position ``at[length]`` on.
    """

    capacity: int
    segments: dict[int, np.ndarray]
    cut: dict[int, int]
    at: dict[int, int]
    first_cut: int = field(default=0)


def make_plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan for so many pieces of each length, by minimum bin slack."""
    left = {n: c for n, c in counts.items() if c > 0}
    used = dict.fromkeys(left, 0)
    segments: dict[int, list] = {n: [] for n in left}
    cut: dict[int, int] = {}
    sequence = 0
    for longest in sorted(left, reverse=True):
        while left[longest]:
            left[longest] -= 1
            pattern = fullest(left, capacity - longest) if longest < capacity else {}
            left[longest] += 1
            pattern[longest] = pattern.get(longest, 0) + 1
            if sum(n * c for n, c in pattern.items()) < capacity:
                # Nothing fills the window beside this length.
                cut[longest] = used[longest]
                left[longest] = 0
                break
            windows = min(left[n] // c for n, c in pattern.items())
            offset = 0
            for n, c in sorted(pattern.items(), reverse=True):
                segments[n].append((used[n], sequence, c, offset))
                used[n] += windows * c
                left[n] -= windows * c
                offset += n * c
            sequence += windows
    position, at = 0, {}
    for n in sorted(cut, reverse=True):
        at[n] = position
        position += n * (counts[n] - cut[n])
    tables = {n: np.array(s, np.int64).reshape(-1, 4) for n, s in segments.items()}
    return Plan(capacity, tables, cut, at, sequence)


def place(plan: Plan, length: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces of one length by their numbers."""
    sequence, offset = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
    loose = numbers >= plan.cut.get(length, np.iinfo(np.int64).max)
    if loose.any():
        position = plan.at[length] + (numbers[loose] - plan.cut[length]) * length
        sequence[loose] = plan.first_cut + position // plan.capacity
        offset[loose] = position % plan.capacity
    if not loose.all():
        table, own = plan.segments[length], numbers[~loose]
        row = table[np.searchsorted(table[:, 0], own, "right") - 1]
        nth = own - row[:, 0]
        sequence[~loose] = row[:, 1] + nth // row[:, 2]
        offset[~loose] = row[:, 3] + nth % row[:, 2] * length
    return sequence, offset


def _ids(tokenizer: WordTokenizer, texts: pa.Array) -> Iterator[bytes]:
    """The ids of each text, of so many at a time that they hold ``_TEXTS_AT_ONCE`` code points."""
    together, size = [], 0
    for text in texts:
        together.append(text.as_py() or "")
        size += len(together[-1])
        if size >= _TEXTS_AT_ONCE:
            yield from tokenizer.ids_of(together)
            together, size = [], 0
    yield from tokenizer.ids_of(together)


def _cut_into_pieces(tokenizer: Callable[[], WordTokenizer], capacity: int, end_id: int):
    def run(batches):
        own, end = tokenizer(), np.array([end_id], "<u4").tobytes()
        task, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            column, kind = batch.column("doc_id").to_pylist(), batch.column("doc_id").type
            rows, size = [], 0
            for doc_id, ids in zip(column, _ids(own, batch.column("text"))):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    length = min(capacity, total - start)
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, total, start, length, seen[length], task, part))
                    seen[length] += 1
                size += len(ids)
                if size >= _BATCH_BYTES:
                    yield _batch(rows, kind)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, kind)

    return released(run)


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
    names = ["doc_id", "doc_tokens", "start", "length", "nth", "task", "ids"]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _put_in_place(plan: Plan):
    """Sequence and offset for each piece; those across a border become two."""

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            number = batch.column("nth").to_numpy() + batch.column("before").to_numpy()
            sequence, offset = np.zeros((2, len(length)), np.int64)
            for n in np.unique(length):
                own = length == n
                sequence[own], offset[own] = place(plan, int(n), number[own])
            first = np.minimum(length, plan.capacity - offset)
            across = np.flatnonzero(first < length)
            start, ids = batch.column("start").to_numpy(), batch.column("ids")
            if len(across):
                bytes_of = ids.to_pylist()
                tails = [bytes_of[i][4 * first[i] :] for i in across]
                for i in across:
                    bytes_of[i] = bytes_of[i][: 4 * first[i]]
                ids = pa.array(bytes_of + tails, pa.binary())
            both = np.concatenate([np.arange(len(length)), across])
            zeros = np.zeros(len(across), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(both)) if len(across) else batch.column("doc_id"),
                    pa.array(np.concatenate([start, (start + first)[across]])),
                    pa.array(np.concatenate([first, (length - first)[across]])),
                    ids,
                    pa.array(batch.column("doc_tokens").to_numpy()[both]),
                    pa.array(np.concatenate([sequence, sequence[across] + 1])),
                    pa.array(np.concatenate([offset, zeros])),
                ],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return released(run)


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: its document and place there, its ids, and where it is packed.

    Columns: ``doc_id``, ``start`` (ids of the document before the piece),
    ``length``, ``ids`` (little-endian unsigned 32-bit numbers), ``doc_tokens``,
    ``sequence_id`` and ``offset``. ``tokenizer`` is the path of a vocabulary
    that never joins words. ``end_id`` follows the ids of every document, so a
    null or empty text is one piece of one id. Every row is a document, repeated
    ones and those without id too. Only the last sequence can be shorter than
    the capacity.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = docs.select("doc_id", "text").mapInArrow(
        _cut_into_pieces(lambda: WordTokenizer(tokenizer), capacity, end_id), _PIECE.format(id=kind)
    )
    # Stored, the pieces keep the numbers they got, whatever runs again later.
    pieces = settled(pieces, "pieces")
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    numbering = by_task.select(
        "length", "task", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    numbering = settled(numbering, "numbering")
    by_length = numbering.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = make_plan({r["length"]: r["n"] for r in by_length}, capacity)
    before = numbering.select("length", "task", "before")
    if numbering.count() <= BROADCAST_ROWS:
        before = F.broadcast(before)
    numbered = pieces.join(before, ["length", "task"])
    return numbered.mapInArrow(_put_in_place(plan), _PLACED.format(id=kind))
