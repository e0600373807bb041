"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes ratios.

A text is the set of its hashed character n-grams. Each n-gram present counts
with its naive Bayes log-count ratio, the logarithm of how much likelier it is
in a toxic text than in a clean one, and a logistic regression on these scaled
features gives the score. Only labelled rows are learnt from.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.llm.rows import fresh, quoted, released

_CHUNK = 1 << 20  # code points hashed at a time


@dataclass(frozen=True)
class Settings:
    """What the model depends on besides the labelled rows.

    ``per_class`` bounds the labelled documents of either class that the model
    is fitted on; those of the smallest id hashes are taken. ``min_z`` is by
    how many standard errors an n-gram's share of the toxic texts must differ
    from that of the clean ones to become a feature, and ``max_features`` of
    those with the most are kept.
    """

    sizes: tuple[int, ...] = (3, 4, 5, 6)
    bits: int = 20
    per_class: int = 6000
    smoothing: float = 0.5
    min_z: float = 4.0
    max_features: int = 4096
    l2: float = 1.0
    steps: int = 150


@dataclass(frozen=True)
class Model:
    """Weights by hashed n-gram; ``slots`` maps a bucket to its weight, -1 to none."""

    sizes: tuple[int, ...]
    bits: int
    slots: np.ndarray
    weights: np.ndarray
    bias: float


def hashed_ngrams(text: str, sizes, bits: int):
    """Buckets of the character n-grams of a text, repeats included, in chunks.

    The text is lower-cased and a blank is put before and after it. White space
    counts as it stands.
    """
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    longest = max(sizes)
    for start in range(0, max(1, len(points) - longest + 1), _CHUNK):
        part = points[start : start + _CHUNK + longest - 1].astype(np.uint64)
        rolling = np.zeros(len(part), np.uint64)
        for n in range(1, longest + 1):
            if len(part) < n:
                break
            rolling = rolling[: len(part) - n + 1] * np.uint64(0x100000001B3) + part[n - 1 :]
            if n in sizes:
                mixed = (rolling ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                yield (mixed >> np.uint64(64 - bits)).astype(np.int64)


def _present(text: str | None, sizes, bits: int) -> np.ndarray:
    found = [np.unique(h) for h in hashed_ngrams(text or "", sizes, bits)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _features(text: str | None, model: Model) -> np.ndarray:
    """Slots of the n-grams of a text that have a weight, each once."""
    hit = []
    for h in hashed_ngrams(text or "", model.sizes, model.bits):
        slots = model.slots[h]
        hit.append(np.unique(slots[slots >= 0]))
    return np.unique(np.concatenate(hit)) if hit else np.zeros(0, np.int64)


def training_rows(
    docs: DataFrame, labels: DataFrame, allowed: Column, per_class: int
) -> DataFrame:
    """``text`` and ``toxic`` of the labelled documents the model is fitted on.

    Labels other than 0 and 1 and labels without an id are left out. An id
    labelled both ways counts as toxic. At most ``2 * per_class`` ids are
    chosen, so they can be sent to every task that reads documents.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("id IS NOT NULL AND toxic IN (0, 1)").filter(allowed)
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    chosen = None
    for label in (0, 1):
        own = known.filter(F.col("toxic") == label)
        own = own.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(per_class)
        chosen = own if chosen is None else chosen.unionAll(own)
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("id", "text", "toxic")


def _count(settings: Settings):
    """Per task, in how many toxic and clean texts each n-gram occurs."""

    def run(batches):
        counts = np.zeros((2, 1 << settings.bits), np.int32)
        for batch in batches:
            texts, toxic = batch.column("text").to_pylist(), batch.column("toxic").to_pylist()
            for text, label in zip(texts, toxic):
                counts[label, _present(text, settings.sizes, settings.bits)] += 1
        seen = np.flatnonzero(counts.any(axis=0))
        for part in np.array_split(seen, max(1, len(seen) // 100_000)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), *(pa.array(c[part], pa.int64()) for c in counts)],
                names=["gram", "clean", "toxic"],
            )

    return released(run)


def _encode(slots: np.ndarray, settings: Settings):
    """Per training text, the selected features it has."""
    model = Model(settings.sizes, settings.bits, slots, np.zeros(0), 0.0)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows = [_features(t, model).astype(np.int32).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), pa.array(rows, pa.binary()), batch.column("toxic")],
                names=["id", "features", "toxic"],
            )

    return released(run)


def _logistic(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, settings: Settings):
    """Weights and bias of an L2-regularised logistic regression, by accelerated steps.

    Both classes count alike whatever their numbers.
    """
    column = np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    scale = ratios[column]
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    # The step suits the curvature: a quarter of the largest squared row norm.
    norms = np.bincount(row, scale**2, len(rows))
    step = 1.0 / (0.25 * (share @ (norms + 1)) + settings.l2 / len(y))
    w, bias = np.zeros(len(ratios)), 0.0
    ahead_w, ahead_bias, t = w, bias, 1.0
    for _ in range(settings.steps):
        margin = np.bincount(row, scale * ahead_w[column], len(rows)) + ahead_bias
        error = share * (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - y)
        grad = np.bincount(column, scale * error[row], len(ratios)) + settings.l2 / len(y) * ahead_w
        new_w, new_bias = ahead_w - step * grad, ahead_bias - step * error.sum()
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        ahead_w = new_w + (before - 1) / t * (new_w - w)
        ahead_bias = new_bias + (before - 1) / t * (new_bias - bias)
        w, bias = new_w, new_bias
    return w * ratios, bias


def fit(
    docs: DataFrame,
    labels: DataFrame,
    allowed: Column | None = None,
    settings: Settings = Settings(),
) -> Model:
    """The model learnt from the labelled documents.

    ``allowed`` is a condition on the label's ``id`` that its rows must meet.
    The n-grams are counted and the texts encoded by Spark; the driver gets the
    counts of the selected n-grams and the encoded sample, both bounded by the
    settings. Without labelled rows of both classes every score is 0, or 1
    where all labelled rows are toxic; where no n-gram tells the classes apart
    it is the share of toxic rows.
    """
    allowed = F.lit(True) if allowed is None else allowed
    sample = training_rows(docs, labels, allowed, settings.per_class)
    counts = sample.select("text", "toxic").mapInArrow(
        _count(settings), "gram long, clean long, toxic long"
    )
    counts = counts.groupBy("gram").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    slots = np.full(1 << settings.bits, -1, np.int32)
    if len(sizes) < 2:
        certain = 60.0 if 1 in sizes else -60.0
        return Model(settings.sizes, settings.bits, slots, np.zeros(0), certain)
    a = settings.smoothing
    in_toxic, in_clean = F.col("toxic") + a, F.col("clean") + a
    ratio = F.log(in_toxic / (sizes[1] + 2 * a)) - F.log(in_clean / (sizes[0] + 2 * a))
    # Difference of the shares of toxic and clean texts in its standard errors.
    n1, n0 = float(sizes[1]), float(sizes[0])
    both = (F.col("toxic") + F.col("clean") + a) / (n1 + n0 + 2 * a)
    apart = F.abs(F.col("toxic") / n1 - F.col("clean") / n0)
    z = apart / F.sqrt(both * (1 - both) * (1 / n1 + 1 / n0))
    best = (
        counts.select("gram", ratio.alias("ratio"), z.alias("z"))
        .filter(F.col("z") >= settings.min_z)
        .orderBy(F.desc("z"), "gram")
        .limit(settings.max_features)
        .collect()
    )
    if not best:
        share = sizes[1] / (sizes[0] + sizes[1])
        return Model(settings.sizes, settings.bits, slots, np.zeros(0), float(np.log(share / (1 - share))))
    ratios = np.array([r["ratio"] for r in best])
    slots[[r["gram"] for r in best]] = np.arange(len(best))
    encoded = sample.mapInArrow(
        _encode(slots, settings), "id string, features binary, toxic int"
    ).collect()
    encoded.sort(key=lambda r: (r["id"], bytes(r["features"]), r["toxic"]))
    rows = [np.frombuffer(r["features"], np.int32) for r in encoded]
    y = np.array([r["toxic"] for r in encoded], float)
    weights, bias = _logistic(rows, y, ratios, settings)
    return Model(settings.sizes, settings.bits, slots, weights, float(bias))


def score_text(text: str | None, model: Model) -> float:
    """Probability that a text is toxic; a null text counts as empty."""
    margin = model.weights[_features(text, model)].sum() + model.bias
    return float(1 / (1 + np.exp(-np.clip(margin, -60, 60))))


def score(model: Model, text: Column) -> Column:
    """The score of a text column as an expression."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        # One text at a time is held as Python's, beside the batch.
        return pa.array([score_text(t.as_py(), model) for t in texts], pa.float64())

    return scored(text)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def score_documents(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), held_out: int = 0
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document.

    Only labels of ids outside the fold ``held_out`` are learnt from. Every row
    of ``docs`` gives one row, also repeated ones and those without id or text.
    """
    model = fit(docs, labels, fold(F.col("id")) != held_out, settings)
    scored = docs.select(
        "doc_id",
        (fold(F.col("doc_id")) == held_out).alias("held_out"),
        score(model, F.col("text")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.5
) -> DataFrame:
    """The documents scored below ``threshold``, with the columns they came with.

    The model is fitted on all labelled rows.
    """
    model = fit(docs, labels, settings=settings)
    name = fresh(docs.columns, "toxicity")
    kept = docs.withColumn(name, score(model, F.col(quoted("text")))).filter(F.col(name) < threshold)
    return kept.drop(name)
