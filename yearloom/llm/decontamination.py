"""Benchmark decontamination: spaced seeds and verified overlaps.

Texts are lower-cased and cut into words at ASCII white space. A spaced seed is
a hash of some of the words of a short stretch; a fixed mask says which count
and which may differ. Seeds common to a document and a benchmark item place the
item beside the document, and only there the words are compared one by one.

An overlap is a stretch of ``stretch`` words in which at most ``substitutions``
words differ. With the mask and figures given here every such stretch of 13
words holds a seed wherever its two differing words are and wherever it begins.
Of a shorter item all words must lie beside the document's: one of them may
differ where there are ``HALVED`` or more, none in still shorter items. Such an
item has seeds of its own, without gaps: all its words, or those of either half,
one of which no single substitution can touch. Documents are seeded in these
lengths as well, at every word, if the benchmark has such items at all.
Insertions and deletions end a stretch.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.llm.rows import computed, fresh, quoted, text_key
from yearloom.scratch import settled

#: 1 where the word counts, 0 where it may differ. All of one length.
MASKS = ("11000011",)
#: Documents are seeded at every so many words, benchmark items at every word.
STRIDE = 2
STRETCH = 13
SUBSTITUTIONS = 2
#: Words of the shortest items in which one word may differ.
HALVED = 8
#: Stored benchmark seeds above this number are joined by shuffle; a row takes 24 bytes.
BROADCAST_SEEDS = 1_000_000


def words(text: Column) -> Column:
    """The words of a text as hashes; none for a null or blank text."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t\\n\\x0B\\f\\r]+", -1)
    return F.transform(F.array_remove(split, ""), lambda w: F.xxhash64(w))


def seeds(table: DataFrame, masks: Sequence[str], stride: int = 1) -> DataFrame:
    """One row per stretch and mask: the columns beside ``words``, ``at``, ``seed``.

    ``at`` is the number of the stretch's first word, a multiple of
    ``stride``. Fewer words than a mask is long give no seed.
    """
    span = len(masks[0])
    if any(len(m) != span for m in masks):
        raise ValueError("masks of different lengths")

    def of(text: Column) -> Column:
        starts = F.when(
            F.size(text) >= span,
            F.sequence(F.lit(0), F.size(text) - span, F.lit(stride)),
        ).otherwise(F.array().cast("array<int>"))

        def seed(number: int, mask: str) -> Column:
            chosen = [k for k, counts in enumerate(mask) if counts == "1"]
            return F.transform(
                starts, lambda i: F.xxhash64(F.lit(number), *[F.get(text, i + k) for k in chosen])
            )

        every = [seed(number, mask) for number, mask in enumerate(masks)]
        return F.struct(F.size(text).alias("n"), F.concat(*every).alias("seeds"))

    others = [c for c in table.columns if c != "words"]
    # Bound to the variable of a function, the words are made once for each text,
    # and they are not carried along with every seed.
    made = table.select(*others, F.inline(F.transform(F.array("words"), of)))
    found = made.select(*others, "n", F.posexplode("seeds").alias("p", "seed"))
    starts = F.floor((F.col("n") - span) / stride) + 1
    at = (F.col("p") % starts * stride).cast("int")
    return found.select(*others, at.alias("at"), "seed")


def _short_seeds(items: DataFrame, stretch: int) -> DataFrame:
    """The seeds of items of fewer than ``stretch`` words: a hash of ``span`` words at ``item_at``."""
    text, n = F.col("words"), F.size("words")
    half = F.floor(n / 2).cast("int")
    whole = F.array(F.struct(F.lit(0).alias("item_at"), n.alias("span")))
    halves = F.array(
        F.struct(F.lit(0).alias("item_at"), half.alias("span")),
        F.struct(half.alias("item_at"), (n - half).alias("span")),
    )
    short = items.filter((n > 0) & (n < stretch))
    made = short.select("*", F.inline(F.when(n >= HALVED, halves).otherwise(whole)))
    seed = F.xxhash64(F.slice(text, F.col("item_at") + 1, F.col("span")))
    return made.select("item_id", "edition", "item_at", "span", seed.alias("seed"))


def _runs(texts: DataFrame, span: int) -> DataFrame:
    """The hash of every ``span`` words of a text, ``at`` the first of them."""
    others = [c for c in texts.columns if c != "words"]

    def of(text: Column) -> Column:
        starts = F.when(
            F.size(text) >= span, F.sequence(F.lit(0), F.size(text) - span)
        ).otherwise(F.array().cast("array<int>"))
        runs = F.transform(starts, lambda i: F.xxhash64(F.slice(text, i + 1, F.lit(span))))
        return F.struct(runs.alias("runs"))

    made = texts.select(*others, F.inline(F.transform(F.array("words"), of)))
    return made.select(*others, F.posexplode("runs").alias("at", "seed"))


def _sent(sought: DataFrame) -> DataFrame:
    return F.broadcast(sought) if sought.count() <= BROADCAST_SEEDS else sought


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: Sequence[str] = MASKS,
    stretch: int = STRETCH,
    substitutions: int = SUBSTITUTIONS,
    stride: int = STRIDE,
) -> DataFrame:
    """One row per document, item and placement that overlap.

    Columns: ``doc_id``, ``version`` (a hash of the text), ``item_id``,
    ``shift`` (document word minus item word), ``item_words``, ``first`` and
    ``last`` (item words, from 0, between which the overlaps lie) and
    ``equal_words`` (equal words between them). Rows equal in id and text count
    once. Null and blank texts and items overlap nothing.
    """
    texts = docs.select("doc_id", text_key().alias("version"), "text")
    items = benchmark.select("item_id", text_key().alias("edition"), "text").distinct()
    found = lambda table: table.withColumn("words", words(F.col("text"))).drop("text")
    sought = seeds(found(items).filter(F.size("words") >= stretch), masks)
    sought = settled(sought.withColumnRenamed("at", "item_at"), "benchmark-seeds")
    short = settled(_short_seeds(found(items), stretch), "short-seeds")
    hits = [seeds(found(texts), masks, stride).join(_sent(sought), "seed")]
    # No more lengths than an item that is not long has words.
    for row in short.select("span").distinct().orderBy("span").collect():
        of_length = short.filter(F.col("span") == row["span"]).drop("span")
        hits.append(_runs(found(texts), row["span"]).join(_sent(of_length), "seed"))
    shift = (F.col("at") - F.col("item_at")).alias("shift")
    placed = reduce(DataFrame.unionAll, [
        h.select(
            F.col("doc_id").alias("own"), F.col("version").alias("own_version"),
            F.col("item_id").alias("item"), F.col("edition").alias("item_edition"), shift,
        )
        for h in hits
    ])
    # Stored, the placements are few rows whose size Spark knows.
    placed = settled(placed.distinct(), "placements")
    of_doc = F.col("own").eqNullSafe(F.col("doc_id")) & (F.col("own_version") == F.col("version"))
    of_item = F.col("item").eqNullSafe(F.col("item_id")) & (F.col("item_edition") == F.col("edition"))
    beside = placed.join(texts.withColumn("doc", F.col("text")).drop("text"), of_doc).join(
        items.withColumnRenamed("text", "item_text"), of_item
    )
    beside = beside.select("doc_id", "version", "item_id", "shift", "doc", "item_text")
    beside = computed(beside, doc_words=words(F.col("doc")), words=words(F.col("item_text")))
    # Item words from the first to the last that lie beside a document word.
    doc, item, shift = F.col("doc_words"), F.col("words"), F.col("shift")
    start, end = F.greatest(F.lit(0), -shift), F.least(F.size(item), F.size(doc) - shift)
    measured = computed(
        beside.drop("doc", "item_text"),
        item_words=F.size(item),
        start=start,
        needed=F.least(F.lit(stretch), F.size(item)),
        allowed=F.when(F.size(item) >= stretch, substitutions)
        .when(F.size(item) >= HALVED, F.least(F.lit(1), F.lit(substitutions)))
        .otherwise(0),
        equal=F.transform(
            F.sequence(start, end - 1),
            lambda i: (F.get(item, i) == F.get(doc, i + shift)).cast("int"),
        ),
    ).filter(F.size("equal") >= F.col("needed"))

    def total(at: Column, n: Column) -> Column:
        return F.aggregate(F.slice("equal", at + 1, n), F.lit(0), lambda a, e: a + e)

    good = F.filter(
        F.sequence(F.lit(0), F.size("equal") - F.col("needed")),
        lambda s: total(s, F.col("needed")) >= F.col("needed") - F.col("allowed"),
    )
    over = computed(measured.drop("doc_words", "words"), good=good).filter(F.size("good") > 0)
    begin, length = F.array_min("good"), F.array_max("good") - F.array_min("good") + F.col("needed")
    return over.select(
        "doc_id", "version", "item_id", "shift", "item_words",
        (F.col("start") + begin).alias("first"),
        (F.col("start") + begin + length - 1).alias("last"),
        total(begin, length).alias("equal_words"),
    ).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``item_id``, ``item_words``, ``equal_words`` of each overlapping pair.

    ``equal_words`` is that of the placement with the most.
    """
    pairs = overlaps(docs, benchmark).groupBy("doc_id", "item_id")
    return pairs.agg(
        F.max("item_words").cast("long").alias("item_words"),
        F.max("equal_words").cast("long").alias("equal_words"),
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, shortest: int = HALVED) -> DataFrame:
    """A corpus stage: the documents that overlap no benchmark item.

    Items of fewer than ``shortest`` words are left out of account, as a text
    that has such few words in common with a benchmark need not stem from it.
    Rows without id are compared and kept or dropped as any other.
    """
    benchmark = benchmark.filter(F.size(words(F.col("text"))) >= shortest)
    own, version = fresh(docs.columns, "own"), fresh(docs.columns, "version")
    flagged = overlaps(docs, benchmark).select(
        F.col("doc_id").alias(own), F.col("version").alias(version)
    ).distinct()
    flagged = settled(flagged, "contaminated")
    same = docs[quoted("doc_id")].eqNullSafe(flagged[own]) & (text_key() == flagged[version])
    return docs.join(flagged, same, "left_anti")
