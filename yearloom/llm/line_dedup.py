"""Line dedup: repeated windows of three consecutive lines.

A line is what lies between two newlines, compared without the white space
around it. A window is three lines in a row that hold more than white space;
blank lines between them are skipped. All occurrences of a window but the first,
by document id and position, are removed: every line from its first to its last
one, the blank ones between included, overlapping windows merged.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.llm.rows import fresh, quoted, text_key
from yearloom.scratch import settled

WINDOW = 3
#: What is not part of a line's content: ASCII white space at either end.
_BLANKS = " \t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _content(line: Column) -> Column:
    return F.trim(line, F.lit(_BLANKS))


def windows(docs: DataFrame) -> DataFrame:
    """One row per document and window: two hashes, ``doc_id``, ``version``, lines.

    ``first`` and ``last`` are line numbers from 0. The two 64-bit hashes stand
    for the window's content. ``version`` is a hash of the whole text: it tells
    texts under one id apart, while repeated rows count as one document.
    """
    lines = docs.select("doc_id", text_key().alias("version"), _lines(F.col("text")).alias("lines"))
    # The position of every line that is not blank, and the hash of its content.
    filled = F.filter(
        F.transform(
            F.col("lines"),
            lambda line, i: F.struct(
                i.alias("at"),
                (_content(line) != "").alias("filled"),
                F.xxhash64(_content(line)).alias("one"),
                F.xxhash64(F.lit(WINDOW), _content(line)).alias("two"),
            ),
        ),
        lambda line: line["filled"],
    )
    numbered = lines.select("doc_id", "version", filled.alias("lines")).filter(
        F.size("lines") >= WINDOW
    )
    nth = [lambda i, k=k: F.get(F.col("lines"), i + k) for k in range(WINDOW)]
    window = F.transform(
        F.sequence(F.lit(0), F.size("lines") - WINDOW),
        lambda i: F.struct(
            F.xxhash64(*[n(i)["one"] for n in nth]).alias("one"),
            F.xxhash64(*[n(i)["two"] for n in nth]).alias("two"),
            nth[0](i)["at"].alias("first"),
            nth[-1](i)["at"].alias("last"),
        ),
    )
    return numbered.select("doc_id", "version", F.explode(window).alias("w")).select(
        "w.one", "w.two", "doc_id", "version", "w.first", "w.last"
    )


def later_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``version``, ``first``, ``last`` of each window to remove."""
    every = windows(docs)
    place = F.struct("doc_id", "version", "first")
    repeated = (
        every.groupBy("one", "two")
        .agg(F.min(place).alias("kept"), F.max(place).alias("latest"))
        .filter("kept < latest")
        .select("one", "two", "kept")
    )
    # Stored, the repeated windows are few rows whose size Spark knows, and a
    # window that very many documents hold can be split over tasks by the join.
    repeated = settled(repeated, "repeated-windows")
    later = every.join(repeated, ["one", "two"]).filter(place > F.col("kept"))
    return later.select("doc_id", "version", "first", "last")


def remove_repeated(docs: DataFrame, removed: str | None = None) -> DataFrame:
    """``docs`` without the lines of repeated windows; every row stays.

    Other columns stay as they are, ``n_chars`` included. ``removed`` names an
    added column with the numbers of the removed lines, ascending. A text
    without three filled lines, a null or an empty one has no window and stays
    as it is. Rows equal in id and text are one document and lose the same
    lines; texts under one id are ordered by their hash; a null id comes before
    all others.
    """
    added = {name: fresh([*docs.columns, removed or ""], name) for name in ("own", "version", "spans")}
    spans = (
        later_spans(docs)
        .groupBy("doc_id", "version")
        .agg(F.collect_list(F.struct("first", "last")).alias(added["spans"]))
        .withColumnsRenamed({"doc_id": added["own"], "version": added["version"]})
    )
    same_id = docs[quoted("doc_id")].eqNullSafe(spans[added["own"]])
    joined = docs.join(spans, same_id & (text_key() == spans[added["version"]]), "left")
    covered = F.array_distinct(
        F.flatten(
            F.transform(F.col(added["spans"]), lambda s: F.sequence(s["first"], s["last"]))
        )
    )
    lines = _lines(F.col(quoted("text")))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
    rest = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    text = F.when(F.col(added["spans"]).isNull(), F.col(quoted("text"))).otherwise(rest)
    columns = [
        text.alias(c) if c == "text" else F.col(quoted(c)).alias(c) for c in docs.columns
    ]
    if removed is not None:
        numbers = F.coalesce(F.sort_array(covered), F.array().cast("array<int>"))
        columns.append(numbers.alias(removed))
    return joined.select(*columns)


def without_repeated_windows(docs: DataFrame) -> DataFrame:
    """A corpus stage: the documents with what is left of their texts.

    ``n_chars`` is counted anew where that column is there. A document of which
    no line is left is dropped; one whose text was empty before stays.
    """
    name = fresh(docs.columns, "removed")
    rest = remove_repeated(docs, name).filter((F.size(name) == 0) | (F.trim(F.col(quoted("text")), F.lit(_BLANKS + "\n")) != ""))
    if "n_chars" in rest.columns:
        n = F.length(F.col(quoted("text"))).cast(docs.schema["n_chars"].dataType)
        rest = rest.withColumn("n_chars", F.when(F.size(name) == 0, F.col("n_chars")).otherwise(n))
    return rest.drop(name)
