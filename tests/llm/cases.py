"""Awkward rows for every operator."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators might use themselves.
        T.StructField("own", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("a.b", T.StringType()),
        T.StructField("words", T.StringType()),
    ]
)


def documents(spark, texts):
    """A table of (id, text), with columns of clashing names beside."""
    rows = [(i, t, None, None if t is None else len(t), "o", "v", "k", "d", "w") for i, t in texts]
    return spark.createDataFrame(rows, DOCUMENTS)


def prose(n, start=0):
    """``n`` different words."""
    return " ".join(f"word{k:04d}" for k in range(start, start + n))


#: Nulls, empty and blank texts, repeated rows, one id with two texts, a long text.
AWKWARD = [
    (1, prose(60)),
    (2, prose(60)),
    (2, prose(60)),
    (3, None),
    (4, ""),
    (5, " \n\t \n"),
    (None, prose(60)),
    (None, None),
    (6, "one two"),
    (6, prose(70, 500)),
    (7, prose(30_000, 2000)),
    (8, "ONE  two\n"),
]
