"""Exact search for the highest inner products by a uniform threshold in three phases.

The components of all vectors are cut into as many slices as there are nodes. A
node knows its slice only, and the score of a pair is the sum of the nodes'
partial scores.

1. Each node lists its best rows for each query. The rows of the lists with the
   highest known sums are scored by all nodes. The k-th best of these scores is
   one that the result cannot fall below: the query's cutoff.
2. Each node is told the cutoffs and gives every row whose partial score is at
   least the cutoff's share, cutoff / nodes. A row that no node gives scores
   less than the cutoff. Of those given, each row stays whose known partial
   scores, with just less than a share for every node that did not give it,
   can reach the cutoff.
3. The nodes score the rows that are left, and the k highest are the result.

All queries are compared with all rows, in blocks: a task has a fragment of the
rows and a chunk of the queries, both of bounded size, and the slice of one node.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yearloom.llm.rows import quoted
from yearloom.llm.vectors import matrix, paired_products, products, whole_vectors
from yearloom.scratch import remove, scratch_dir, settled

#: Rows of a fragment and queries of a chunk; a task holds a number for each pair.
_FRAGMENT, _CHUNK = 4096, 1024
#: Rows scored in the first phase for each one that is wanted.
_TRIED = 4

_PAIR = "query long, row long, partial long"
_PAIR_ARROW = pa.schema([("query", pa.int64()), ("row", pa.int64()), ("partial", pa.int64())])
_GIVEN = "g long, s long, query long, row array<long>, partial array<long>, cutoff long"
_ASKED = "query long, s long, asked array<long>"


def _lists(k: int, width: int):
    """Phase 1 at a node: its ``k`` best rows of a fragment for every query."""

    def found(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return _PAIR_ARROW.empty_table()
        ids, asking = rows["row"].to_numpy(), queries["query"].to_numpy()
        partial = products(matrix(queries["part"], width), matrix(rows["part"], width))
        foreign = asking[:, None] != ids[None, :]
        kept = min(k, len(ids))
        order = np.where(foreign, partial, np.iinfo(np.int64).min)
        best = np.argpartition(order, len(ids) - kept, axis=1)[:, len(ids) - kept :]
        of = np.repeat(np.arange(len(asking)), kept)
        best = best.ravel()
        keep = foreign[of, best]
        of, best = of[keep], best[keep]
        return pa.table([asking[of], ids[best], partial[of, best]], schema=_PAIR_ARROW)

    return found


def _given(nodes: int, width: int):
    """Phase 2 at a node: for every query the rows of a fragment that reach its share."""
    lists = pa.list_(pa.int64())
    schema = pa.schema(
        [("g", pa.int64()), ("s", pa.int64()), ("query", pa.int64())]
        + [("row", lists), ("partial", lists), ("cutoff", pa.int64())]
    )

    def found(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return schema.empty_table()
        ids, asking = rows["row"].to_numpy(), queries["query"].to_numpy()
        partial = products(matrix(queries["part"], width), matrix(rows["part"], width))
        # Without k scores to go by there is no cutoff, and every row counts.
        shares = [None if c is None else -(-c // nodes) for c in queries["cutoff"].to_pylist()]
        least = np.array([np.iinfo(np.int64).min if x is None else x for x in shares], np.int64)
        of, at = np.nonzero((partial >= least[:, None]) & (asking[:, None] != ids[None, :]))
        ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(asking)))])
        n = len(asking)
        return pa.table(
            [
                np.full(n, queries["g"][0].as_py()),
                np.full(n, queries["s"][0].as_py()),
                asking,
                pa.ListArray.from_arrays(ends.astype(np.int32), ids[at]),
                pa.ListArray.from_arrays(ends.astype(np.int32), partial[of, at]),
                queries["cutoff"].combine_chunks(),
            ],
            schema=schema,
        )

    return found


def _left_over(nodes: int):
    """After phase 2, for a chunk and a fragment: the rows that can reach the cutoff."""
    lists = pa.list_(pa.int64())
    schema = pa.schema([("query", pa.int64()), ("s", pa.int64()), ("asked", lists)])

    def kept(given: pa.Table) -> pa.Table:
        given = given.sort_by("query")
        asking = given["query"].to_numpy()
        cutoffs = given["cutoff"].to_pylist()
        found_rows, partials = given["row"].combine_chunks(), given["partial"].combine_chunks()
        starts = np.flatnonzero(np.diff(asking, prepend=asking[0] - 1))
        queries, asked = [], []
        for start, end in zip(starts, [*starts[1:], len(asking)]):
            rows = np.concatenate([found_rows[i].values.to_numpy() for i in range(start, end)])
            known = np.concatenate([partials[i].values.to_numpy() for i in range(start, end)])
            rows, inverse, told = np.unique(rows, return_inverse=True, return_counts=True)
            if not len(rows):
                continue
            cutoff = cutoffs[start]
            if cutoff is not None:
                total = np.zeros(len(rows), np.int64)
                np.add.at(total, inverse, known)
                share = -(-cutoff // nodes)
                rows = rows[total + (nodes - told) * (share - 1) >= cutoff]
            queries.append(asking[start])
            asked.append(rows)
        fragment = np.full(len(queries), given["s"][0].as_py(), np.int64)
        return pa.table(
            [np.array(queries, np.int64), fragment, pa.array(asked, lists)], schema=schema
        )

    return kept


def _answers(width: int):
    """A node's partial scores of the rows that it is asked for."""

    def found(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return _PAIR_ARROW.empty_table()
        rows = rows.sort_by("row")
        ids, asking = rows["row"].to_numpy(), queries["query"].to_numpy()
        asked = queries["asked"].combine_chunks()
        of = np.repeat(np.arange(len(asking)), asked.value_lengths().to_numpy(zero_copy_only=False))
        wanted = asked.flatten().to_numpy()
        at = np.searchsorted(ids, wanted)
        mine, theirs = matrix(rows["part"], width), matrix(queries["part"], width)
        step = max(1, (1 << 22) // max(width, 1))
        partial = [
            paired_products(theirs[of[i : i + step]], mine[at[i : i + step]])
            for i in range(0, len(wanted), step)
        ]
        partial = np.concatenate([np.zeros(0, np.int64), *partial])
        return pa.table([asking[of], wanted, partial], schema=_PAIR_ARROW)

    return found


class _Nodes:
    """The slices of all rows, and of the queries among them."""

    def __init__(self, rows: DataFrame, is_query: Column, nodes: int):
        n, n_queries, longest = rows.agg(
            F.count("*"), F.count_if(is_query), F.max(F.size("ints"))
        ).first()
        self.nodes = nodes
        self.width = -(-(longest or 0) // nodes)
        self._fragments = max(1, -(-n // _FRAGMENT))
        self._chunks = max(1, -(-n_queries // _CHUNK))
        self._rows = rows.select("row", self.fragment("row").alias("s"), "ints")
        self.queries = rows.filter(is_query).select(
            F.col("row").alias("query"),
            F.pmod(F.xxhash64("row", F.lit(1)), F.lit(self._chunks)).alias("g"),
            F.col("ints").alias("own"),
        )

    def fragment(self, row: str) -> Column:
        return F.pmod(F.xxhash64(row), F.lit(self._fragments))

    def _sliced(self, df: DataFrame, ints: str) -> DataFrame:
        node = F.explode(F.sequence(F.lit(0), F.lit(self.nodes - 1)))
        part = F.slice(F.col(ints), F.col("j") * self.width + 1, F.lit(self.width))
        return df.withColumn("j", node).withColumn("part", part).drop(ints)

    def everywhere(self, queries: DataFrame) -> DataFrame:
        """Each query for every fragment."""
        return queries.withColumn(
            "s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self._fragments - 1).cast("long")))
        )

    def told(self, queries: DataFrame, what, schema: str) -> DataFrame:
        """What every node says to ``queries``, each of which names a fragment."""
        chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self._chunks - 1).cast("long")))
        rows = self._sliced(self._rows, "ints").withColumn("g", chunk)
        asking = self._sliced(queries, "own")
        keys = ("g", "s", "j")
        return rows.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(what, schema)

    def scored(self, pairs: DataFrame) -> DataFrame:
        """``query``, ``row`` and score of each row asked for in ``pairs``."""
        asking = pairs.join(self.queries, "query")
        told = self.told(asking, _answers(self.width), _PAIR)
        return told.groupBy("query", "row").agg(F.sum("partial").alias("score"))


def top_matches(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    nodes: int = 2,
    key: str = "vec_id",
    value: str = "embedding",
) -> DataFrame:
    """The ``k`` rows of highest inner product with each query, other than itself.

    Queries are the rows whose ``key`` is divisible by ``every``. Gives
    ``query_id``, ``rank`` from 1, the row's ``key`` and ``score``, which is the
    inner product of the vectors' components as whole numbers floor(1024 * x).
    Of equal scores the smaller key comes first. Queries with fewer than ``k``
    other rows get all of them; an empty table gives no rows.

    More nodes make each node's work less and the cutoff's share a weaker bound:
    on vectors of 64 components of little structure 1.5 percent of all pairs
    are left for the third phase with 2 nodes and 16 percent with 4.

    Vectors that are null or hold null, NaN or infinite components take no part.
    A vector shorter than another counts as if it went on with zeros. Rows with
    a null key are found by queries, last among equals, and are none themselves.
    Rows that repeat a key or a whole row are rows of their own: each is found,
    and each is a query. Other columns are not looked at. Scores that pass 64
    bits are an error.
    """
    spark = vectors.sparkSession
    paths = [scratch_dir(spark, f"topk-{what}") for what in ("rows", "cutoffs")]
    try:
        numbered = whole_vectors(vectors, key, value).select(
            F.monotonically_increasing_id().alias("row"), "key", "ints"
        )
        rows = settled(numbered, "topk-rows", paths[0])
        at = _Nodes(rows, F.col("key") % every == 0, nodes)
        by_known = Window.partitionBy("query").orderBy(F.desc("known"), "row")
        tried = (
            at.told(at.everywhere(at.queries), _lists(k, at.width), _PAIR)
            .groupBy("query", "row")
            .agg(F.sum("partial").alias("known"))
            .withColumn("n", F.row_number().over(by_known))
            .filter(F.col("n") <= _TRIED * k)
            .groupBy("query", at.fragment("row").alias("s"))
            .agg(F.collect_list("row").alias("asked"))
        )
        by_score = Window.partitionBy("query").orderBy(F.desc("score"), "row")
        cutoffs = (
            at.scored(tried)
            .withColumn("n", F.row_number().over(by_score))
            .filter(F.col("n") == k)
            .select("query", F.col("score").alias("cutoff"))
        )
        cutoffs = settled(cutoffs, "topk-cutoffs", paths[1])

        asking = at.everywhere(at.queries.join(cutoffs, "query", "left"))
        left_over = (
            at.told(asking, _given(nodes, at.width), _GIVEN)
            .groupBy("g", "s")
            .applyInArrow(_left_over(nodes), _ASKED)
        )
        keys = rows.select("row", "key")
        scored = (
            at.scored(left_over)
            .join(keys, "row")
            .join(keys.select(F.col("row").alias("query"), F.col("key").alias("query_id")), "query")
        )
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"), "row")
        best = (
            scored.withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("key").alias(key), "score")
        )
        return settled(best, "topk")
    finally:
        for path in paths:
            remove(spark, path)
