"""Lloyd's clustering with the dimensions of all vectors dealt to column blocks.

Vectors lie in packs, and the components of a pack in blocks of columns, each a
row of its own. In a round, a task that holds a block measures its part of the
squared distances to its slice of every centroid; the parts of a pack are added
up under its number, and the least sum is the cluster. The clusters, a byte for
each vector, go back to the blocks, which lie dealt out by pack and block and
are not moved; each sums its own columns by cluster, and from these sums comes
its slice of the new centroids. All numbers are whole and nothing is rounded.

Only centroids and their sums, k times the number of dimensions, pass through
the driver.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.llm.vectors import matrix, whole_vectors
from yearloom.scratch import remove, scratch_dir, settled

#: Vectors of a pack; a pack's columns, distances and clusters are one value each.
_PACK = 512
_PARTS = "pack long, part binary"
_CLUSTERS = "pack long, cluster binary, distance binary"
_SUMS = "b int, cluster int, n long, sums array<decimal(38,0)>"


def _packs(dimensions: int, blocks: int):
    """Cut the rows of a task into packs, and each pack into blocks of columns."""
    edges = [dimensions * b // blocks for b in range(blocks + 1)]
    schema = pa.schema(
        [("pack", pa.int64()), ("b", pa.int32()), ("keys", pa.binary()), ("block", pa.binary())]
    )

    def cut(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        keys, rows, held = [], [], 0

        def packs(least: int):
            nonlocal number, keys, rows, held
            k, r = np.concatenate(keys), np.concatenate(rows)
            while len(k) >= least:
                own_k, own_r = k[:_PACK], np.ascontiguousarray(r[:_PACK])
                blocks_of = [np.ascontiguousarray(own_r[:, a:z]) for a, z in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * blocks, pa.int64()),
                        pa.array(range(blocks), pa.int32()),
                        pa.array([own_k.tobytes()] + [b""] * (blocks - 1), pa.binary()),
                        pa.array([x.tobytes() for x in blocks_of], pa.binary()),
                    ],
                    schema=schema,
                )
                number, k, r = number + 1, k[_PACK:], r[_PACK:]
            keys, rows, held = [k], [r], len(k)

        for batch in batches:
            if batch.num_rows:
                keys.append(batch.column("key").to_numpy(zero_copy_only=False).astype(np.int64))
                rows.append(matrix(batch.column("ints"), dimensions).astype(np.int64))
                held += batch.num_rows
                if held >= _PACK:
                    yield from packs(_PACK)
        if held:
            yield from packs(1)

    return cut


def _partial_distances(centroids: list[list[int]], blocks: int):
    """Of each block: the squared distances of its vectors to its slice of every centroid."""
    dimensions = len(centroids[0])
    edges = [dimensions * b // blocks for b in range(blocks + 1)]

    def measured(batches):
        slices = [np.array([c[a:z] for c in centroids], np.int64) for a, z in zip(edges, edges[1:])]
        for batch in batches:
            parts = []
            for b, block in zip(batch.column("b").to_pylist(), batch.column("block")):
                own = slices[b]
                x = np.frombuffer(block.as_buffer(), np.int64).reshape(-1, own.shape[1])
                parts.append(_squared_distances(x, own).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("pack"), pa.array(parts, pa.binary())], ["pack", "part"])

    return measured


def _squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    largest = max(int(np.abs(a).max(initial=0)) for a in (x, centroids))
    if 4 * largest * largest * max(x.shape[1], 1) >= 1 << 62:
        wide = x.astype(object)
        far = [((wide - c.astype(object)) ** 2).sum(axis=1) for c in centroids]
        return np.stack(far, axis=1).astype(np.int64)
    made = np.empty((len(x), len(centroids)), np.int64)
    for i, c in enumerate(centroids):
        gap = x - c
        made[:, i] = np.einsum("ij,ij->i", gap, gap)
    return made


def _nearest(k: int):
    """Of each pack: the parts of all its blocks added up, and the least of every vector."""

    def chosen(parts: pa.Table) -> pa.Table:
        total = None
        for part in parts["part"]:
            own = np.frombuffer(part.as_buffer(), np.int64)
            total = own.copy() if total is None else total + own
        total = total.reshape(-1, k)
        cluster = total.argmin(axis=1)  # the first of equals
        distance = total[np.arange(len(total)), cluster]
        size = np.uint8 if k <= 256 else np.uint32
        return pa.table(
            {
                "pack": parts["pack"][:1],
                "cluster": pa.array([cluster.astype(size).tobytes()], pa.binary()),
                "distance": pa.array([distance.tobytes()], pa.binary()),
            }
        )

    return chosen


def _block_sums(k: int):
    """Of all blocks of a task: the sums of their columns by cluster."""
    size = np.uint8 if k <= 256 else np.uint32

    def summed(batches):
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, block, cluster in zip(
                batch.column("b").to_pylist(), batch.column("block"), batch.column("cluster")
            ):
                of = np.frombuffer(cluster.as_buffer(), size)
                x = np.frombuffer(block.as_buffer(), np.int64).reshape(len(of), -1)
                order = np.argsort(of, kind="stable")
                x, n = x[order], np.bincount(of, minlength=k)
                starts = np.cumsum(n) - n
                if b not in sums:
                    sums[b], counts[b] = np.zeros((k, x.shape[1]), object), np.zeros(k, np.int64)
                for i in np.flatnonzero(n):
                    # Half-words, so that no sum of a pack passes 64 bits.
                    rows = x[starts[i] : starts[i] + n[i]]
                    high, low = (rows >> 32).sum(axis=0), (rows & 0xFFFFFFFF).sum(axis=0)
                    sums[b][i] += high.astype(object) * (1 << 32) + low.astype(object)
                counts[b] += n
        rows = [(b, i, int(counts[b][i]), list(sums[b][i])) for b in sums for i in range(k) if counts[b][i]]
        if rows:
            b, cluster, n, s = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(b, pa.int32()),
                    pa.array(cluster, pa.int32()),
                    pa.array(n, pa.int64()),
                    pa.array(s, pa.list_(pa.decimal128(38, 0))),
                ],
                ["b", "cluster", "n", "sums"],
            )

    return summed


def _unpacked(k: int):
    """One row for each vector of a pack."""
    size = np.uint8 if k <= 256 else np.uint32

    def rows(batches):
        for batch in batches:
            for keys, cluster, distance in zip(*(batch.column(c) for c in ("keys", "cluster", "distance"))):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(keys.as_buffer(), np.int64)),
                        pa.array(np.frombuffer(cluster.as_buffer(), size).astype(np.int32)),
                        pa.array(np.frombuffer(distance.as_buffer(), np.int64)),
                    ],
                    ["key", "cluster", "distance"],
                )

    return rows


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors of the ``k`` smallest SHA-256 hashes of ``<seed>:<key>``, in that order."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    chosen = vectors.select("ints", rank.alias("rank")).orderBy("rank", "ints").limit(k)
    return [list(r["ints"]) for r in chosen.collect()]


class _Blocks:
    """The vectors in packs and column blocks, dealt out by both and kept so."""

    def __init__(self, vectors: DataFrame, dimensions: int, blocks: int, path: str):
        self.count = blocks
        schema = "pack long, b int, keys binary, block binary"
        cut = vectors.mapInArrow(_packs(dimensions, blocks), schema)
        stored = settled(cut, "column-blocks", path)
        partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self._dealt = stored.select("pack", "b", "block").repartition(partitions, "pack", "b")
        self._dealt.persist(StorageLevel.MEMORY_AND_DISK)
        self.keys = stored.filter("b = 0").select("pack", "keys")

    def release(self) -> None:
        self._dealt.unpersist()

    def clusters(self, centroids: list[list[int]]) -> DataFrame:
        """``pack`` with the clusters and distances of its vectors."""
        parts = self._dealt.mapInArrow(_partial_distances(centroids, self.count), _PARTS)
        return parts.groupBy("pack").applyInArrow(_nearest(len(centroids)), _CLUSTERS)

    def moved(self, centroids: list[list[int]]) -> list[list[int]]:
        """The mean of each cluster, rounded down; an empty one keeps its place."""
        block = F.explode(F.sequence(F.lit(0), F.lit(self.count - 1)))
        told = self.clusters(centroids).select("pack", "cluster", block.alias("b"))
        joined = self._dealt.join(told.hint("shuffle_hash"), ["pack", "b"])
        sums = joined.select("b", "block", "cluster").mapInArrow(_block_sums(len(centroids)), _SUMS)
        total = (
            sums.select("b", "cluster", "n", F.posexplode("sums").alias("column", "x"))
            .groupBy("b", "cluster", "column")
            .agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
        )
        dimensions = len(centroids[0])
        made = [list(c) for c in centroids]
        for r in total.collect():
            made[r["cluster"]][dimensions * r["b"] // self.count + r["column"]] = int(r["x"]) // r["n"]
        return made


def clustered(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dimensions: int = 64,
    blocks: int = 4,
    seed: int = 3,
    key: str = "vec_id",
    value: str = "embedding",
) -> DataFrame:
    """Every vector's cluster after ``rounds`` rounds of Lloyd's algorithm.

    Components count as whole numbers floor(1024 * x). The first centroids are
    the vectors of the ``k`` smallest SHA-256 hashes of ``<seed>:<key>``; of
    fewer vectors, all. Each round assigns every vector to the nearest centroid
    by squared distance, the smaller number of equals, and moves each centroid
    that has vectors to their mean, rounded down. Then all are assigned again.

    Gives ``key``, ``cluster``, ``distance`` (squared), ``cluster_inertia`` and
    ``inertia``, the distance summed over the cluster and over all, and
    ``centroid_sha256`` of the cluster's last centroid in decimal, with commas.

    Vectors of other than ``dimensions`` components, null ones, those without a
    key and those with null, NaN or infinite components are left out. Rows that
    repeat a key or a whole row each count and are each returned; under one key
    the smaller vector is the first centroid's. An empty table gives no rows;
    other columns are not looked at. Numbers that pass 64 bits are an error.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, key, value)
    kept = whole.filter((F.size("ints") == dimensions) & F.col("key").isNotNull())
    path = scratch_dir(spark, "column-blocks")
    rows = _Blocks(kept, dimensions, blocks, path)
    try:
        centroids = first_centroids(kept, k, seed)
        if not centroids:
            return _empty(spark, key)
        for _ in range(rounds):
            centroids = rows.moved(centroids)
        unpacked = rows.clusters(centroids).join(rows.keys, "pack")
        members = settled(
            unpacked.select("keys", "cluster", "distance").mapInArrow(
                _unpacked(len(centroids)), "key long, cluster int, distance long"
            ),
            "clusters",
        )
    finally:
        rows.release()
        remove(spark, path)
    return _with_sums(members, centroids, key)


_RESULT = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def _empty(spark: SparkSession, key: str) -> DataFrame:
    return spark.createDataFrame([], f"`{key}` long, {_RESULT}")


def _with_sums(members: DataFrame, centroids: list[list[int]], key: str) -> DataFrame:
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    by_cluster = {r["cluster"]: int(r["x"]) for r in members.groupBy("cluster").agg(exact.alias("x")).collect()}
    total = sum(by_cluster.values())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    sums = F.create_map(*[F.lit(x) for c, s in by_cluster.items() for x in (c, s)])
    names = F.array(*[F.lit(d) for d in digests])
    return members.select(
        F.col("key").alias(key),
        "cluster",
        "distance",
        sums[F.col("cluster")].cast("long").alias("cluster_inertia"),
        F.lit(total).cast("long").alias("inertia"),
        names[F.col("cluster")].alias("centroid_sha256"),
    )
