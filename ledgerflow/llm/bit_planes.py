"""Centroid clustering by bit-plane popcount.

A component x becomes the integer floor(scale * x).  Each bit plane of a
vector's 64 integers (two's complement, so the highest plane counts negative)
is packed into one unsigned 64-bit number.  With the planes of a centroid
packed likewise, the exact dot product is the sum over pairs of planes of their
weight times popcount(plane AND plane), and |x|^2 - 2 x.c + |c|^2 is the exact
squared distance.  No floating point number takes part.

The planes are packed once into a written table (10 numbers a vector where
components are below one); each round reads that table alone, and a task sends
at most k rows of exact sums to the shuffle.  Only the k centroids and their
sums pass through the driver.

Nulls and edges: vectors that are null, or have another number of components,
or hold a null or non-finite one, are left out; a null id is kept and counts as
an empty string in the seeds' hash; repeated rows are clustered each; seeds of
equal hash go by their integers; fewer kept vectors than centroids give fewer
centroids; an empty table gives an empty result; other columns are not read.
Integers beyond +-2**27, for which a long may not hold the distance, raise.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.session import scratch_path

#: Components of a vector: one bit each of a 64-bit number.
SIZE = 64
_LIMIT = 1 << 27
#: Vectors compared at a time: the products with 40 centroids then stay in the cache.
_CHUNK = 2048


def kept(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", scale: int = 256) -> DataFrame:
    """vec_id and the integers (x, array<long>) of all vectors with exactly 64 finite components."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    return vectors.where((F.size(vector) == SIZE) & F.forall(x, finite)).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("x"))


def pack_planes(x: np.ndarray, width: int) -> np.ndarray:
    """(n, 64) integers -> (n, width) numbers; number p holds bit p of every component."""
    planes = [np.packbits((x >> p & 1).astype(bool), axis=1, bitorder="little") for p in range(width)]
    return np.ascontiguousarray(np.stack(planes, axis=1)).view("<u8").reshape(len(x), width)


def unpack_planes(planes: np.ndarray) -> np.ndarray:
    """The inverse of pack_planes."""
    n, width = planes.shape
    bits = np.unpackbits(np.ascontiguousarray(planes).view(np.uint8).reshape(n, width, 8), axis=2, bitorder="little")
    return np.einsum("npd,p->nd", bits, weights(width), dtype=np.int64)


def weights(width: int) -> np.ndarray:
    """What a bit of each plane is worth."""
    w = np.int64(1) << np.arange(width, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def dots(planes: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """(n, k) exact dot products from the planes of n vectors and of k centroids."""
    total = np.zeros((len(planes), len(centres)), dtype=np.int64)
    worth = weights(planes.shape[1])
    for i, a in enumerate(worth):
        for j, b in enumerate(worth):
            total += a * b * np.bitwise_count(planes[:, i, None] & centres[None, :, j]).astype(np.int64)
    return total


def nearest(planes: np.ndarray, norm: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smallest) and the squared distance, for every vector."""
    centres = pack_planes(centroids, planes.shape[1])
    own = (centroids * centroids).sum(axis=1)
    label, distance = np.empty(len(planes), dtype=np.int64), np.empty(len(planes), dtype=np.int64)
    for lo in range(0, len(planes), _CHUNK):
        part = slice(lo, lo + _CHUNK)
        d = norm[part, None] - 2 * dots(planes[part], centres) + own[None, :]
        label[part] = d.argmin(axis=1)
        distance[part] = d[np.arange(len(d)), label[part]]
    return label, distance


def _long_lists(rows: np.ndarray) -> pa.Array:
    """An (n, m) array of 64-bit numbers as a column of lists."""
    n, m = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * m), pa.array(rows.reshape(-1).view(np.int64)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def write_planes(vectors: DataFrame, width: int, folder: str) -> DataFrame:
    """vec_id, norm (the squared length) and planes of every kept vector, written to ``folder``."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), SIZE)
            planes = pack_planes(x, width)
            norm = (x * x).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(norm), _long_lists(planes)], ["vec_id", "norm", "planes"])

    schema = "vec_id long, norm long, planes array<long>"
    vectors.mapInArrow(packed, schema).write.parquet(folder)
    return vectors.sparkSession.read.schema(schema).parquet(folder)


def _planes(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    return _matrix(batch.column("planes"), width).view(np.uint64), batch.column("norm").to_numpy()


def moved(table: DataFrame, centroids: np.ndarray, width: int) -> np.ndarray:
    """One round: every non-empty centroid becomes the exact floor of its vectors' mean."""
    k = len(centroids)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, SIZE), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            planes, norm = _planes(batch, width)
            label, _ = nearest(planes, norm, centroids)
            for lo in range(0, len(label), _CHUNK):
                own = label[lo: lo + _CHUNK]
                order = np.argsort(own, kind="stable")
                found, first = np.unique(own[order], return_index=True)
                total[found] += np.add.reduceat(unpack_planes(planes[lo: lo + _CHUNK][order]), first, axis=0)
            count += np.bincount(label, minlength=k)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some]), _long_lists(total[some])], ["cluster", "n", "s"])

    found = (
        table.select("norm", "planes").mapInArrow(sums, "cluster long, n long, s array<long>")
        .select("cluster", "n", F.posexplode("s").alias("at", "s"))
        .groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))
        .collect()  # k * 64 rows
    )
    out = centroids.copy()
    for r in found:
        out[r["cluster"], r["at"]] = int(r["s"]) // r["n"]
    return out


def seeds(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k kept vectors of least sha256 of salt:id, in that order."""
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(name, 256).alias("hash"), "x").orderBy("hash", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], dtype=np.int64).reshape(-1, SIZE)


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, salt: str = "2", scale: int = 256, vector: str = "embedding",
    vec_id: str = "vec_id",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid (array<long>) of every kept vector."""
    spark = vectors.sparkSession
    whole = kept(vectors, vector, vec_id, scale)
    least, most = whole.agg(F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
    schema = "vec_id long, cluster int, distance long"
    if least is None:
        extra = ", cluster_inertia long, inertia long, centroid array<long>"
        return spark.createDataFrame([], schema + extra)
    if max(-least, most) >= _LIMIT:
        raise ValueError(f"components must stay within +-{_LIMIT / scale}")
    width = max(1, most.bit_length(), (-least - 1).bit_length() if least < 0 else 0) + 1
    table = write_planes(whole, width, scratch_path(spark, f"planes-{uuid4().hex}"))
    centroids = seeds(whole, k, salt)
    for _ in range(rounds):
        centroids = moved(table, centroids, width)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, distance = nearest(*_planes(batch, width), centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(label.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    folder = scratch_path(spark, f"clusters-{uuid4().hex}")
    table.mapInArrow(assigned, schema).write.parquet(folder)
    done = spark.read.schema(schema).parquet(folder)
    own = {r["cluster"]: r["d"] for r in done.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows
    inertia = sum(own.values())
    facts = spark.createDataFrame(
        [(c, d, inertia, centroids[c].tolist()) for c, d in own.items()],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return done.join(F.broadcast(facts), "cluster").select("vec_id", *(c for c in done.columns if c != "vec_id"), *facts.columns[1:])


def centroid_digest(centroid: str = "centroid"):
    """sha256 of a centroid's components as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.col(centroid).cast("array<string>"), ","), 256)
