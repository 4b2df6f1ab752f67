"""Centroid clustering of integer vectors; distances are sums of tabulated squared differences."""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from buycast.llm.common import stored

#: Components are held within this bound, so that squared distances of 64 components fit in 64 bits.
BOUND = 1 << 27
#: Sums of distances beyond the largest long are given as that.
MOST = (1 << 63) - 1
#: Vectors that one set of tables serves, at most.
ROWS = 16_384


def quantised(vectors, dims=64, scale=256):
    """vec_id and ``v``, the integers floor(scale * x) of every vector with ``dims`` finite components, written once.

    Other vectors (null, other lengths, null, NaN or infinite components) are left out. Integers beyond
    ``BOUND`` are set to it.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    held = lambda x: F.greatest(F.least(x, F.lit(BOUND)), F.lit(-BOUND))
    # held before the product, which may be infinite, and after it
    whole = lambda x: held(F.floor(held(x.cast("double")) * scale)).cast("int")
    kept = vectors.filter((F.size("embedding") == dims) & F.forall("embedding", lambda x: finite(x.cast("double"))))
    return stored(kept.select("vec_id", F.transform("embedding", whole).alias("v")))


def first_centroids(rows, k, seed):
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id`` (null id: nothing after the colon), in that order;
    vectors under one id are ordered by their components. Fewer vectors: all of them."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [r.v for r in rows.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()]


def nearest(v, centroids):
    """(cluster, squared distance) of each row of ``v``; ties go to the smaller number.

    For every dimension, the values that occur are listed once, and the squared difference of each to every
    centroid is tabulated; a distance is then a sum of table rows, one gather for each dimension.
    """
    far = np.zeros((len(v), len(centroids)), dtype=np.int64)
    for d in range(v.shape[1]):
        values, place = np.unique(v[:, d], return_inverse=True)
        table = (values[:, None].astype(np.int64) - centroids[None, :, d]) ** 2
        far += table[place]
    cluster = far.argmin(axis=1)
    return cluster, far[np.arange(len(v)), cluster]


def _batches(batches):
    """(vec_ids, matrix) in parts of ``ROWS`` rows of Arrow batches."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            lists = part.column(part.schema.get_field_index("v"))
            yield part.column(part.schema.get_field_index("vec_id")), lists.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)


def _sums(centroids):
    """For mapInArrow: one row per centroid and task, with the number and the componentwise sums of its vectors."""
    import pyarrow as pa

    def fold(batches):
        n = np.zeros(len(centroids), dtype=np.int64)
        total = np.zeros(centroids.shape, dtype=np.int64)
        for _, v in _batches(batches):
            cluster, _ = nearest(v, centroids)
            n += np.bincount(cluster, minlength=len(n))
            order = np.argsort(cluster, kind="stable")
            own, starts = np.unique(cluster[order], return_index=True)
            total[own] += np.add.reduceat(v[order], starts, axis=0, dtype=np.int64)
        some = np.flatnonzero(n)
        if len(some):
            yield pa.RecordBatch.from_pydict({"cluster": pa.array(some.astype(np.int32)), "n": pa.array(n[some]),
                                              "total": pa.array(list(total[some]), type=pa.list_(pa.int64()))})

    return fold


def refined(rows, centroids):
    """The centroids after one round: exact floor(sum / count) of the vectors assigned to each; empty ones stay."""
    dims = centroids.shape[1]
    folded = rows.mapInArrow(_sums(centroids), "cluster int, n long, total array<long>")
    # k rows of fixed width
    sums = folded.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[d]) for d in range(dims)]).alias("total"))
    out = centroids.copy()
    for r in sums.collect():
        out[r.cluster] = [s // r.n for s in r.total]
    return out


def clustered(vectors, k=40, rounds=5, seed=2, dims=64, scale=256):
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that ``quantised`` keeps.

    Lloyd's rounds on integers: centroids start as ``first_centroids``, each of ``rounds`` rounds assigns all
    vectors and replaces every centroid that has some, and a last assignment gives the result. All of it is
    integer arithmetic, so neither partitions nor their order change it. A round is one pass over the
    written vectors that sends k rows of sums per task; only k centroids pass the driver. A cluster
    with most of the vectors costs as much as any other.

    Null vec_id stays null; repeated rows appear as often as they are given; other columns are not read;
    fewer vectors than ``k`` give fewer centroids, an empty table no rows. Vectors have no text, so
    a long one is only one of another length, and left out.
    """
    rows = quantised(vectors, dims, scale)
    start = first_centroids(rows, k, seed)
    centroids = np.array(start, dtype=np.int64).reshape(len(start), dims)
    if not start:
        return rows.sparkSession.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = refined(rows, centroids)

    def assign(batches):
        import pyarrow as pa

        for ids, v in _batches(batches):
            cluster, far = nearest(v, centroids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(far)], ["vec_id", "cluster", "distance"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    assigned = stored(rows.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"))
    inertia = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    inertia, total = {c: min(s, MOST) for c, s in inertia.items()}, min(sum(inertia.values()), MOST)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    table = pd.DataFrame([(c, s, total, names[c]) for c, s in sorted(inertia.items())],
                         columns=["cluster", "cluster_inertia", "inertia", "centroid_sha256"])
    per_cluster = rows.sparkSession.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(per_cluster), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
