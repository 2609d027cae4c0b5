"""Clusters of vectors by exact delta Lloyd rounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, scratch

#: Components stay under this, so that squared distances of 64 of them fit a long.
LARGEST = (1 << 26) - 1


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dim: int = 64, scale: int = 256) -> DataFrame:
    """``vec_id, v``: the vectors with exactly ``dim`` components, none null or non-finite, as integers ``floor(scale * x)``.

    A component whose integer would be over ``LARGEST`` is an error, as distances would not fit a long.
    """
    x = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    too_large = F.raise_error(F.lit(f"a component is over {LARGEST} / {scale}")).cast("int")
    whole = F.transform(x, lambda c: F.when(F.abs(c * scale) < LARGEST, F.floor(c * scale).cast("int")).otherwise(too_large))
    return vectors.where((F.size(x) == dim) & finite).select(F.col(f"`{vec_id}`").alias("vec_id"), whole.alias("v"))


def starts(whole: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors with the least SHA-256 of ``seed:vec_id``; ties by the vector, a null vec_id behind all others.  At most ``k`` rows reach the driver."""
    order: Column = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [list(r.v) for r in whole.orderBy(order.asc_nulls_last(), "v").limit(k).collect()]


def squared_distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows, as int64."""
    largest = max(int(np.abs(v).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * v.shape[1] * largest**2 < 1 << 53:  # every sum below is then exact in a double
        a, b = v.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)
    out = np.empty((len(v), len(c)), np.int64)
    for j, row in enumerate(c.astype(np.int64)):
        out[:, j] = ((v.astype(np.int64) - row) ** 2).sum(axis=1)
    return out


def reassigned(v: np.ndarray, owner: np.ndarray, distance: np.ndarray, centroids: np.ndarray, changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New owners and distances; an owner of -1 is none yet.

    A vector whose own centroid stayed compares the changed ones with the distance
    it has; one whose own centroid changed compares all.  The smaller number wins ties.
    """
    owner, distance = owner.copy(), distance.copy()
    lost = (owner < 0) | changed[owner]
    if lost.any():
        d = squared_distances(v[lost], centroids)
        owner[lost] = d.argmin(axis=1)
        distance[lost] = d.min(axis=1)
    new = np.flatnonzero(changed)
    if len(new) and not lost.all():
        kept = np.flatnonzero(~lost)
        d = squared_distances(v[kept], centroids[new])
        near, best = new[d.argmin(axis=1)], d.min(axis=1)
        takes = (best < distance[kept]) | ((best == distance[kept]) & (near < owner[kept]))
        owner[kept[takes]], distance[kept[takes]] = near[takes], best[takes]
    return owner, distance


def _round(state: DataFrame, centroids: np.ndarray, changed: np.ndarray, last: bool) -> DataFrame:
    """One round over ``state(vec_id, v, owner, distance, transfer)``; rows with ``transfer`` are sums, a few a task.

    Those rows hold, for a centroid, how many vectors it won less those it lost
    (``distance``) and the signed sum of them (``transfer``).
    """
    k, dim = centroids.shape
    kind = state.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        won, sums, ids = np.zeros(k, np.int64), np.zeros((k, dim), np.int64), None
        for batch in batches:
            ids = batch.column(0).type
            v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            was = batch.column(2).to_numpy(zero_copy_only=False)
            owner, distance = reassigned(v, was, batch.column(3).to_numpy(zero_copy_only=False), centroids, changed)
            moved = owner != was
            for sign, side in ((1, owner), (-1, was)):
                at = moved & (side >= 0)
                np.add.at(won, side[at], sign)
                np.add.at(sums, side[at], sign * v[at].astype(np.int64))
            vectors = pa.nulls(batch.num_rows, pa.list_(pa.int32())) if last else batch.column(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), vectors, pa.array(owner, pa.int32()), pa.array(distance, pa.int64()), pa.nulls(batch.num_rows, pa.list_(pa.int64()))], names=["vec_id", "v", "owner", "distance", "transfer"])
        at = np.flatnonzero(won.astype(bool) | sums.any(axis=1))
        if len(at) and not last:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(at), ids), pa.nulls(len(at), pa.list_(pa.int32())), pa.array(at, pa.int32()), pa.array(won[at]), pa.array(sums[at].tolist(), pa.list_(pa.int64()))], names=["vec_id", "v", "owner", "distance", "transfer"]
            )

    return state.mapInArrow(run, f"vec_id {kind}, v array<int>, owner int, distance long, transfer array<long>")


def clusters(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector.

    Lloyd rounds in exact integers.  The assignment of every vector and its distance
    are written each round; a round compares only the centroids that changed, and
    all of them for vectors whose own centroid did.  Global counts and sums stay from
    round to round and take the signed transfers of vectors that changed their owner, which
    tasks add up before they are sent (``k`` rows a task).  Only ``k * dim`` numbers reach
    the driver.  When no centroid changes, later rounds would change nothing and are left out.

    Vectors of another length or with null or non-finite components give no row, an
    empty table none at all; fewer than ``k`` vectors start as many centroids; repeated
    rows are vectors of their own; a null vec_id is kept.  Other columns are not looked at.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, vec_id, vector, dim, scale)
    centroids = np.array(starts(whole, k, seed), np.int64).reshape(-1, dim)
    state = whole.select("vec_id", "v", F.lit(-1).alias("owner"), F.lit(0).cast("long").alias("distance"))
    k = len(centroids)
    if not k:
        return state.select("vec_id", F.col("owner").alias("cluster"), "distance", F.col("distance").alias("cluster_inertia"), F.col("distance").alias("inertia"), F.lit("").alias("centroid_sha256")).where("false")
    counts, sums, changed, table = np.zeros(k, np.int64), np.zeros((k, dim), np.int64), np.ones(k, bool), None
    for r in range(rounds + 1):
        before, table = table, scratch(_round(state, centroids, changed, last=r == rounds), f"assigned{r}")
        discard(before)
        state = table.where("transfer is null").drop("transfer")
        if r == rounds:
            break
        sent = table.where("transfer is not null")
        for row in sent.groupBy("owner").agg(F.sum("distance").alias("n")).collect():
            counts[row.owner] += row.n
        for row in sent.select("owner", F.posexplode("transfer").alias("at", "x")).groupBy("owner", "at").agg(F.sum("x").alias("x")).collect():
            sums[row.owner, row.at] += row.x
        moved = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], centroids)
        changed = (moved != centroids).any(axis=1)
        centroids = moved
        if not changed.any():
            break
    inertia = {row.owner: row.d for row in state.groupBy("owner").agg(F.sum("distance").alias("d")).collect()}  # a row a centroid
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    rows = [(c, d, sum(inertia.values()), digest[c]) for c, d in sorted(inertia.items())]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", F.col("owner").alias("cluster"), "distance").join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
