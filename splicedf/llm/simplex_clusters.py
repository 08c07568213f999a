"""Centroid clustering: distances to pivots, projected to the apex of a simplex, bound the distance of vector and centroid.

A vector's distances to n pivots place it as the apex over the simplex of the pivots in n dimensions. The distance of two
apexes is at most that of their vectors; with the height of one turned over it is at least that. Pivots do not move, so
a vector's apex is worked out once and kept with it; in each round only the few centroids' apexes are new. Centroids whose
lower bound is above the least upper bound go, and the rest are compared as integers.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splicedf.llm.common import written
from splicedf.llm.int_vectors import LONG, CellSums, exact, floors, matrix, means, sound

CLUSTERS, ROUNDS, DIMS, SCALE, SEED = 8, 10, 64, 1024, 3
#: Pivots are chosen among the first CANDIDATES vectors by hash; one that rises less than FLAT of the largest distance over the others adds nothing.
PIVOTS, CANDIDATES, FLAT = 8, 64, 0.05
#: Room for rounding in the bounds, as a share of the squared distances to the first pivot; rounding itself is far below.
ROOM = 1e-6
CHUNK = 2_000


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows of equal place, exact."""
    a, b = exact(a, b, a.shape[1])
    return ((a - b) ** 2).sum(1)


class Simplex:
    """Pivots as vertices of a simplex: the first at the origin, each next one dimension higher."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        n = len(pivots)
        self.vertices = np.zeros((n - 1, n - 1))
        for i in range(1, n):
            at = Simplex.of(self.vertices[: i - 1, : i - 1], pivots[:i], pivots[i : i + 1])
            self.vertices[i - 1, :i] = at[0]

    @staticmethod
    def of(vertices: np.ndarray, pivots: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Apexes: coordinates in the span of the pivots, then the height above it."""
        to = np.stack([squared(rows, np.broadcast_to(p, rows.shape)).astype(float) for p in pivots], 1)
        inner = (to[:, :1] + (vertices**2).sum(1)[None, :] - to[:, 1:]) / 2
        flat = np.linalg.solve(vertices, inner.T).T if len(vertices) else inner
        return np.c_[flat, np.sqrt(np.maximum(to[:, 0] - (flat**2).sum(1), 0.0))]

    def apexes(self, rows: np.ndarray) -> np.ndarray:
        return self.of(self.vertices, self.pivots, rows)


def simplex(candidates: np.ndarray, most: int) -> Simplex:
    """Pivots taken one by one, the candidate that rises highest above those before."""
    chosen, largest = [0], 0.0
    while len(chosen) < min(most, len(candidates)):
        heights = Simplex(candidates[chosen]).apexes(candidates)[:, -1]
        largest = max(largest, heights.max())
        if heights.max() <= FLAT * largest or largest == 0:
            break
        chosen.append(int(heights.argmax()))
    return Simplex(candidates[chosen])


def nearest(rows: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Of each row the nearest centroid (the first of equals), the squared distance, and how many distances were compared in all."""
    base = sum((apexes[:, i : i + 1] - tops[None, :, i]) ** 2 for i in range(tops.shape[1] - 1)) + np.zeros((len(rows), len(tops)))
    up, down = apexes[:, -1:] + tops[None, :, -1], apexes[:, -1:] - tops[None, :, -1]
    room = ROOM * ((apexes**2).sum(1)[:, None] + (tops**2).sum(1)[None, :] + 1.0)
    live = base + down**2 - room <= (base + up**2 + room).min(1)[:, None]
    row, cluster = np.nonzero(live)
    d = squared(rows[row], centroids[cluster])
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, int)
    least = np.minimum.reduceat(d, first) if len(row) else d
    at = np.flatnonzero((d == np.repeat(least, np.diff(np.r_[first, len(row)]))).astype(bool))
    at = at[np.unique(row[at], return_index=True)[1]]
    return cluster[at], least, len(row)


def chunks(batch, dims: int):
    """(first row, vectors, apexes) of a batch, in chunks."""
    v = matrix(batch.column(batch.schema.get_field_index("v")), dims)
    a = batch.column(batch.schema.get_field_index("apex"))
    a = matrix(a, len(a.flatten()) // max(len(a), 1))
    for i in range(0, len(v), CHUNK):
        yield v[i : i + CHUNK], a[i : i + CHUNK]


def projected(table: DataFrame, pivots: Simplex, dims: int) -> DataFrame:
    """table (_id, v) with the apexes."""

    def add(batches):
        import pyarrow as pa

        for batch in batches:
            v = matrix(batch.column(1), dims)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(pivots.apexes(v)), pa.list_(pa.float64()))], ["_id", "v", "apex"])

    return table.select("_id", "v").mapInArrow(add, f"_id {table.schema['_id'].dataType.simpleString()}, v array<bigint>, apex array<double>")


def moved(table: DataFrame, pivots: Simplex, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    tops, (k, dims) = pivots.apexes(centroids), centroids.shape

    def gather(batches):
        sums = CellSums(k, dims)
        for batch in batches:
            for v, a in chunks(batch, dims):
                sums.add(nearest(v, a, centroids, tops)[0], v)
        yield sums.batch()

    return means(table.select("v", "apex").mapInArrow(gather, CellSums.SCHEMA), centroids)


def assigned(table: DataFrame, pivots: Simplex, centroids: np.ndarray) -> DataFrame:
    """_id, cluster, distance and compared (how many centroids the bounds left, on average over the row's chunk)."""
    tops, dims = pivots.apexes(centroids), centroids.shape[1]

    def assign(batches):
        import pyarrow as pa

        for batch in batches:
            found = [nearest(v, a, centroids, tops) for v, a in chunks(batch, dims)]
            cluster = np.concatenate([c for c, _, _ in found]) if found else np.zeros(0, int)
            distance = [min(int(x), LONG) for _, d, _ in found for x in d]
            left = [n / len(c) for c, _, n in found for _ in c]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64()), pa.array(left, pa.float64())], ["_id", "cluster", "distance", "compared"])

    return table.select("_id", "v", "apex").mapInArrow(assign, f"_id {table.schema['_id'].dataType.simpleString()}, cluster int, distance long, compared double")


def clustered(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED, most_pivots: int = PIVOTS) -> tuple[DataFrame, list[list[int]]]:
    """(_id, cluster, distance, compared) of each vector with exactly `dims` sound components, and the final centroids.

    Vectors that are null, of another length or hold nulls, NaN or infinities are dropped. Components beyond LIMIT
    saturate, distances do so at the largest long. The first centroids go by the hash of the id; of equal ids the smaller
    vector comes first, null ids last. Repeated rows each count and have a row. With fewer vectors than clusters there are
    so many centroids; an empty table gives an empty result. Other columns are left out, whatever their names. Rounds end
    early where no centroid moves, as then none would move any more.
    """
    v = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("x")).filter(sound(F.col("x")) & (F.size("x") == dims)).select("_id", floors(F.col("x"), scale).alias("v"))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")).cast("binary"), 256)
    first = [r["v"] for r in v.orderBy(key.asc_nulls_last(), "v").limit(max(CANDIDATES, clusters)).collect()]
    if not first:
        return v.select("_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"), F.lit(None).cast("double").alias("compared")), []
    centroids, pivots = np.array(first[:clusters], object), simplex(np.array(first, object), most_pivots)
    table = written(projected(v, pivots, dims), "apexes")
    for _ in range(rounds):
        new = moved(table, pivots, centroids)
        if (new == centroids).all():
            break
        centroids = new
    return written(assigned(table, pivots, centroids), "clusters"), [[int(x) for x in c] for c in centroids]


def report(vectors: DataFrame, **how) -> DataFrame:
    """clustered() with the sums of distances by cluster and in all, and each centroid's hash; what meets on the driver is one row a cluster."""
    out, centroids = clustered(vectors, **how)
    if not centroids:
        return out.select("_id", "cluster", "distance", F.lit(None).cast("long").alias("cluster_inertia"), F.lit(None).cast("long").alias("inertia"), F.lit(None).cast("string").alias("centroid_sha256"), "compared")
    sums = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    own = F.array(*[F.lit(min(sums.get(c, 0), LONG)).cast("long") for c in range(len(centroids))])
    hashes = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids])
    return out.select("_id", "cluster", "distance", F.get(own, F.col("cluster")).alias("cluster_inertia"), F.lit(min(sum(sums.values()), LONG)).cast("long").alias("inertia"), F.get(hashes, F.col("cluster")).alias("centroid_sha256"), "compared")
