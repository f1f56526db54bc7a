"""Operator 12 — k-means in exact integers, with a rotated filter in front of the distances.

*Vectors.*  Those with the right number of components, none null, NaN or infinite; a component x becomes the integer
floor(scale * x).  Centroids start as the vectors with the smallest hash of their id and stay integers: a round replaces each
non-empty one by floor(sum / count) of its vectors.  So every step is exact and a rerun gives the same clusters.

*Filter.*  The principal axes of the vectors (moments summed by Spark, the eigenvectors of one small matrix on
the driver) rotate the space; per vector the leading :data:`LEAD` coordinates and the norm of the rest are stored.  For a
centroid rotated the same way, the squared distance of the leading coordinates plus the squared difference of the
two remaining norms is never more than the squared distance.  The centroid with the smallest bound is measured first; only
centroids whose bound, less a margin for rounding (:data:`MARGIN` of the squared norms), does not exceed that distance
are measured too, in integers.  The rotation only decides what is skipped, so the order in which Spark adds up the moments cannot change a result.

*Work.*  Vectors stay where they lie: a round is one pass that sends one row of sums per task and centroid (64-bit sums; larger
numbers in limbs of :data:`LIMB` bits).  Only the centroids (k x dimensions) pass through the driver.

Defined cases: rows that are not kept get no row (a component whose multiple is beyond the doubles counts as infinite); several rows with one id are vectors of their own; a null id counts as the
empty text in the hash; equal distances go to the smaller number; with fewer vectors than centroids there are
as many centroids as vectors; no vector, no rows; components of any size are exact (above 2**27 in Python integers), a
distance or an inertia beyond 64 bits is null.  Other columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakemart.llm.common import map_arrow, materialize

K, ROUNDS, DIM, SCALE, SEED = 40, 5, 64, 256, 2
#: Leading rotated coordinates that are stored.
LEAD = 16
MARGIN = 1e-9
#: Components below this have distances that fit 64 bits.
_SMALL = 1 << 27
LIMB = 31
#: Whole numbers below this are doubles.
_DOUBLES = 1 << 1023


def kept(column: str, dim: int, scale: int) -> Column:
    bad = F.exists(F.col(column), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * scale) == float("inf")))
    return F.coalesce((F.size(column) == dim) & ~bad, F.lit(False))


def _integers(column: pa.Array, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) as whole doubles (scale is a power of two, so the product is exact)."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    with np.errstate(over="ignore"):
        return np.floor(x * scale)


def _moments(dim: int, scale: int):
    def run(batches):
        total, n = np.zeros((dim + 1, dim)), 0
        for b in batches:
            with np.errstate(all="ignore"):
                q = _integers(b.column(0), dim, scale)
                total[:dim] += q.T @ q
                total[dim] += q.sum(axis=0)
            n += len(q)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim + 1), pa.int32()), pa.array([float(n)] * (dim + 1)),
                                              pa.array(list(total), pa.list_(pa.float64()))], names=["i", "n", "row"])
    return run


def rotation(vectors: DataFrame, dim: int, scale: int) -> np.ndarray:
    """Principal axes (columns, most spread first); the identity where the moments are no finite numbers."""
    parts = map_arrow(vectors.select("embedding"), _moments(dim, scale), "i int, n double, row array<double>")
    sums = parts.groupBy("i").agg(F.sum("n"), *(F.sum(F.col("row")[j]) for j in range(dim))).collect()      # dim + 1 rows
    if not sums:
        return np.eye(dim)
    table = np.array([list(r)[2:] for r in sorted(sums)])
    with np.errstate(all="ignore"):
        n = sums[0][1]
        cov = table[:dim] / n - np.outer(table[dim], table[dim]) / n / n
    return np.linalg.eigh(cov)[1][:, ::-1] if np.isfinite(cov).all() else np.eye(dim)


def _rotate(dim: int, scale: int, axes: np.ndarray, lead: int):
    def run(batches):
        for b in batches:
            q = _integers(b.column(1), dim, scale)
            front, rest = _split(q, axes, lead)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(list(front), pa.list_(pa.float64())), pa.array(rest)],
                names=["vec_id", "embedding", "lead", "rest"])
    return run


def _split(q: np.ndarray, axes: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(all="ignore"):
        y = q @ axes
        return y[:, :lead], np.sqrt((y[:, lead:] ** 2).sum(axis=1))


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``q`` to ``c``; both 64-bit integers, or both Python integers."""
    d = q - c
    return (d * d).sum(axis=1)


class Nearest:
    """Nearest centroid and exact squared distance for batches of vectors."""

    def __init__(self, centroids: list[list[int]], axes: np.ndarray, lead: int):
        self.centroids = centroids
        self.big = any(abs(x) >= _SMALL for c in centroids for x in c)
        self.front, self.rest = _split(np.array([[float(x) for x in c] for c in centroids]), axes, lead)
        with np.errstate(all="ignore"):
            self.norm = (self.front ** 2).sum(axis=1) + self.rest ** 2

    def bounds(self, front: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances, less the margin; 0 where they are no finite numbers."""
        with np.errstate(all="ignore"):
            own = (front ** 2).sum(axis=1)[:, None]
            low = own + (self.front ** 2).sum(axis=1) - 2 * (front @ self.front.T) + (rest[:, None] - self.rest) ** 2
            low -= MARGIN * (own + rest[:, None] ** 2 + self.norm)
        return np.where(np.isfinite(low), low, 0)

    def search(self, q: np.ndarray, front: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = self.bounds(front, rest)
        big = np.full(len(q), self.big) | (np.abs(q) >= _SMALL).any(axis=1)
        cluster, distance = np.zeros(len(q), np.int64), np.zeros(len(q), object)
        for rows, kind in ((np.flatnonzero(~big), np.int64), (np.flatnonzero(big), object)):
            if len(rows):
                x = q[rows].astype(kind) if kind is np.int64 else np.array([[int(v) for v in r] for r in q[rows]], object)
                cluster[rows], distance[rows] = self._among(x, low[rows], np.array(self.centroids, kind))
        return cluster, distance

    @staticmethod
    def _among(x: np.ndarray, low: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best = low.argmin(axis=1)
        least = _exact(x, centroids[best])
        # a bound is a double: compare it with the distance rounded up
        limit = least.astype(np.float64) if least.dtype != object else np.array([float(d) if d < _DOUBLES else math.inf for d in least])
        open_ = low <= np.nextafter(limit, math.inf)[:, None]
        for c in range(len(centroids)):
            at = np.flatnonzero(open_[:, c] & (best != c))
            if len(at):
                d = _exact(x[at], centroids[c])
                better = (d < least[at]) | ((d == least[at]) & (c < best[at]))
                best[at[better]], least[at[better]] = c, d[better]
        return best, least


def _columns(batch: pa.RecordBatch, dim: int, scale: int, lead: int):
    front = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, lead)
    return _integers(batch.column(1), dim, scale), front, batch.column(3).to_numpy(zero_copy_only=False)


def _limbs(x: int) -> list[int]:
    """``x`` as a sum of limbs times powers of 2 ** LIMB; the last one carries the sign."""
    out = []
    while not -(1 << LIMB) <= x < 1 << LIMB:
        out.append(x & ((1 << LIMB) - 1))
        x >>= LIMB
    return out + [x]


def _sums(nearest: Nearest, dim: int, scale: int, lead: int):
    """Per task one row of sums for each centroid and limb."""
    def run(batches):
        k = len(nearest.centroids)
        small, n, large = np.zeros((k, dim), np.int64), np.zeros(k, np.int64), {}
        for b in batches:
            q, front, rest = _columns(b, dim, scale, lead)
            cluster, _ = nearest.search(q, front, rest)
            n += np.bincount(cluster, minlength=k)
            fits = (np.abs(q) < _SMALL).all(axis=1)
            np.add.at(small, cluster[fits], q[fits].astype(np.int64))
            for c, row in zip(cluster[~fits].tolist(), q[~fits]):
                for j, v in enumerate(row):
                    for i, limb in enumerate(_limbs(int(v))):
                        large.setdefault((c, i), [0] * dim)[j] += limb
        rows = [(c, 0, int(n[c]), small[c].tolist()) for c in range(k) if n[c]] + [(c, i, 0, v) for (c, i), v in large.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(
                (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))], names=["cluster", "limb", "n", "sums"])
    return run


def _assigned(nearest: Nearest, dim: int, scale: int, lead: int):
    def run(batches):
        for b in batches:
            cluster, distance = nearest.search(*_columns(b, dim, scale, lead))
            fits = [int(d) if d < 1 << 63 else None for d in distance]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster, pa.int32()), pa.array(fits, pa.int64())],
                                             names=["vec_id", "cluster", "distance"])
    return run


def first_centroids(vectors: DataFrame, k: int, seed: int, dim: int, scale: int) -> list[list[int]]:
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = vectors.select("vec_id", key.alias("key"), "embedding").orderBy("key", "embedding").limit(k).collect()      # k rows
    return [[math.floor(scale * float(x)) for x in r["embedding"]] for r in first]


def moved(centroids: list[list[int]], sums: Iterable) -> list[list[int]]:
    total, count = {}, {}
    for r in sums:
        count[r["cluster"]] = count.get(r["cluster"], 0) + r["n"]
        at = total.setdefault(r["cluster"], [0] * len(centroids[0]))
        for j in range(len(at)):
            at[j] += r[f"s{j}"] << (LIMB * r["limb"])
    return [[s // count[c] for s in total[c]] if count.get(c) else old for c, old in enumerate(centroids)]


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED,
            lead: int = LEAD) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id``, ``cluster``, ``distance`` (squared) of every kept row of ``vectors`` (``vec_id``, ``embedding``), and the centroids."""
    if scale < 1 or scale & (scale - 1) or not 0 < lead <= dim:
        raise ValueError("the scale must be a power of two, and the leading coordinates some of the dimensions")
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    item = vectors.schema["embedding"].dataType.simpleString()
    good = vectors.where(kept("embedding", dim, scale)).select("vec_id", "embedding")
    axes = rotation(good, dim, scale)
    rotated = materialize(map_arrow(good, _rotate(dim, scale, axes, lead), f"vec_id {id_type}, embedding {item}, lead array<double>, rest double"),
                          "rotated")
    centroids = first_centroids(rotated, k, seed, dim, scale)
    if not centroids:
        return rotated.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    for _ in range(rounds):
        parts = map_arrow(rotated, _sums(Nearest(centroids, axes, lead), dim, scale, lead), "cluster int, limb int, n long, sums array<long>")
        centroids = moved(centroids, parts.groupBy("cluster", "limb").agg(
            F.sum("n").alias("n"), *(F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(dim))).collect())     # k rows, times limbs
    out = map_arrow(rotated, _assigned(Nearest(centroids, axes, lead), dim, scale, lead), f"vec_id {id_type}, cluster int, distance long")
    return materialize(out, "clusters"), centroids


def with_inertia(clusters: DataFrame) -> DataFrame:
    """Add ``cluster_inertia`` and ``inertia``: distances summed over the row's cluster and over all rows."""
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    per = clusters.groupBy("cluster").agg(total.alias("one"))                     # one row per centroid
    whole = per.agg(F.sum("one")).first()[0]
    whole = F.lit(int(whole) if whole is not None and whole < 1 << 63 else None).cast("long")
    return (clusters.join(F.broadcast(per.select("cluster", F.col("one").try_cast("long").alias("cluster_inertia"))), "cluster")
            .withColumn("inertia", whole))
