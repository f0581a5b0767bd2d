"""Centroid clustering: Lloyd's rounds with exact results, most distances of which are never computed.

Each vector carries its centroid, an upper bound of the distance to it and a lower bound of the distance to all others.
When centroids move, the upper bound grows by the drift of its own. The lower bound is loosened by less than the others' full
drift: all members of cluster i lie in a sphere around its old centroid, and for a centroid that moves from p to q by d, a point
at angle t off the direction of the move, seen from the middle m of p and q, comes nearer by d * cos(t) at most, since
(|x-p|^2 - |x-q|^2) = 2 d |x-m| cos(t) and |x-p| + |x-q| >= 2 |x-m|. In the plane of p, q and the sphere's centre, the smallest
t of the sphere is the centre's angle less the arc sine of radius / distance. A sphere wholly behind m even tightens the bound. Vectors
whose bounds do not settle them are compared with all centroids in integers; so are ties.

A round writes the vectors with their bounds to the shared folder, then sums what changed its cluster; the driver sees a
row for each cluster. Sums are exact, so results do not depend on partitions, their order or repeated tasks.

Defined cases: vectors that are null, have another number of components, or a null or non-finite one take no part; repeated
rows each count and return; a null vec_id takes part as any other, but comes last as a starting centroid; with fewer vectors than
centroids there are as many centroids as vectors; an empty table gives no rows; extra columns are ignored. Squared distances must fit in
a long: components within 2 ** 27 of each other after scaling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialize, table

STATE = "vec_id long, v array<long>, was int, cluster int, upper double, lower double"
#: Relative slack of bounds against rounding of floating-point numbers.
SLACK = 1e-9


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int | None = None, scale: int = 1024, keep: list[Column] = ()) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component, of whole and finite vectors; ``keep`` has further columns."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    wanted = rows.where(F.col(vector_col).isNotNull() & finite)
    if dims is not None:
        wanted = wanted.where(F.size(vector_col) == dims)
    return wanted.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("v"), *keep)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def starting_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The k vectors of smallest SHA-256 of ``salt`` and id, in that order."""
    digest = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = vectors.select("v", "vec_id", digest.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(k)
    return np.array([r.v for r in first.collect()], np.int64)


def loosening(old: np.ndarray, new: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """For each cluster, by how much a member's distance to any other centroid can have shrunk at most (below zero: it grew)."""
    k = len(old)
    most = np.full(k, -np.inf)
    for j in range(k):
        p, q = old[j].astype(float), new[j].astype(float)
        d, mid = np.linalg.norm(q - p), (p + q) / 2
        for i in range(k):
            if i == j:
                continue
            away = old[i] - mid
            far = np.linalg.norm(away)
            if d == 0:
                nearer = 0.0
            elif far <= radii[i] * (1 + SLACK):
                nearer = d
            else:
                t = np.arccos(np.clip(away @ (q - p) / (far * d), -1, 1)) - np.arcsin(min(1.0, radii[i] * (1 + SLACK) / far))
                nearer = d * np.cos(max(t, 0.0))
                if nearer < 0:  # |x-p| + |x-q| is at most this
                    least = far - radii[i] * (1 + SLACK)
                    nearer *= least / np.hypot(least, d / 2)
            most[i] = max(most[i], nearer + SLACK * (1 + d))
    return most if k > 1 else np.zeros(k)


def scan(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest, squared distance, squared distance of the next one as a float) in integers; ties go to the smaller number."""
    d = np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    near = d.argmin(axis=1)
    rows = np.arange(len(x))
    first = d[rows, near]
    other = d.astype(float)
    other[rows, near] = np.inf
    return near, first, other.min(axis=1)


def _assign(old: np.ndarray, new: np.ndarray, radii: np.ndarray):
    """The task of one round: bounds moved to ``new``, unsettled vectors scanned."""
    dims, drift, loose = new.shape[1], np.linalg.norm((new - old).astype(float), axis=1), loosening(old, new, radii)
    gaps = np.linalg.norm((new[:, None] - new[None]).astype(float), axis=2) + np.diag([np.inf] * len(new))
    half = gaps.min(axis=1) / 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column(1), dims)
            a = b.column(3).to_numpy(zero_copy_only=False).copy()
            was, upper, lower = a.copy(), b.column(4).to_numpy(zero_copy_only=False).copy(), b.column(5).to_numpy(zero_copy_only=False).copy()
            known = a >= 0
            upper[known] += drift[a[known]]
            lower[known] -= loose[a[known]]
            open_ = ~known
            open_[known] = upper[known] * (1 + SLACK) >= np.maximum(half[a[known]], lower[known]) * (1 - SLACK)
            tight = np.flatnonzero(open_ & known)
            upper[tight] = np.sqrt(((x[tight] - new[a[tight]]) ** 2).sum(axis=1))
            open_[tight] = upper[tight] * (1 + SLACK) >= np.maximum(half[a[tight]], lower[tight]) * (1 - SLACK)
            left = np.flatnonzero(open_)
            if len(left):
                near, first, other = scan(x[left], new)
                a[left], upper[left], lower[left] = near, np.sqrt(first), np.sqrt(other)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(was, pa.int32()), pa.array(a, pa.int32()), pa.array(upper), pa.array(lower)], names=["vec_id", "v", "was", "cluster", "upper", "lower"])

    return run


def _changes(k: int, dims: int):
    """Per task and cluster: vectors and component sums that came less those that left, and the largest upper bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, radius = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), np.full(k, -1.0)
        for b in batches:
            x = matrix(b.column(0), dims)
            was, now = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            np.maximum.at(radius, now, b.column(3).to_numpy(zero_copy_only=False))
            moved = was != now
            for side, sign in ((now, 1), (was, -1)):
                mine = moved & (side >= 0)
                n += sign * np.bincount(side[mine], minlength=k)
                for c in np.unique(side[mine]):
                    sums[c] += sign * x[mine & (side == c)].sum(axis=0)
        values = pa.ListArray.from_arrays(pa.array(np.arange(k + 1) * dims, pa.int32()), pa.array(sums.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k), pa.int32()), pa.array(n), pa.array(radius), values], names=["cluster", "n", "radius", "sums"])

    return run


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, salt: str = "3:") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, v, cluster), centroids) of (vec_id, v), all of one length, after ``rounds`` updates and a last assignment."""
    vectors = materialize(vectors.select("vec_id", "v"))
    new = starting_centroids(vectors, k, salt)
    state = vectors.select("vec_id", "v", F.lit(-1).alias("was"), F.lit(-1).alias("cluster"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"))
    if not len(new):
        return state.select("vec_id", "v", "cluster"), new
    k, dims = new.shape
    old, radii = new, np.zeros(k)
    counts, totals = [0] * k, [[0] * dims for _ in range(k)]
    for n in range(rounds + 1):
        before, state = state, materialize(state.mapInArrow(_assign(old, new, radii), STATE))
        discard(before)
        if n == rounds:
            break
        each = state.select("v", "was", "cluster", "upper").mapInArrow(_changes(k, dims), "cluster int, n long, radius double, sums array<long>")
        by_part = each.select("cluster", "n", "radius", F.posexplode("sums").alias("i", "s"))
        whole = by_part.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        for r in whole.collect():  # a row for each cluster and component
            totals[r.cluster][r.i] += int(r.s)
            counts[r.cluster] += r.n if r.i == 0 else 0
            radii[r.cluster] = max(0.0, r.radius)
        old, new = new, np.array([[t // c for t in sums] if c else new[i] for i, (c, sums) in enumerate(zip(counts, totals, strict=True))], np.int64)
    return state.select("vec_id", "v", "cluster"), new


def clusters(vectors: DataFrame, **options) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector."""
    spark = vectors.sparkSession
    assigned, centroids = cluster(vectors, **options)
    schema = "cluster int, centroid array<long>, centroid_sha256 string"
    texts = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    named = spark.createDataFrame([(i, c, h) for i, (c, h) in enumerate(zip(centroids.tolist(), texts, strict=True))], schema)
    gap = F.aggregate(F.zip_with("v", "centroid", lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"), lambda s, x: s + x)
    each = assigned.join(F.broadcast(named), "cluster").select("vec_id", "cluster", gap.alias("distance"), "centroid_sha256")  # k rows
    sums = each.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows
    of = spark.createDataFrame([(r.cluster, r.cluster_inertia, sum(x.cluster_inertia for x in sums)) for r in sums], "cluster int, cluster_inertia long, inertia long")
    return each.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(integer_vectors(table(spark, sf_dir, "embeddings"), dims=64, scale=1024), k=8, rounds=10, salt="3:")


def _op13_sql(rounds: int = 10) -> str:
    gap = "CAST(list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS BIGINT)"
    parts = [
        "v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings "
        "WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), v) - 1 AS k, v AS c FROM v QUALIFY k < 8)",
    ]
    for n in range(rounds + 1):
        parts.append(f"a{n} AS MATERIALIZED (SELECT rid, any_value(v) AS v, any_value(vec_id) AS vec_id, min({gap} * 8 + k) AS m FROM v, c{n} GROUP BY rid)")
        if n < rounds:
            parts.append(f"s{n} AS MATERIALIZED (SELECT m % 8 AS k, i, sum(v[i]) AS s, count(*) AS n FROM a{n}, range(1, 65) t(i) GROUP BY ALL)")
            parts.append(f"c{n + 1} AS MATERIALIZED (SELECT c{n}.k, coalesce(any_value(x.c), any_value(c{n}.c)) AS c FROM c{n} LEFT JOIN (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{n} GROUP BY k) x USING (k) GROUP BY c{n}.k)")
    return (
        "WITH " + ",\n".join(parts) + f" SELECT vec_id, CAST(m % 8 AS INTEGER) AS cluster, CAST(m // 8 AS BIGINT) AS distance, CAST(sum(m // 8) OVER (PARTITION BY m % 8) AS BIGINT) AS cluster_inertia, "
        f"CAST(sum(m // 8) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} ON k = m % 8"
    )


OP13_SQL = _op13_sql()
