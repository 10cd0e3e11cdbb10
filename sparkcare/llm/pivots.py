"""Centroid clustering with a LAESA pivot table.

Vectors become whole numbers, floor(scale * x), and are stored once with their distances to
PIVOTS fixed pivots (the first centroids).  Each round measures only centroids against
pivots; a vector's distance to a centroid is at least the largest difference of their
pivot distances.  A vector first meets the centroid with the smallest such bound, exactly;
every centroid whose bound is not above that distance survives and is measured exactly, in
whole numbers, so ties go to the smaller number for certain.  A task sums its vectors by
cluster before the shuffle, so neither a hot vector nor a hot cluster meets in one task; the
driver gets one row per cluster and dimension.

Defined cases: a vector is kept if it has exactly ``dims`` components, none null, NaN or
infinite; a null id is hashed as the empty text; repeated ids and equal vectors are rows like
any other, and starting centroids with the same hash go by their components; fewer kept
vectors than ``clusters`` give as many centroids; no kept vector gives an empty result;
components stop at +-LARGEST and distances and inertia at the largest long; columns other than id and
vector aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

PIVOTS = 16
LARGEST = 10 ** 18
SMALL = 1 << 26     # below, squared distances of up to 64 dimensions fit in a long
LONG = (1 << 63) - 1
SLACK = 1e-9
BATCH = 4096


def kept_vectors(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """vec_id, v: the vectors that count, as longs."""
    x = F.transform(vectors[vec_col], lambda c: c.cast("double"))
    good = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform("x", lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("long"))
    return (vectors.select(vectors[id_col].alias("vec_id"), x.alias("x"))
            .where((F.size("x") == dims) & good).select("vec_id", whole.alias("v")))


def fit_for(*arrays: np.ndarray) -> np.ndarray:
    """Longs where squared distances fit, else Python's numbers without bound."""
    if all(not a.size or max(int(a.max()), -int(a.min())) < SMALL for a in arrays):
        return arrays if len(arrays) > 1 else arrays[0]
    exact = [a.astype(object) for a in arrays]
    return exact if len(exact) > 1 else exact[0]


def squared(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    points, centre = fit_for(points, centre)
    return ((points - centre) ** 2).sum(axis=1)


def pivot_table(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of points (rows) to pivots (columns)."""
    return np.stack([np.sqrt(squared(points, p).astype(np.float64)) for p in pivots], axis=1)


def assign(points: np.ndarray, to_pivots: np.ndarray, centres: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centre, and how many distances were measured."""
    of_centres = pivot_table(centres, pivots)
    bound = np.abs(to_pivots[:, None, :] - of_centres[None, :, :]).max(axis=2)
    bound -= SLACK * (1.0 + to_pivots.max(axis=1)[:, None] + of_centres.max(axis=1)[None, :])
    first = bound.argmin(axis=1)
    points, centres = fit_for(points, centres)
    best = ((points - centres[first]) ** 2).sum(axis=1)
    number, measured = first.astype(np.int64), len(points)
    survive = bound <= np.sqrt(best.astype(np.float64))[:, None]
    for c in range(len(centres)):
        at = np.flatnonzero(survive[:, c] & (first != c))
        if len(at):
            d = ((points[at] - centres[c]) ** 2).sum(axis=1)
            measured += len(at)
            nearer = (d < best[at]) | ((d == best[at]) & (c < number[at]))
            at, d = at[nearer.astype(bool)], d[nearer.astype(bool)]
            best[at], number[at] = d, c
    return number, best, measured


def _points(column: pa.ListArray, dims: int, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dims)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            yield batch.slice(at, BATCH)


def next_centres(table: DataFrame, centres: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The floor of each cluster's mean; empty clusters stay."""
    dims = centres.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centres), np.int64)
        total = np.zeros((len(centres), dims), object)
        for batch in _parts(batches):
            points = _points(batch.column("v"), dims)
            number, _, _ = assign(points, _points(batch.column("p"), len(pivots), np.float64), centres, pivots)
            points = fit_for(points)
            for c in np.unique(number):
                mine = points[number == c]
                count[c] += len(mine)
                total[c] += mine.sum(axis=0)
        held = np.flatnonzero(count)
        for c in held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * dims, pa.int32()), pa.array(range(dims), pa.int32()),
                 pa.array([str(t) for t in total[c]]), pa.array([count[c]] * dims, pa.int64())],
                ["cluster", "dim", "total", "n"])

    found = (table.mapInArrow(sums, "cluster int, dim int, total string, n long").groupBy("cluster", "dim")
             .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect())
    new = centres.copy()
    for r in found:  # clusters x dims rows
        new[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
    return new


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64,
                    clusters: int = 40, rounds: int = 5, scale: int = 256, seed: int = 2,
                    pivots: int = PIVOTS) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia,
    centroid_sha256 (of the components of its centroid) and centroid, the components."""
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, id_col, vec_col, dims, scale)
    kind = kept.schema["vec_id"].dataType.simpleString()
    seeds = (kept.withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256))
             .orderBy("hash", "v").limit(clusters).collect())  # ``clusters`` rows
    columns = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<bigint>"
    if not seeds:
        return spark.createDataFrame([], f"vec_id {kind}, {columns}")
    centres = np.array([r["v"] for r in seeds], np.int64)
    fixed = centres[:pivots]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            far = pivot_table(_points(batch.column("v"), dims), fixed)
            ends = pa.array(np.arange(0, far.size + 1, len(fixed), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(ends, pa.array(far.ravel()))], ["vec_id", "v", "p"])

    table = stored(kept.mapInArrow(measure, f"vec_id {kind}, v array<bigint>, p array<double>"))
    for _ in range(rounds):
        centres = next_centres(table, centres, fixed)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            number, best, _ = assign(_points(batch.column("v"), dims),
                                     _points(batch.column("p"), len(fixed), np.float64), centres, fixed)
            best = np.minimum(best, LONG).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(best)],
                                             ["vec_id", "cluster", "distance"])

    found = stored(table.mapInArrow(last, f"vec_id {kind}, cluster int, distance long"))
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # a row per cluster
    inertia = min(sum(sums.values()), LONG)
    of = spark.createDataFrame(
        [(c, min(s, LONG), inertia, hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest(),
          [int(x) for x in centres[c]]) for c, s in sorted(sums.items())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<bigint>")
    return found.join(F.broadcast(of), "cluster").select("vec_id", *(n.split()[0] for n in columns.split(", ")))
