"""Centroid clustering over a vector approximation file (VA-file).

Vectors become integer components.  Next to its full form, each vector has an
approximation: ``BITS`` bits per dimension that name one of 16 cells, whose
limits are quantiles of that dimension.  For a set of centroids, lookup tables
hold the least and the greatest squared difference to any value in a cell, so a
few additions per centroid bound a vector's distance from below and above.  A
vector with one centroid whose upper bound lies below all other lower bounds is
assigned by its approximation alone; where intervals overlap (equal bounds
included, so that ties are decided exactly) the full vector is fetched.

A round needs the new sums of its clusters.  They are kept up to date from the
vectors that moved: each task finds the nearest centroid under the last and the
present centroids, both by the approximations, and fetches the full form only of
vectors that changed their cluster.  So a round is a pure function of the stored
table and of two sets of centroids; nothing is kept per vector, and a lost task
is simply run again.  Sums and counts are added up by Spark; the driver sees a
row per centroid and dimension.

Fetching means decoding: the full form is a binary column of the same Parquet
table, scanned along with the approximations; only wanted rows are turned into
numbers.  The first assignment (no last one) and the last (every distance is in
the result) fetch all.

Integer arithmetic throughout, so equal input gives equal results on any cluster.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged

SIZE = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SEED = 3
BITS = 4  # of a dimension's cell; two dimensions share a byte
CELLS = 1 << BITS
SAMPLE = 2048  # vectors, the first by hash, from which cell limits are taken; they change no result
REACH = 1 << 27  # components beyond this could overflow a 64-bit squared distance
ROWS = 4096  # vectors handled at a time


def integer_vectors(vectors: DataFrame, key: str, column: str, size: int, scale: int) -> DataFrame:
    """``vec_id, v array<long>`` of the vectors with exactly ``size`` components,
    all finite: each component ``floor(scale * x)``."""
    x = F.col("x").cast("array<double>")
    whole = F.size("x") == size
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(column).alias("x")).where(F.col("x").isNotNull() & whole).where(finite)
    v = F.transform(x, lambda e: F.floor(e * F.lit(float(scale))))
    return rows.select("vec_id", v.cast("array<long>").alias("v"))


def first_by_hash(vectors: DataFrame, n: int, seed: int) -> list:
    """The ``n`` vectors with the smallest lowercase-hex SHA-256 of ``seed:vec_id``
    (a null id is written ``null``), in that order; of one id the smaller components first."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    return [r["v"] for r in vectors.select(h.alias("h"), "v").orderBy("h", "v").limit(n).collect()]  # n is a constant


def cell_limits(sample: np.ndarray) -> np.ndarray:
    """``(size, CELLS - 1)`` ascending upper limits: cell ``c`` holds values in
    ``[limits[c - 1], limits[c])``, the outer cells are open."""
    return np.quantile(sample, np.arange(1, CELLS) / CELLS, axis=0, method="nearest").T.astype(np.int64)


def cells_of(v: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Cell numbers of ``v`` (rows, size), two to a byte."""
    c = np.stack([np.searchsorted(limits[d], v[:, d], side="right") for d in range(v.shape[1])], axis=1).astype(np.uint8)
    if c.shape[1] % 2:
        c = np.concatenate((c, np.zeros((len(c), 1), np.uint8)), axis=1)
    return c[:, ::2] << BITS | c[:, 1::2]


def interval_tables(centroids: np.ndarray, limits: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared difference to each centroid by byte of the
    approximation: two arrays ``(bytes, 256, centroids)``.  ``least`` and ``most``
    are the extremes of each dimension, which close the outer cells."""
    size = len(limits)
    low = np.concatenate((least[:, None], limits), axis=1)            # (size, CELLS), inclusive
    high = np.maximum(np.concatenate((limits - 1, most[:, None]), axis=1), low)
    c = centroids.T[:, None, :]                                      # (size, 1, k)
    under, over = low[:, :, None] - c, c - high[:, :, None]
    near = np.maximum(np.maximum(under, over), 0) ** 2
    far = np.maximum(np.abs(under), np.abs(over)) ** 2
    if size % 2:
        near, far = (np.concatenate((t, np.zeros((1, *t.shape[1:]), np.int64))) for t in (near, far))
    byte = np.arange(256)
    return tuple(t[::2][:, byte >> BITS] + t[1::2][:, byte & CELLS - 1] for t in (near, far))


def exact(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (of equal ones the smaller number) and its squared distance."""
    if not len(v):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    d = np.stack([((v - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(v)), best]


def bounds(cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds ``(rows, centroids)`` of the squared distances."""
    out = []
    for table in tables:
        total = table[0][cells[:, 0]]
        for b in range(1, cells.shape[1]):
            total += table[b][cells[:, b]]
        out.append(total)
    return out[0], out[1]


def nearest(cells: np.ndarray, tables, centroids: np.ndarray, fetch) -> tuple[np.ndarray, int]:
    """Nearest centroid of each row, and how many full vectors that took; ``fetch(rows)`` gives them."""
    low, high = bounds(cells, tables)
    best = high.argmin(axis=1)
    rows = np.arange(len(cells))
    rivals = low <= high[rows, best][:, None]
    open_ = np.flatnonzero(rivals.sum(axis=1) > 1)
    best[open_] = exact(fetch(open_), centroids)[0]
    return best, len(open_)


def parts_of(batch: pa.RecordBatch, size: int):
    """``cells, fetch`` of at most ``ROWS`` rows at a time."""
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        full = part.column(1)
        cells = np.frombuffer(b"".join(part.column(0).to_pylist()), np.uint8).reshape(part.num_rows, -1)

        def fetch(rows, full=full):
            wanted = full.take(pa.array(rows, pa.int32()))
            return np.frombuffer(b"".join(wanted.to_pylist()), "<i8").reshape(len(rows), size)
        yield part, cells, fetch


SUMS = "k int, d int, s long"


def round_sums(table: DataFrame, now: np.ndarray, last: np.ndarray | None, limits, least, most) -> tuple[dict, int]:
    """Changes of the sums (``d`` < size) and counts (``d`` = size) of each cluster
    from the assignment by ``last`` to that by ``now``, and the vectors fetched for it.

    ``last`` None: from no assignment, so every vector counts as moved."""
    size, k = now.shape[1], len(now)

    def run(batches):
        tables = [interval_tables(c, limits, least, most) for c in ((now,) if last is None else (now, last))]
        sums, fetched = np.zeros((k, size + 1), np.int64), 0
        for batch in batches:
            for _, cells, fetch in parts_of(batch, size):
                to, n = nearest(cells, tables[0], now, fetch)
                fetched += n
                if last is None:
                    moved, origin = np.arange(len(to)), None
                else:
                    was, n = nearest(cells, tables[1], last, fetch)
                    moved = np.flatnonzero(was != to)
                    origin = was[moved]
                    fetched += n
                v = fetch(moved)
                fetched += len(moved)
                v = np.concatenate((v, np.ones((len(v), 1), np.int64)), axis=1)
                np.add.at(sums, to[moved], v)
                if origin is not None:
                    np.subtract.at(sums, origin, v)
        i, d = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array([*i, -1], pa.int32()), pa.array([*d, -1], pa.int32()),
                                          pa.array([*sums[i, d], fetched], pa.int64())], names=["k", "d", "s"])

    found = table.select("cells", "full").mapInArrow(run, SUMS).groupBy("k", "d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    rows = {(r["k"], r["d"]): int(r["s"]) for r in found.collect()}  # a row per centroid and dimension
    return rows, rows.pop((-1, -1), 0)


def assigned(table: DataFrame, centroids: np.ndarray, limits, least, most) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector; the distances need all full forms."""
    size, id_type = centroids.shape[1], table.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part, _, fetch in parts_of(batch, size):
                best, d = exact(fetch(np.arange(part.num_rows)), centroids)
                yield pa.RecordBatch.from_arrays([part.column(2), pa.array(best, pa.int32()), pa.array(d, pa.int64())],
                                                 names=["vec_id", "cluster", "distance"])

    return table.select("cells", "full", "vec_id").mapInArrow(run, f"vec_id {id_type}, cluster int, distance long")


def approximated(ints: DataFrame, limits: np.ndarray) -> DataFrame:
    """``vec_id, cells, full``: the approximation and the components as little-endian longs."""
    id_type, size = ints.schema["vec_id"].dataType.simpleString(), len(limits)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                v = part.column(1).flatten().to_numpy().reshape(-1, size)
                cells = cells_of(v, limits)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([c.tobytes() for c in cells], pa.binary()),
                                                  pa.array([x.tobytes() for x in v.astype("<i8")], pa.binary())], names=["vec_id", "cells", "full"])

    return staged(ints.mapInArrow(run, f"vec_id {id_type}, cells binary, full binary"), "approximations")


def cluster(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", size: int = SIZE, scale: int = SCALE,
            centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, report: list | None = None) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid array<long>`` of
    every kept vector: exactly ``size`` components, none null or non-finite.

    The start is the first ``centroids`` kept vectors by hash (all, if there are
    fewer).  Each round assigns every vector to the nearest centroid (squared
    Euclidean distance, of equal ones the smaller number) and replaces each that
    has vectors by their componentwise ``floor(sum / count)``; an empty one
    stays.  A last assignment follows.  Null ids are ids like any others and
    repeated rows count each.  Components whose integer is 2 ** 27 or beyond raise
    an error, as a distance might not fit 64 bits.  Without a kept vector the
    result is empty; other columns are not read.  ``report`` gets the full
    vectors fetched in each round.
    """
    ints = staged(integer_vectors(vectors, key, column, size, scale), "integers")
    ends = ints.agg(F.count("*").alias("n"), *[f(F.get("v", F.lit(d))).alias(f"{n}{d}") for n, f in (("a", F.min), ("b", F.max)) for d in range(size)]).first()
    least, most = (np.array([ends[f"{n}{d}"] or 0 for d in range(size)], object) for n in "ab")
    if ends["n"] and max(-least.min(), most.max()) >= REACH:
        raise ValueError(f"components of {REACH} or more: a squared distance may not fit 64 bits")
    least, most = least.astype(np.int64), most.astype(np.int64)
    sample = np.array(first_by_hash(ints, max(SAMPLE, centroids), seed), np.int64).reshape(-1, size)
    now = sample[:centroids]
    if not len(now):
        now = np.zeros((1, size), np.int64)  # of an empty table; no row refers to it
    limits = cell_limits(sample) if len(sample) else np.zeros((size, CELLS - 1), np.int64)
    table = approximated(ints, limits)

    sums, last = np.zeros((len(now), size + 1), object), None
    for _ in range(rounds):
        change, fetched = round_sums(table, now, last, limits, least, most)
        for (k, d), s in change.items():
            sums[k, d] += s
        if report is not None:
            report.append(fetched)
        means = [[int(x) // int(row[size]) for x in row[:size]] if row[size] else now[i] for i, row in enumerate(sums)]
        last, now = now, np.array(means, np.int64)
        if (last == now).all():
            break  # every later round would change nothing
    final = staged(assigned(table, now, limits, least, most), "assigned")
    own = {r["cluster"]: int(r["s"]) for r in final.groupBy("cluster").agg(  # a row per centroid
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    clusters = [(i, own.get(i, 0), sum(own.values()), [int(x) for x in c]) for i, c in enumerate(now)]
    per = ints.sparkSession.createDataFrame(clusters, "_cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return final.join(F.broadcast(per), F.col("cluster") == F.col("_cluster")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digest(centroid):
    """Lowercase hex SHA-256 of a centroid's components, as decimal integers joined by commas."""
    return F.sha2(F.array_join(centroid.cast("array<string>"), ","), 256)

