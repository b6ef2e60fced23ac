"""Lloyd's clustering in whole numbers, with bounds that spare most distances.

For each vector and centroid the last distance that was computed is kept, with the round it belongs to. The
centroids of all rounds are at hand, so a stored distance bounds today's one from below and above by the length of
the whole way from the centroid of that round to today's: the norm of the sum of its moves, which is at most the
sum of their norms. Where the bounds cannot tell which centroid is nearest, the distances are computed again,
exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starwash.llm.vectors import PACKED, PACKED_ARROW, Block, as_dicts, named, pack
from starwash.sources.staging import discard, staged_path

STATE = f"{PACKED}, cluster binary, squares binary, rounds binary, moved array<long>, evaluated long"
STATE_ARROW = pa.schema([
    *PACKED_ARROW, ("cluster", pa.binary()), ("squares", pa.binary()), ("rounds", pa.binary()),
    ("moved", pa.list_(pa.int64())), ("evaluated", pa.int64()),
])
SLACK = 1e-9
OUTPUT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances; the type of ``x`` holds them (see ``working_type``)."""
    gap = x - centroid
    return np.einsum("ij,ij->i", gap, gap).astype(np.int64)


def working_type(largest: float, dims: int) -> type:
    """Floats where every sum of squares is below 2^53, else 64-bit integers; a ValueError beyond those."""
    most = dims * (2 * largest) ** 2
    if most >= 2**62:
        raise ValueError("squared distances of these vectors do not fit 64 bits")
    return np.float64 if most < 2**53 else np.int64


def nearest(
    x: np.ndarray, cluster: np.ndarray, squares: np.ndarray, rounds: np.ndarray, history: np.ndarray
) -> tuple[np.ndarray, int]:
    """(new cluster of every vector, number of distances computed) for the last centroids of ``history``.

    ``squares`` and ``rounds`` (vector, centroid) are what was computed last and when; both are updated in place.
    Equally near: the smaller number. A pair is skipped only if its lower bound is above the vector's upper bound
    by more than rounding can change, so skipped centroids are truly farther.
    """
    now, k = len(history) - 1, history.shape[1]
    way = np.sqrt(((history - history[now]).astype(np.float64) ** 2).sum(axis=2))  # (round, centroid)
    rows = np.arange(len(x))
    lower = np.sqrt(squares) - way[rounds, np.arange(k)]
    upper = np.sqrt(squares[rows, cluster]) + way[rounds[rows, cluster], cluster]

    def unsure(lower: np.ndarray, upper: np.ndarray, own: np.ndarray) -> np.ndarray:
        out = lower * (1 - SLACK) <= (upper * (1 + SLACK) + SLACK)[:, None]
        out[np.arange(len(own)), own] = False
        return out

    check = np.flatnonzero(unsure(lower, upper, cluster).any(axis=1))
    computed = 0
    for c in range(k):  # first the own centroid: its distance often settles the vector
        own = check[cluster[check] == c]
        squares[own, c], rounds[own, c] = squared(x[own], history[now, c]), now
        computed += len(own)
    own = cluster[check]
    rescan = unsure(lower[check], np.sqrt(squares[check, own]), own)
    for c in range(k):
        failed = check[rescan[:, c]]
        squares[failed, c], rounds[failed, c] = squared(x[failed], history[now, c]), now
        computed += len(failed)
    new = cluster.copy()
    known = np.where(rounds[check] == now, squares[check], np.iinfo(np.int64).max)
    new[check] = known.argmin(axis=1)
    return new, computed


def _moves(x: np.ndarray, old: np.ndarray, new: np.ndarray, k: int) -> np.ndarray:
    """What the sums (k x components) and counts (k) of the clusters gain, flat."""
    x = x.astype(np.int64)
    out = np.zeros((k, x.shape[1] + 1), np.int64)
    for c in range(k):
        enters, leaves = (new == c) & (old != c), (old == c) & (new != c)
        out[c, :-1] = x[enters].sum(axis=0) - x[leaves].sum(axis=0)
        out[c, -1] = enters.sum() - leaves.sum()
    return out.ravel()


def _assigned(blocks: DataFrame, history: np.ndarray, kind: type) -> DataFrame:
    """Rows of STATE after one more assignment. ``blocks`` has PACKED columns before the first, STATE after."""
    now, k = len(history) - 1, history.shape[1]

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in as_dicts(tables):
            x = Block.read(row).x.astype(kind)
            if now == 0:
                squares = np.column_stack([squared(x, c) for c in history[0].astype(kind)])
                rounds = np.zeros(squares.shape, np.int16)
                old, new, computed = np.full(len(x), -1, np.int32), squares.argmin(axis=1).astype(np.int32), squares.size
            else:
                squares = np.frombuffer(row["squares"], "<i8").reshape(-1, k).copy()
                rounds = np.frombuffer(row["rounds"], "<i2").reshape(-1, k).copy()
                old = np.frombuffer(row["cluster"], "<i4")
                new, computed = nearest(x, old, squares, rounds, history.astype(kind))
            yield pa.RecordBatch.from_pylist([{
                **row, "cluster": new.astype("<i4").tobytes(), "squares": squares.astype("<i8").tobytes(),
                "rounds": rounds.astype("<i2").tobytes(), "moved": _moves(x, old, new, k), "evaluated": computed,
            }], STATE_ARROW)

    return blocks.mapInArrow(run, STATE)


def _ends(state: DataFrame, history: np.ndarray, kind: type) -> DataFrame:
    """``vec_id, cluster, distance`` of the last assignment, distances exact."""
    now, k = len(history) - 1, history.shape[1]

    def run(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in as_dicts(tables):
            block, cluster = Block.read(row), np.frombuffer(row["cluster"], "<i4")
            own = np.arange(len(cluster)), cluster
            distance = np.frombuffer(row["squares"], "<i8").reshape(-1, k)[own].copy()
            stale = np.frombuffer(row["rounds"], "<i2").reshape(-1, k)[own] != now
            for c in range(k):
                late = np.flatnonzero(stale & (cluster == c))
                distance[late] = squared(block.x[late].astype(kind), history[now, c].astype(kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.ids), pa.array(cluster), pa.array(distance)], names=["vec_id", "cluster", "distance"]
            )

    return state.mapInArrow(run, "vec_id long, cluster int, distance long")


def _usable(vector: Column, scale: float, dims: int) -> Column:
    whole = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * scale) < float("inf")))
    return F.coalesce((F.size(vector) == dims) & whole, F.lit(False))


def starts(df: DataFrame, k: int, dims: int, scale: float, seed: int) -> np.ndarray:
    """The ``k`` usable vectors whose id has the smallest hash (all, if fewer); ``k`` rows reach the driver."""
    vector = F.col("embedding").cast("array<double>")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    usable = df.select(name.alias("h"), vector.alias("v")).filter(_usable(F.col("v"), scale, dims))
    rows = usable.orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return np.floor(np.array([r.v for r in rows], dtype=np.float64).reshape(-1, dims) * scale)


def _write(df: DataFrame, spark: SparkSession) -> tuple[DataFrame, str]:
    path = staged_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def cluster_vectors(
    df: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: float = 1024, seed: int = 3
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable row (vec_id, embedding).

    Usable are vectors of ``dims`` components, none null or non-finite; components become floor(scale * x). The first
    centroids are the ``k`` vectors with the smallest sha256 of ``seed:vec_id`` (equal ones: the smaller vector).
    Each round assigns every vector to the nearest centroid, the smaller number if equally near, and moves centroids
    with vectors to floor(sum / count); then all are assigned once more. Rounds after one in which no centroid moved
    would change nothing and are not run.

    A row without an id counts, and becomes a first centroid only when there are too few others. Repeated rows count each; with fewer vectors than ``k`` there are as many
    clusters; without any the result is empty; other columns are left out. A ValueError is raised where squared
    distances do not fit 64 bits. A round reads and writes the blocks with their bounds once and shuffles only sums;
    a lost executor costs its blocks of the running round. k x dims sums and k centroids reach the driver.
    """
    spark = df.sparkSession
    first = starts(df, k, dims, scale, seed)
    if not len(first):
        return spark.createDataFrame([], OUTPUT)
    packed = pack(df, F.col("vec_id"), F.lit(0), F.col("embedding"), scale, dims)
    kind = working_type(packed.agg(F.max("largest")).first()[0], dims)
    k = len(first)
    history, sums = first[None].astype(np.int64), [0] * (k * (dims + 1))
    state, path = packed, None
    for turn in range(rounds + 1):
        old = path
        state, path = _write(_assigned(state, history, kind), spark)
        if old:
            discard(spark, old)
        if turn == rounds:
            break
        gained = state.select(F.posexplode("moved").alias("at", "gain")).groupBy("at")
        for at, gain in gained.agg(F.sum(F.col("gain").cast("decimal(38,0)"))).collect():  # k x (dims + 1) rows
            sums[at] += int(gain)
        centroids = history[-1].copy()
        for c in range(k):
            *total, count = sums[c * (dims + 1) : (c + 1) * (dims + 1)]
            if count:
                centroids[c] = [s // count for s in total]
        if (centroids == history[-1]).all():
            break
        history = np.concatenate([history, centroids[None]])
    ends, ends_path = _write(_ends(state, history, kind), spark)
    discard(spark, path)
    found = ends.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()  # k rows
    inertia = {c: int(s) for c, s in found}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in history[-1].tolist()]

    def of_cluster(values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)

    return ends.select(
        named("vec_id"), "cluster", "distance",
        of_cluster([inertia.get(c, 0) for c in range(k)]).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        of_cluster(names).alias("centroid_sha256"),
    )
