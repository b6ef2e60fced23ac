"""Hard negatives and clustering against brute force, and the exactness of what they are made of."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from conftest import same_rows
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from starwash.llm import clusters, negatives, vectors

ROWS = "vec_id long, embedding array<float>, label int"


def plain_negatives(rows, every=100, positives=5, negatives=10, low=30, high=90, scale=256):
    usable = [
        (i, [math.floor(scale * x) for x in e], l) for i, e, l in rows
        if l is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    last = (1 << 63) - 1
    out, anchors = [], {(a, tuple(e), l): (a, e, l) for a, e, l in usable if a is not None and a % every == 0}
    for a, ea, la in anchors.values():
        scored = sorted(((-sum(x * y for x, y in zip(ea, e)), last if i is None else i, l) for i, e, l in usable))
        for p, i, _ in [s for s in scored if s[2] == la and s[1] != a][:positives]:
            window = [s for s in scored if s[2] != la and low * -p <= 100 * -s[0] <= high * -p][:negatives]
            for rank, (n, j, _) in enumerate(window, 1):
                out.append((a, None if i == last else i, rank, None if j == last else j, -p, -n))
    return out


def plain_clusters(rows, k=8, rounds=10, dims=64, scale=1024, seed=3):
    usable = [
        (i, [math.floor(scale * x) for x in e]) for i, e, *_ in rows
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)
    ]
    def name(v):
        return (v[0] is None, hashlib.sha256(f"{seed}:{v[0]}".encode()).hexdigest(), v[1])

    centroids = [v for _, v in sorted(usable, key=name)[:k]]

    def assigned():
        out = []
        for _, v in usable:
            out.append(min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centroids)))
        return out

    for _ in range(rounds):
        at = [c for _, c in assigned()]
        for n in range(len(centroids)):
            own = [v for (_, v), c in zip(usable, at) if c == n]
            if own:
                centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    ends = assigned()
    inertia = {n: sum(d for d, c in ends if c == n) for n in range(len(centroids))}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, d, inertia[c], sum(inertia.values()), names[c]) for (i, _), (d, c) in zip(usable, ends)]


@pytest.fixture(scope="module")
def given_rows(spark, small):
    return [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]


def dirty_rows(dims=64, n=150):
    """Small whole values, so that ties are frequent; a vector that a third of the rows share; every kind of gap."""
    rng = random.Random(5)
    rows = [(i, [rng.randint(-2, 2) / 4 for _ in range(dims)], rng.randint(0, 3)) for i in range(n)]
    rows += [(1000 + i, [0.5] * dims, i % 2) for i in range(n // 3)]
    whole = [0.25] * dims
    return rows + [
        rows[0], rows[0], rows[n - 10], (None, whole, 1), (None, whole, 2), (2000, None, 1), (2001, whole, None),
        (2002, [None] + whole[1:], 1), (2003, [math.nan] + whole[1:], 1), (2004, [math.inf] + whole[1:], 1),
        (2100, [], 1), (2200, [1.0, -1.0], 2), (2300, whole + [1.0], 1), (None, None, None),
    ]


def test_negatives_of_the_given_table(spark, given_rows):
    df = spark.createDataFrame(given_rows, ROWS)
    same_rows(negatives.mine_hard_negatives(df, F.col("label")).collect(), plain_negatives(given_rows))


@pytest.mark.parametrize("parts", [1, 7])
def test_negatives_with_ties_copies_and_gaps(spark, parts):
    rows = dirty_rows()
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    got = negatives.mine_hard_negatives(df, F.col("label"), every=50, parts=parts).collect()
    # The two rows without an id are equal in all columns that the result shows; ranks tell them apart.
    same_rows(got, plain_negatives(rows, every=50))


def test_many_anchor_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 4)
    monkeypatch.setattr(negatives, "ANCHOR_TILE", 3)
    monkeypatch.setattr(vectors, "BLOCK_VECTORS", 8)
    rows = dirty_rows(dims=5)
    got = negatives.mine_hard_negatives(spark.createDataFrame(rows, ROWS), F.col("label"), every=2, parts=3).collect()
    same_rows(got, plain_negatives(rows, every=2))


def test_negatives_of_an_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], ROWS)
    assert negatives.mine_hard_negatives(empty, F.col("label")).collect() == []
    rows = dirty_rows(n=60)
    names = ("anchor", "id", "score", "rank", "block", "group", "part", "data", "positive_id")
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("x") for c in names})
    same_rows(negatives.mine_hard_negatives(df, F.col("label"), every=10).collect(), plain_negatives(rows, every=10))


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 200), st.integers(0, 30), st.integers(0, 10**9))
def test_scores_are_exact(dims, bits, seed):
    rng = random.Random(seed)
    a, b = ([[rng.randint(-(1 << bits), 1 << bits) for _ in range(dims)] for _ in range(n)] for n in (3, 4))
    longest = max(sum(x * x for x in v) for v in a + b)
    if longest * vectors.ROUNDING >= 2**62:
        with pytest.raises(ValueError):
            negatives.primes_for(longest * vectors.ROUNDING)
        return
    primes = negatives.primes_for(longest * vectors.ROUNDING)
    x, y = (negatives.residues(np.array(m, dtype=np.float64), primes) for m in (a, b))
    assert negatives.scores(x, y, primes).astype(np.int64).tolist() == [[sum(p * q for p, q in zip(v, w)) for w in b] for v in a]


def test_unequal_lengths_count_zeros(spark):
    rows = [(0, [1.0, 1.0], 0), (1, [1.0], 0), (2, [0.5, 0.0, 9.0], 1), (3, [], 1)]
    got = negatives.mine_hard_negatives(spark.createDataFrame(rows, ROWS), F.col("label")).collect()
    same_rows(got, [(0, 1, 1, 2, 65536, 32768)])


def test_clusters_of_the_given_table(spark, given_rows):
    df = spark.createDataFrame(given_rows, ROWS)
    same_rows(clusters.cluster_vectors(df).collect(), plain_clusters(given_rows))


def test_clusters_with_ties_copies_and_gaps(spark):
    rows = dirty_rows(dims=6)
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("x") for c in ("block", "cluster", "n", "h", "v", "moved")})
    got = clusters.cluster_vectors(df.repartition(4), k=5, rounds=6, dims=6).collect()
    same_rows(got, plain_clusters(rows, k=5, rounds=6, dims=6))


def test_fewer_vectors_than_clusters(spark):
    rows = [(1, [0.5, 0.5], 0), (2, [0.25, -1.0], 0), (2, [0.25, -1.0], 0)]
    got = clusters.cluster_vectors(spark.createDataFrame(rows, ROWS), dims=2).collect()
    same_rows(got, plain_clusters(rows, dims=2))
    empty = clusters.cluster_vectors(spark.createDataFrame([], ROWS))
    assert empty.collect() == [] and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("scale,kind", [(1, np.float64), (2**17, np.int64)])
def test_bounds_never_change_the_nearest_centroid(scale, kind):
    """Against full distances over many random moves; and they spare most of them."""
    rng = np.random.default_rng(2)
    centers = rng.integers(-900, 900, (8, 16)) * scale
    x = (centers[rng.integers(0, 8, 3000)] + rng.integers(-120, 120, (3000, 16)) * scale).astype(kind)
    history = centers[None].astype(np.int64)
    squares = np.column_stack([clusters.squared(x, c) for c in history[0].astype(kind)])
    rounds, cluster, computed = np.zeros(squares.shape, np.int16), squares.argmin(axis=1).astype(np.int32), 0
    assert clusters.working_type(float(np.abs(x).max()), 16) is kind
    for _ in range(12):
        step = rng.integers(-25, 26, (1, 8, 16)) * scale
        history = np.concatenate([history, history[-1:] + step])
        cluster, n = clusters.nearest(x, cluster, squares, rounds, history.astype(kind))
        computed += n
        full = np.column_stack([clusters.squared(x, c) for c in history[-1].astype(kind)])
        assert (cluster == full.argmin(axis=1)).all()
    assert computed < 0.35 * 12 * squares.size


def test_distances_beyond_64_bits_are_refused(spark):
    rows = [(1, [1e30, 1.0], 0)]
    with pytest.raises(ValueError):
        clusters.cluster_vectors(spark.createDataFrame(rows, ROWS), dims=2)
