"""Byte, word and SimHash deduplication against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import xxhash
from conftest import same_rows
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from starwash.llm import batches, simhash, substring, suffixes
from starwash.llm.hashing import Windows, mixed

LAST = 1 << 62


def brute(rows, parts_of, length, joined):
    """Expected (doc_id, size, removed, spans, digest) when equal ids are not earlier than each other."""
    found = {}
    docs = [(LAST if i is None else i, i, parts_of(t)) for i, t in rows]
    for at, _, parts in docs:
        for j in range(len(parts) - length + 1):
            key = tuple(parts[j : j + length])
            found[key] = min(found.get(key, LAST), at)
    out = []
    for at, i, parts in docs:
        gone, own = [False] * len(parts), set()
        for j in range(len(parts) - length + 1):
            key = tuple(parts[j : j + length])
            if found[key] < at or key in own:
                gone[j : j + length] = [True] * length
            own.add(key)
        spans = sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))
        kept = joined([p for p, g in zip(parts, gone) if not g])
        out.append((i, len(parts), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def words(text):
    return (text or "").encode().split()


def by_bytes(text):
    return list((text or "").encode())


def repetitive(seed, n=60):
    """Short texts from few pieces, so that repeats overlap, nest and cross in every way."""
    rng = random.Random(seed)
    pieces = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(2, 30))) for _ in range(12)]
    return [(i, " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 8)))) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_words_equal_brute_force(make, seed):
    rows = repetitive(seed)
    got = substring.remove_repeated_words(make(rows, "doc_id long, text string")).collect()
    same_rows(got, brute(rows, words, 20, b" ".join))


@pytest.mark.parametrize("seed", [3, 4])
def test_bytes_equal_brute_force(make, seed):
    rows = repetitive(seed)
    got = suffixes.remove_repeated_bytes(make(rows, "doc_id long, text string")).collect()
    same_rows(got, brute(rows, by_bytes, 100, bytes))


def test_blocks_of_equal_name_are_told_apart_by_their_check(make, monkeypatch):
    """All blocks get the same name; documents share 90 bytes, which is no repeat, and two of them 300."""
    class Colliding(suffixes.Suffixes):
        def __init__(self, *args):
            super().__init__(*args)
            self.block = np.zeros_like(self.block)

    rng = random.Random(9)
    new = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    short, long = new(90), new(300)
    rows = [(i, new(200) + short + new(200) + (long if i > 1 else "") + new(50)) for i in range(4)]
    monkeypatch.setattr(suffixes, "Suffixes", Colliding)
    monkeypatch.setattr(batches, "BATCH_BYTES", 1)  # a batch for each document
    got = suffixes.remove_repeated_bytes(make(rows, "doc_id long, text string")).collect()
    same_rows(got, brute(rows, by_bytes, 100, bytes))


def test_small_batches_give_the_same(make, monkeypatch):
    rows = repetitive(5)
    docs = make(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(batches, "BATCH_BYTES", 300)
    monkeypatch.setattr(suffixes, "SEGMENT", 128)
    monkeypatch.setattr(substring, "SEGMENT", 64)
    same_rows(suffixes.remove_repeated_bytes(docs).collect(), brute(rows, by_bytes, 100, bytes))
    same_rows(substring.remove_repeated_words(docs).collect(), brute(rows, words, 20, b" ".join))


def test_dirty_rows(make, dirty_docs):
    rows = [(r[0], r[1]) for r in dirty_docs]
    same_rows(substring.remove_repeated_words(make(dirty_docs)).collect(), brute(rows, words, 20, b" ".join))
    same_rows(suffixes.remove_repeated_bytes(make(dirty_docs)).collect(), brute(rows, by_bytes, 100, bytes))


def test_empty_tables(make):
    assert substring.remove_repeated_words(make([])).collect() == []
    assert suffixes.remove_repeated_bytes(make([])).collect() == []
    assert simhash.near_duplicates(make([])).collect() == []
    assert simhash.keep_one_of_each(make([])).collect() == []


@given(st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=300), st.integers(1, 40))
@settings(max_examples=60, deadline=None)
def test_keys_survive_packing(keys, parts):
    keys = np.array(sorted(keys), dtype=np.uint64)
    begin, back = 0, []
    for part, end in enumerate(batches.split(keys, parts).tolist()):
        own = keys[begin:end]
        assert all(int(k) * parts >> 64 == part for k in own)
        back.append(batches.unpacked_keys(batches.packed_keys(own)))
        begin = end
    assert np.array_equal(np.concatenate(back), keys)


def test_equal_windows_have_equal_hashes():
    rng = np.random.default_rng(1)
    values = mixed(rng.integers(0, 3, 5000).astype(np.uint64))
    w, n = Windows(values), 6
    by_content = {}
    for i, h in enumerate(w.all(n).tolist()):
        by_content.setdefault(values[i : i + n].tobytes(), set()).add(h)
    assert all(len(h) == 1 for h in by_content.values())
    assert len({h for s in by_content.values() for h in s}) == len(by_content)


# --- SimHash -----------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    ws = [w for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {n: find(n) for n in nodes}


def test_fingerprints_and_groups(make, dirty_docs):
    got = simhash.near_duplicates(make(dirty_docs)).collect()
    prints = [(r[0], plain_fingerprint(r[1])) for r in dirty_docs]
    values = sorted({p for _, p in prints})
    edges = [(a, b) for a in values for b in values if a < b and bin(a ^ b).count("1") <= 2]
    root = roots(values, edges)
    names = {}
    for i, p in prints:
        if i is not None:
            names[root[p]] = min(names.get(root[p], LAST), i)
    same_rows(got, [(i, f"{p:016x}", names.get(root[p])) for i, p in prints])
    kept = simhash.keep_one_of_each(make(dirty_docs)).collect()
    assert len(kept) == len(set(root.values()))
    assert {root[plain_fingerprint(r.text)] for r in kept} == set(root.values())
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_every_link_is_found(spark, bits):
    rng = random.Random(bits)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values):
        for _ in range(6):
            for _ in range(rng.randint(1, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {tuple(sorted(r)) for r in simhash.linked(spark.createDataFrame([(v,) for v in signed], "fp long"), bits).collect()}
    expected = {
        (a, b) for a in signed for b in signed
        if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= bits
    }
    assert got == expected


def test_few_but_neighbours_meet(spark):
    """Of random values none meet; chains of near ones meet about as often as they link."""
    rng = random.Random(12)
    values = {rng.getrandbits(64) for _ in range(20_000)}
    far = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")

    def meetings(df):
        cells = simhash._with_neighbours(df.select("fp", simhash.segment_counts(F.col("fp")).alias("cell")))
        per_cell = cells.groupBy("cell").agg(F.count("*").alias("n"))
        return per_cell.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0]

    assert meetings(far) <= 5  # 2e8 pairs
    near = set()
    for v in list(values)[:300]:
        for _ in range(10):
            v ^= 1 << rng.randrange(64)
            near.add(v - (1 << 64) if v >> 63 else v)
    df = spark.createDataFrame([(v,) for v in near], "fp long")
    # A pair within two bits meets in its own cells, in those around and in those between.
    assert meetings(df) <= 60 * simhash.linked(df).count()


def test_segment_counts_are_the_bits_of_each_pair(spark):
    rng = random.Random(3)
    values = [0, -1, 1 << 62, -(1 << 63), *[rng.getrandbits(64) - (1 << 63) for _ in range(50)]]
    df = spark.createDataFrame([(v,) for v in values], "fp long").select("fp", simhash.segment_counts(F.col("fp")).alias("c"))
    for fp, c in df.collect():
        assert all((fp >> 2 * s & 3).bit_count() == c >> 2 * s & 3 for s in range(32))


def test_batches_leave_no_table_and_one_file_for_each_task(spark, make):
    before = {t.name for t in spark.catalog.listTables()}
    docs = make([(i, f"text {i} " * 50) for i in range(200)], "doc_id long, text string").repartition(6)
    packed = batches.pack(docs)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert len(packed.inputFiles()) <= 6 and packed.agg(F.sum("n_bytes")).first()[0] == sum(len(f"text {i} " * 50) for i in range(200))
    answers = packed.select(F.col("batch").alias("_of"), F.shiftright("batch", 32).alias("_task"))
    own = (F.col("task") == F.col("_task")) & (F.col("batch") - F.col("_of") == 0)
    plan = packed.hint("merge").join(answers.hint("merge"), own, "left")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.index("Exchange") > plan.index("SortMergeJoin")
    assert batches.n_parts(packed, 0.0001) > batches.n_parts(packed, 34)


def test_identifiers_name_equal_strings_alike_at_every_depth():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 2, 3000, dtype=np.uint8)
    ids = suffixes.Identifiers(Windows(mixed(data.astype(np.uint64) + np.uint64(7))).all(8), 8)
    for length in (8, 9, 15, 16, 17, 31, 32, 33, 100):
        starts = np.arange(len(data) - length + 1)
        names = ids.of(starts, starts + length).tolist()
        by_text = {}
        for s, n in zip(starts, names):
            by_text.setdefault(data[s : s + length].tobytes(), set()).add(n)
        assert all(len(n) == 1 for n in by_text.values()) and len(set(names)) == len(by_text)


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(2000 + i, 2000 + (i + 1) % 30) for i in range(30)]
    edges += [(rng.randrange(3000, 3100), rng.randrange(3000, 3100)) for _ in range(80)]
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    got = simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    found = {r.node: r.root for r in got}
    expected = roots(nodes, [e for e in edges if e[0] != e[1]])
    assert {n: found.get(n, n) for n in nodes} == expected and len(got) == len(found)
