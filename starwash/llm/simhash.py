"""SimHash near-duplicates: fingerprints, a grid join on segment bit counts, exact check, connected groups.

A fingerprint is mapped to the bit counts of its segments. Two fingerprints that differ in d bits have count
vectors at Manhattan distance d at most, so the grid of count vectors finds every pair: each fingerprint is
put into all cells within half the distance of its own, and two that are near enough meet in a cell between
them. Only pairs that meet are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from starwash.llm.common import TEXT_GROUP_BYTES, text_bytes, unwrapped, wrapped
from starwash.sources.staging import stage

SHINGLE = 3
MAX_BITS = 2
SEED = 42

# Segments of two bits: their bit counts, each 0 to 2, lie in the places of the segments. Two unrelated values share
# all counts with a chance of (3/8)^32, about 2e-14, so that even 10^9 values meet few but their neighbours.
SEGMENTS, SEGMENT_BITS = 32, 2
LOW_BITS = 0x5555555555555555
BLOCK = 1 << 15


def fingerprint_of(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text's word shingles; a bit is set if more than half the hashes have it."""
    words = text.lower().split()  # bytes: A-Z only, and only blank and tab to carriage return
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, n, BLOCK):
        parts = [b" ".join(words[i : i + shingle]) for i in range(at, min(n, at + BLOCK))]
        hashes = np.frombuffer(b"".join([digest(p, SEED) for p in parts]), dtype=np.uint8).reshape(-1, 8)
        ones += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprint(column: str = "text", shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return compute(text_bytes(column))


def segment_counts(fp: Column) -> Column:
    """The bit counts of the 32 two-bit segments, packed into a long: a half adder on each pair of bits."""
    low = fp.bitwiseAND(F.lit(LOW_BITS))
    high = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW_BITS))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _with_neighbours(cells: DataFrame) -> DataFrame:
    """Every row also in the cells one step away in one segment, 48 on average."""
    cell = F.col("cell")
    steps = [cell]
    for s in range(SEGMENTS):
        at = SEGMENT_BITS * s
        count = F.shiftrightunsigned(cell, at).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1).cast("long"))
        rest = cell.bitwiseXOR(F.shiftleft(count, at))
        steps.append(F.when(count < SEGMENT_BITS, rest.bitwiseOR(F.shiftleft(count + 1, at))))
        steps.append(F.when(count > 0, rest.bitwiseOR(F.shiftleft(count - 1, at))))
    return cells.select("fp", F.explode(F.array_compact(F.array(*steps))).alias("cell"))


def linked(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of different values of ``fp`` that differ in at most ``max_bits`` bits.

    One row per pair. ``fingerprints`` holds each value once, so copies never multiply pairs, and a value
    has at most as many partners as there are values within that many bits. The values are dealt out before each
    enters its cells, since as a staged table they may be one file. The planner does not see that this makes 48 rows
    of one, so it is told to sort and merge; by its own estimate it would broadcast the cells of a million values.
    """
    tasks = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = fingerprints.repartition(tasks, "fp").select("fp", segment_counts(F.col("fp")).alias("cell"))
    for step in range((max_bits + 1) // 2):
        cells = _with_neighbours(cells)
        cells = cells.distinct() if step else cells
    a, b = cells.alias("a"), cells.alias("b")
    near = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    pairs = a.hint("merge").join(b, (F.col("a.cell") == F.col("b.cell")) & (F.col("a.fp") < F.col("b.fp")) & near)
    return pairs.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges`` (a, b).

    Large-star and small-star steps: each replaces edges by edges to smaller nodes, keeps what is connected,
    never makes more edges than there were, and needs about the logarithm of the longest path in rounds.
    Each round is a written table, so a lost executor repeats one step.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    while True:
        both = edges.union(edges.select("v", "u"))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        star = small.select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        star = stage(star)
        edges, before = star, edges
        moved = edges.join(before, ["u", "v"], "left_anti").limit(1).count()
        if not moved:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def groups(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) for the fingerprints in ``prints`` that have a link; all others stand alone."""
    return components(linked(stage(prints.select("fp").distinct()), max_bits))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    A null or empty text has fingerprint zero and links like any other. ``component_id`` is the smallest
    doc_id of the group; rows with a null id belong to groups but never name one, so a group of only such
    rows has a null component. Repeated rows give repeated rows; an empty table gives an empty result. A very long
    text is hashed whole, some thousand shingles at a time. Other columns, whatever their names, are left out.
    """
    prints = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint("text", shingle).alias("fp")))
    lowest = prints.groupBy("fp").agg(F.min("doc_id").alias("lowest"))
    roots = groups(prints, max_bits).withColumnRenamed("node", "fp")
    member = stage(lowest.join(roots, "fp", "left").select("fp", "lowest", F.coalesce("root", "fp").alias("root")))
    named = member.groupBy("root").agg(F.min("lowest").alias("component_id"))
    names = member.join(named, "root").select("fp", "component_id")
    return prints.join(names, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, all their columns, one of each group: the smallest doc_id (null last).

    Among rows with that id the one numbered first when the input was written down; rows are numbered so
    that exact repeats, too, leave one. Null, empty and very long texts as in ``near_duplicates``; columns may have
    the names used here; an empty table stays empty.
    """
    numbered = wrapped(docs, fp=fingerprint("text", shingle), id=F.col("doc_id").cast("long"))
    numbered = stage(numbered.withColumn("n", F.monotonically_increasing_id()), TEXT_GROUP_BYTES)
    narrow = numbered.select("fp", "id", "n")
    # Smallest id per fingerprint, nulls last, then the smallest number: two plain minima instead of one
    # over a struct, which Spark would sort for.
    ids = narrow.groupBy("fp").agg(F.min("id").alias("id"))
    firsts = narrow.join(ids.withColumnRenamed("id", "lowest"), "fp").filter(F.col("id").eqNullSafe(F.col("lowest")))
    firsts = firsts.groupBy("fp", "id").agg(F.min("n").alias("n"))
    roots = groups(narrow, max_bits).withColumnRenamed("node", "fp")
    member = stage(firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    best = member.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "n")).alias("best"))
    return unwrapped(numbered.join(best.select(F.col("best.n").alias("n")), "n", "left_semi"))
