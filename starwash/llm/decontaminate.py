"""Benchmark decontamination: a broadcast hash set of benchmark windows, looked up at every document word.

The set is one constant array of buckets that every task holds. A document never leaves its row: its words are looked
up, hits are verified word by word and turned into word positions by array expressions, without a shuffle.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from starwash.llm.common import unwrapped, wrapped
from starwash.llm.urls import LOWER, UPPER
from starwash.sources.staging import stage

#: A word: digits, lower-case letters and everything beyond ASCII, after A-Z are lowered.
BENCHMARK_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10

#: Windows of the benchmark, and UTF-8 bytes of their words and ids, that the broadcast sets hold at most; a
#: benchmark above either bound is looked up by a shuffled join instead. Words have no greatest length: a
#: paragraph without ASCII is one, and lies in up to WINDOW windows.
MAX_BROADCAST_WINDOWS = 20_000
MAX_BROADCAST_BYTES = 10_000_000
ENTRIES = "array<array<struct<words: array<string>, items: array<string>>>>"
PROBE = 3  # words hashed first; most positions end there


def words_of(text: Column) -> Column:
    """Words of a text, null without any."""
    lowered = F.translate(text, UPPER, LOWER)
    return F.coalesce(F.regexp_extract_all(lowered, F.lit(f"({BENCHMARK_WORD})"), F.lit(1)), F.array().cast("array<string>"))


def _hash(words: Column, at: Column, count: int) -> Column:
    """Hash of ``count`` words from 0-based position ``at``; single elements, since a slice copies the array."""
    return F.xxhash64(*(F.get(words, at + k) for k in range(count)))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, words): windows of WINDOW words, and items of fewer words as one window."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("w")).filter(F.size("w") > 0)
    last = F.greatest(F.size("w") - WINDOW, F.lit(0))
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("w", i + 1, WINDOW))
    return items.select("item_id", F.explode(windows).alias("words")).distinct()


def _by_length(windows: DataFrame) -> list[int]:
    """Window lengths that occur: at most WINDOW numbers."""
    return sorted(r[0] for r in windows.select(F.size("words")).distinct().collect())


def _count_and_bytes(windows: DataFrame) -> tuple[int, int]:
    """Number of windows, and UTF-8 bytes of their words and ids."""
    item = F.coalesce(F.octet_length(F.col("item_id").cast("string")), F.lit(0))
    size = F.octet_length(F.concat_ws("", "words")) + item
    count, total = windows.agg(F.count("*"), F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()
    return count, total


def _lookup_set(windows: DataFrame, length: int) -> tuple[Column, int]:
    """A constant: 2^k buckets of (words, item ids) by the hash of the first words; and 2^k.

    The caller has checked the windows against MAX_BROADCAST_WINDOWS and MAX_BROADCAST_BYTES, the bounds of what
    passes the driver on its way into the plan. As a column of every row the set would be copied once per document.
    """
    own = windows.filter(F.size("words") == length).groupBy("words").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    hashed = own.withColumn("h", _hash(F.col("words"), F.lit(0), min(PROBE, length))).collect()
    buckets = 1 << max(4, (8 * len(hashed)).bit_length())
    entries: list[list[dict] | None] = [None] * buckets
    for row in hashed:
        at = row.h & (buckets - 1)
        entries[at] = [*(entries[at] or []), {"words": row.words, "items": row["items"]}]
    return F.from_json(F.lit(json.dumps(entries)), ENTRIES), buckets


def _hits(words: Column, length: int, table: Column, size: int) -> Column:
    """Array of (positions, items): the verified occurrences of windows of one length.

    ``items`` holds one list of ids for each entry of these words; the list is empty when no item has an id.
    ``table`` is a constant, so the set reaches the tasks with the plan and nothing is joined.
    """
    probe = min(PROBE, length)

    def bucket(at: Column) -> Column:
        return F.get(table, _hash(words, at, probe).bitwiseAND(F.lit(size - 1)).cast("int"))

    candidates = F.filter(
        F.when(F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length))
        .otherwise(F.array().cast("array<int>")),
        lambda at: bucket(at).isNotNull(),
    )

    def verified(at: Column) -> Column:
        text = F.slice(words, at + 1, length)
        same = F.filter(bucket(at), lambda e: e["words"] == text)
        return F.struct(
            F.sequence(at, at + length - 1).alias("positions"),
            F.transform(same, lambda e: e["items"]).alias("items"),
        )

    return F.filter(F.transform(candidates, verified), lambda h: F.size(h["items"]) > 0)


def _looked_up(text: Column, sets: dict[int, tuple[Column, int]]) -> Column:
    """Struct of the number of words and the hits of a text.

    The words are bound by a lambda, so that no optimiser rule copies their computation into each use.
    """
    none = F.array().cast("array<struct<positions: array<int>, items: array<array<string>>>>")
    found = F.transform(F.array(words_of(text)), lambda words: F.struct(
        F.size(words).alias("n_words"),
        F.concat(none, *(_hits(words, n, *entry) for n, entry in sets.items())).alias("hits"),
    ))
    return F.get(found, F.lit(0))


def _joined_hits(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """The way for a benchmark too large to broadcast: documents' windows are joined by hash, then verified.

    ``docs`` (row, id, w) is staged and numbered, so the hits find their row again.
    """
    hits = None
    for length in lengths:
        own = windows.filter(F.size("words") == length).withColumn("h", _hash(F.col("words"), F.lit(0), length))
        starts = F.when(F.size("w") >= length, F.sequence(F.lit(0), F.size("w") - length))
        hashes = F.transform(starts, lambda at: _hash(F.col("w"), at, length))
        probes = docs.select("id", F.posexplode(hashes).alias("at", "h"))
        met = probes.join(own, "h").select("id", "at", "words", F.col("item_id").cast("string").alias("item"))
        hits = met if hits is None else hits.union(met)
    exact = docs.select("id", "w").join(hits, "id").filter(F.slice("w", F.col("at") + 1, F.size("words")) == F.col("words"))
    spans = exact.groupBy("id").agg(
        F.array_distinct(F.flatten(F.collect_set(F.sequence("at", F.col("at") + F.size("words") - 1)))).alias("positions"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )
    return docs.join(spans, "id", "left").withColumns({
        "n_words": F.size("w"),
        "positions": F.coalesce("positions", F.array().cast("array<int>")),
        "items": F.coalesce("items", F.array().cast("array<string>")),
    })


def _with_hits(docs: DataFrame, benchmark: DataFrame, most: int) -> DataFrame:
    """Add ``n_words``, ``positions`` (hit words) and ``items`` (sorted ids) to rows that have ``t``, a text."""
    windows = stage(benchmark_windows(benchmark))
    lengths, (count, size) = _by_length(windows), _count_and_bytes(windows)
    if count > most or size > MAX_BROADCAST_BYTES:
        numbered = docs.withColumns({"w": words_of(F.col("t")), "id": F.monotonically_increasing_id()})
        return _joined_hits(stage(numbered.drop("t")), windows, lengths)
    found = docs.withColumn("found", _looked_up(F.col("t"), {n: _lookup_set(windows, n) for n in lengths}))
    return found.withColumns({
        "n_words": F.col("found.n_words"),
        "positions": F.array_distinct(F.flatten("found.hits.positions")),
        "items": F.array_sort(F.array_distinct(F.flatten(F.flatten("found.hits.items")))),
    })


def contamination(docs: DataFrame, benchmark: DataFrame, most: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``docs``.

    A null text has no words and is clean; a null item counts as no item. The words of an item of null item_id
    are hit like others, the id is not listed.
    Repeated rows and items give equal results. Benchmark texts without words match nothing. A very long text is
    looked up whole; other columns, whatever their names, are left out; without documents the result is empty.
    """
    found = _with_hits(docs.select("doc_id", F.col("text").alias("t")), benchmark, most)
    return found.select(
        "doc_id",
        F.col("n_words").cast("long"),
        F.size("positions").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("positions") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, most: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """The rows of ``docs``, all their columns, without a benchmark window; others are removed whole.

    Column names may be those used here; null, empty and very long texts as in ``contamination``.
    """
    found = _with_hits(wrapped(docs, t=F.col("text")), benchmark, most)
    return unwrapped(found.filter(F.size("positions") == 0))
