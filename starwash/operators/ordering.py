"""Global order without a single task: sorted chunks, dense ids, fills along an order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from starwash.sources.staging import stage

CHUNK = "_chunk"
POSITION = "_pos"


def sorted_chunks(
    df: DataFrame, *keys: str | Column, chunks: int | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Range-partition and sort by ``keys``; number the chunks and the rows inside each.

    ``chunks`` bounds what one task sorts and scans: rows / chunks. Choose it so that a chunk fits a task's
    memory; by default it is ``spark.sql.shuffle.partitions``, which is fixed whatever the input holds.

    The result is staged: range bounds come from a sample, so the chunk of a row must be stored
    before two consumers may rely on it. Many rows with one key only share a chunk if ``keys`` ends
    there; add an ordering column to let them spread. ``columns`` are the ones to keep (default: all).
    """
    chunks = chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row_in_chunk = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = (
        df.repartitionByRange(chunks, *keys)
        .sortWithinPartitions(*keys)
        .withColumns({CHUNK: F.spark_partition_id(), POSITION: row_in_chunk})
    )
    return stage(numbered if columns is None else numbered.select(*columns, CHUNK, POSITION))


def with_ordinal(
    df: DataFrame, name: str, *order: str | Column, chunks: int | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """A bigint column that grows along ``order``: chunk number, then place in the chunk.

    For tables without a position of their own; a CSV scan gives one for nothing. Every later comparison along
    the order is then one of fixed width, which aggregates keep in hash tables. Staged, as ``sorted_chunks``;
    ``columns`` are the ones to keep, as there.
    """
    parts = sorted_chunks(df, *order, chunks=chunks, columns=columns)
    ordinal = F.shiftleft(F.col(CHUNK).cast("bigint"), 33).bitwiseOR(F.col(POSITION))
    return parts.select(*(df.columns if columns is None else columns), ordinal.alias(name))


def first_per_key(
    df: DataFrame, key: str, order: str, first: Mapping[str, Column | None], join_null: bool = True
) -> DataFrame:
    """``key`` and columns ``first``: each the value of the first row of the key, in the unique bigint ``order``,
    that meets its condition (None: of the first row at all); null where no row does.

    In two steps: the least ``order`` per key and column, a hash aggregate of fixed width that starts map-side, and
    the values by joining back on it. The staged result of the first step tells the planner whether it is small
    enough to be broadcast, so that the rows need not move. ``join_null``: null is a key as any other.
    """
    rows = df.select(*dict.fromkeys([key, order, *first]))
    rows = rows if join_null else rows.filter(F.col(key).isNotNull())
    place = {c: f"_at{i}" for i, c in enumerate(first)}
    least = [
        F.min(F.col(order) if usable is None else F.when(usable, F.col(order))).alias(place[c]) for c, usable in first.items()
    ]
    found = stage(rows.groupBy(F.col(key).alias("_key")).agg(*least))
    wanted = F.lit(False)
    for at in place.values():
        wanted = wanted | F.coalesce(F.col(order) == F.col(at), F.lit(False))
    hits = stage(rows.join(found, F.col(key).eqNullSafe(F.col("_key"))).filter(wanted).drop("_key"))
    out = hits.select(F.col(key).alias("_key")).distinct()
    for c, at in place.items():
        own = hits.filter(F.col(order) == F.col(at)).select(F.col(key).alias("_own"), F.col(c).alias(f"{at}_value"))
        out = out.join(own, F.col("_key").eqNullSafe(F.col("_own")), "left").drop("_own")
    return out.select(F.col("_key").alias(key), *[F.col(f"{at}_value").alias(c) for c, at in place.items() if c != key])


def with_dense_ids(df: DataFrame, key: str, id_column: str, chunks: int | None = None) -> DataFrame:
    """Ids 1..n in the order of a unique ``key`` (nulls last), as the first column.

    Each chunk's rows are numbered where they lie; only the chunk sizes, one row per chunk, meet in
    one task to become offsets, and they are what is broadcast.
    """
    parts = sorted_chunks(df, F.col(key).asc_nulls_last(), chunks=chunks)
    earlier = W.orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        parts.groupBy(CHUNK)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(CHUNK, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    )
    dense = (F.col("_before") + F.col(POSITION) + 1).cast("bigint")
    return parts.join(F.broadcast(offsets), CHUNK).select(dense.alias(id_column), *df.columns)


def with_dense_day_ids(days: DataFrame, key: str, id_column: str) -> DataFrame:
    """Ids 1..n for distinct calendar days.

    A DATE column has at most 3.7 million values (years 1 to 9999), so one task can number them.
    """
    return days.select(F.row_number().over(W.orderBy(key)).cast("bigint").alias(id_column), *days.columns)


def fill_within_group(
    df: DataFrame, key: str, column: str, order: str, chunks: int | None = None
) -> DataFrame:
    """Fill nulls of ``column`` forward, then backward, inside each ``key`` in the order of ``order``.

    Groups are cut into sorted chunks, so a key holding much of the data is filled by many tasks;
    what a chunk needs from the others is one summary row per key and chunk. Backward filling only
    reaches rows before the first value of a group, so that value is all it needs.
    """
    parts = sorted_chunks(df, key, order, chunks=chunks)
    value = F.col(column)
    in_chunk = W.partitionBy(CHUNK, key).orderBy(POSITION)
    so_far = F.last(value, ignorenulls=True).over(in_chunk.rowsBetween(W.unboundedPreceding, 0))
    filled = parts.withColumn("_here", so_far)

    # Places first, as numbers of fixed width; then the values at those places.
    known = F.when(value.isNotNull(), F.col(POSITION))
    places = stage(parts.groupBy(CHUNK, key).agg(F.max(known).alias("_last_at"), F.min(known).alias("_first_at")))
    at = F.explode(F.array_distinct(F.array("_first_at", "_last_at"))).alias(POSITION)
    values = stage(parts.select(CHUNK, POSITION, value.alias("_value")).join(places.select(CHUNK, at), [CHUNK, POSITION]))
    summary = places
    for place, name in (("_last_at", "_last"), ("_first_at", "_first")):
        there = values.select(CHUNK, F.col(POSITION).alias(place), F.col("_value").alias(name))
        summary = summary.join(there, [CHUNK, place], "left")
    across = W.partitionBy(key).orderBy(CHUNK)
    carried = F.last("_last", ignorenulls=True).over(across.rowsBetween(W.unboundedPreceding, -1))
    first = F.first("_first", ignorenulls=True).over(
        across.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    summary = summary.filter(F.col(key).isNotNull()).select(
        CHUNK, key, carried.alias("_carried"), first.alias("_group_first")
    )
    result = F.when(F.col(key).isNull(), value).otherwise(F.coalesce("_here", "_carried", "_group_first"))
    return (
        filled.join(summary, [CHUNK, key], "left")
        .withColumn(column, result)
        .select(*df.columns)
    )
