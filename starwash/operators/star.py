"""Dimensions with dense surrogate ids, and fact keys looked up from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starwash.functions.dates import calendar_parts, date_text
from starwash.operators.dedupe import keep_first
from starwash.operators.ordering import first_per_key, with_dense_day_ids, with_dense_ids
from starwash.sources.staging import stage


def build_dimension(df: DataFrame, columns: Sequence[str], key: str, id_column: str, order: str) -> DataFrame:
    """One row per natural ``key`` (the first in ``order``) with ids 1..n in key order."""
    first = keep_first(df.select(*columns, order), key, order).select(*columns)
    return with_dense_ids(first, key, id_column)


def build_filled_dimension(
    df: DataFrame, key: str, first: str, filled: str, default: str, id_column: str, order: str
) -> DataFrame:
    """As :func:`build_dimension` for columns ``first`` and ``filled``, where ``filled`` may be missing
    in some rows of a key.

    Filling forward and backward and then keeping the first row leaves the first known value of the
    group, so it needs the least ``order``, a unique bigint, of each column only.
    """
    known = first_per_key(df, key, order, {first: None, filled: F.col(filled).isNotNull()})
    per_key = known.withColumn(filled, F.coalesce(filled, F.lit(default)))
    return with_dense_ids(per_key, key, id_column).select(id_column, first, filled)


def build_date_dimension(df: DataFrame, date: str, id_column: str = "date_id") -> DataFrame:
    """One row per occurring day, with calendar parts; the day itself as text in ``date``."""
    days = df.filter(F.col(date).isNotNull()).select(F.col(date).alias("_day")).distinct()
    parts = [c.alias(n) for n, c in calendar_parts(F.col("_day")).items()]
    numbered = with_dense_day_ids(days, "_day", id_column)
    return numbered.select(id_column, date_text(F.col("_day")).alias("date"), *parts)


def unseen_rows(stored: DataFrame, new: DataFrame, key: Column, id_column: str) -> DataFrame:
    """Rows of ``new`` whose natural ``key`` (an expression over the columns of both) ``stored`` lacks, with ids.

    Stored rows keep their ids, the others get the next ones in the order of ``new``'s own ids. Null is a key as
    any other. Only the largest stored id, one number, reaches the driver.
    """
    last = stored.agg(F.max(id_column)).first()[0] or 0
    keys = stored.select(key.alias("_stored_key"))
    fresh = new.withColumn("_key", key).join(keys, F.col("_key").eqNullSafe(F.col("_stored_key")), "left_anti").drop("_key")
    rest = [c for c in new.columns if c != id_column]
    numbered = with_dense_ids(fresh.withColumnRenamed(id_column, "_order"), "_order", id_column)
    return numbered.withColumn(id_column, F.col(id_column) + F.lit(last)).select(id_column, *rest)


def append_dimension(
    stored: DataFrame, new: DataFrame, key: Column, id_column: str, append: Callable[[DataFrame], int]
) -> int:
    """``append`` the rows of ``new`` that ``stored`` lacks; their number. Nothing is written when there are none."""
    fresh = stage(unseen_rows(stored, new, key, id_column))
    return 0 if fresh.isEmpty() else append(fresh)


def matched_ids(new: DataFrame, stored: DataFrame, key: Column, id_column: str) -> DataFrame:
    """``(id_column, _stored)``: the stored id of every row of ``new`` by the natural ``key``, staged."""
    theirs = stored.select(key.alias("_stored_key"), F.col(id_column).alias("_stored"))
    mine = new.select(id_column, key.alias("_key"))
    return stage(mine.join(theirs, F.col("_key").eqNullSafe(F.col("_stored_key"))).select(id_column, "_stored"))


def lookup_id(df: DataFrame, value: Column, dim: DataFrame, dim_key: Column, id_column: str) -> DataFrame:
    """Left join that adds ``id_column`` of the dimension row whose key equals ``value``.

    Null matches null. Only key and id leave the dimension. There is no broadcast hint: a staged or
    stored dimension has a known size, a small one is broadcast and a large one is shuffled, where
    adaptive execution splits the partitions of frequent keys.
    """
    ids = dim.select(dim_key.alias("_dim_key"), F.col(id_column))
    return df.withColumn("_fact_key", value).join(
        ids, F.col("_fact_key").eqNullSafe(F.col("_dim_key")), "left"
    ).drop("_fact_key", "_dim_key")


def unmatched(df: DataFrame, ids: Sequence[str]) -> Column:
    """True where any of the looked-up ids is missing."""
    missing = F.lit(False)
    for i in ids:
        missing = missing | F.col(i).isNull()
    return missing
