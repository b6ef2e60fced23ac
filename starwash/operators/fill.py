"""Missing values: flags, constants, lookups from other rows, incomplete rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starwash.operators.ordering import first_per_key
from starwash.sources.staging import stage


def flag_missing(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """Boolean columns ``{flag name: column}``, true where the column is null."""
    return df.withColumns({flag: F.col(c).isNull() for flag, c in flags.items()})


def fill_constant(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    return df.na.fill(dict(values))


def is_complete(df: DataFrame, columns: Sequence[str]) -> Column:
    """True where none of ``columns`` is null (or NaN)."""
    types = dict(df.dtypes)
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
        if types[c] in ("double", "float"):
            complete = complete & ~F.coalesce(F.isnan(c), F.lit(False))
    return complete


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(is_complete(df, columns))


def keep_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows that :func:`drop_incomplete` removes."""
    return df.filter(~is_complete(df, columns))


def fill_from_same_key(df: DataFrame, key: str, column: str, order: str) -> DataFrame:
    """Fill null or blank ``column`` with the first known value of the same ``key``, in the unique bigint ``order``.

    The lookup is reduced map-side to one row per key and staged, so that its true size decides
    between a broadcast and a shuffled join.
    """
    known = F.when(F.col(column) != "", F.col(column))
    lookup = stage(first_per_key(df, key, order, {column: F.col(column) != ""}, join_null=False))
    lookup = lookup.withColumnRenamed(column, "_known")
    filled = df.join(lookup, key, "left").withColumn(column, F.coalesce(known, F.col("_known")))
    return filled.select(*df.columns)
