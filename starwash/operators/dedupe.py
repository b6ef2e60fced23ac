"""Duplicate removal and duplicate detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from starwash.functions.text import quoted
from starwash.sources.staging import stage


def keep_first(df: DataFrame, key: str, order: str, usable: Column | None = None) -> DataFrame:
    """First row per ``key`` in the order of ``order`` (null is one key).

    Spark turns the filtered row number into a group limit that already runs before the shuffle:
    each task sends on at most one row per key, so a key with many copies does not pile up.

    With ``usable`` it is the first row that meets the condition, and keys without such a row are
    left out. Usable rows rank first, which needs no filter below the window: such a filter would
    compute all the cleaning expressions that the condition refers to a second time. Rows without a
    key may stay for the same reason, the group limit leaves one of them per task.
    """
    rank = W.partitionBy(key)
    rank = rank.orderBy(order) if usable is None else rank.orderBy("_unusable", order)
    kept = F.col("_rank") == 1
    if usable is not None:
        df = df.withColumn("_unusable", ~usable)
        kept = kept & ~F.col("_unusable")
    return df.withColumn("_rank", F.row_number().over(rank)).filter(kept).drop("_rank", "_unusable")


def row_digest(df: DataFrame) -> Column | None:
    """128 bits of a row as a struct of two bigints; equal rows have equal digests, nulls equal to each other.

    None for columns that Spark cannot hash the way it compares them (maps, numbers with a sign of zero inside others).
    """
    values = []
    for field in df.schema.fields:
        name, t = F.col(quoted(field.name)), field.dataType.simpleString()
        if "map<" in t or "variant" in t or (("<" in t) and ("float" in t or "double" in t)):
            return None
        values.append(F.when(name == 0, F.lit(0).cast(t)).otherwise(name) if t in ("float", "double") else name)
    if not values:
        return None
    # The hash passes over nulls, so which columns are null is hashed, too.
    gaps = [v.isNull() for v in values]
    return F.struct(F.xxhash64(*gaps, *values).alias("a"), F.xxhash64(F.lit("second"), *values, *gaps).alias("b"))


def _parted(df: DataFrame, digest: Column) -> tuple[DataFrame, DataFrame | None]:
    """(rows whose digest occurs once, the others or None if there are none); the rows are staged.

    Only digests are shuffled to find out. Then the few that occur more than once select the rows that move; staged,
    they are broadcast when small.
    """
    rows = stage(df.select(F.struct("*").alias("row"), digest.alias("digest")))
    counts = rows.groupBy(F.col("digest.a").alias("a"), F.col("digest.b").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    repeated = stage(counts.filter("n > 1").select("a", "b"))
    if repeated.isEmpty():
        return rows.select("row.*"), None
    same = (F.col("digest.a") == F.col("a")) & (F.col("digest.b") == F.col("b"))
    return (
        rows.join(repeated, same, "left_anti").select("row.*"),
        rows.join(repeated, same, "left_semi").select("row.*"),
    )


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One copy of each full row; nulls are equal to each other.

    Rows meet by a digest of 16 bytes first. Full rows move only where a digest occurs more than once, and there
    they are compared column by column, so that rows which merely share a digest all stay.
    """
    digest = row_digest(df)
    if digest is None:
        return df.dropDuplicates()
    once, again = _parted(df, digest)
    return once if again is None else once.unionAll(again.dropDuplicates())


def rows_with_repeated_key(df: DataFrame, key: str) -> DataFrame:
    """All copies of rows whose ``key`` occurs more than once (null is one key).

    The keys are counted first and joined back: a window over the key would pass every row of a
    frequent key through one task.
    """
    repeated = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return df.join(repeated, F.col(key).eqNullSafe(F.col("_key")), "left_semi")


def near_duplicate_customers(
    df: DataFrame, email: str, name: str, keep: list[str], email_was_missing: str
) -> DataFrame:
    """Distinct ``keep`` rows of real e-mails that appear with more than one name.

    The distinct rows come first, so copies of one customer collapse before anything is grouped by
    e-mail.
    """
    customers = df.filter(~F.col(email_was_missing)).select(*keep).distinct()
    several = (
        customers.groupBy(email).agg(F.min(name).alias("_low"), F.max(name).alias("_high"))
        .filter("_low < _high").select(email)
    )
    return customers.join(several, email, "left_semi").select(*keep)


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first copy of each full row (one row: ``duplicate_rows``); by digest, as above."""
    digest = row_digest(df)
    rows = df if digest is None else _parted(df, digest)[1]
    if rows is None:
        return df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("duplicate_rows"))
    return _rows_beyond_first(rows, rows.columns).withColumnRenamed("rows_beyond_first", "duplicate_rows")


def duplicate_key_count(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first per ``key`` (one row: ``duplicate_keys``)."""
    return _rows_beyond_first(df, [key]).withColumnRenamed("rows_beyond_first", "duplicate_keys")


def _rows_beyond_first(df: DataFrame, columns: list[str]) -> DataFrame:
    copies = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("rows_beyond_first"))
