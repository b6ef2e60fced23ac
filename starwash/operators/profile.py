"""Profiling: schema, missing values, distinct values, frequencies, description."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starwash.functions.numeric import round_half_even
from starwash.operators.dedupe import duplicate_row_count
from starwash.operators.quantiles import QUARTILES, long_values, quantiles_of_counts, side_by_side
from starwash.sources.staging import stage


def _is_missing(name: str, type_name: str) -> Column:
    c = F.col(name)
    return c.isNull() | F.isnan(c) if type_name in ("double", "float") else c.isNull()


def _missing_counts(df: DataFrame) -> DataFrame:
    """``(position, column, dtype, missing_count, n_rows)`` from one aggregate over the data."""
    counts = [F.count_if(_is_missing(c, t)).alias(f"_m{i}") for i, (c, t) in enumerate(df.dtypes)]
    totals = df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    rows = F.array(*[
        F.struct(
            F.lit(i).cast("bigint").alias("position"),
            F.lit(c).alias("column"),
            F.lit(t).alias("dtype"),
            F.col(f"_m{i}").alias("missing_count"),
            F.col("n_rows"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ])
    return totals.select(F.inline(rows))


def schema_profile(df: DataFrame) -> DataFrame:
    """Position, name, type, non-null count of every column, and the shape of the table."""
    return _schema(_missing_counts(df), len(df.columns))


def _schema(totals: DataFrame, n_columns: int) -> DataFrame:
    return totals.select(
        "position",
        "column",
        "dtype",
        (F.col("n_rows") - F.col("missing_count")).alias("non_null_count"),
        "n_rows",
        F.lit(n_columns).cast("bigint").alias("n_columns"),
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """Columns with missing values: count, and percent of all rows."""
    return _missing(_missing_counts(df))


def _missing(totals: DataFrame) -> DataFrame:
    percent = round_half_even(F.col("missing_count") / F.col("n_rows") * 100)
    return totals.filter("missing_count > 0").select(
        "column", "missing_count", percent.alias("missing_pct")
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], error: float | None = None) -> DataFrame:
    """Number of distinct non-null values per column, 0 for a column without any.

    With ``error``, the relative standard deviation of an estimate, from one sketch per column: only the sketches
    are shuffled, and two of three estimates lie within ``error`` of the truth.
    """
    if error is not None:
        types = dict(df.dtypes)
        values = [F.when(~_is_missing(c, types[c]), F.col(c)) for c in columns]
        counts = df.agg(*[F.approx_count_distinct(v, error).alias(f"_d{i}") for i, v in enumerate(values)])
        rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_d{i}").alias("n_distinct")) for i, c in enumerate(columns)])
        return counts.select(F.inline(rows))
    found = distinct_values(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    return _listed(df, columns).join(found, "column", "left").select(
        "column", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_distinct")
    )


def _listed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column, whether or not it has values."""
    return df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, columns))).alias("column"))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column, one row each, sorted."""
    return long_values(df, columns, "string").distinct().orderBy("column", "value")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each value, null included, most frequent first."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc_nulls_last("value"))


def frequencies(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, value, number, n)``, staged: how often each value of each column occurs, nulls included.

    One pass over ``df``. ``number`` is the value of a numeric column, the micros since 1970 of a date or timestamp,
    else null; ``value`` the text of a value that ``number`` may not hold exactly. Both are null for a missing one. NaN is missing and -0.0 is 0.0. Everything a profile says of single
    columns follows from this table. Equal values collapse map-side; a column of unique values moves once.
    """
    types = dict(df.dtypes)
    names = list(columns if columns is not None else df.columns)
    cells = []
    for c in names:
        t, present = types[c], F.when(~_is_missing(c, types[c]), F.col(c))
        if t in ("double", "float"):
            present = F.when(present == 0, F.lit(0).cast(t)).otherwise(present)
        number = present.cast("double") if _is_numeric(t) else F.lit(None).cast("double")
        if t in DATES:
            number = F.unix_micros(present.cast("timestamp")).cast("double")
        text = F.lit(None).cast("string") if t in EXACT else present.cast("string")
        cells.append(F.struct(F.lit(c).alias("column"), text.alias("value"), number.alias("number")))
    if not cells:
        return df.sparkSession.createDataFrame([], "column string, value string, number double, n bigint")
    long = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    return stage(long.groupBy("column", "value", "number").agg(F.count(F.lit(1)).alias("n")))


DATES = ("date", "timestamp", "timestamp_ntz")
#: Types whose values are doubles without loss.
EXACT = ("tinyint", "smallint", "int", "float", "double")
KNOWN = "(value is not null or number is not null)"


def _is_numeric(type_name: str) -> bool:
    return type_name in ("tinyint", "smallint", "int", "bigint", "float", "double") or type_name.startswith("decimal")


def _described_numbers(counted: DataFrame) -> DataFrame:
    """``column, count, mean, std, min, q1, median, q3, max`` of the numbers of a frequency table."""
    known = counted.filter("number is not null")
    sums = known.groupBy("column").agg(
        F.sum("n").alias("count"),
        (F.sum(F.col("number") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("number").alias("min"),
        F.max("number").alias("max"),
    )
    sums = F.broadcast(stage(sums))  # one row per column
    gap = F.col("number") - F.col("mean")
    spread = known.join(sums, "column").groupBy("column").agg(
        F.sum(gap * gap * F.col("n")).alias("_squares"), F.max("count").alias("_count")
    )
    deviation = F.when(F.col("_count") > 1, F.sqrt(F.col("_squares") / (F.col("_count") - 1)))
    spread = spread.select("column", deviation.alias("std"))
    by_value = known.groupBy("column", F.col("number").alias("value")).agg(F.sum("n").alias("n"))
    ranked = side_by_side(quantiles_of_counts(by_value.withColumn("segment", F.lit(1)), QUARTILES))
    return sums.join(spread, "column", "left").join(F.broadcast(ranked), "column", "left").select(
        "column", "count", "mean", "std", "min", "q1", "median", "q3", "max"
    )


def _described_texts(counted: DataFrame) -> DataFrame:
    """``column, count, unique, top, freq`` of the values of a frequency table."""
    known = counted.filter("value is not null")
    sums = stage(known.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), F.max("n").alias("freq")
    ))
    # Only the values of the highest frequency are compared as texts.
    most = known.join(F.broadcast(sums.select("column", F.col("freq").alias("n"))), ["column", "n"], "left_semi")
    top = most.groupBy("column").agg(F.min("value").alias("top"))
    return sums.join(top, "column").select("column", "count", "unique", "top", "freq")


def describe_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per numeric column; one pass over ``df``."""
    return _described_numbers(frequencies(df.select(*[F.col(c).cast("double").alias(c) for c in columns])))


def describe_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value (the smallest of a tie) and its frequency; one pass."""
    return _described_texts(frequencies(df, columns))


def _described_dates(counted: DataFrame, columns: Sequence[str]) -> DataFrame:
    stats = _described_numbers(counted.filter(F.col("column").isin(list(columns))))
    found = stats.select("column", "count", *[
        F.timestamp_micros(F.col(m).cast("bigint")).cast("timestamp_ntz").alias(m)
        for m in ("min", "q1", "median", "q3", "max")
    ])
    return _listed(counted, columns).join(found, "column", "left").fillna(0, ["count"])


def describe_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, extremes and exact quartiles per date or timestamp column, as timestamps without zone; one pass."""
    return _described_dates(frequencies(df, columns), columns)


def _described_all(counted: DataFrame, dtypes: Sequence[tuple[str, str]]) -> DataFrame:
    numeric = [c for c, t in dtypes if _is_numeric(t)]
    texts = [c for c, t in dtypes if not _is_numeric(t)]
    parts = []
    if numeric:
        parts.append(_described_numbers(counted.filter(F.col("column").isin(numeric))))
    if texts:
        parts.append(_described_texts(counted.filter(F.col("column").isin(texts))))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    measures = ["count", "unique", "top", "freq", "mean", "std", "min", "q1", "median", "q3", "max"]
    complete = _listed(counted, [c for c, _ in dtypes]).join(out, "column", "left").fillna(0, ["count"])
    if "unique" in out.columns:
        counts = F.when(F.col("column").isin(texts), F.coalesce("unique", F.lit(0))).otherwise(F.col("unique"))
        complete = complete.withColumn("unique", counts)
    return complete.select("column", *[m for m in measures if m in out.columns])


def describe_all(df: DataFrame) -> DataFrame:
    """Both descriptions, one row per column; measures of the other kind are null, and all but the counts
    for a column without a value. Decimals are numbers; ``describe_dates`` has the measures of dates. One pass."""
    return _described_all(frequencies(df), df.dtypes)


def preview(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows in the order of ``order``."""
    return df.orderBy(order).limit(n)


def extract_report(df: DataFrame, order: str | None = None) -> dict[str, DataFrame]:
    """What is worth knowing of a table just read (``order`` column left out).

    Three passes over ``df``: the frequency table, from which schema, missing values, distinct values and all
    descriptions follow, whole rows for duplicates, and the preview.
    """
    data = df.drop(order) if order else df
    counted = frequencies(data)
    totals = _missing_of(counted, data.dtypes)
    report = {
        "schema": _schema(totals, len(data.columns)),
        "missing": _missing(totals),
        "distinct": _listed(counted, data.columns).join(
            counted.filter(KNOWN).groupBy("column").agg(F.count(F.lit(1)).alias("n")), "column", "left"
        ).select("column", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_distinct")),
        "duplicates": duplicate_row_count(data),
        "describe": _described_all(counted, data.dtypes),
    }
    dated = [c for c, t in data.dtypes if t in DATES]
    if dated:
        report["dates"] = _described_dates(counted, dated)
    if order:
        report["preview"] = preview(df, order).drop(order)
    return report


def _missing_of(counted: DataFrame, dtypes: Sequence[tuple[str, str]]) -> DataFrame:
    """As ``_missing_counts``, from a frequency table."""
    names = F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("position"), F.lit(c).alias("column"), F.lit(t).alias("dtype"))
        for i, (c, t) in enumerate(dtypes)
    ])
    listed = counted.sparkSession.range(1).select(F.inline(names))
    sums = counted.groupBy("column").agg(
        F.sum(F.when(~F.expr(KNOWN), F.col("n")).otherwise(0)).alias("missing_count"), F.sum("n").alias("n_rows")
    )
    return listed.join(sums, "column", "left").fillna(0, ["missing_count", "n_rows"])
