"""Exact quantiles and box-plot statistics that no single task has to hold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from starwash.operators.ordering import CHUNK, sorted_chunks
from starwash.sources.staging import stage

QUARTILES = (0.25, 0.5, 0.75)
#: Share of the rows by which a sketch's ranks may be off. It decides what is shuffled, never the result.
SKETCH_ERROR = 1e-4


def long_values(df: DataFrame, columns: Sequence[str], as_type: str) -> DataFrame:
    """One row ``(column, value)`` per non-null cell of ``columns``."""
    cells = df.select(*[F.col(c).cast(as_type).alias(c) for c in columns])
    long = cells.unpivot([], list(columns), "column", "value")
    known = F.col("value").isNotNull()
    if as_type == "double":
        known = known & ~F.isnan("value")
    return long.filter(known)


def _brackets(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], error: float) -> dict[str, list[tuple[float, float]]]:
    """Per column disjoint value ranges, ascending, in which the wanted ranks should lie, from one sketch.

    The sketch is merged from one per task; ranks of its answers are off by ``error`` of all rows. Columns without a
    value have none. Two numbers per column and probability reach the driver.
    """
    asked = [q for p in probabilities for q in (max(0.0, p - 2 * error), min(1.0, p + 2 * error))]
    found = df.select(*[_number(c).alias(c) for c in columns]).agg(*[
        F.percentile_approx(F.col(c), asked, int(1 / error)).alias(c) for c in columns
    ]).first()
    out: dict[str, list[tuple[float, float]]] = {}
    for c in columns:
        merged: list[tuple[float, float]] = []
        for low, high in sorted(zip(found[c][::2], found[c][1::2])) if found[c] else []:
            if merged and low <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
            else:
                merged.append((low, high))
        out[c] = merged
    return out


def _number(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _bracketed_counts(df: DataFrame, brackets: Mapping[str, Sequence[tuple[float, float]]]) -> DataFrame:
    """``(column, segment, value, n)``: every value inside a bracket, one row for all values between two brackets.

    Segments ascend with the values; those of brackets are odd. What lies between them collapses map-side, so only
    the values of the brackets are shuffled.
    """
    cells = []
    for c, ranges in brackets.items():
        value, segment, inside = F.col(c), F.lit(0), F.lit(False)
        for k, (low, high) in enumerate(ranges):
            inside = inside | value.between(low, high)
            segment = F.when(value > high, 2 * k + 2).when(value >= low, 2 * k + 1).otherwise(segment)
        cells.append(F.struct(
            F.lit(c).alias("column"), segment.alias("segment"), F.when(inside, value).alias("value"),
            value.isNotNull().alias("known"),
        ))
    long = df.select(*[_number(c).alias(c) for c in brackets]).select(F.explode(F.array(*cells)).alias("cell"))
    return long.select("cell.*").filter("known").groupBy("column", "segment", "value").agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], chunks: int | None = None, error: float = SKETCH_ERROR
) -> DataFrame:
    """``(column, probability, value)`` with linear interpolation between ranks; nulls are ignored.

    Two passes over ``df``: a sketch brackets every wanted rank, then the values inside the brackets, about four
    times ``error`` of the rows for each probability, are counted and ranked exactly. Should a rank lie outside its
    bracket after all, all distinct values are ranked instead, so the result is exact in any case. Columns without
    any value have no row. ``chunks`` bounds a task's share, as in ``sorted_chunks``.
    """
    counted = stage(_bracketed_counts(df, _brackets(df, columns, probabilities, error)))
    found = stage(quantiles_of_counts(counted, probabilities, chunks))
    if not found.filter("outside").isEmpty():
        whole = long_values(df, columns, "double").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        found = quantiles_of_counts(whole.withColumn("segment", F.lit(1)), probabilities, chunks)
    return found.drop("outside")


def quantiles_of_counts(counted: DataFrame, probabilities: Sequence[float], chunks: int | None = None) -> DataFrame:
    """``(column, probability, value, outside)`` from ``(column, segment, value, n)`` with n > 0.

    The rows are sorted in chunks, the chunk totals locate the chunk of every wanted rank, and only those chunks are
    read again. ``outside``: the rank lies in an even segment, whose values are not known.
    """
    parts = sorted_chunks(counted, "column", "segment", "value", chunks=chunks)

    in_order = W.partitionBy("column").orderBy(CHUNK)
    ranges = parts.groupBy("column", CHUNK).agg(F.sum("n").alias("_size")).select(
        "column",
        CHUNK,
        F.coalesce(F.sum("_size").over(in_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        "_size",
        F.sum("_size").over(W.partitionBy("column")).alias("_total"),
    )
    spot = (F.col("_total") - 1) * F.col("probability")
    wanted = (
        ranges.withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .withColumn("_spot", spot)
        .withColumn("_rank", F.explode(F.array(F.floor("_spot"), F.ceil("_spot"))))
        .filter((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_size")))
        .select("column", CHUNK, "_before", "probability", "_spot", "_rank")
    )
    upto = F.sum("n").over(W.partitionBy("column", CHUNK).orderBy("segment", "value"))
    # At most two rows per column and probability, whatever the data: bounded, so broadcast.
    places = F.broadcast(wanted.select("column", CHUNK).distinct())
    ranked = parts.join(places, ["column", CHUNK], "left_semi").withColumn("_upto", upto)
    found = ranked.join(F.broadcast(wanted), ["column", CHUNK]).filter(
        (F.col("_rank") < F.col("_before") + F.col("_upto"))
        & (F.col("_rank") >= F.col("_before") + F.col("_upto") - F.col("n"))
    )
    ends = found.groupBy("column", "probability").agg(
        F.min("value").alias("_low"), F.max("value").alias("_high"), F.max("_spot").alias("_spot"),
        F.max(F.col("segment") % 2 == 0).alias("outside"),
    )
    part = F.col("_spot") - F.floor("_spot")
    gap = F.col("_high") - F.col("_low")
    value = F.when(part < 0.5, F.col("_low") + gap * part).otherwise(F.col("_high") - gap * (1 - part))
    return ends.select("column", "probability", value.alias("value"), "outside")


def quartiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: ``column, q1, median, q3``."""
    return side_by_side(exact_quantiles(df, columns, QUARTILES))


def side_by_side(found: DataFrame) -> DataFrame:
    """Quartiles as rows (column, probability, value) to ``column, q1, median, q3``."""
    def at(p: float) -> Column:
        return F.max(F.when(F.col("probability") == p, F.col("value")))

    return found.groupBy("column").agg(at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))


def fences(spread: DataFrame, factor: float = 1.5) -> DataFrame:
    """Add ``iqr, lower_bound, upper_bound`` to rows with ``q1`` and ``q3``."""
    iqr = F.col("q3") - F.col("q1")
    return spread.withColumns({
        "iqr": iqr,
        "lower_bound": F.col("q1") - factor * iqr,
        "upper_bound": F.col("q3") + factor * iqr,
    })


def iqr_bounds(df: DataFrame, column: str) -> DataFrame:
    """One row: ``q1, q3, iqr, lower_bound, upper_bound`` of one column."""
    return fences(quartiles(df, [column])).select("q1", "q3", "iqr", "lower_bound", "upper_bound")


def boxplot_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: whisker ends (extreme values inside the fences), quartiles, values outside."""
    spread = F.broadcast(fences(quartiles(df, columns)))  # one row per column
    value, low, high = F.col("value"), F.col("lower_bound"), F.col("upper_bound")
    inside = value.between(low, high)
    cells = long_values(df, columns, "double").join(spread, "column")
    return cells.groupBy("column", "q1", "median", "q3").agg(
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    ).select("column", "whisker_low", "q1", "median", "q3", "whisker_high", "n_outliers")
