"""Constraints as validation queries, and declarative expectations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starwash.functions.rules import not_in_set
from starwash.operators.dedupe import duplicate_key_count
from starwash.sources.staging import stage


class ValidationError(ValueError):
    """A table breaks a constraint and is not loaded."""


def foreign_key_orphans(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """``(foreign_key, key_value, n_rows)`` for fact keys absent from ``{key column: dimension}``.

    One pass over the fact for all keys: it is reduced map-side to one row per key column and value before those
    meet the keys of all dimensions in one anti-join. Keys of different types are compared and shown as text.
    """
    types = {fact.schema[key].dataType.simpleString() for key in dimensions}
    one_type = types.pop() if len(types) == 1 else "string"

    def pair(key: str) -> Column:
        return F.struct(F.lit(key).alias("foreign_key"), F.col(key).cast(one_type).alias("key_value"))

    used = fact.select(F.explode(F.array(*map(pair, dimensions))).alias("k")).groupBy("k.foreign_key", "k.key_value")
    held = reduce(DataFrame.unionByName, [dim.select(pair(key).alias("k")).select("k.*") for key, dim in dimensions.items()])
    return used.agg(F.count(F.lit(1)).alias("n_rows")).join(held, ["foreign_key", "key_value"], "left_anti")


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, n_null)`` for every required column that holds nulls; one pass over the data."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "n_null").filter("n_null > 0")


def unique_violations(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


@dataclass(frozen=True)
class TableRules:
    """What a table promises: columns without null, keys (null or not) that occur once."""

    not_null: Sequence[str]
    unique: Sequence[str]


def table_violations(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> DataFrame:
    """``(table_name, rule, column, n_broken)`` for every rule, zeros included.

    A table's null checks share one pass; ``unique`` counts the key values that occur more than once.
    """
    parts = []
    for name, own in rules.items():
        df = tables[name]
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in own.not_null])
        nulls = counts.unpivot([], list(own.not_null), "column", "n_broken")
        parts.append(nulls.select(F.lit(name).alias("table_name"), F.lit("not_null").alias("rule"), "column", "n_broken"))
        for key in own.unique:
            repeated = duplicate_key_count(df, key).select(F.col("duplicate_keys").alias("n_broken"))
            parts.append(repeated.select(
                F.lit(name).alias("table_name"), F.lit("unique").alias("rule"), F.lit(key).alias("column"), "n_broken"
            ))
    return reduce(DataFrame.unionByName, parts)


def require_valid(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> None:
    broken = table_violations(tables, rules).filter("n_broken > 0").collect()  # one row per rule at most
    if broken:
        raise ValidationError("; ".join(f"{r.table_name}.{r.column} {r.rule}: {r.n_broken}" for r in broken))


def require_foreign_keys(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> None:
    per_key = foreign_key_orphans(fact, dimensions).groupBy("foreign_key").agg(F.sum("n_rows").alias("n"))
    broken = {r["foreign_key"]: r["n"] for r in per_key.collect()}  # one row per foreign key
    if broken:
        raise ValidationError(f"rows without a dimension row: {broken}")


def require_unique(df: DataFrame, key: str) -> None:
    n = duplicate_key_count(df, key).first()["duplicate_keys"]
    if n:
        raise ValidationError(f"{n} duplicate {key} value(s)")


def require_not_null(df: DataFrame, columns: Sequence[str]) -> None:
    broken = {r["column"]: r["n_null"] for r in not_null_violations(df, columns).collect()}
    if broken:
        raise ValidationError(f"nulls in required columns: {broken}")


def require_rows(df: DataFrame) -> None:
    if df.isEmpty():
        raise ValidationError("no rows to load")


@dataclass(frozen=True)
class Expectation:
    """A named rule on one column; ``failed`` is a boolean expression that is never null.

    ``applies`` limits the rows that are checked.
    """

    rule: str
    column: str
    failed: Column
    applies: Column | None = None


def expect_not_null(column: str) -> Expectation:
    return Expectation("not_null", column, F.col(column).isNull())


def expect_between(column: str, low: float, high: float) -> Expectation:
    return Expectation("between", column, F.coalesce(~F.col(column).between(low, high), F.lit(True)))


def expect_in_set(column: str, values: Sequence[str]) -> Expectation:
    return Expectation("in_set", column, not_in_set(F.col(column), values))


def expect_within(column: str, expected: Column, limit: float, applies: Column | None = None) -> Expectation:
    off = F.coalesce(F.abs(F.col(column) - expected) > limit, F.lit(False))
    return Expectation("within_threshold", column, off, applies)


def check_expectations(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """``(rule, column, n_checked, n_failed, passed)``; all rules share one pass over the data."""
    counts = []
    for i, e in enumerate(expectations):
        applies = F.lit(True) if e.applies is None else e.applies
        counts += [F.count_if(applies).alias(f"_c{i}"), F.count_if(applies & e.failed).alias(f"_f{i}")]
    rows = F.array(*[
        F.struct(
            F.lit(e.rule).alias("rule"),
            F.lit(e.column).alias("column"),
            F.col(f"_c{i}").alias("n_checked"),
            F.col(f"_f{i}").alias("n_failed"),
            (F.col(f"_f{i}") == 0).alias("passed"),
        )
        for i, e in enumerate(expectations)
    ])
    return df.agg(*counts).select(F.inline(rows))


MAX_RULES = 62


@dataclass(frozen=True)
class Quarantine:
    """What expectations say of a table: ``counts`` as ``check_expectations``, the rows that meet all rules, and the
    others with ``reasons``, an array of ``rule(column)`` in the order of the expectations."""

    counts: DataFrame
    accepted: DataFrame
    rejected: DataFrame


def _mask(bits: Sequence[Column]) -> Column:
    return reduce(lambda x, y: x.bitwiseOR(y), [F.when(b, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, b in enumerate(bits)])


def quarantine(df: DataFrame, expectations: Sequence[Expectation], reasons: str = "reasons") -> Quarantine:
    """Evaluate all rules once per row, as a bit for each broken one, and derive counts and both tables from that.

    ``df`` is computed once and staged with two bit masks; the counts come from the few different pairs of masks.
    """
    if not 0 < len(expectations) <= MAX_RULES:
        raise ValueError(f"between 1 and {MAX_RULES} expectations")
    applies = [F.lit(True) if e.applies is None else F.coalesce(e.applies, F.lit(False)) for e in expectations]
    broken = [a & e.failed for a, e in zip(applies, expectations)]
    judged = stage(df.select(F.struct("*").alias("row"), _mask(applies).alias("checked"), _mask(broken).alias("broken")))

    pairs = judged.groupBy("checked", "broken").agg(F.count(F.lit(1)).alias("n"))

    def n_with(mask: str, place: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col(mask).bitwiseAND(F.lit(1 << place)) != 0, F.col("n"))), F.lit(0))

    sums = pairs.agg(*[n_with(mask, i).alias(f"{mask}{i}") for i in range(len(expectations)) for mask in ("checked", "broken")])
    counts = sums.select(F.inline(F.array(*[
        F.struct(
            F.lit(e.rule).alias("rule"), F.lit(e.column).alias("column"), F.col(f"checked{i}").alias("n_checked"),
            F.col(f"broken{i}").alias("n_failed"), (F.col(f"broken{i}") == 0).alias("passed"),
        )
        for i, e in enumerate(expectations)
    ])))
    names = [
        F.when(F.col("broken").bitwiseAND(F.lit(1 << i)) != 0, F.lit(f"{e.rule}({e.column})")) for i, e in enumerate(expectations)
    ]
    return Quarantine(
        counts,
        judged.filter("broken = 0").select("row.*"),
        judged.filter("broken <> 0").select("row.*", F.array_compact(F.array(*names)).alias(reasons)),
    )
