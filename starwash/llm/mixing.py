"""Mix sources to target weights: capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from starwash.llm.common import WORD, unwrapped, wrapped
from starwash.sources.staging import stage

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BUCKETS = 4096
SEED = 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from one row per source (source, source_size).

    Sources by code point, null last, take the weights in turn. Together the targets are the size of all
    sources. The water level is found on sources sorted by how early they reach ``max_epochs``: with the
    first k full, the level is what is left over the weight that is left. It rises as long as the next
    source is over its cap and falls after that, so the highest one is where repeated redistribution ends.
    The windows run over one row per source, not over documents: right for thousands of sources, but millions of
    hosts as sources would meet in one task. Sources without a word get the target 0.
    """
    in_order = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double")
    cap = (F.col("source_size") * max_epochs).cast("double")
    by_fill = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = by_fill.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    level = sizes.withColumns({"weight": weight, "cap": cap}).withColumns({
        "left": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "weight_left": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    water = F.max(F.col("left") / F.col("weight_left")).over(everything)
    target = F.least(F.col("cap"), F.col("weight") * water)
    return level.select("source", "source_size", target.alias("target"))


def _bucket(seed: int) -> Column:
    """The first twelve bits of a digest of seed, id and size, a number below BUCKETS."""
    key = F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"), F.col("size").cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 3), 16, 10).cast("long")


def plan(sized: DataFrame, weights: Sequence[float], max_epochs: float, seed: int) -> DataFrame:
    """One row per source: target, whole repetitions and the hash bucket below which one more copy is taken.

    A document falls in one of BUCKETS by its seeded hash. Words are summed per source and bucket (map-side
    first, so a source with a third of all rows is a few thousand rows), and the bucket is chosen at which
    the words below it come nearest to the fraction that is wanted.
    """
    sums = stage(sized.groupBy("source", _bucket(seed).alias("bucket")).agg(F.sum("size").alias("words")))
    goals = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goals = goals.withColumn("whole", F.floor(epochs)).withColumn(
        "wanted", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))
    )
    upto = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    filled = sums.withColumn("filled", F.sum("words").over(upto))
    miss = F.abs(F.col("g.wanted") - F.col("f.filled"))
    edges = (
        goals.alias("g")
        .join(filled.alias("f"), F.col("g.source").eqNullSafe(F.col("f.source")))
        .filter(miss < F.col("g.wanted"))  # else none at all is nearer
        .groupBy(F.col("g.source").alias("s"))
        .agg(F.min(F.struct(miss, F.col("f.bucket"))).alias("best"))
        .select("s", (F.col("best.bucket") + 1).alias("edge"))
    )
    return goals.join(edges, goals["source"].eqNullSafe(edges["s"]), "left").select(
        goals["source"].alias("plan_source"), "source_size", "target", "whole",
        F.coalesce("edge", F.lit(0)).alias("edge"),
    )


def with_copies(df: DataFrame, weights: Sequence[float], max_epochs: float, seed: int) -> DataFrame:
    """Add source_size, target and copies to rows that have doc_id, source and size."""
    narrow = df.select("doc_id", "source", "size")
    sources = stage(plan(narrow, weights, max_epochs, seed))
    copies = F.col("whole") + (_bucket(seed) < F.col("edge")).cast("long")
    return df.join(sources, F.col("source").eqNullSafe(F.col("plan_source"))).withColumn("copies", copies)


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS, seed: int = SEED
) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``.

    ``taken`` is the size times the copies the mix holds: all whole repetitions of the source, and one more
    for a seeded choice of documents. Null is a source of its own, a null text has size 0 and takes 0.
    Rows repeated with the same id and size are chosen together; an empty table gives an empty result. The words of
    a very long text are counted whole; other columns, whatever their names, are left out.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return with_copies(stage(sized), weights, max_epochs, seed).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed_documents(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS, seed: int = SEED
) -> DataFrame:
    """The rows of ``docs``, all their columns, each as often as ``mix`` takes it.

    Column names may be those used here; texts and empty tables as in ``mix``.
    """
    sized = wrapped(
        docs, doc_id=F.col("doc_id"), source=F.col("source"), size=word_count(F.col("text"))
    )
    chosen = with_copies(sized, weights, max_epochs, seed).filter("copies > 0")
    repeated = chosen.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return unwrapped(repeated)
