"""What several corpus operators share: reading tables, the definition of a word, names that cannot clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word of a text: everything between blanks and the control characters tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"

ROW = "row"

#: Row groups of staged texts: a writing task holds one, beside the Python worker that reads the texts.
TEXT_GROUP_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wrapped(df: DataFrame, **working: Column | str) -> DataFrame:
    """All columns of ``df`` as one struct ``row`` beside working columns.

    Working names can then not clash with any column of the input; ``unwrapped`` restores the input.
    """
    return df.select(
        F.struct("*").alias(ROW),
        *((F.col(c) if isinstance(c, str) else c).alias(name) for name, c in working.items()),
    )


def unwrapped(df: DataFrame) -> DataFrame:
    return df.select(f"{ROW}.*")


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text, null as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))



def bounded_sample(df: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` distinct rows, chosen by a hash of their content: the same on every run.

    Above twice that many, only hashes in a share of the hash range are ordered, so that each task hands on
    about its share of ``rows`` and not ``rows`` of its own.
    """
    names = df.columns
    hashed = df.distinct().withColumn("h", F.xxhash64(*names))
    total = hashed.count()
    if total > 2 * rows:
        hashed = hashed.filter(F.pmod("h", F.lit(1 << 30)) < int((1 << 30) * (2 * rows / total)))
    return hashed.orderBy("h", *names).limit(rows).select(*names)
