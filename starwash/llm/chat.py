"""Chat formatting: collapse cumulative snapshots of a conversation, then render what is left.

A log that stores a conversation again after every turn holds each of its prefixes as a conversation of its
own. Every turn gets the hash of the conversation up to it; a conversation whose whole hash is the hash up to
some turn of a longer one is a snapshot of that one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from starwash.operators.ordering import CHUNK, POSITION, sorted_chunks
from starwash.sources.staging import stage

TURNS_PER_PIECE = 1000
KEY = "conv"


def _carried(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Add to every row of sorted chunks what its conversation has in earlier chunks, and in total.

    ``values`` are aggregates that combine by themselves: counts as sums, hashes as exclusive or. One row
    per conversation and chunk meets here, never the turns.
    """
    parts = rows.groupBy(CHUNK, KEY).agg(*(c.alias(n) for n, c in values.items()))
    earlier = W.partitionBy(KEY).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(KEY)
    combine = {n: F.bit_xor if n.startswith("h") else F.sum for n in values}
    zero = F.lit(0).cast("long")
    sums = parts.select(
        CHUNK, KEY,
        *(F.coalesce(combine[n](n).over(earlier), zero).alias(f"{n}_before") for n in values),
        *(combine[n](n).over(every).alias(f"{n}_all") for n in values),
    )
    return rows.join(sums, [CHUNK, KEY])


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Turns with ``place`` (1, 2, ...), ``n`` turns of the conversation, and the hashes of all turns up to
    this one (``up1``, ``up2``) and of all turns (``all1``, ``all2``).

    The hash of a prefix is the exclusive or of its turns' hashes, each of which contains the turn's place,
    role and text; two hashes make 128 bits. Turns are sorted into chunks by conversation and turn, so that
    one conversation with much of the data spreads over many tasks.
    """
    named = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias(KEY), "conv_id", "turn",
        F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("order", F.xxhash64("role", "text"))
    chunks = sorted_chunks(named.filter("conv_id is not null"), KEY, F.col("turn").asc_nulls_last(), "order")
    in_chunk = W.partitionBy(CHUNK, KEY).orderBy(POSITION).rowsBetween(W.unboundedPreceding, 0)
    placed = _carried(chunks, {"n": F.count(F.lit(1))}).withColumn(
        "place", F.col("n_before") + F.count(F.lit(1)).over(in_chunk)
    )
    tagged = stage(placed.select(
        CHUNK, POSITION, KEY, "conv_id", "role", "text", "place", F.col("n_all").alias("n"),
        F.xxhash64(F.lit(1), "place", "role", "text").alias("t1"),
        F.xxhash64(F.lit(2), "text", "role", "place").alias("t2"),
    ))
    both = _carried(tagged, {"h1": F.bit_xor("t1"), "h2": F.bit_xor("t2")})
    return both.select(
        "conv_id", KEY, "role", "text", "place", "n",
        F.bit_xor("t1").over(in_chunk).bitwiseXOR(F.col("h1_before")).alias("up1"),
        F.bit_xor("t2").over(in_chunk).bitwiseXOR(F.col("h2_before")).alias("up2"),
        F.col("h1_all").alias("all1"), F.col("h2_all").alias("all2"),
    )


def maximal_conversations(hashed: DataFrame) -> DataFrame:
    """(conv): conversations that are no prefix of a longer one; of equal ones the smallest id.

    Both sides of the anti-join are grouped first, so a first turn or a conversation that a third of the
    log shares is one row on each side.
    """
    whole = hashed.filter("place = n").groupBy("n", "all1", "all2").agg(F.min("conv_id").alias("conv_id"))
    prefixes = hashed.filter("place < n").select(
        F.col("place").alias("n"), F.col("up1").alias("all1"), F.col("up2").alias("all2")
    ).distinct()
    return whole.join(prefixes, ["n", "all1", "all2"], "left_anti").select("conv_id")


def format_chats(turns: DataFrame, turns_per_piece: int = TURNS_PER_PIECE) -> DataFrame:
    """(conv_id, piece, n_turns, text): every maximal conversation rendered in turn order.

    A turn is rendered as ``<|role|>``, a line break, the text, ``<|end|>`` and a line break. A conversation
    of more than ``turns_per_piece`` turns continues in further pieces, so no row grows without bound.
    Rows without a conv_id belong to no conversation and are left out; a null role is ``unknown``, a null
    text empty, a null turn comes last; turns with the same number are ordered by a hash of their content,
    and repeated rows are turns of their own. A very long single turn is rendered whole, in the row of its piece.
    Other columns, whatever their names, are left out; an empty table gives an empty result.
    """
    hashed = stage(prefix_hashes(turns))
    kept = hashed.join(maximal_conversations(hashed), "conv_id", "left_semi")
    line = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("<|end|>\n"))
    piece = F.floor((F.col("place") - 1) / turns_per_piece).cast("long")
    parts = kept.groupBy("conv_id", piece.alias("piece")).agg(
        F.count(F.lit(1)).alias("n_turns"), F.array_sort(F.collect_list(F.struct("place", line.alias("line")))).alias("l")
    )
    return parts.select("conv_id", "piece", "n_turns", F.concat_ws("", "l.line").alias("text"))
