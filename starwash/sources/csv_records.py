"""Records of CSV files whose quoted fields hold line breaks, without reading a file in one task.

A line is a function from the state it begins in to the state it ends in: outside of quotes or inside. Most lines are
constant (they end outside, however they begin) or leave the state as it is; one lone quote flips it. The functions of
a split's lines compose to one of the split, those of a file's splits, one row each, to the state in which every split
begins, and that gives the state in which every line begins. Lines that begin inside a quoted field are joined to the
line where their record starts; all others are records as they are, and never move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from starwash.sources.staging import stage

PLACE = ["file", "split", "row"]


def _odd(x: Column) -> Column:
    return F.pmod(x, F.lit(2)) == 1


def _xor(a: Column, b: Column) -> Column:
    return a != b


def _begins(before: WindowSpec, constant: Column, flips: Column, first: Column) -> Column:
    """The state after the steps in the window ``before``, beginning with ``first``.

    A step is a constant (a state) or null, and then a number of flips, odd or even. Only the last constant and the
    flips after it count.
    """
    so_far = F.coalesce(F.sum(flips).over(before), F.lit(0))
    last = F.last(F.when(constant.isNotNull(), F.struct(constant.alias("state"), F.col("_flips_upto").alias("flips"))), True)
    seen = last.over(before)
    return F.when(seen.isNotNull(), _xor(seen["state"], _odd(so_far - seen["flips"]))).otherwise(_xor(first, _odd(so_far)))


def lines_with_state(lines: DataFrame) -> DataFrame:
    """``(file, split, row, open, end, start_split, start_row, first)`` from ``(file, split, row, outside, inside)``.

    ``outside`` and ``inside`` say whether a line ends inside quotes when it begins outside or inside. ``open``: it
    begins inside; ``end``: it ends inside; ``start_*``: the place of the line where its record starts; ``first``: it
    starts its file's first record.
    """
    in_split = W.partitionBy("file", "split").orderBy("row")
    upto, before = in_split.rowsBetween(W.unboundedPreceding, 0), in_split.rowsBetween(W.unboundedPreceding, -1)
    constant = F.when(F.col("outside") == F.col("inside"), F.col("outside"))
    flips = (F.col("outside") & ~F.col("inside")).cast("int")
    steps = lines.withColumns({"_constant": constant, "_flips": flips}).withColumn("_flips_upto", F.sum("_flips").over(upto))
    begins = {
        state: _begins(before, F.col("_constant"), F.col("_flips"), F.lit(state == "_if_inside"))
        for state in ("_if_outside", "_if_inside")
    }
    steps = stage(steps.withColumns(begins).withColumn("_last", F.lead("row").over(in_split).isNull()))

    def ends(begin: Column) -> Column:
        return F.when(begin, F.col("inside")).otherwise(F.col("outside"))

    # One row per split: its function, then the state in which it begins.
    splits = steps.filter("_last").select(
        "file", "split", ends(F.col("_if_outside")).alias("outside"), ends(F.col("_if_inside")).alias("inside")
    )
    in_file = W.partitionBy("file").orderBy("split")
    splits = splits.withColumns({"_constant": constant, "_flips": flips}).withColumn(
        "_flips_upto", F.sum("_flips").over(in_file.rowsBetween(W.unboundedPreceding, 0))
    )
    begin = _begins(in_file.rowsBetween(W.unboundedPreceding, -1), F.col("_constant"), F.col("_flips"), F.lit(False))
    splits = stage(splits.select("file", "split", begin.alias("_begin")))
    known = steps.join(splits, ["file", "split"]).withColumn(
        "open", F.when(F.col("_begin"), F.col("_if_inside")).otherwise(F.col("_if_outside"))
    )
    known = known.withColumn("end", ends(F.col("open")))
    start = F.last(F.when(~F.col("open"), F.col("row")), True).over(upto)
    known = stage(known.withColumn("_start", start).select(*PLACE, "open", "end", "_start", "_last"))

    # A record that goes on over splits starts at the last line of an earlier one that begins outside.
    here = F.when(F.col("_start").isNotNull(), F.struct("split", F.col("_start").alias("row")))
    earlier = F.last(here, True).over(in_file.rowsBetween(W.unboundedPreceding, -1))
    carried = known.filter("_last").select("file", "split", earlier.alias("_carried"))
    placed = known.join(carried, ["file", "split"]).withColumns({
        "start_split": F.when(F.col("_start").isNotNull(), F.col("split")).otherwise(F.col("_carried.split")),
        "start_row": F.coalesce("_start", "_carried.row"),
    })
    # A file's first record starts in its first line: of the split at 0, the least row.
    heads = lines.filter("split = 0").groupBy("file").agg(F.min("row").alias("_head"))
    first = (F.col("start_split") == 0) & (F.col("start_row") == F.col("_head"))
    return placed.join(heads, "file").select(*PLACE, "open", "end", "start_split", "start_row", first.alias("first"))


def unclosed_files(states: DataFrame) -> DataFrame:
    """Files that end inside a quoted field: the last line of each that does."""
    at = F.max(F.struct("split", "row")).alias("at")
    ends, finish = states.filter("end").groupBy("file").agg(at), states.groupBy("file").agg(at)
    return ends.join(finish, ["file", "at"]).select("file")


def joined_records(lines: DataFrame, states: DataFrame) -> DataFrame:
    """``(line, file, split, row, first)``: one row per record, at the place where it starts, its lines joined by
    line breaks.

    Only lines of records of several lines and file heads meet the states; the others stay where they lie. The lines of
    one record are collected, so it must fit a task; a file whose quotes never close is to be refused before.
    """
    goes_on = states.filter(F.col("open") | F.col("end") | F.col("first"))
    several = stage(goes_on.select(*PLACE, "start_split", "start_row", "first"))
    alone = lines.join(several.select(*PLACE), PLACE, "left_anti")
    pieces = lines.join(several, PLACE).groupBy("file", "start_split", "start_row", "first").agg(
        F.sort_array(F.collect_list(F.struct("split", "row", "line"))).alias("pieces")
    )
    whole = F.array_join(F.transform("pieces", lambda p: p["line"]), "\n")
    together = pieces.select(
        whole.alias("line"), "file", F.col("start_split").alias("split"), F.col("start_row").alias("row"), "first"
    )
    return alone.select("line", *PLACE, F.lit(False).alias("first")).unionByName(together)
