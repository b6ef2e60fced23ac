"""CSV scan and sink."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window as W, functions as F, types as T

from starwash.functions.text import null_tokens_to_null, quoted
from starwash.sources.csv_records import joined_records, lines_with_state, unclosed_files
from starwash.sources.staging import stage

REJECT = "_malformed"

#: Parts the fields of a line that is read as one field; text does not hold it.
NO_SEPARATOR = "\x01\x02\x01"
#: Fields that end in the line, then one that a quote opens and none closes. A quote opens a field only where the
#: field begins; later ones are text, and after a closing quote so is the rest of the field. Possessive, so that the
#: match takes one pass and no stack.
OPEN_AT_THE_END = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|),)*+"[^"]*+(?:""[^"]*+)*+$'
#: Splits of files, one row each: up to so many are broadcast, 30 bytes or so each.
MAX_BROADCAST_SPLITS = 1_000_000
ROW_BITS = 33
ROW_GROUP_BYTES = 32 << 20  # of staged lines


class MalformedCsv(ValueError):
    """A file holds rows that its header does not describe."""


def ends_in_quotes(line: Column) -> Column:
    """Whether a field goes on in the next line. Every line before it ended outside of quotes, or is reported."""
    may = line.startswith('"') | line.contains(',"')
    return F.when(may, line.rlike(OPEN_AT_THE_END)).otherwise(False)


def unbalanced_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line)`` of every line that ends inside a quoted field.

    Such a file needs ``multiline``; read line by line, its rows would fall apart unnoticed.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    return lines.filter(ends_in_quotes(F.col("line")))


def _raw_lines(spark: SparkSession, path: str, header: bool, strict: bool) -> DataFrame:
    """Lines without the headers, with the place of each; ``strict``: every file has the first one's header."""
    reader = spark.read.option("header", header).option("sep", NO_SEPARATOR).option("quote", "").option("escape", "")
    line = reader.csv(path).columns[0] if header else "line"
    lines = reader.schema(T.StructType([T.StructField(line, T.StringType())])).option("enforceSchema", not strict).csv(path)
    return lines.select(
        F.col(quoted(line)).alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("row"),
    )


def parsed_lines(
    spark: SparkSession, path: str, names: Sequence[str], header: bool, rejects: str | None, strict: bool
) -> DataFrame:
    """``(record, open, file, split, row)`` of every line: one scan of the files, lazily.

    ``open`` marks lines that end inside a quoted field; they have no record. A record has the columns ``names``
    as text and ``rejects``, if asked for; without it a line of another number of fields ends the read.
    """
    lines = _raw_lines(spark, path, header, strict).withColumn("open", ends_in_quotes(F.col("line")))
    return _parsed(lines, names, rejects)


def _parsed(lines: DataFrame, names: Sequence[str], rejects: str | None) -> DataFrame:
    fields = [f"{quoted(n)} string" for n in [*names, *([rejects] if rejects else [])]]
    options = {"escape": '"', "mode": "PERMISSIVE" if rejects else "FAILFAST"}
    if rejects:
        options["columnNameOfCorruptRecord"] = rejects
    record = F.when(~F.col("open"), F.from_csv("line", ", ".join(fields), options))
    return lines.select(record.alias("record"), "open", "file", "split", "row")


def scan_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    order_column: str | None = None,
    multiline: bool = False,
    types: Mapping[str, str] | None = None,
    rejects: str | None = None,
    header: bool = True,
) -> DataFrame:
    """Every column as text, null tokens as null. A missing path raises.

    The files are read once, here, into a staged table of the columns; what reads the result later reads only the
    columns it needs. A quote opens a field where the field begins and is text elsewhere. A field that goes on in
    the next line raises ``MalformedCsv`` unless ``multiline`` says that it is meant. A row with more or fewer
    fields than the header ends the read, or, when ``rejects`` names a column, has its text there (null in good
    rows); ``split_rejects`` parts them.

    Types are never inferred: that reads the data twice and depends on the rows at hand. ``types`` casts
    columns, and what does not cast becomes null. ``order_column`` adds a bigint that grows with the file and the
    position in it. Files are split between tasks, with ``multiline``, too. Files without ``header`` need ``columns``;
    where both are given, all files must begin with the first one's header line, and that must name the columns.
    """
    reader = spark.read.option("header", header).option("escape", '"').option("multiLine", multiline)
    found = reader.csv(path).columns if header or not columns else list(columns)
    names = list(columns) if columns else found
    strict = bool(header and columns and not rejects)
    if strict and [n.lower() for n in found] != [n.lower() for n in names]:
        raise MalformedCsv(f"the header names {found}, not {names}")
    seen = Observation()
    if multiline:
        lines = _records_of_lines(spark, path, header, strict)
    else:
        lines = _raw_lines(spark, path, header, strict).withColumn("open", ends_in_quotes(F.col("line")))
    parsed = _parsed(lines, names, rejects).observe(seen, F.min(F.when(F.col("open"), F.col("file"))).alias("file"))
    place = [F.struct("file", "split", "row").alias(order_column)] if order_column else []
    try:
        staged = stage(_typed(parsed.select("record.*", *place), names, types))
    except Exception as failure:  # of Spark or, for what it does not know, of the JVM bridge
        # A broken row may be the rest of a field that goes on; only a failed read looks for the cause.
        broken = [] if multiline else unbalanced_lines(spark, path).limit(1).collect()
        if broken:
            raise _line_break(broken[0].file) from failure
        raise
    if seen.get["file"]:
        raise _line_break(seen.get["file"])
    return _with_ordinal(staged, order_column) if order_column else staged


def _records_of_lines(spark: SparkSession, path: str, header: bool, strict: bool) -> DataFrame:
    """As ``_raw_lines``, but records, whose quoted fields may hold line breaks; ``open`` is false.

    The files are split between tasks and read once, into a staged table of lines. A line break inside a field
    becomes a line feed.
    """
    line = F.col("value")
    lines = stage(spark.read.text(path).select(
        line.alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("row"),
        ends_in_quotes(line).alias("outside"), ends_in_quotes(F.concat(F.lit('"'), line)).alias("inside"),
    ), ROW_GROUP_BYTES)
    states = stage(lines_with_state(lines.drop("line")))
    unclosed = unclosed_files(states).limit(1).collect()
    if unclosed:
        raise MalformedCsv(f"a quoted field in {unclosed[0].file} never closes")
    records = joined_records(lines.select("line", "file", "split", "row"), states)
    if header:
        if strict:
            heads = records.filter("first").select("line").distinct().limit(2).collect()
            if len(heads) > 1:
                raise MalformedCsv("the files have different header lines")
        records = records.filter("not first")
    return records.filter(F.trim("line") != "").drop("first").withColumn("open", F.lit(False))


def _line_break(file: str) -> MalformedCsv:
    return MalformedCsv(f"quoted line break in {file}: pass multiline=True")


def _typed(df: DataFrame, names: Sequence[str], types: Mapping[str, str] | None) -> DataFrame:
    text = null_tokens_to_null(df, list(names))
    return text.withColumns({c: F.col(quoted(c)).try_cast(t) for c, t in types.items()}) if types else text


def _with_ordinal(staged: DataFrame, order_column: str) -> DataFrame:
    """The place (file, split, row) of each row as one bigint: the rank of its split, then the row inside it.

    There is one split per 128 MB or file, so their ranks are found in one task and joined.
    """
    splits = staged.select(f"{order_column}.file", f"{order_column}.split").distinct()
    rank = F.row_number().over(W.orderBy("file", "split")).cast("bigint")
    ranks = stage(splits.select(F.struct("file", "split").alias("_split"), rank.alias("_rank")))
    if ranks.count() <= MAX_BROADCAST_SPLITS:
        ranks = F.broadcast(ranks)
    place = F.struct(f"{order_column}.file", f"{order_column}.split")
    ordinal = F.shiftleft("_rank", ROW_BITS).bitwiseOR(F.col(f"{order_column}.row"))
    joined = staged.join(ranks, place == F.col("_split"))
    return joined.select(*[ordinal.alias(c) if c == order_column else F.col(quoted(c)) for c in staged.columns])


def split_rejects(scanned: DataFrame, rejects: str = REJECT) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed rows as text) of a scan with ``rejects``."""
    bad = F.col(rejects).isNotNull()
    return scanned.filter(~bad).drop(rejects), scanned.filter(bad).select(rejects)


def write_csv(df: DataFrame, path: str, drop: Sequence[str] = ()) -> None:
    """CSV with a header, without the helper columns named in ``drop``."""
    (
        df.drop(*drop)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
