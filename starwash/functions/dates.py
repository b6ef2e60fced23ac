"""Date parsing with audit labels, calendar parts and load delay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starwash.functions.text import WHITE_SPACE, strip

DAY = r"(?:3[01]|[12]\d|0?[1-9])"
MONTH = r"(?:1[0-2]|0?[1-9])"
YEAR = r"(?!0000)\d{4}"
AROUND = "[" + "".join(rf"\u{ord(c):04x}" for c in WHITE_SPACE) + "]*"  # what ``strip`` removes

MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"  # the first letters of each

# Label of each way an ambiguous date was read (fixed values).
ISO = "ISO_format"
DMY_CERTAIN = "DD_MM_YYYY_unambiguous"
MDY_CERTAIN = "MM_DD_YYYY_unambiguous"
DMY_BY_LOAD = "DD_MM_YYYY_by_load_ts"
MDY_BY_LOAD = "MM_DD_YYYY_by_load_ts"
DMY_ASSUMED = "DD_MM_YYYY_default_assumption"
UNPARSEABLE = "UNPARSEABLE"
IMPUTED_LABELS = [UNPARSEABLE, DMY_BY_LOAD, MDY_BY_LOAD, DMY_ASSUMED]


def _rearranged(s: Column, shape: str, order: str) -> Column:
    """Date from text of a shape; ``order`` puts its groups as year-month-day. Null when it is no date.

    Other text matches the second alternative, which leaves no groups. The cast of a wrong day gives
    null at no cost, where a format-driven parser throws once per row.
    """
    return F.regexp_replace(s, f"(?s)^(?:{shape}|.*)$", order).try_cast("date")


def _ten_characters(c: Column) -> tuple[Column, Column]:
    """Dates from ``2024-01-05`` and from ``05/01/2024``, null for any other text, without a regex.

    The separators lie at their places and the day ends with a digit, so the cast has only digits to accept.
    """
    ten, digits = F.length(c) == 10, ("0", "9")
    iso = ten & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-") & F.substring(c, 10, 1).between(*digits)
    dmy = ten & (F.substring(c, 3, 1) == "/") & (F.substring(c, 6, 1) == "/") & F.substring(c, 2, 1).between(*digits)
    turned = F.concat_ws("-", F.substring(c, 7, 4), F.substring(c, 4, 2), F.substring(c, 1, 2))
    return (
        F.when(iso & ~c.startswith("0000"), c.try_cast("date")),
        F.when(dmy & ~c.endswith("0000"), turned.try_cast("date")),
    )


def _numeric_date(c: Column, year_first: str, day_first: str) -> Column:
    """Both numeric orders at once, white space around allowed; the arguments are their separators.

    The usual ten characters are read by their places, other text by the regex.
    """
    ymd = rf"({YEAR}){year_first}({MONTH}){year_first}({DAY})"
    dmy = rf"({DAY}){day_first}({MONTH}){day_first}({YEAR})"
    return F.coalesce(*_ten_characters(c), _rearranged(c, f"{AROUND}(?:{ymd}|{dmy}){AROUND}", "$1$6-$2$5-$3$4"))


def _eleven_characters(c: Column) -> Column:
    """Date from ``05-Jan-2024``, null for any other text, read by places as above."""
    place = F.instr(F.lit(MONTHS), F.lower(F.substring(c, 4, 3)))
    shape = (F.length(c) == 11) & (F.substring(c, 3, 1) == "-") & (F.substring(c, 7, 1) == "-") & (place % 3 == 1)
    shape = shape & F.substring(c, 2, 1).between("0", "9") & ~c.endswith("0000")
    turned = F.concat_ws("-", F.substring(c, 8, 4), F.floor(place / 3) + 1, F.substring(c, 1, 2))
    return F.when(shape, turned.try_cast("date"))


def _named_month(s: Column, shape: str, pattern: str) -> Column:
    return F.when(s.rlike(shape), F.try_to_timestamp(s, F.lit(pattern)).cast("date"))


def parse_dates(c: Column) -> Column:
    """``2024-01-05``, ``05-Jan-2024`` or ``05/01/2024`` (day first); anything else is null."""
    s = strip(c)
    return F.coalesce(
        _eleven_characters(c),
        _numeric_date(c, "-", "/"),
        _named_month(s, rf"^\d{{1,2}}-[A-Za-z]{{3}}-{YEAR}$", "d-MMM-yyyy"),
    )


def parse_flexible_date(c: Column) -> Column:
    """``parse_dates`` plus ``2024/01/05``, ``05-01-2024`` (day first) and ``Jan 5, 2024``."""
    s = strip(c)
    return F.coalesce(
        _numeric_date(c, "[-/]", "[-/]"),
        _named_month(s, rf"^\d{{1,2}}-[A-Za-z]{{3}}-{YEAR}$", "d-MMM-yyyy"),
        _named_month(s, rf"^[A-Za-z]{{3}} \d{{1,2}}, {YEAR}$", "MMM d, yyyy"),
    )


def resolve_ambiguous_date(
    df: DataFrame, text: str, load_date: Column, date_to: str, method_to: str
) -> DataFrame:
    """Add the date read from ``text`` and the label of how it was decided.

    Two numbers before the year are day-month or month-day. A number above 12 settles it, then the
    reading that equals the load date, then day-month. Unreadable text has a null date.
    """
    s = strip(F.col(text))
    two_numbers = rf"(\d{{1,2}})[-/](\d{{1,2}})[-/]({YEAR})"
    readings = df.withColumns({
        "_iso": _rearranged(s, rf"({YEAR})[-/](\d{{2}})[-/](\d{{2}})", "$1-$2-$3"),
        "_dmy": _rearranged(s, two_numbers, "$3-$2-$1"),
        "_mdy": _rearranged(s, two_numbers, "$3-$1-$2"),
        "_load": load_date,
    })
    iso, dmy, mdy, load = (F.col(c) for c in ("_iso", "_dmy", "_mdy", "_load"))
    # A real date has a month of at most 12, so "a number above 12" is "the other reading is no date".
    method = (
        F.when(iso.isNotNull(), ISO)
        .when(dmy.isNotNull() & mdy.isNull(), DMY_CERTAIN)
        .when(mdy.isNotNull() & dmy.isNull(), MDY_CERTAIN)
        .when(dmy == load, DMY_BY_LOAD)
        .when(mdy == load, MDY_BY_LOAD)
        .when(dmy.isNotNull(), DMY_ASSUMED)
        .otherwise(UNPARSEABLE)
    )
    chosen = F.when(F.col(method_to) == ISO, iso).when(F.col(method_to).startswith("MM"), mdy).otherwise(dmy)
    return (
        readings.withColumn(method_to, method)
        .withColumn(date_to, chosen)
        .drop("_iso", "_dmy", "_mdy", "_load")
    )


def date_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def calendar_parts(date: Column) -> dict[str, Column]:
    return {
        "year": F.year(date).cast("bigint"),
        "quarter": F.quarter(date).cast("bigint"),
        "month": F.month(date).cast("bigint"),
        "month_name": F.date_format(date, "MMMM"),
        "day": F.dayofmonth(date).cast("bigint"),
        "weekday_name": F.date_format(date, "EEEE"),
    }


def hours_between(start: Column, end: Column) -> Column:
    """Fractional wall-clock hours from ``start`` to ``end``; negative when ``end`` is earlier.

    Both lose their time zone first, so a clock change of the session's zone does not count.
    """
    gap = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    part = {p: F.extract(F.lit(p), gap).cast("double") for p in ("DAY", "HOUR", "MINUTE", "SECOND")}
    return part["DAY"] * 24 + part["HOUR"] + (part["MINUTE"] * 60 + part["SECOND"]) / 3600


def is_late(delay_hours: Column, limit: float = 24.0) -> Column:
    return F.coalesce(delay_hours > limit, F.lit(False))
