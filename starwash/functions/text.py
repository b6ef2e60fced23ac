"""Text standardisation: trimming, case, null tokens, e-mail, keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# The characters Python's str.strip() and \s treat as white space.
WHITE_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
# Texts a CSV reader of the pandas family takes as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Characters that have case, and a private-use character to mark word starts with.
CASED = r"\p{IsUppercase}\p{IsLowercase}\p{IsTitlecase}"
WORD_START = "\ue000 "

# Not a letter or blank, then a letter or anything beyond ASCII: a word start that no blank precedes.
# The characters are listed one by one, which the regex engine tests by table, unlike ranges.
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
NO_LETTERS = "".join(rf"\x{i:02x}" for i in range(128) if chr(i) not in LETTERS)
INNER_START = f"[^{LETTERS} ][^{NO_LETTERS}]"

# Texts of these characters only can have no white space but blanks.
PRINTABLE = "".join(rf"\x{i:02x}" for i in range(0x20, 0x7F))
NO_AT_OR_BLANK = "".join(rf"\x{i:02x}" for i in range(0x21, 0x7F) if chr(i) != "@")
PLAIN_EMAIL = rf"^[{NO_AT_OR_BLANK}]+@[{NO_AT_OR_BLANK}]+\.[{NO_AT_OR_BLANK}]+$"
EMAIL_SHAPE = r"^[^@]+@[^@]+\.[^@]+$"  # of text without white space


def strip(c: Column) -> Column:
    """Trim any Unicode white space (``trim`` alone only removes blanks).

    Most texts have printable ASCII characters at both ends, blanks apart, and need no search in the set.
    """
    trimmed = F.trim(c)
    plain = F.substring(trimmed, 1, 1).between("!", "~") & F.substring(trimmed, -1, 1).between("!", "~")
    return F.when(plain, trimmed).otherwise(F.btrim(c, F.lit(WHITE_SPACE)))


def squeeze(c: Column) -> Column:
    """Trimmed, and every run of white space as one blank.

    Most texts are plain characters with single blanks inside and need no more than a trim.
    """
    trimmed = F.trim(c)
    blanks = F.trim(F.translate(c, WHITE_SPACE, " " * len(WHITE_SPACE)))
    return F.when(
        trimmed.contains("  ") | trimmed.rlike(f"[^{PRINTABLE}]"), F.regexp_replace(blanks, " +", " ")
    ).otherwise(trimmed)


def title_case(c: Column) -> Column:
    """Capital after any character without case: ``o'brien 7-eleven`` -> ``O'Brien 7-Eleven``.

    ``initcap`` only starts a word after a blank, so a marker with a blank goes before the other word
    starts and is taken out again. Texts without such a start do not need it.
    """
    marked = F.regexp_replace(c, f"([^ {CASED}])(?=[{CASED}])", f"$1{WORD_START}")
    words = F.initcap(F.when(c.rlike(INNER_START), marked).otherwise(c))
    return F.replace(words, F.lit(WORD_START), F.lit(""))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def standard_text(c: Column) -> Column:
    """Trimmed, single-spaced, title-cased."""
    return title_case(squeeze(c))


def clean_text(c: Column) -> Column:
    """Trimmed and single-spaced; blank becomes null."""
    return empty_to_null(squeeze(c))


def title_case_text(c: Column) -> Column:
    """``clean_text`` in title case: names, products, categories."""
    return title_case(clean_text(c))


def clean_email(c: Column) -> Column:
    """Lower case without white space; anything not shaped like an address becomes null.

    Plain addresses are accepted as they are, others lose their white space and are looked at again.
    """
    plain = F.trim(c)
    packed = F.translate(c, WHITE_SPACE, "")
    return F.lower(F.when(plain.rlike(PLAIN_EMAIL), plain).when(packed.rlike(EMAIL_SHAPE), packed))


def normalize_key(c: Column) -> Column:
    """Matching key of an already cleaned value."""
    return F.lower(c)


def clean_columns(
    df: DataFrame, plain: Mapping[str, str], titled: Mapping[str, str], others: Mapping[str, Column],
    blank_to_null: bool = False,
) -> DataFrame:
    """Add text cleaned from source columns (``plain`` and ``titled``, which also gets title case) and ``others``,
    expressions over the columns of ``df``.

    A projection copies every row whole, which costs as much as a light expression. So there are two steps only: all
    columns at once, then title case, which uses its input twice. The sources are computed once per row.
    """
    clean = clean_text if blank_to_null else squeeze
    first = df.withColumns({**{n: clean(F.col(src)) for n, src in {**plain, **titled}.items()}, **others})
    return first.withColumns({n: title_case(F.col(n)) for n in titled})


def clean_text_columns(
    df: DataFrame, sources: dict[str, str], title: bool = False, blank_to_null: bool = False
) -> DataFrame:
    """Clean many columns (``{new name: source column}``), as :func:`clean_columns`."""
    return clean_columns(df, {} if title else sources, sources if title else {}, {}, blank_to_null)


def null_if_token(c: Column) -> Column:
    return F.when(~c.isin(NULL_TOKENS), c)


def quoted(name: str) -> str:
    """A column name for ``F.col`` and DDL, whatever its characters."""
    return "`" + name.replace("`", "``") + "`"


def null_tokens_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace null tokens in the given text columns (default: all text columns)."""
    names = columns if columns is not None else [n for n, t in df.dtypes if t == "string"]
    return df.withColumns({n: null_if_token(F.col(quoted(n))) for n in names})
