"""Number parsing, rounding and derived measures."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Texts the cast accepts although they are no numbers in a CSV: 1d, 1f, 0x1p3, NaN, Infinity.
JAVA_NUMBER = r"[dDxX]|[0-9.][fF]|[nN][aA][nN]|[iI][nN][fF]"

# Money: a sign, a symbol or a code of up to three letters before or after, digits that are grouped by comma in
# threes or not at all, decimals; other text matches the last alternative, which leaves no groups.
_DIGITS = r"((?:\d{1,3}(?:,\d{3})+|\d+)(?:[.]\d*)?|[.]\d+)"
MONEY = rf"^(?:([+-]?)[ ]?(?:\p{{Sc}}|[A-Za-z]{{1,3}}[.]?)?[ ]?([+-]?){_DIGITS}[ ]?(?:\p{{Sc}}|[A-Za-z]{{2,3}})?|(?s:.*))$"
PLAIN_MONEY = r"^[$]?[0-9]{1,3}(?:(?:,[0-9]{3})+|[0-9]*)(?:[.][0-9]*)?\z"  # the most frequent of these shapes
BRACKETS = r"^\(([^()+-]*)\)$"


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def round_half_even(c: Column, digits: int = 2) -> Column:
    """numpy-style rounding of a binary double (``bround`` works on the decimal text and differs)."""
    scale = float(10**digits)
    return F.rint(c * scale) / scale


def parse_number(c: Column) -> Column:
    """Text to double, white space around it allowed; text that is not a finite number becomes null.

    The cast takes none of those other numbers that ends with a digit but hexadecimal ones, so most texts need no regex.
    """
    plain = F.substring(c, -1, 1).between("0", "9") & ~c.contains("x") & ~c.contains("X")
    return finite(F.when(plain | ~c.rlike(JAVA_NUMBER), c.try_cast("double")))


def finite(c: Column) -> Column:
    """Infinity, which a text of many digits parses to, as null; so is NaN.

    The remainder of a division by infinity is the number itself, of infinity it is NaN. ``nullif`` computes ``c``
    once, in a projection of its own; a condition on ``c`` would compute it a second time.
    """
    return F.nullif(c % F.lit(float("inf")), F.lit(float("nan")))


def parse_currency(c: Column) -> Column:
    """Money text such as ``$1,234.50``, ``Rs. 500`` or ``(100.50)``, which is negative, to double.

    Anything that is not wholly of this shape is null, never a number made of the digits in it. Plain amounts
    only lose their symbol and commas, which needs a test but no rewriting by regex.
    """
    trimmed = F.trim(c)
    signed = F.when(trimmed.startswith("("), F.regexp_replace(trimmed, BRACKETS, "-$1")).otherwise(trimmed)
    plain = F.replace(trimmed, F.lit("$"))
    digits = F.when(trimmed.rlike(PLAIN_MONEY), plain).otherwise(F.regexp_replace(signed, MONEY, "$1$2$3"))  # two signs do not cast
    return finite(F.replace(digits, F.lit(",")).try_cast("double"))


def net_amount(quantity: Column, price: Column, discount_percent: Column) -> Column:
    return round_half_even(quantity * price * (F.lit(1.0) - discount_percent / 100))


def impute_amount(amount: Column, quantity: Column, price: Column) -> Column:
    """Keep a known amount, else quantity times price when both are known."""
    return F.coalesce(amount, round_half_even(quantity * price))
