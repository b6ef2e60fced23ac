"""Row rules: fills, synonym maps, membership and validity flags, accuracy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from starwash.functions.text import strip

# Synonyms per standard value, matched on trimmed lower-case text.
GENDER_RULES = {"M": ["m", "male"], "F": ["f", "female"]}
PAYMENT_RULES = {
    "Credit Card": ["cc", "credit card", "card"],
    "PromptPay": ["pp", "promptpay", "prompt pay"],
    "Cash on Delivery": ["cod", "cash on delivery", "cash"],
    "Bank Transfer": ["transfer", "bank transfer", "bank_transfer"],
}
STATUS_RULES = {
    "Completed": ["completed", "done"],
    "Processing": ["processing"],
    "Cancelled": ["cancelled", "cancel"],
    "Returned": ["returned"],
}
ORDER_STATUSES = list(STATUS_RULES)
QUANTITY_RANGE = (1, 20)
ACCURACY_LIMIT = 1.0


def in_set(c: Column, values: Sequence[str]) -> Column:
    """Membership that is false, not null, for a null value."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def not_in_set(c: Column, values: Sequence[str]) -> Column:
    return ~in_set(c, values)


def differs_from(c: Column, value: str) -> Column:
    """Inequality that is true for a null value."""
    return ~c.eqNullSafe(value)


def standardize(c: Column, rules: Mapping[str, Sequence[str]], otherwise: str = "Unknown") -> Column:
    """Map synonyms to standard values; any other text, or null, becomes ``otherwise``."""
    key = F.lower(strip(c))
    return F.coalesce(*[F.when(key.isin(list(words)), name) for name, words in rules.items()], F.lit(otherwise))


def placeholder_email(email: Column, customer_id: Column) -> Column:
    own = F.concat(F.lit("unknown_"), F.coalesce(customer_id, F.lit("")), F.lit("@unknown.local"))
    return F.coalesce(email, own)


def invalid_quantity(quantity: Column) -> Column:
    return F.coalesce(~quantity.between(*QUANTITY_RANGE), F.lit(True))


def expected_amount(quantity: Column, price: Column, discount_rate: Column) -> Column:
    return quantity * price * (F.lit(1.0) - discount_rate)


def amount_mismatch(amount: Column, expected: Column, is_promotion: Column) -> Column:
    """True when the amount is off by more than the limit; promotions have their own prices."""
    off = F.coalesce(F.abs(amount - expected) > ACCURACY_LIMIT, F.lit(False))
    return off & differs_from(is_promotion, "Y")
