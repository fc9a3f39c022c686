"""Rounding and decimal text."""

from __future__ import annotations

import math
import re
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenloom.functions.booleans import bound, compare

# digits with an optional fraction and exponent; words such as NaN are not numbers
NUMBER_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def round_decimal(c: Column, places: int) -> Column:
    """Half-up rounding on the decimal value, so ties do not depend on binary noise."""
    return F.round(c.cast("decimal(38,10)"), places).cast("double")


def is_number_text(c: Column) -> Column:
    return F.coalesce(c.rlike(NUMBER_TEXT), F.lit(False))


def text_to_double(c: Column) -> Column:
    """A number with or without blanks around it; null for other text."""
    return F.when(F.trim(c).rlike(NUMBER_TEXT), c.try_cast("double"))


# what the shortest plain form leaves out, in this order: (pattern, replacement)
_SHORTEN = [
    (r"^\+", ""),
    (r"^(-?)0+(?=\d)", "$1"),
    (r"(\.\d*?)0+$", "$1"),
    (r"\.$", ""),
    (r"^(-?)\.", "$10."),
    (r"^-0$", "0"),
]


def normalize_number(c: Column) -> Column:
    """Plain decimal text without leading or trailing zeros; null past 38 digits.

    Text in scientific notation goes through DECIMAL(38,18); plain text is only
    trimmed, so it keeps all of its digits.
    """

    def shorten(text: Column) -> Column:
        plain = F.when(text.rlike("[eE]"), text.try_cast("decimal(38,18)").cast("string")).otherwise(text)
        plain = F.when(text.rlike(NUMBER_TEXT), plain)
        for pattern, replacement in _SHORTEN:
            plain = F.regexp_replace(plain, pattern, replacement)
        return plain

    def checked(number: Column) -> Column:
        digits = F.regexp_replace(F.regexp_replace(number, "[-.]", ""), "^0+", "")
        # zeros at the end of a whole number only give its size
        digits = F.when(number.contains("."), digits).otherwise(F.regexp_replace(digits, "0+$", ""))
        return F.when(F.length(digits) <= 38, number)

    return bound(bound(c, shorten), checked)


def order_text(c: Column) -> Column:
    """A text per number (as text, up to 38 digits and 130 places) that sorts like the number."""

    def key(number: Column) -> Column:
        size = F.ltrim(number, F.lit("-"))
        whole = F.lpad(F.split_part(size, F.lit("."), F.lit(1)), 130, "0")
        wide = F.concat(whole, F.lit("."), F.split_part(size, F.lit("."), F.lit(2)))
        # below zero the digits turn round, and a longer fraction comes first
        turned = F.concat(F.lit("-"), F.translate(wide, "0123456789", "9876543210"), F.lit(":"))
        return F.when(number.startswith("-"), turned).otherwise(F.concat(F.lit("0"), wide))

    return bound(normalize_number(c), key)


def _order_text(text: str) -> str | None:
    """``order_text`` of a literal in plain digits."""
    value = Decimal(text)
    whole, _, rest = f"{value.copy_abs():f}".partition(".")
    whole, rest = whole.lstrip("0"), rest.rstrip("0")
    if len((whole + rest).lstrip("0") if rest else whole.rstrip("0")) > 38:
        return None
    wide = f"{(whole or '0').rjust(130, '0')[:130]}.{rest}"
    if value < 0:
        return "-" + wide.translate(str.maketrans("0123456789", "9876543210")) + ":"
    return "0" + wide


# numbers that DECIMAL(38,12) holds, and numbers without an exponent
EXACT_TEXT = r"^[+-]?0*\d{0,26}(\.\d{0,12}0*)?$"
PLAIN_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)$"


def compare_to(number: Column, op: str, literal: int | float | Decimal | str) -> Column:
    """A number given as text against a literal: by value where a decimal or the digits can tell,

    else as doubles. Null for text that is no number. Doubles that are further apart than their rounding
    decide by themselves, so only values next to the literal are compared digit by digit."""
    text = str(literal)
    tests = F.when(~number.rlike(NUMBER_TEXT), F.lit(None).cast("boolean"))
    near = float(text)
    if math.isfinite(near):
        value = number.try_cast("double")
        tests = tests.when(F.abs(value - F.lit(near)) > F.lit(1e-14 * abs(near)), compare(value, op, F.lit(near)))
    if re.match(EXACT_TEXT, text):
        exact = compare(number.try_cast("decimal(38,12)"), op, F.lit(Decimal(text)).cast("decimal(38,12)"))
        tests = tests.when(number.rlike(EXACT_TEXT), exact)
    if re.match(PLAIN_TEXT, text):
        tests = tests.when(number.rlike(PLAIN_TEXT), compare(order_text(number), op, F.lit(_order_text(text))))
    return tests.otherwise(compare(number.try_cast("double"), op, F.lit(float(text))))


# numbers of which DECIMAL(28,9) holds sums and differences
_SHORT_TEXT = r"^[+-]?\d{1,18}(\.\d{1,9})?$"


def decimal_add(left: Column, right: Column) -> Column:
    """Sum of two numbers given as text, as normalised text."""
    return _exact(left, right, F.try_add)


def decimal_subtract(left: Column, right: Column) -> Column:
    return _exact(left, right, F.try_subtract)


def _exact(left: Column, right: Column, combine) -> Column:
    """The sum or difference at the finest scale that holds it; null beyond 38 digits.

    A number that a scale cannot hold without loss is null at that scale, so the first scale that
    fits both is exact. Short numbers, nearly all there are, take one scale and one replacement.
    """
    short = left.rlike(_SHORT_TEXT) & right.rlike(_SHORT_TEXT)
    sums = combine(*(c.try_cast("decimal(28,9)") for c in (left, right))).cast("string")
    tries = [F.when(short, F.regexp_replace(sums, r"\.?0+$", ""))]
    for scale in (0, 12, 24, 36):
        kind = f"decimal({37 if scale else 38},{scale})"
        a, b = (c.try_cast(kind) for c in (left, right))
        whole = (normalize_number(a.cast("string")) == normalize_number(left)) & (normalize_number(b.cast("string")) == normalize_number(right))
        tries.append(F.when(whole, normalize_number(combine(a, b).cast("string"))))
    return F.coalesce(*tries)
