"""Text rules: splitting lines, reading doubles, writing pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_line(line: Column) -> Column:
    """Tokens of a line split on single spaces.

    Leading and inner empty tokens are kept, trailing ones dropped; an empty
    line is one empty token, a line of spaces only has none.
    """
    body = F.rtrim(line)
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(F.split(body, " "))
    )


# Fixed value: what Java reads as a double, surrounding control characters included.
JAVA_DOUBLE = (
    r"\A[\x00-\x20]*[+-]?"
    r"(NaN|Infinity"
    r"|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?"
    r"|0[xX]([0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][+-]?[0-9]+[fFdD]?"
    r")[\x00-\x20]*\z"
)


def cast_number(text: Column) -> Column:
    """``try_cast`` for texts that begin like a number, null for the others.

    A cast builds an exception for every word it meets, which is far slower
    than the look at one character.
    """
    first = F.ascii(text)
    digit_or_sign = first.between(ord("+"), ord("9"))
    word = first.isin(ord("N"), ord("I"))
    control = (first <= ord(" ")) & (text != "")
    return F.when(digit_or_sign | word | control, text.try_cast("double"))


def java_number(number: Column, text: Column) -> Column:
    """``number`` as cast from ``text``, null if Java does not spell it so.

    The cast takes ``inf`` or ``nan`` in any case.  Only non-finite results can
    come from those words, so ordinary numbers never pay for the pattern.
    """
    settled = number.isNull() | (F.abs(number) < float("inf"))
    return F.when(settled, number).when(text.rlike(JAVA_DOUBLE), number)


def parse_double(text: Column) -> Column:
    """Read a double by Java's text rules; null where the text is not one."""
    return java_number(cast_number(text), text)


def is_finite(value: Column) -> Column:
    """True for ordinary numbers, false for null, NaN and the infinities."""
    return F.coalesce(F.abs(value) < float("inf"), F.lit(False))


def pair_text(prediction: Column, label: Column) -> Column:
    """``(prediction,label)`` with no space, doubles in Java notation."""
    return F.concat(
        F.lit("("), prediction.cast("string"), F.lit(","), label.cast("string"), F.lit(")")
    )
