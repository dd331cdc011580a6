"""Money, ratio and address expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column) -> Column:
    """Exact two-place amount; sums of it do not depend on the order of rows."""
    return value.cast("decimal(18,2)")


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole``, 0 for an empty whole."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double") * 100.0).otherwise(F.lit(0.0))


def ipv4_number(text: Column) -> Column:
    """Dotted IPv4 text to its 32-bit number, NULL where it is not one."""
    octets = [F.try_element_at(F.split(text, r"\."), F.lit(i)) for i in range(1, 5)]
    numbers = [o.try_cast("long") for o in octets]
    value = (
        F.shiftleft(numbers[0], 24)
        .bitwiseOR(F.shiftleft(numbers[1], 16))
        .bitwiseOR(F.shiftleft(numbers[2], 8))
        .bitwiseOR(numbers[3])
    )
    return F.when(text.rlike(r"^(\d{1,3}\.){3}\d{1,3}$") & (F.greatest(*numbers) <= 255), value)


def ipv4_text(number: Column) -> Column:
    """32-bit number back to dotted text."""
    parts = [F.shiftright(number, shift).bitwiseAND(F.lit(255)).cast("string") for shift in (24, 16, 8, 0)]
    return F.concat_ws(".", *parts)


def ipv4_prefix(number: Column, length: int) -> Column:
    """The leading ``length`` bits of an address."""
    return F.shiftright(number, 32 - length)
