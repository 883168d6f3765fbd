"""Mathematical and bitwise functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_(value: Column, digits: int = 0) -> Column:
    """Half away from zero; negative digits round left of the point."""
    return F.round(value, digits)


def power(base: Column, exponent: Column) -> Column:
    return F.pow(base, exponent)


def mod(a: Column, b: Column) -> Column:
    """Remainder with the dividend's sign."""
    return a % b


def trunc(value: Column, digits: int = 0) -> Column:
    """Cuts towards zero."""
    return F.signum(value) * F.floor(F.abs(value) * F.lit(10.0**digits)) / F.lit(10.0**digits)


def strict_avg(value: Column) -> Column:
    """Average of integers as an integer, cut towards zero."""
    return trunc(F.avg(value)).cast("long")


def strict_div(a: Column, b: Column) -> Column:
    """Quotient of integers, cut towards zero."""
    return trunc(a / b).cast("long")


def bit_count(value: Column) -> Column:
    return F.bit_count(value)


def get_bit(value: Column, bit: Column) -> Column:
    return F.getbit(value, bit)


def left_shift(value: Column, bits: int) -> Column:
    return F.shiftleft(value, bits)


def right_shift(value: Column, bits: int) -> Column:
    """Logical shift."""
    return F.shiftrightunsigned(value, bits)


def bit_and(*values: Column) -> Column:
    return reduce(lambda a, b: a.bitwiseAND(b), values)


def bit_or(*values: Column) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), values)


def bit_xor(*values: Column) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), values)
