"""Conditional, conversion and null functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import UnsupportedFeatureError


def iif(condition: Column, then: Column, otherwise: Column) -> Column:
    return F.when(condition, then).otherwise(otherwise)


def choose(index: Column, *values: Column) -> Column:
    """The index-th value (from 1), null out of range."""
    return F.get(F.array(*values), index - 1)


def try_cast(value: Column, to: str) -> Column:
    return value.try_cast(to)


#: Conversion styles and the patterns they mean (fixed values).
STYLES = {101: "MM/dd/yyyy", 103: "dd/MM/yyyy", 104: "dd.MM.yyyy", 105: "dd-MM-yyyy", 110: "MM-dd-yyyy", 111: "yyyy/MM/dd", 112: "yyyyMMdd", 120: "yyyy-MM-dd HH:mm:ss", 126: "yyyy-MM-dd'T'HH:mm:ss"}


def try_convert(value: Column, to: str, style: int | None = None) -> Column:
    if style is None:
        return value.try_cast(to)
    if style not in STYLES:
        raise UnsupportedFeatureError(f"style {style}")
    return F.try_to_timestamp(value, F.lit(STYLES[style])).cast(to)


def try_parse(value: Column, to: str, culture: str = "en-US") -> Column:
    """Numbers may hold thousands separators; other cultures than en-US are declined."""
    if culture.lower() not in ("en-us", ""):
        raise UnsupportedFeatureError(f"culture {culture}")
    plain = F.regexp_replace(F.trim(value), r"(?<=\d),(?=\d{3})", "") if to.split("(")[0] in ("int", "long", "bigint", "double", "float", "decimal") else F.trim(value)
    return plain.try_cast(to)


def coalesce(*values: Column) -> Column:
    return F.coalesce(*values)


def nullif(a: Column, b: Column) -> Column:
    return F.nullif(a, b)
