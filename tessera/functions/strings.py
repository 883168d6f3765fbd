"""String functions with enterprise-SQL meaning."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import UnsupportedFeatureError

#: Collation names of the SQL dialect and the Spark collation each stands for (fixed values).
COLLATIONS = {
    "latin1_general_ci_as": "UNICODE_CI",
    "latin1_general_cs_as": "UNICODE",
    "sql_latin1_general_cp1_ci_as": "UNICODE_CI",
    "sql_latin1_general_cp1_cs_as": "UNICODE",
    "latin1_general_bin2": "UTF8_BINARY",
    "latin1_general_100_bin2_utf8": "UTF8_BINARY",
    "database_default": "UTF8_BINARY",
}


def collate(s: Column, name: str) -> Column:
    if name.lower() not in COLLATIONS:
        raise UnsupportedFeatureError(f"collation {name}")
    return F.collate(s, COLLATIONS[name.lower()])


def len_(s: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(s))


def trim_chars(s: Column, chars: str | None = None) -> Column:
    return F.trim(s) if chars is None else F.btrim(s, F.lit(chars))


def concat_ws(sep: str, *parts: Column) -> Column:
    """Joins what isn't null."""
    return F.concat_ws(sep, *parts)


def string_split(s: Column, sep: str) -> Column:
    """Array of the parts; the separator is literal and empty parts stay."""
    return F.split(s, re.sub(r"([^A-Za-z0-9 ])", r"\\\1", sep), -1)


def find_in_set(value: Column, members: Column) -> Column:
    """Position (from 1) of a value in a comma list, 0 if it isn't there."""
    return F.find_in_set(value, members)


def set_literal(values: list[str]) -> str:
    """Sorted comma list of at most 64 members without commas."""
    if len(set(values)) > 64 or any("," in v for v in values):
        raise ValueError("a set has at most 64 members, none with a comma")
    return ",".join(sorted(set(values)))


def set_contains_all(members: Column, values: list[str]) -> Column:
    return F.size(F.array_except(F.array(*[F.lit(v) for v in values]), F.split(members, ","))) == 0


def elt(index: Column, *values: Column) -> Column:
    """The index-th value (from 1), null out of range."""
    return F.get(F.array(*values), index - 1)


def field(value: Column, *values: Column) -> Column:
    """Position (from 1) of the value among the others, 0 if missing."""
    return F.coalesce(F.array_position(F.array(*values), value), F.lit(0)).cast("long")


#: Format tokens of .NET dates and the Java tokens they become (fixed values).
DATE_TOKENS = {"yyyy": "yyyy", "yy": "yy", "MMMM": "MMMM", "MMM": "MMM", "MM": "MM", "M": "M", "dddd": "EEEE", "ddd": "EEE", "dd": "dd", "d": "d", "HH": "HH", "H": "H", "hh": "hh", "h": "h", "mm": "mm", "m": "m", "ss": "ss", "s": "s", "fff": "SSS", "tt": "a"}


def format_date(value: Column, pattern: str) -> Column:
    """FORMAT of a date or time, invariant culture."""
    tokens = sorted(DATE_TOKENS, key=len, reverse=True)
    return F.date_format(value, re.sub("|".join(tokens), lambda m: DATE_TOKENS[m[0]], pattern))


def format_number(value: Column, pattern: str) -> Column:
    """FORMAT of a number, invariant culture: ``N<digits>``, ``F<digits>``, ``D<width>``, ``P<digits>`` (percent), ``C<digits>``
    (currency, negative in brackets), or a picture of ``#``, ``0``, ``,`` and one ``.``, such as ``#,##0.00``."""
    if re.fullmatch(r"[#0,]+(\.[#0]+)?", pattern):
        return _picture(value, pattern)
    if not re.fullmatch(r"[A-Za-z]\d*", pattern):
        raise UnsupportedFeatureError(f"number format {pattern}")
    kind, digits = pattern[0].upper(), int(pattern[1:] or 2)
    if kind == "P":
        return F.concat(F.format_number(value * 100, digits), F.lit(" %"))
    if kind == "C":
        plain = F.concat(F.lit("\u00a4"), F.format_number(F.abs(value), digits))
        return F.when(value < 0, F.concat(F.lit("("), plain, F.lit(")"))).otherwise(plain)
    if kind == "N":
        return F.format_number(value, digits)
    if kind == "F":
        return F.format_string(f"%.{digits}f", value.cast("double"))
    if kind == "D":
        text = value.cast("long").cast("string")
        plain = F.ltrim(text, F.lit("-"))
        # the width is the least number of digits: longer numbers stay whole, and the sign stands before the zeros
        return F.concat(F.when(text.startswith("-"), "-").otherwise(""), F.lpad(plain, F.greatest(F.length(plain), F.lit(digits)), F.lit("0")))
    raise UnsupportedFeatureError(f"number format {pattern}")


def _picture(value: Column, pattern: str) -> Column:
    """Digits of a picture: zeros are always there, ``#`` only where a digit is, a comma groups by thousands."""
    whole, _, part = pattern.partition(".")
    least, most, always = whole.count("0"), len(part), part.rindex("0") + 1 if "0" in part else 0
    text = F.format_number(F.abs(value), most)
    text = text if "," in whole else F.replace(text, F.lit(","))
    front, back = F.substring_index(text, ".", 1), F.substring_index(text, ".", -1) if most else F.lit("")
    front = front if least else F.when(front == "0", "").otherwise(front)
    front = F.lpad(front, F.greatest(F.length(front), F.lit(least)), F.lit("0"))
    back = F.concat(F.substring(back, 1, always), F.rtrim(F.substr(back, F.lit(always + 1)), F.lit("0"))) if most else back
    sign = F.when((value < 0) & F.regexp_like(text, F.lit("[1-9]")), "-").otherwise("")
    return F.concat(sign, front, F.when(back != "", F.concat(F.lit("."), back)).otherwise(""))
