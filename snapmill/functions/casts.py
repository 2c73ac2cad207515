"""Tolerant typing: a value that does not fit its type becomes null and never raises.

Everything here is ``try_cast``, so results do not depend on ``spark.sql.ansi.enabled``. A
``try_cast`` that fails throws and catches an exception inside, which costs about a hundred
times as much as one that succeeds, and raw tables are full of misfits. So text is tested
against a pattern first. Each pattern lets through all that the cast accepts; what it lets
through beyond that, the cast still turns into null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT, DATE, AMOUNT, COUNT, WIDE = "string", "date", "float", "int", "double"

_BLANK = r"[\x00-\x20\x7F]*"
_LOOKS_LIKE = {
    COUNT: rf"^{_BLANK}[+-]?[0-9]+{_BLANK}$",
    DATE: rf"^{_BLANK}[+-]?[0-9]{{4}}",
    WIDE: rf"^{_BLANK}[+-]?([0-9.]+([eE][+-]?[0-9]+)?[dDfF]?{_BLANK}$|[iI][nN][fF]|[nN][aA][nN]|0[xX])",
}
_LOOKS_LIKE[AMOUNT] = _LOOKS_LIKE[WIDE]


def parse(text: Column, type_name: str) -> Column:
    """Text to a type. ``int`` accepts whole digits only: ``'3.0'`` is null."""
    if type_name == TEXT:
        return text
    return F.when(text.rlike(_LOOKS_LIKE[type_name]), text.try_cast(type_name))


def as_type(value: Column, type_name: str, is_text: bool) -> Column:
    return parse(value, type_name) if is_text else value.try_cast(type_name)


def as_measured(value: Column, type_name: str, is_text: bool) -> Column:
    """A measured number is a double first, so ``'3.7'`` is 3 as int."""
    return as_type(value, WIDE, is_text).try_cast(type_name)


def fits_int(value: Column) -> Column:
    """Narrow a bigint result to int; out of range is null."""
    return value.try_cast(COUNT)


def captured_number(text: Column, pattern: str) -> Column:
    """First capture group as a bigint that an int holds; no match and more digits are null.

    What is added up from such numbers cannot overflow a bigint.
    """
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast(COUNT).cast("bigint")
