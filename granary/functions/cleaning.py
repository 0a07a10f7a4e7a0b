"""Turning messy text into numbers, dates and standard names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_number(
    text: str | Column, decimal: str = ".", group: str | None = None, signed: bool = True
) -> Column:
    """Dirty number text to double; whatever is no number after cleaning becomes null.

    Characters outside digits, the decimal mark and (if ``signed``) the minus
    are removed, so with ``decimal="."`` a comma just vanishes (``25,3`` is 253).
    With ``decimal=","`` both marks are read as a decimal point. Name the
    thousands mark in ``group`` to have it removed beforehand.
    """
    value = as_column(text)
    if group:
        value = F.replace(value, F.lit(group), F.lit(""))
    kept = "0-9." + ("," if decimal == "," else "") + ("-" if signed else "")
    value = F.regexp_replace(value, f"[^{kept}]", "")
    if decimal == ",":
        value = F.replace(value, F.lit(","), F.lit("."))
    return value.try_cast("double")


def parse_day(text: str | Column, pattern: str = "dd/MM/yyyy") -> Column:
    """Text to date; impossible or unpadded dates become null instead of failing the job."""
    return F.try_to_date(as_column(text), pattern)


def lookup(key: str | Column, mapping: Mapping[str, object], default: object) -> Column:
    """Value of ``key`` in a small literal mapping, else ``default`` (a literal or a Column).

    A key that is mapped to null gives null, however many entries there are; a null key is in no mapping.
    """
    found, fallback = as_column(key), default if isinstance(default, Column) else F.lit(default)
    entries = [F.lit(part) for name, value in mapping.items() if name is not None for part in (name, value)]
    if not entries:
        return fallback
    pairs = F.create_map(*entries)
    return F.when(F.map_contains_key(pairs, found), F.try_element_at(pairs, found)).otherwise(fallback)


def code_to_name(code: str | Column, names: Mapping[str, str]) -> Column:
    """Standard name of a code; a code without a name is upper-cased."""
    return lookup(code, names, F.upper(as_column(code)))


def standard_name(text: str | Column, aliases: Mapping[str, str] | None = None) -> Column:
    """Trimmed, upper-cased key; ``aliases`` maps spellings (already upper case) to the agreed one."""
    name = F.upper(F.trim(as_column(text)))
    return lookup(name, aliases, name) if aliases else name


def iso_stamp(moment: str | Column) -> Column:
    """Timestamp as ISO text with microseconds."""
    return F.date_format(as_column(moment), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
