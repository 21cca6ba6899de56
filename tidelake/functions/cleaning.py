"""How each contract kind turns a raw column into a typed one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.functions.text import normalise_city

NUMERIC_TYPES = {"int": "int", "money": "decimal(10,2)", "real": "double"}


def cleaned(kind: str, raw: Column, raw_type: T.DataType, tolerant: bool = False) -> Column:
    """Typed column for a contract kind.

    Strict casts raise on malformed input (ANSI mode); tolerant ones give NULL.
    """
    if kind == "asis":
        return raw
    if kind in ("key", "text"):
        return F.trim(raw)
    if kind == "code":
        return F.lower(F.trim(raw))
    if kind == "state":
        return F.upper(F.trim(raw))
    if kind == "city":
        return normalise_city(raw)
    if kind == "time":
        if isinstance(raw_type, (T.TimestampType, T.TimestampNTZType)):
            return raw
        return F.try_to_timestamp(raw) if tolerant else F.to_timestamp(raw)
    target = NUMERIC_TYPES[kind]
    return raw.try_cast(target) if tolerant else raw.cast(target)


def can_fail(kind: str, raw_type: T.DataType) -> bool:
    """Whether cleaning this kind can meet malformed input."""
    return isinstance(raw_type, T.StringType) and (kind == "time" or kind in NUMERIC_TYPES)
