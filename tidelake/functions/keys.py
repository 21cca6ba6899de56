"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*parts: str | Column) -> Column:
    """SHA-256 of a natural key; several parts are joined by ``||``.

    A single part keeps NULL as NULL. With several parts NULLs are skipped, so such a key is never
    NULL and proves nothing about its parts: use ``operators.integrity.grain_report`` for that.
    """
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    natural = columns[0] if len(columns) == 1 else F.concat_ws("||", *columns)
    return F.sha2(natural, 256)


def packed_key(key: str | Column) -> Column:
    """A surrogate key as its 32 bytes, half of what its text takes in a shuffle.

    Equal for equal keys only: text that is no lower-case SHA-256 stays as its bytes, made longer than any digest.
    """
    text = F.col(key) if isinstance(key, str) else key
    digest = F.unhex(text)
    plain = F.encode(F.concat(text, F.lit("\0" * 33)), "UTF-8")
    return F.when((F.length(digest) == 32) & (F.lower(F.hex(digest)) == text), digest).otherwise(plain)


def unpacked_key(packed: str | Column) -> Column:
    """The text that ``packed_key`` made bytes of."""
    key = F.col(packed) if isinstance(packed, str) else packed
    plain = F.decode(F.substring(key, F.lit(1), F.length(key) - 33), "UTF-8")
    return F.when(F.length(key) == 32, F.lower(F.hex(key))).otherwise(plain)
