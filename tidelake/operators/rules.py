"""Row rules as small building blocks. Each gives the SQL text of a condition over one row.

Comparisons with an unknown side are unknown, as everywhere in SQL; the blocks whose name says so let the
unknown pass. Texts rather than columns, so that rules can be declared without a session and shown in reports.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

Declared = tuple[tuple[str, str, str], ...]


def _literal(value: object) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def present(column: str) -> str:
    return f"{column} IS NOT NULL"


def missing(column: str) -> str:
    return f"{column} IS NULL"


def equals(column: str, value: object) -> str:
    return f"{column} = {_literal(value)}"


def differs(column: str, value: object) -> str:
    return f"{column} <> {_literal(value)}"


def one_of(column: str, values: Iterable[object]) -> str:
    return f"{column} IN ({', '.join(map(_literal, values))})"


def within(column: str, least: object, most: object) -> str:
    return f"{column} >= {_literal(least)} AND {column} <= {_literal(most)}"


def at_least(column: str, least: object) -> str:
    return f"{column} >= {_literal(least)}"


def above(column: str, bound: object) -> str:
    return f"{column} > {_literal(bound)}"


def before(column: str, other: str) -> str:
    return f"{column} < {other}"


def all_of(*conditions: str) -> str:
    return " AND ".join(f"({c})" for c in conditions)


def unless(exception: str, condition: str) -> str:
    """The condition, wherever the exception does not hold."""
    return f"({exception}) OR ({condition})"


def in_order_if_known(earlier: str, later: str) -> str:
    """The second time is not before the first; passes where either is unknown."""
    return f"coalesce({later} >= {earlier}, true)"


def declare(drop: Mapping[str, str] | None = None, fail: Mapping[str, str] | None = None, warn: Mapping[str, str] | None = None) -> Declared:
    """Rules of a data set as ``(name, severity, condition)``: what drops, what fails, then what warns."""
    severities = {"drop": drop, "fail": fail, "warn": warn}
    return tuple((name, severity, condition) for severity, rules in severities.items() for name, condition in (rules or {}).items())


def identified(**columns: str) -> dict[str, str]:
    """Rules that an id is there: rule name to column."""
    return {name: present(column) for name, column in columns.items()}
