"""Row expectations with three severities, counted in the same pass that writes the rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidelake.plans.rules import QUALITY_RULES


class Rule(NamedTuple):
    name: str
    severity: str  # warn, drop or fail
    predicate: str

    def holds(self) -> Column:
        """True or False; a predicate that is NULL counts as failed."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def rules_for(dataset: str) -> tuple[Rule, ...]:
    return tuple(Rule(*entry) for entry in QUALITY_RULES.get(dataset, ()))


def drop_failing(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Keep rows that meet every ``drop`` rule; ``warn`` and ``fail`` rules change nothing."""
    for rule in rules:
        if rule.severity == "drop":
            df = df.filter(F.expr(rule.predicate))
    return df


def guard(df: DataFrame, rules: Iterable[Rule], dataset: str) -> DataFrame:
    """Make any row that breaks a ``fail`` rule end the job that computes it.

    The check runs inside the tasks, so a write fails before it commits and no extra pass is due.
    """
    for rule in rules:
        if rule.severity == "fail":
            message = F.lit(f"expectation {rule.name} failed on {dataset}")
            df = df.filter(
                F.when(rule.holds(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
            )
    return df


def _counters(rules: Sequence[Rule]) -> list[Column]:
    return [
        F.count_if(rule.holds() if outcome == "passed" else ~rule.holds()).alias(
            f"{rule.name}__{outcome}"
        )
        for rule in rules
        for outcome in ("passed", "failed")
    ]


def observed(
    df: DataFrame, rules: Sequence[Rule], dataset: str, *more: Column
) -> tuple[DataFrame, Observation | None]:
    """Attach counters, and ``more`` aggregates, that fill in when the frame is written."""
    if not rules:
        return df, None
    observation = Observation(dataset)
    return df.observe(observation, *_counters(rules), *more), observation


def outcomes(
    counts: Mapping[str, int], rules: Sequence[Rule], dataset: str
) -> list[dict[str, object]]:
    """Counter values as event-log entries."""
    return [
        {
            "name": rule.name,
            "dataset": dataset,
            "passed_records": int(counts[f"{rule.name}__passed"]),
            "failed_records": int(counts[f"{rule.name}__failed"]),
        }
        for rule in rules
    ]


def tally(df: DataFrame, rules: Sequence[Rule], dataset: str, run: Column) -> DataFrame:
    """Counts per run as one ``array<struct>`` column in the event-log layout.

    One conditional aggregate for all rules of the data set, combined map-side.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("name"),
                F.lit(dataset).alias("dataset"),
                F.count_if(rule.holds()).alias("passed_records"),
                F.count_if(~rule.holds()).alias("failed_records"),
            )
            for rule in rules
        ]
    )
    return df.groupBy(run.alias("timestamp")).agg(entries.alias("expectations"))
