"""Data-quality rules on a DataFrame, batch or streaming.

A rule is a named SQL predicate; a row violates it when the predicate is false
*or null*. Counting rides along with the data (``DataFrame.observe``), so a rule
costs no extra pass.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The actions a rule can carry.
ACTIONS = (
    "expect",
    "expect_or_drop",
    "expect_or_fail",
    "expect_all",
    "expect_all_or_drop",
    "expect_all_or_fail",
)


@dataclass(frozen=True)
class Rule:
    """One expectation: ``description`` names it, ``constraint`` must hold for each row."""

    description: str
    constraint: str
    action: str = "expect"

    def __post_init__(self) -> None:
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}, not {self.action!r}")
        if not self.description:
            raise ValueError("a rule needs a description")

    @property
    def drops(self) -> bool:
        return self.action.endswith("_or_drop")

    @property
    def fails(self) -> bool:
        return self.action.endswith("_or_fail")


def holds(constraint: str | Column) -> Column:
    """The predicate with null counted as violated."""
    predicate = F.expr(constraint) if isinstance(constraint, str) else constraint
    return F.coalesce(predicate, F.lit(False))


def expect(
    df: DataFrame,
    rules: Mapping[str, str],
    action: str = "expect_all",
    name: str | None = None,
) -> tuple[DataFrame, Observation | str]:
    """Apply one action to a dict of rules ``{description: constraint}``."""
    return expectations(df, [Rule(d, c, action) for d, c in rules.items()], name)


def expectations(
    df: DataFrame, rules: list[Rule], name: str | None = None
) -> tuple[DataFrame, Observation | str]:
    """Apply rules with mixed actions; returns the kept rows and the counters.

    The counters cover the rows *before* any is dropped: ``rows`` and, per rule,
    the number of violations under the rule's description. For a batch they are
    an ``Observation`` (read ``.get`` after the action that ran the plan); for a
    stream the name under which each progress event carries them.

    A failing rule raises inside the task that meets the row, so the write job
    aborts before it commits and nothing is published.
    """
    names = [r.description for r in rules]
    if len(set(names)) != len(names):
        raise ValueError("rule descriptions must be distinct")
    counters = [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(~holds(r.constraint)).alias(r.description) for r in rules
    ]
    if df.isStreaming:
        handle: Observation | str = name or "expectations"
    else:
        handle = Observation(name) if name else Observation()
    checked = df.observe(handle, *counters)

    failing = [r for r in rules if r.fails]
    if failing:
        guard = F.lit(True)
        for rule in reversed(failing):
            message = F.lit(f"expectation violated: {rule.description} ({rule.constraint})")
            guard = F.when(holds(rule.constraint), guard).otherwise(
                F.raise_error(message).cast("boolean")
            )
        checked = checked.filter(guard)
    for rule in rules:
        if rule.drops:
            checked = checked.filter(holds(rule.constraint))
    return checked, handle


def violations(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per rule: rows checked and rows violating it, in one pass over the data."""
    if not rules:
        raise ValueError("no rules given")
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(~holds(r.constraint)).alias(f"v{i}") for i, r in enumerate(rules)],
    )
    per_rule = F.array(
        *[
            F.struct(
                F.lit(r.description).alias("rule"),
                F.lit(r.action).alias("action"),
                F.col("rows").alias("rows"),
                F.col(f"v{i}").alias("violations"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return counted.select(F.inline(per_rule))


def row_filter(df: DataFrame, predicate: str | None) -> DataFrame:
    """Rows a reader may see; null counts as not visible, as in any WHERE."""
    return df.filter(F.expr(predicate)) if predicate else df
