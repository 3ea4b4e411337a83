"""Row rules as data: what to drop and what to flag."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

_HOLDS = {
    "not_null": lambda column, _: column.isNotNull(),
    "greater_than": lambda column, bound: column > F.lit(bound),
    "less_than": lambda column, bound: column < F.lit(bound),
}
_ACTIONS = ("drop", "flag")

# The rule list that ships with the configuration.
DEFAULT_RULES = (
    {"field": "Customer ID", "type": "not_null", "action": "drop"},
    {"field": "Price", "type": "greater_than", "value": 0, "action": "flag"},
    {"field": "Quantity", "type": "less_than", "value": 1000, "action": "flag"},
    {"field": "StockCode", "type": "not_null", "action": "drop"},
)


@dataclass(frozen=True)
class Rule:
    field: str
    type: str
    action: str
    value: Any = None

    @classmethod
    def of(cls, spec: Mapping[str, Any]) -> Rule:
        rule = cls(spec["field"], spec["type"], spec["action"], spec.get("value"))
        if rule.type not in _HOLDS:
            raise ValueError(f"Unknown rule type: {rule.type}")
        if rule.action not in _ACTIONS:
            raise ValueError(f"Unknown rule action: {rule.action}")
        return rule

    @property
    def violated(self) -> Column:
        """True unless the rule holds; a null value never satisfies a comparison."""
        holds = _HOLDS[self.type](F.col(f"`{self.field}`"), self.value)
        return ~F.coalesce(holds, F.lit(False))

    @property
    def flag_name(self) -> str:
        return f"{self.field.lower().replace(' ', '_')}_flag"


def _rules(specs: Sequence[Mapping[str, Any]]) -> list[Rule]:
    return [Rule.of(spec) for spec in specs]


def apply_rules(df: DataFrame, specs: Sequence[Mapping[str, Any]] = DEFAULT_RULES) -> DataFrame:
    """Drop and flag in one projection and one filter, whatever the number of rules.

    Several flag rules on one field share its flag: set when any is violated.
    """
    rules = _rules(specs)
    flags: dict[str, Column] = {}
    for rule in rules:
        if rule.action == "flag":
            seen = flags.get(rule.flag_name)
            flags[rule.flag_name] = rule.violated if seen is None else seen | rule.violated
    dropped = [rule.violated for rule in rules if rule.action == "drop"]
    kept = df.where(~reduce(lambda a, b: a | b, dropped)) if dropped else df
    return kept.withColumns(flags) if flags else kept


def rule_violations(
    df: DataFrame, specs: Sequence[Mapping[str, Any]] = DEFAULT_RULES
) -> DataFrame:
    """Violating rows per rule, all counted in one scan."""
    rules = _rules(specs)
    counts = df.agg(*[F.count_if(rule.violated).alias(f"n{i}") for i, rule in enumerate(rules)])
    rows = F.array(
        *[
            F.struct(
                F.lit(rule.field).alias("field"),
                F.lit(rule.type).alias("type"),
                F.lit(None if rule.value is None else float(rule.value))
                .cast("double")
                .alias("value"),
                F.lit(rule.action).alias("action"),
                F.col(f"n{i}").alias("violations"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return counts.select(F.inline(rows))
