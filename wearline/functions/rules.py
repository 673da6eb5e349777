"""Rules as data: each is a name and a predicate over the columns of a row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``when`` is a SQL predicate; for quality rules it describes the *bad* row."""

    name: str
    when: str

    @property
    def predicate(self) -> Column:
        return F.expr(self.when)


# Quality limits (a row is bad when the predicate holds).
QUALITY_RULES = [
    Rule("invalid_air_temp_rows", "air_temperature_k < 250 OR air_temperature_k > 350"),
    Rule("invalid_process_temp_rows", "process_temperature_k < 250 OR process_temperature_k > 400"),
    Rule("invalid_rotation_rows", "rotational_speed_rpm <= 0"),
    Rule("invalid_torque_rows", "torque_nm < 0"),
    Rule("invalid_tool_wear_rows", "tool_wear_min < 0"),
]

# Rule baseline for the five failure modes.
FAILURE_RULES = [
    Rule("twf", "tool_wear_min > 200"),
    Rule("hdf", "process_temperature_k - air_temperature_k > 10"),
    Rule("pwf", "torque_nm > 55"),
    Rule("osf", "rotational_speed_rpm < 1200 AND torque_nm > 50"),
    Rule("rnf", "machine_type = 'L' AND tool_wear_min > 180"),
]

# Identity and score of the rule baseline.
RULE_MODEL = ("baseline_rule_engine", "v0", 0.5)


def flags(rules: Sequence[Rule], prefix: str = "") -> list[Column]:
    """One INT 0/1 column per rule; an unknown (NULL) predicate gives 0."""
    return [F.when(r.predicate, 1).otherwise(0).alias(prefix + r.name) for r in rules]


def violation(rules: Sequence[Rule]) -> Column:
    """Name of the first rule a row breaks, NULL when it breaks none."""
    return F.coalesce(*[F.when(r.predicate, r.name) for r in rules])
