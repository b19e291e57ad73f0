"""Quality rules: rows kept, rows set aside, and a report, each from one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealtide.functions.columns import named, row_count

# Rule names a source may declare.
RULE_TYPES = ("not_null", "greater_than", "greater_than_equal", "regex", "date_format")


@dataclass(frozen=True)
class Rule:
    column: str
    rule_type: str
    value: object = None
    pattern: str | None = None
    format: str | None = None

    def __post_init__(self) -> None:
        if self.rule_type not in RULE_TYPES:
            raise ValueError(f"unknown rule type {self.rule_type!r}")
        if self.rule_type.startswith("greater") and self.value is None:
            raise ValueError(f"{self.rule_type} on {self.column!r} needs a value")
        if self.rule_type == "regex" and self.pattern is None:
            raise ValueError(f"regex on {self.column!r} needs a pattern")
        if self.rule_type == "date_format" and self.format is None:
            raise ValueError(f"date_format on {self.column!r} needs a format")

    @staticmethod
    def of(rule: Rule | Mapping[str, object]) -> Rule:
        return rule if isinstance(rule, Rule) else Rule(**rule)

    @property
    def label(self) -> str:
        return f"{self.rule_type}({self.column})"

    def passes(self) -> Column:
        """True or false, never null. Nulls pass the comparisons and fail all other rules."""
        value = named(self.column)
        if self.rule_type == "not_null":
            return value.isNotNull()
        if self.rule_type == "greater_than":
            return F.coalesce(value > F.lit(self.value), F.lit(True))
        if self.rule_type == "greater_than_equal":
            return F.coalesce(value >= F.lit(self.value), F.lit(True))
        if self.rule_type == "regex":
            return F.coalesce(value.rlike(self.pattern), F.lit(False))
        return F.try_to_date(value.cast("string"), self.format).isNotNull()

    def wording(self) -> tuple[str, str]:
        """Text of the alert before and after the number of failed rows."""
        # The wording of the alerts.
        ending = {
            "not_null": "NULL values",
            "greater_than": f"values not greater than {self.value}",
            "greater_than_equal": f"values less than {self.value}",
            "regex": f"values not matching pattern '{self.pattern}'",
            "date_format": f"values not in date format '{self.format}'",
        }[self.rule_type]
        return f"Column '{self.column}' contains ", f" {ending}"


def rules_of(rules: Sequence[Rule | Mapping[str, object]]) -> list[Rule]:
    return [Rule.of(r) for r in rules]


def _all_pass(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [r.passes() for r in rules], F.lit(True))


def kept(df: DataFrame, rules: Sequence[Rule | Mapping[str, object]]) -> DataFrame:
    """Rows that pass every rule."""
    return df.where(_all_pass(rules_of(rules)))


def broken_rules(rules: Sequence[Rule | Mapping[str, object]]) -> Column:
    """The names of all the rules that a row breaks."""
    checks = rules_of(rules)
    return F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.label)) for r in checks])) if checks else F.array().cast("array<string>")


def quarantine(df: DataFrame, rules: Sequence[Rule | Mapping[str, object]]) -> DataFrame:
    """The other rows, with the names of all the rules they break."""
    return df.where(~_all_pass(rules_of(rules))).withColumn("failed_rules", broken_rules(rules))


def failure_counts(rules: Sequence[Rule | Mapping[str, object]]) -> list[Column]:
    """Per rule the rows that fail it after passing all rules before it.

    These are the counts of checking rule after rule, each on the survivors of the
    one before, but as aggregates of a single scan. Usable in ``agg`` and ``observe``.
    """
    checks = rules_of(rules)
    return [
        F.count_if(_all_pass(checks[:i]) & ~rule.passes()).alias(f"rule_{i}")
        for i, rule in enumerate(checks)
    ]


def report(df: DataFrame, rules: Sequence[Rule | Mapping[str, object]]) -> DataFrame:
    """One row per failed rule, in rule order."""
    return listed(df.agg(*(failure_counts(rules) or [row_count()])), rules)


def listed(counted: DataFrame, rules: Sequence[Rule | Mapping[str, object]]) -> DataFrame:
    """The report of a row of ``failure_counts``."""
    entries = []
    for i, rule in enumerate(rules_of(rules)):
        before, after = rule.wording()
        count = F.col(f"rule_{i}")
        entries.append(
            F.struct(
                F.lit(i + 1).cast("bigint").alias("rule_no"),
                F.lit(rule.column).alias("column_name"),
                F.lit(rule.rule_type).alias("rule_type"),
                F.concat(F.lit(before), count.cast("string"), F.lit(after)).alias("message"),
                count.alias("failed_count"),
            )
        )
    shape = "array<struct<rule_no:bigint,column_name:string,rule_type:string,message:string,failed_count:bigint>>"
    rows = F.array(*entries) if entries else F.array().cast(shape)
    return counted.select(F.inline(rows)).where("failed_count > 0")
