"""From raw to cleaned rows: transforms first, then quality rules, in one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from dealtide.operators import quality
from dealtide.operators.transforms import apply_transforms
from dealtide.sources.catalog import Source


@dataclass(frozen=True)
class Silver:
    rows: DataFrame
    rejected: DataFrame
    report: DataFrame


def to_silver(raw: DataFrame, source: Source) -> Silver:
    """Cleaned rows, the rows set aside and the quality report; all lazy."""
    changed = apply_transforms(raw, source.transforms)
    return Silver(
        rows=quality.kept(changed, source.rules),
        rejected=quality.quarantine(changed, source.rules),
        report=quality.report(changed, source.rules),
    )
