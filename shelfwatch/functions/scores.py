"""Score mappings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MODERATE_PSI = 0.1
SIGNIFICANT_PSI = 0.2


def nli_score(label: Column, score: Column) -> Column:
    """Faithfulness from an entailment label and its confidence; 0.5 where neither side is taken."""
    label = F.upper(label)
    score = score.cast("double")
    mapped = F.when(label == "ENTAILMENT", score).when(label == "CONTRADICTION", 1.0 - score)
    return F.coalesce(mapped, F.lit(0.5))


def clip_forecast(value: Column) -> Column:
    """Forecasts are never negative; a missing or not-a-number value becomes 0."""
    value = value.cast("double")
    return F.when(value.isNull() | F.isnan(value) | (value < 0), F.lit(0.0)).otherwise(value)


def drift_band(psi: Column) -> Column:
    """``stable`` below 0.1, ``moderate`` to 0.2 inclusive, ``significant`` above."""
    return (
        F.when(psi < MODERATE_PSI, "stable")
        .when(psi <= SIGNIFICANT_PSI, "moderate")
        .when(psi > SIGNIFICANT_PSI, "significant")
    )
