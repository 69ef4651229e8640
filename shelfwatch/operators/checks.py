"""Data checks and two further drift statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tails import chi2_tail, kolmogorov_tail
from .drift import column_kinds, common_columns, psi_numeric, value_counts
from .ordered import ranked_values

SALES_RULES = {
    "null_date": "date IS NULL",
    "null_store": "store_nbr IS NULL",
    "null_family": "family IS NULL",
    "null_sales": "sales IS NULL OR isnan(sales)",
    "negative_sales": "sales < 0",
    "negative_onpromotion": "onpromotion < 0",
}


def quality_checks(df: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """Rows (rule, violations, passed); all rules are counted in one pass."""
    rules = SALES_RULES if rules is None else rules
    counted = df.agg(*[F.count_if(F.coalesce(F.expr(r), F.lit(False))).alias(name) for name, r in rules.items()])
    rows = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules]
    return counted.select(F.inline(F.array(*rows))).withColumn("passed", F.col("violations") == 0)


def schema_changes(df: DataFrame, expected: dict[str, str]) -> list[str]:
    """Missing, extra and retyped columns against ``expected`` (name to type name); no job runs."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    changes = [f"missing {c}" for c in expected if c not in found]
    changes += [f"extra {c}" for c in found if c not in expected]
    changes += [f"{c} is {found[c]}, not {t}" for c, t in expected.items() if c in found and found[c] != t]
    return changes


def _ks_rows(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    ranked = ranked_values(value_counts(ref, cur, cols, "double"), "feature", "v", ["ref_n", "cur_n"])

    def cdf(side: str) -> Column:
        return F.try_divide(F.col(f"{side}_upto"), F.col(f"{side}_total"))

    return ranked.groupBy("feature").agg(
        F.max(F.abs(cdf("ref_n") - cdf("cur_n"))).alias("ks"),
        F.max("ref_n_total").alias("ref_rows"),
        F.max("cur_n_total").alias("cur_rows"),
    )


def ks_statistic(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows (feature, ks): largest gap between both cumulative distributions."""
    return _ks_rows(ref, cur, cols).select("feature", "ks")


def chi2_test(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows (feature, chi2, degrees, both_sides): chi-squared of the category counts of both frames, and whether both have any."""
    counts = value_counts(ref, cur, cols, "string")
    totals = counts.groupBy("feature").agg(F.sum("ref_n").alias("__r"), F.sum("cur_n").alias("__c"))
    row = F.col("ref_n") + F.col("cur_n")

    def term(seen: str, total: str) -> Column:
        expected = row * F.col(total) / (F.col("__r") + F.col("__c"))
        return F.try_divide((F.col(seen) - expected) * (F.col(seen) - expected), expected)

    return (
        counts.join(F.broadcast(totals), "feature")
        .groupBy("feature")
        .agg(
            F.sum(F.coalesce(term("ref_n", "__r"), F.lit(0.0)) + F.coalesce(term("cur_n", "__c"), F.lit(0.0))).alias("chi2"),
            (F.count(F.lit(1)) - 1).alias("degrees"),
            F.max((F.col("__r") > 0) & (F.col("__c") > 0)).alias("both_sides"),
        )
    )


#: Below this chance of so large a difference between alike frames a column counts as drifted.
ALPHA = 0.05


def drift_tests(
    ref: DataFrame, cur: DataFrame, cols: Sequence[str] | None = None, alpha: float = ALPHA
) -> DataFrame:
    """Rows (feature, test, statistic, degrees, p_value, drift) of the columns that both frames share.

    Numbers are compared by the Kolmogorov-Smirnov test, in its limit of large samples, and
    have no degrees of freedom; categories by the chi-squared test of both frames' counts. Missing
    values and not-a-number play no part. Where a frame has no values the chance is missing, and
    there is no drift.
    """
    numeric, categorical = column_kinds(ref, list(cols) if cols is not None else common_columns(ref, cur))
    parts = []
    if numeric:
        found = _ks_rows(ref, cur, numeric)
        tail = kolmogorov_tail(F.col("ks"), F.col("ref_rows"), F.col("cur_rows"))
        parts.append(found.select("feature", F.lit("ks").alias("test"), F.col("ks").alias("statistic"), F.lit(None).cast("long").alias("degrees"), tail.alias("p_value")))
    if categorical:
        found = chi2_test(ref, cur, categorical)
        both = F.col("both_sides")
        tail = F.when(both, chi2_tail(F.col("chi2"), F.col("degrees")))
        parts.append(found.select("feature", F.lit("chi2").alias("test"), F.col("chi2").alias("statistic"), F.col("degrees").cast("long").alias("degrees"), tail.alias("p_value")))
    if not parts:
        raise ValueError("the frames share no columns")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.withColumn("drift", F.coalesce(F.col("p_value") < alpha, F.lit(False)))


def prediction_drift(ref: DataFrame, cur: DataFrame, prediction: str = "yhat") -> DataFrame:
    """Stability index of a model's output."""
    return psi_numeric(ref, cur, [prediction])


def store_attributes(df: DataFrame, stores: DataFrame, key: str = "store_nbr") -> DataFrame:
    """Add the attributes of each store; Spark broadcasts the store table when its size allows."""
    return df.join(stores, key, "left")
