"""Drift scores as gauge lines and as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the help text of the gauge.
HELP = "Population Stability Index per feature"


def format_gauge_lines(psi: DataFrame, name: str = "psi_score") -> DataFrame:
    """Rows (line_no, line): help, type, then one line per feature in name order, six decimals."""
    scores = psi.filter(F.col("psi").isNotNull()).agg(
        F.array_sort(F.collect_list(F.struct("feature", "psi"))).alias("scores")
    )
    head = F.array(F.lit(f"# HELP {name} {HELP}"), F.lit(f"# TYPE {name} gauge"))
    body = F.transform(
        "scores", lambda s: F.format_string(name + '{feature="%s"} %.6f', s["feature"], s["psi"])
    )
    return scores.select(F.posexplode(F.concat(head, body)).alias("line_no", "line"))


def gauge_json(psi: DataFrame) -> DataFrame:
    """One row (scores): all scores as one JSON object, in feature order."""
    pairs = F.array_sort(F.collect_list(F.struct("feature", "psi")))
    return psi.filter(F.col("psi").isNotNull()).agg(F.to_json(F.map_from_entries(pairs)).alias("scores"))


def write_gauge_file(psi: DataFrame, path: str, name: str = "psi_score") -> None:
    """Write the lines in order; there are as many as the table has columns."""
    format_gauge_lines(psi, name).coalesce(1).sortWithinPartitions("line_no").select("line").write.mode(
        "overwrite"
    ).text(path)
