"""Question / context / answer files in JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import is_blank
from ..session import scratch_path

REQUIRED = ("question", "context", "answer")
#: Pieces of files whose first line numbers are broadcast, at about 200 bytes each.
PIECES = 500_000


class QuarantineNotEmpty(ValueError):
    """Strict reading found rows that are not valid."""


class EmptyEvalSet(ValueError):
    """No valid row was found."""


def check_eval_lines(lines: DataFrame, value: str = "value", fields: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Add one column per field and ``reason``, null for good rows; blank lines are dropped.

    A field must be a JSON string with something in it: a number is not taken for its text,
    which is why the line is parsed to a variant first.
    """
    raw = F.col(value)
    rows = lines.filter(raw.isNotNull() & ~is_blank(raw)).withColumn("__json", F.try_parse_json(raw))
    rows = rows.withColumns(
        {f"__{f}": F.try_variant_get("__json", f"$.{f}", "variant") for f in fields}
    )
    # A variant holding the JSON null is not SQL null, so a present null is not "missing".
    missing = F.array_compact(F.array(*[F.when(F.col(f"__{f}").isNull(), f) for f in sorted(fields)]))
    texts = {f: F.try_variant_get("__json", f"$.{f}", "string") for f in fields}
    wrong = F.array_compact(
        F.array(
            *[
                F.when(
                    (F.schema_of_variant(F.col(f"__{f}")) != "STRING") | F.coalesce(is_blank(texts[f]), F.lit(True)), f
                )
                for f in fields
            ]
        )
    )
    reason = (
        F.when(F.col("__json").isNull(), "bad_json")
        .when(~F.startswith(F.schema_of_variant("__json"), F.lit("OBJECT")), "not_an_object")
        .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.concat_ws(", ", missing)))
        .when(F.size(wrong) > 0, F.concat(F.lit("not a non-empty string: "), F.concat_ws(", ", wrong)))
    )
    dropped = ["__json", *[f"__{f}" for f in fields]]
    return rows.withColumns({**texts, "reason": reason}).drop(*dropped)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows (source, line_no, value) of every line of the text files at ``path``, numbered from 1 in each file.

    Spark cuts a large file into pieces, and each line belongs to the piece that it starts in.
    One pass counts the lines of every piece, one row each; their sums say at which number a
    piece begins, and the second pass counts on from there. No file goes through one task, and
    only a file's pieces are sorted. Lines end with a line feed, a carriage return, or both.

    Both passes must cut alike: ``spark.sql.files.maxPartitionBytes`` has to stay as it is until
    the rows are read, and files must not change meanwhile.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("piece"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    counted = lines.groupBy("source", "piece").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("lines"))
    earlier = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("source", "piece", "first", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))
    table = scratch_path(spark, "line-numbers")
    starts.write.parquet(table)
    starts = spark.read.schema(starts.schema).parquet(table)
    if starts.count() <= PIECES:
        starts = F.broadcast(starts)
    number = F.col("before") + F.col("place") - F.col("first") + 1
    return lines.join(starts, ["source", "piece"]).select("source", number.alias("line_no"), "value")


def scan_eval_jsonl(spark: SparkSession, path: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine of source, line_no, raw, reason).

    Strict reading raises when a row is bad, naming its file and line, and when no good row is left.
    """
    checked = check_eval_lines(numbered_lines(spark, path))
    good = checked.filter(F.col("reason").isNull()).select(*REQUIRED)
    bad = checked.filter(F.col("reason").isNotNull()).select("source", "line_no", F.col("value").alias("raw"), "reason")
    if strict:
        # One aggregate decides; the shown row comes from a minimum, not from a collect.
        found = checked.agg(
            F.count_if(F.col("reason").isNull()).alias("good"),
            F.count_if(F.col("reason").isNotNull()).alias("bad"),
            F.min(F.when(F.col("reason").isNotNull(), F.struct("source", "line_no", "reason"))).alias("first_bad"),
        ).first()
        if found["bad"]:
            first = found["first_bad"]
            raise QuarantineNotEmpty(
                f"{found['bad']} bad rows, such as {first['reason']} in line {first['line_no']} of {first['source']}"
            )
        if not found["good"]:
            raise EmptyEvalSet(f"{path} contains no valid rows")
    return good, bad
