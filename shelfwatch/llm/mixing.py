"""Mix sources to target weights by repeating whole documents.

Words are added up per source, the targets give each source a rate, and every document is
taken floor(rate) times plus once more with the fraction as probability, decided by a hash of
its id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_broadcast, stored

WEIGHTS, SHARE, MAX_RATE = (5, 2, 1), 1.5, 2.0
_WORD_GAP = r"[\x20\x09-\x0D]+"


def word_count(text):
    """Number of words of a text column; null has none."""
    parts = F.split(F.coalesce(text.cast("string"), F.lit("")), _WORD_GAP)
    blank = (F.element_at(parts, 1) == "").cast("int") + F.when(
        F.size(parts) > 1, (F.element_at(parts, -1) == "").cast("int")
    ).otherwise(0)
    return (F.size(parts) - blank).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_rate: float = MAX_RATE
) -> DataFrame:
    """Rows (source, source_size, weight, target) from rows (source, size).

    Sources in code point order, null last, get the weights in turn. All targets together are
    ``share`` of all words; a target stops at ``max_rate`` times its source's size, and what
    is over goes to the others by weight until none is above. The level that does this is found
    by a few aggregates over one row per source, so the number of sources is free.
    """
    spark = sizes.sparkSession
    totals = stored(sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")), "source-sizes")
    ordered = totals.select("source").sort(F.col("source").asc_nulls_last())
    schema = "source string, at long"
    places = spark.createDataFrame(ordered.rdd.zipWithIndex().map(lambda p: (p[0][0], p[1])), schema)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    same = totals["source"].eqNullSafe(places["source"])
    table = stored(
        totals.join(places, same).select(totals["source"], "source_size", weight.cast("long").alias("weight")),
        "source-weights",
    )
    cap = F.col("source_size") * F.lit(max_rate)
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = total * share / (table.agg(F.sum("weight")).first()[0] or 1)
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        taken, free = table.agg(
            F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        if not free:
            break
        higher = (total * share - taken) / free
        if higher <= level:
            break
        level = higher
    return table.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def mixed_sizes(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_rate: float = MAX_RATE,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, copies, taken), one for each row.

    The draw depends on the seed and the id alone: reruns agree, and rows that repeat an id are
    drawn alike. A null source is a source; a null text has size 0; a null id draws as the
    text "null". A source without words has target 0 and rate 0. No rows give no rows.
    """
    sizes = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col)).alias("size"),
        ),
        "sizes",
    )
    table = bounded_broadcast(source_targets(sizes, weights, share, max_rate).withColumnRenamed("source", "s"))
    joined = sizes.join(table, sizes["source"].eqNullSafe(table["s"]))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.floor(rate) + (_draw(F.col("doc_id"), seed) < rate - F.floor(rate)).cast("long")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies")
    ).withColumn("taken", F.col("size") * F.col("copies"))


def _draw(doc_id, seed: int):
    """A number from 0 to below 1, from the first 13 digits of a hash of seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_rate: float = MAX_RATE,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; see :func:`mixed_sizes`.

    Texts are not shuffled: rates are broadcast, one row per source, as long as their number
    is bounded, and the draw is made on the row itself.
    """
    sizes = stored(
        docs.select(F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"))
        .groupBy("source")
        .agg(F.sum("size").alias("size")),
        "sizes",
    )
    table = source_targets(sizes, weights, share, max_rate)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rates = bounded_broadcast(table.select(F.col("source").alias("__s"), rate.alias("__rate")))
    joined = docs.join(rates, docs[f"`{source_col}`"].cast("string").eqNullSafe(rates["__s"]))
    copies = F.floor("__rate") + (
        _draw(F.col(id_col).cast("long"), seed) < F.col("__rate") - F.floor("__rate")
    ).cast("long")
    times = F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("__copy")
    return (
        joined.filter(copies > 0).select(*[docs[f"`{c}`"] for c in docs.columns], times).drop("__copy")
    )


#: The same mix of documents in SQL.
MIXED_SIZES_SQL = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1] AS weight
  FROM d GROUP BY source
),
r AS (
  SELECT *, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) AS k,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight FROM s
),
l AS (
  SELECT k,
         (1.5::DOUBLE * total - coalesce(sum(2.0::DOUBLE * source_size) OVER w, 0)) / (all_weight - coalesce(sum(weight) OVER w, 0)) AS level,
         2.0::DOUBLE * source_size / weight AS stop
  FROM r WINDOW w AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
best AS (SELECT level FROM l WHERE stop > level ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * coalesce((SELECT level FROM best), 0)) AS target FROM s),
j AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('0:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM j
"""
