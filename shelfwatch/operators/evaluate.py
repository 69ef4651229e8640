"""Answer-quality scores and the gate on their means."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cosine_clip, nli_score, token_precision

METRICS = ("faithfulness", "relevance", "precision")
SEPARATOR = " [SEP] "
MAX_TOKENS = 512


class GateFailed(RuntimeError):
    """The mean of at least one metric is below the threshold."""


def score_faithfulness(
    df: DataFrame,
    scorer_factory: Callable[[int], Callable[[Sequence[str]], Sequence[tuple[str, float] | None]]],
    max_tokens: int = MAX_TOKENS,
) -> DataFrame:
    """Add ``faithfulness`` of each (context, answer).

    ``scorer_factory(max_tokens)`` is called once per task and returns a function from texts
    to (label, confidence), or None where it has no result. It gets whole texts: cutting
    them to its own tokens is the model's part.
    """

    @F.pandas_udf("label string, score double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = scorer_factory(max_tokens)
        for texts in batches:
            results = [r or (None, None) for r in scorer(texts.tolist())]
            yield pd.DataFrame(results, columns=["label", "score"], index=texts.index)

    pair = F.concat(F.col("context"), F.lit(SEPARATOR), F.col("answer"))
    return (
        df.withColumn("__nli", classify(pair))
        .withColumn("faithfulness", nli_score(F.col("__nli.label"), F.col("__nli.score")))
        .drop("__nli")
    )


def embed_text(
    df: DataFrame, cols: Sequence[str], embedder_factory: Callable[[], Callable[[Sequence[str]], Sequence]]
) -> DataFrame:
    """Add ``<col>_vec``, a unit vector per text, for each named column.

    ``embedder_factory()`` is called once per task and column and returns a function from
    texts to vectors; the vectors are brought to length 1 here.
    """

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy as np

        embedder = embedder_factory()
        for texts in batches:
            vectors = np.asarray(embedder(texts.tolist()), dtype="float64").reshape(len(texts), -1)
            lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
            unit = vectors / np.where(lengths == 0, 1.0, lengths)
            yield pd.Series(list(unit.astype("float32")), index=texts.index)

    return df.select("*", *[embed(F.col(c)).alias(f"{c}_vec") for c in cols])


def score_answers(df: DataFrame, scorer_factory: Callable, embedder_factory: Callable) -> DataFrame:
    """Add the three metrics to rows of (question, context, answer)."""
    scored = score_faithfulness(df, scorer_factory)
    scored = embed_text(scored, ["question", "answer"], embedder_factory)
    return scored.withColumns(
        {
            "relevance": cosine_clip(F.col("question_vec"), F.col("answer_vec")),
            "precision": token_precision(F.col("context"), F.col("answer")),
        }
    ).drop("question_vec", "answer_vec")


def eval_gate(scores: DataFrame, threshold: float = 0.7, metrics: Sequence[str] = METRICS) -> DataFrame:
    """One row: mean, pass flag and two-decimal display of each metric, and ``overall``.

    The flags compare full values; the display columns are for reports only.
    """
    means = scores.agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(m).alias(f"mean_{m}") for m in metrics]
    )
    passed = [F.coalesce(F.col(f"mean_{m}") >= threshold, F.lit(False)) for m in metrics]
    overall = passed[0]
    for flag in passed[1:]:
        overall = overall & flag
    return means.select(
        "*",
        *[flag.alias(f"pass_{m}") for m, flag in zip(metrics, passed)],
        *[F.format_string("%.2f", F.col(f"mean_{m}")).alias(f"shown_{m}") for m in metrics],
        overall.alias("overall"),
    )


def require_pass(gate: DataFrame) -> dict:
    """The gate's row as a dict; raises ``GateFailed`` when there are no rows or overall fails."""
    row = gate.first().asDict()
    if not row["n"]:
        raise GateFailed("no rows were scored")
    if not row["overall"]:
        raise GateFailed(f"below the threshold: {[k[5:] for k, v in row.items() if k.startswith('pass_') and not v]}")
    return row
