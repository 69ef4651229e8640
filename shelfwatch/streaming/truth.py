"""Predictions beside the actual values that come in later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def delayed_truth(
    predictions: DataFrame,
    actuals: DataFrame,
    keys: Sequence[str] = ("store_nbr", "family", "date"),
    due: str = "date",
    known_at: str = "known_at",
    wait: str = "7 days",
    late: str = "1 day",
    value: str = "sales",
) -> DataFrame:
    """Each prediction with ``y``, the actual value that became known within ``wait`` of its time ``due``.

    Works on batches and on streams. On streams a prediction with its value comes out as soon as
    both are there; one without comes out with a null ``y`` once the watermarks, ``late`` behind
    the newest times of both streams, say that no value can come in time. Both sides leave the
    state by then. ``due`` and ``known_at`` must be timestamps; a value known before ``due`` or
    after ``wait`` does not count, and neither does one with a null key or time. A prediction
    with a null time is a row without a value in a batch, and is dropped by a stream. There must
    be one actual value for a key; further ones would give further rows.
    """
    left = predictions.withWatermark(due, late).alias("p")
    labels = actuals.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(known_at), F.col(value).alias("y"))
    right = labels.withWatermark(known_at, late).alias("a")
    start = F.col(f"p.{due}")
    same = (F.col(f"a.{known_at}") >= start) & (F.col(f"a.{known_at}") <= start + F.expr(f"INTERVAL {wait}"))
    for k in keys:
        own, other = F.col(f"p.{k}"), F.col(f"a.__{k}")
        # Compared as it is, the watermarked time would let a prediction leave the state at its own time.
        same = same & (F.unix_micros(own) == F.unix_micros(other) if k == due else own == other)
    return left.join(right, same, "left_outer").select("p.*", "y")
