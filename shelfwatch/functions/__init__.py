"""Column functions: built-in expressions only, so they stay inside generated code."""

from .calendar import HOLIDAYS, days_to_holiday
from .scores import clip_forecast, drift_band, nli_score
from .text import is_blank, token_precision, tokenize
from .vectors import cosine_clip

__all__ = [
    "HOLIDAYS",
    "clip_forecast",
    "cosine_clip",
    "days_to_holiday",
    "drift_band",
    "is_blank",
    "nli_score",
    "token_precision",
    "tokenize",
]
