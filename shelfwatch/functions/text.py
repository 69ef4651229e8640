"""Token and blank-text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters, numbers of every kind and the underscore, in any script. Java's own word class
# is ASCII-only, and its Unicode variant would also join combining marks.
WORD = r"[\p{L}\p{N}_]+"


def tokenize(text: Column) -> Column:
    """Distinct lower-case words of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def token_precision(context: Column, answer: Column) -> Column:
    """Share of the answer's distinct words that the context holds; 0 for an answer without words.

    Null where either text is null or empty: those rows are input errors, not scores.
    """
    words = tokenize(answer)
    shared = F.size(F.array_intersect(words, tokenize(context)))
    score = F.when(F.size(words) == 0, F.lit(0.0)).otherwise(shared / F.size(words))
    return F.when((F.length(context) > 0) & (F.length(answer) > 0), score)


def is_blank(text: Column) -> Column:
    """True for a text of only white space, in any script."""
    return text.rlike(r"(?U)^[\s\x1c-\x1f]*$")
