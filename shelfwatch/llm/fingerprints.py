"""Document fingerprints by threshold-scaled sketches, in DataFrame functions only.

A sketch holds every shingle hash below a fixed fraction of the hash range, so it grows with
the document. Sketches of parts merge by union, and the share of one sketch found in another
estimates how much of the document the other contains, however unequal their sizes are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import documents_of

#: Words of a shingle, and the fraction of the hash range that is kept.
WORDS, FRACTION = 3, 0.25
#: Documents of a stretch of ids at about, and stretches at most.
STRETCH, STRETCHES = 1_500, 4_096
_BITS = 48
#: Longer words are cut, so that texts without white space have shingles too.
_PIECE = r"[^\x20\x09-\x0D]{1,16}"


def sketch(text: Column, words: int = WORDS, fraction: float = FRACTION) -> Column:
    """The sorted distinct shingle hashes of a text below the threshold, as array<bigint>.

    A text of fewer words has its whole sequence as its one shingle, a blank one has none.
    """
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_PIECE), F.lit(0))
    mask, limit = F.lit((1 << _BITS) - 1), F.lit(int(fraction * (1 << _BITS)))

    def shingles(p: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(p) - words),
            lambda i: F.xxhash64(*[F.get(p, i + j) for j in range(words)]).bitwiseAND(mask),
        )
        whole = F.when(F.size(p) > 0, F.array(F.xxhash64(p).bitwiseAND(mask))).otherwise(F.array().cast("array<bigint>"))
        return F.when(F.size(p) >= words, runs).otherwise(whole)

    # The pieces are bound once, so the text is not searched again for every use.
    hashes = F.element_at(F.transform(F.array(pieces), shingles), 1)
    return F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < limit)))


def merged(a: Column, b: Column) -> Column:
    """The sketch of two documents together."""
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """The estimated share of ``a``'s shingles that ``b`` has; null when ``a``'s sketch is empty."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a))


def likeness(a: Column, b: Column) -> Column:
    """The estimated Jaccard similarity; 0 when both sketches are empty."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))


def fingerprint(text: Column, sketched: Column) -> Column:
    """Text form: a checksum of the whole text, then six bytes per hash in base 64."""
    digits = F.array_join(F.transform(sketched, lambda h: F.lpad(F.hex(h), _BITS // 4, "0")), "")
    check = F.lpad(F.lower(F.hex(F.xxhash64(F.coalesce(text, F.lit(""))))), 16, "0")
    return F.concat(check, F.lit(":"), F.translate(F.base64(F.unhex(digits)), "\r\n", ""))


def sketch_of(fingerprinted: Column) -> Column:
    """The sketch inside a fingerprint."""
    digits = F.hex(F.unbase64(F.substring_index(fingerprinted, ":", -1)))
    size = _BITS // 4
    count = (F.length(digits) / size).cast("int")
    each = F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.conv(F.substring(digits, i * size + 1, F.lit(size)), 16, 10).cast("bigint")
    )
    return F.when(count > 0, each).otherwise(F.array().cast("array<bigint>"))


def id_stretches(docs: DataFrame, stretch: int = STRETCH, most: int = STRETCHES) -> tuple[list[int], int | None]:
    """(ids at which a new stretch begins, the smallest id): stretches of about as many documents each.

    The ids are chosen from a hashed sample; where stretches begin does not change any result.
    """
    ids = docs.filter("doc_id is not null")
    rows, least = ids.agg(F.count(F.lit(1)), F.min("doc_id")).first()
    count = max(1, min(most, -(-rows // stretch)))
    if count == 1:
        return [], least
    every = max(1, rows // (count * 200))
    sample = ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    shares = F.array(*[F.lit(k / count) for k in range(1, count)])
    found = sample.agg(F.percentile_approx("doc_id", shares, 100_000)).first()[0] or []
    return sorted({v for v in found if v > least}), least


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with ``next_<column>`` of the next document by doc_id; after the last comes the first.

    Documents are sorted within stretches of ids; the document that begins a stretch is sent
    to the one before as well. Rows of one id follow each other by a hash of their text, rows
    with a null id come last.
    """
    bounds, least = id_stretches(docs)
    starts = F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>")
    last = len(bounds)
    at = F.coalesce(F.size(F.filter(starts, lambda b: b <= F.col("doc_id"))), F.lit(last))
    at = F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(at)
    first = F.col("doc_id") == F.lit(least) if least is not None else F.lit(True)
    places = F.array(
        F.struct(at.alias("stretch"), F.lit(0).alias("guest")),
        F.when(F.array_contains(starts, F.col("doc_id")), F.struct((at - 1).alias("stretch"), F.lit(1).alias("guest"))),
        F.when(first, F.struct(F.lit(last).alias("stretch"), F.lit(2).alias("guest"))),
    )
    rows = docs.withColumn("__place", F.explode(F.array_compact(places)))
    order = Window.partitionBy("__place.stretch").orderBy(
        F.col("__place.guest"), F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), "text"
    )
    named = [F.lead(c).over(order).alias(f"next_{c}") for c in columns]
    return rows.select("*", *named).filter("__place.guest = 0").drop("__place")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are.

    The edited text has the last ``floor(n_chars / 2)`` code points replaced by the first as
    many, or all, of the next document by doc_id. Rows: (doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next). Texts with the same fingerprint
    have likeness 1. Null counts as empty; an empty text has an empty sketch. Rows that repeat
    an id follow one another; a lone document is its own next. No rows give no rows.
    """
    texts = documents_of(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = with_next(texts.withColumn("sketch", sketch(F.col("text"))), ["text", "sketch"])
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), size - half), F.left(F.col("next_text"), half))
    rows = rows.select(
        "doc_id",
        size.cast("bigint").alias("n_chars"),
        edited.alias("edited"),
        "sketch",
        "next_sketch",
        fingerprint(F.col("text"), F.col("sketch")).alias("fingerprint"),
        F.xxhash64("next_text").alias("next_check"),
        F.xxhash64("text").alias("check"),
    ).withColumn("edited_sketch", sketch(F.col("edited")))
    same_next = (F.col("check") == F.col("next_check")) & (F.col("sketch") == F.col("next_sketch"))
    return (
        rows.withColumn("edited_fingerprint", fingerprint(F.col("edited"), F.col("edited_sketch")))
        .select(
            "doc_id",
            "n_chars",
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            "fingerprint",
            "edited_fingerprint",
            F.when(F.col("fingerprint") == F.col("edited_fingerprint"), F.lit(1.0))
            .otherwise(likeness(F.col("sketch"), F.col("edited_sketch")))
            .alias("near_edited"),
            F.when(same_next, F.lit(1.0)).otherwise(likeness(F.col("sketch"), F.col("next_sketch"))).alias("near_next"),
        )
    )
