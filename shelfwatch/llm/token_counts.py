"""Exact token counts of whole texts, huge ones in overlapping chunks.

A text of ordinary length is encoded as it is. A huge one is encoded in overlapping chunks with
offsets: two neighbouring chunks are spliced at a place in their overlap where both have a
token boundary at white space and agree on the tokens to either side; if there is no such
place, the overlap is widened until there is one or until it holds the rest of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents_of

#: Characters of a chunk, of an overlap at first, and of a text that is encoded in one piece.
CHUNK, OVERLAP, HUGE = 16_384, 512, 32_768
#: Tokens on both sides of a splice that must agree, at least one on each side.
AGREE = 4
#: Pieces whose counts a worker remembers at most.
REMEMBERED = 400_000
LIMIT = 2_048

_tokenizers: dict[str, tuple] = {}


def _tokenizer(path: str):
    """The tokenizer, and the counts of pieces already encoded; one for each worker and file."""
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _tokenizers[path] = (tokenizer, {})
    return _tokenizers[path]


def encoded(tokenizer, text: str, start: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, begins, ends) of a chunk, with offsets into the whole text."""
    found = tokenizer.encode(text[start:stop], add_special_tokens=False)
    spans = np.array(found.offsets, np.int64).reshape(-1, 2) + start
    return np.array(found.ids, np.int64), spans[:, 0], spans[:, 1]


def splice(left: tuple, right: tuple, text: str, start: int, stop: int) -> tuple[int, int] | None:
    """(tokens of left, token of right) at which the chunks join, or None.

    A splice stands where a token begins in both chunks after white space, and the ``AGREE``
    tokens before and after it are the same in both, as far as the overlap ``start..stop`` has
    so many. White space parts words for these tokenizers, so what stands on one side of it
    does not depend on the other.
    """
    common, at_left, at_right = np.intersect1d(left[1], right[1], return_indices=True)
    middle = (start + stop) / 2
    for k in np.argsort(np.abs(common - middle), kind="stable"):
        place, i, j = int(common[k]), int(at_left[k]), int(at_right[k])
        if not start < place < stop or text[place - 1] not in " \n\t\r":
            continue
        if i and left[1][i - 1] == place or j and right[1][j - 1] == place:
            continue  # several tokens may share one character
        before, after = min(i, j, AGREE), min(len(left[0]) - i, len(right[0]) - j, AGREE)
        same = all(
            np.array_equal(a[i - before : i + after], b[j - before : j + after]) for a, b in zip(left, right)
        )
        if before and after and same:
            return i, j
    return None


def count_huge(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text, from overlapping chunks; memory is bounded by the widest chunk."""
    n, start, total, skipped = len(text), 0, 0, 0
    stop = min(n, chunk)
    left = encoded(tokenizer, text, start, stop)
    while stop < n:
        wide = overlap
        while True:
            begin = max(start, stop - wide)
            end = min(n, begin + max(chunk, 2 * wide))
            right = encoded(tokenizer, text, begin, end)
            found = splice(left, right, text, begin, stop)
            if found and found[0] >= skipped:
                total += found[0] - skipped
                skipped, left, start, stop = found[1], right, begin, end
                break
            if begin == start:
                # The overlap is the whole left chunk: take both as one chunk.
                end = min(n, stop + max(chunk, stop - start))
                left, stop = encoded(tokenizer, text, start, end), end
                break
            wide *= 2
    return total + len(left[0]) - skipped


def count_pieces(tokenizer, known: dict, texts: list[str], parted_by_space: bool) -> list[int]:
    """Tokens of each text.

    Where the tokenizer drops white space, a space parts words for sure, so the pieces between
    spaces are encoded once and remembered.
    """
    if not parted_by_space:
        return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    parts = [text.split(" ") for text in texts]
    fresh = list({p for part in parts for p in part if p not in known})
    if fresh:
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
            fresh = list({p for part in parts for p in part})
        for at in range(0, len(fresh), 4096):
            some = fresh[at : at + 4096]
            encodings = tokenizer.encode_batch_fast(some, add_special_tokens=False)
            known.update(zip(some, (len(e.ids) for e in encodings)))
    return [sum(map(known.__getitem__, part)) for part in parts]


def drops_spaces(tokenizer) -> bool:
    """Whether a space between two letters leaves no trace in the tokens of either."""
    pair, apart = "xq zj 7", ["xq", "zj", "7"]
    together = tokenizer.encode(pair, add_special_tokens=False).ids
    return together == [i for p in apart for i in tokenizer.encode(p, add_special_tokens=False).ids] and not (
        tokenizer.encode("   ", add_special_tokens=False).ids
    )


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = LIMIT,
    huge: int = HUGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit), one for each row of ``docs``.

    Counts are those of the ``tokenizers`` library for the whole text, without begin, end or
    added special tokens, truncation or padding. ``tokenizer_path`` names a file that every
    worker has. Null and empty texts have no bytes and no tokens; a null id stays null; rows that
    repeat an id are counted each on their own. No rows give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, known = _tokenizer(tokenizer_path)
        by_space = drops_spaces(tokenizer)
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            for at in range(0, len(texts), 256):
                part = texts.slice(at, 256)
                rows = part.to_pylist()
                counts = np.zeros(len(rows), np.int64)
                usual = [i for i, t in enumerate(rows) if len(t) <= huge]
                counts[usual] = count_pieces(tokenizer, known, [rows[i] for i in usual], by_space)
                for i, text in enumerate(rows):
                    if len(text) > huge:
                        counts[i] = count_huge(tokenizer, text)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, 256),
                        pc.binary_length(part).cast(pa.int64()),
                        pa.array(counts),
                        pa.array(counts > limit),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return documents_of(docs, id_col, text_col).mapInArrow(run, schema)
