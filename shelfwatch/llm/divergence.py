"""How far the word use of each source stands from the other sources of its language.

Words are counted per group, which is a (lang, source); a term is kept where enough documents
of the language hold it. Each group then becomes bitmaps: for every count that occurs in it,
the set of terms that occur so often, cut into words of 64 terms. The weight of a term depends
on its count alone, so a pair of groups needs only its joint cells: how many terms have count
``a`` in the one and ``b`` in the other, which is the population count of the AND of two bit
words. Terms that a group lacks are never stored: their cells are what is left of the totals.

Texts are counted in tasks, a few megabytes at a time; from there on everything is a DataFrame
expression in whole numbers. Counting combines before its shuffle, so neither a source nor a
word that makes up a third of all rows is hot; a word of the bitmaps holds 64 terms of each
source, however many documents there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_broadcast, narrow_batches, stored, text_column
from .periodic import word_array

#: Documents of a language that hold a kept term, at least; what is added to every count; ranks of terms.
MIN_DOCS, SMOOTH, TOP_TERMS = 30, 5, 50
_SCALE = 1_000_000_000
# Fixed value: what a term is made of, all but ASCII other than letters.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of texts that are counted at once.
CHUNK_BYTES = 4 << 20
# A term's bytes with A-Z as a-z; a space for all others.
_TERM_BYTES = np.full(256, 0x20, np.uint8)
_TERM_BYTES[0x80:] = np.arange(0x80, 0x100)
_TERM_BYTES[0x61:0x7B] = _TERM_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a few megabytes of texts at a time."""

    def chunk(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        langs, sources = (rows.column(c).combine_chunks().dictionary_encode() for c in (0, 1))
        group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
        texts = text_column(rows.column(2).combine_chunks())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.zeros(0, np.uint8)
        if offsets[-1] > offsets[0]:
            data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        # What belongs to no term counts as white space.
        words, counts = word_array(_TERM_BYTES[data], offsets - offsets[0])
        words = words.dictionary_encode()
        ids, distinct = words.indices.to_numpy().astype(np.int64), max(1, len(words.dictionary))
        doc = np.repeat(np.arange(len(counts)), counts)
        found, n = np.unique(group[doc] * distinct + ids, return_counts=True)
        held_by = np.unique(doc * distinct + ids)
        docs = np.unique(group[held_by // distinct] * distinct + held_by % distinct, return_counts=True)[1]
        # A row without a term for every group, so that no group is lost.
        groups = np.unique(group)
        of = np.concatenate([found // distinct, groups])
        term = pa.array(np.append(found % distinct, np.zeros(len(groups), np.int64)), mask=np.arange(len(of)) >= len(found))
        none = np.zeros(len(groups), np.int64)
        width = len(sources.dictionary)
        return pa.RecordBatch.from_arrays(
            [
                langs.dictionary.take(pa.array(of // width)),
                sources.dictionary.take(pa.array(of % width)),
                words.dictionary.view(pa.large_string()).cast(pa.string()).take(term),
                pa.array(np.append(n, none)),
                pa.array(np.append(docs, none)),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= CHUNK_BYTES:
            yield chunk(held)
            held = []
    if sum(map(len, held)):
        yield chunk(held)


def group_terms(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Rows (lang, source, term, n, docs): occurrences of each term in a group, and documents that hold it.

    A task counts a few megabytes of texts at once, whole documents always, and Spark adds the
    counts up before its shuffle and after it. A group without terms has a row with a null term.
    """
    narrow_batches(docs.sparkSession)
    names = {lang_col: "lang", source_col: "source", text_col: "text"}
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in names.items()])
    counted = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(cells: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows (lang, term, term_id, lang_n) of the terms that enough documents of the language hold.

    Ids follow the frequency, so that terms of like counts share a bitmap word; each task
    numbers its own stretch of the sorted terms.
    """
    found = cells.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    order = [F.col("lang"), F.col("lang_n").desc(), F.col("term")]
    ranged = found.filter(F.col("docs") >= min_docs).repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.select("lang", "term", F.monotonically_increasing_id().alias("term_id"), "lang_n")


def _weight(n: str, total: str, v: str, smooth: int) -> Column:
    """1 + floor(10^9 * (n + smooth) / (total + smooth * v)) in decimals, which no product overflows; 0 without terms."""
    above = f"cast({n} + {smooth} as decimal(20,0)) * cast({_SCALE} as decimal(10,0))"
    below = f"cast({total} + {smooth} * {v} as decimal(24,0))"
    return F.expr(f"case when {v} > 0 then 1 + ({above}) div ({below}) else 0 end")


def bitmaps(cells: DataFrame) -> DataFrame:
    """Rows (lang, word, source, n, bits): which terms of a bitmap word a source holds ``n`` times."""
    bit = F.expr("shiftleft(1L, cast(term_id & 63 as int))")
    return cells.groupBy("lang", F.shiftright("term_id", 6).alias("word"), "source", "n").agg(F.bit_or(bit).alias("bits"))


def _other(groups: DataFrame) -> DataFrame:
    return groups.select("lang", F.col("source").alias("other"), F.col("zero").alias("other_zero"))


def pair_values(cells: DataFrame, groups: DataFrame, smooth: int = SMOOTH) -> DataFrame:
    """Rows (lang, a, b, value) of every two sources a < b of a language.

    The difference of a cell (n in a, m in b) is written as that of an absent term in both, what
    n and m change alone, and what they change together. The first follows from the number of
    terms, the second from the size of each bitmap, and only the third needs the AND.
    """
    zeros = F.col("zero"), F.col("other_zero")
    both_absent = F.abs(zeros[0] - zeros[1])
    ordered = F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b")
    small = bounded_broadcast(groups)
    base = groups.join(bounded_broadcast(_other(groups)), "lang").filter("source < other")
    base = base.select("lang", *ordered, (F.col("v") * both_absent).alias("value"))

    words = bitmaps(cells).join(small, ["lang", "source"])
    words = stored(words.select("lang", "word", "source", "bits", _weight("n", "total", "v", smooth).alias("p"), "zero"), "bitmaps")
    sizes = words.groupBy("lang", "source", "p", "zero").agg(F.sum(F.bit_count("bits")).alias("terms"))
    alone = F.sum(F.col("terms") * (F.abs(F.col("p") - zeros[1]) - both_absent))
    alone = (
        sizes.join(bounded_broadcast(_other(groups)), "lang")
        .filter("source <> other")
        .groupBy("lang", "source", "other")
        .agg(alone.alias("value"))
        .select("lang", *ordered, "value")
    )
    right = words.select(
        "lang", "word", F.col("source").alias("other"), F.col("bits").alias("other_bits"),
        F.col("p").alias("other_p"), F.col("zero").alias("other_zero"),
    )
    shared = F.bit_count(F.col("bits").bitwiseAND(F.col("other_bits")))
    change = (
        F.abs(F.col("p") - F.col("other_p")) - F.abs(F.col("p") - zeros[1]) - F.abs(zeros[0] - F.col("other_p")) + both_absent
    )
    together = (
        words.join(right, ["lang", "word"])
        .filter("source < other and (bits & other_bits) <> 0")
        .groupBy("lang", F.col("source").alias("a"), F.col("other").alias("b"))
        .agg(F.sum(shared * change).alias("value"))
    )
    return base.union(alone).union(together).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
    smooth: int = SMOOTH,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): how each source differs, and by which terms.

    A group is a (lang, source); a kept term stands in ``min_docs`` documents of its language
    or more. A term that a group holds n times weighs ``p = 1 + floor(10^9 (n + smooth) / (N +
    smooth V))`` there, with N the group's occurrences of kept terms and V the language's kept
    terms. ``pair`` rows give every other source of the language and the summed difference of
    the weights over all kept terms. ``term`` rows give the ``top`` terms that the group uses
    more than its language as a whole, with the excess. Ranks are by value, then by the item's
    bytes. All arithmetic is in whole numbers.

    A null text, lang or source counts as an empty one. A row without terms still makes its
    group; a language without kept terms has pairs of value 0 and no terms. Repeated rows are
    documents of their own. No rows give no rows, and other columns play no part.
    """
    cells = stored(group_terms(docs, text_col, lang_col, source_col), "group-terms")
    terms = stored(kept_terms(cells, min_docs), "kept-terms")
    kept = stored(
        cells.filter("term is not null").join(terms, ["lang", "term"]).select("lang", "source", "term", "term_id", "n", "lang_n"),
        "kept-cells",
    )
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        cells.select("lang", "source")
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "v", "lang_total")])
    )
    groups = stored(groups.withColumn("zero", _weight("0", "total", "v", smooth)), "groups")

    pairs = pair_values(kept, groups.select("lang", "source", "total", "v", "zero"), smooth)
    ways = F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))
    )
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    shape = ["lang", "source", "part", "item", "value", "rank"]
    pair_rows = pairs.select("lang", F.inline(ways), "value").withColumn("rank", F.row_number().over(best))
    pair_rows = pair_rows.withColumn("part", F.lit("pair")).select(*shape)

    more = kept.join(bounded_broadcast(groups.drop("zero")), ["lang", "source"])
    more = more.withColumn("p", _weight("n", "total", "v", smooth)).withColumn("q", _weight("lang_n", "lang_total", "v", smooth))
    more = more.filter("n > 0 and p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    term_rows = more.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return pair_rows.union(term_rows.withColumn("part", F.lit("term")).select(*shape))


DIVERGENCE_SQL = rf"""
with texts as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{TERM}') as found
  from documents
), words as (
  select row, lang, source, unnest(found) as term from texts
), kept as (
  select lang, term from words group by lang, term having count(distinct row) >= {MIN_DOCS}
), counts as (
  select lang, source, term, count(*) as n from words join kept using (lang, term) group by all
), langs as (
  select lang, count(*) as v from kept group by lang
), groups as (
  select g.lang, g.source, coalesce(any_value(v), 0) as v, coalesce(sum(n), 0) as total
  from (select distinct lang, source from texts) g
  left join langs using (lang) left join counts using (lang, source)
  group by g.lang, g.source
), weights as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + ({_SCALE} * (coalesce(c.n, 0) + {SMOOTH})) // (g.total + {SMOOTH} * g.v) as p
  from groups g join kept k using (lang) left join counts c using (lang, source, term)
), whole as (
  select lang, term, 1 + ({_SCALE} * (sum(n) + {SMOOTH})) // (sum(sum(n)) over (partition by lang) + {SMOOTH} * any_value(v)) as q
  from counts join langs using (lang) group by lang, term
), pairs as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from weights a join weights b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by all
), every_pair as (
  select a.lang, a.source, b.source as item, coalesce(p.value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
), ranked as (
  select lang, source, 'pair' as part, item, value from every_pair
  union all
  select lang, source, 'term', term, p - q from weights join whole using (lang, term) where n > 0 and p > q
)
select lang, source, part, item, cast(value as bigint) as value,
  cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
from ranked
qualify part = 'pair' or row_number() over (partition by lang, source, part order by value desc, item) <= {TOP_TERMS}
"""
