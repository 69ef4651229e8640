"""Language-model scores of documents, learned from a training fold of the corpus.

Word counts give the base score. The model is a causal self-attention network over subword
ids of a public vocabulary, trained in numpy inside Spark tasks: each task takes gradient
steps on its own documents' windows, and the weights of all tasks are averaged by Spark after
every round. Each word of a document comes from the counts or from the network, which spells it
out of subwords: its probability is ``(1 - w) * smoothed share of its count + w * network``. The
weight ``w`` is the one of a fixed ladder under which the training fold is likeliest, with each of
its words left out of its own count, so that words seen once stand for words not seen before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .attention import SPAN, Adam, prepared, start_weights, texts_log10, unpack, windows
from .common import bytes_of, chunks, documents_of, mix, range_hashes, stored, text_column, wide_batches
from .token_shards import PieceTable, byte_encoder, encode_pieces, laid_out

#: Words whose counts every task holds; rarer ones are joined.
DICTIONARY = 300_000
#: Subwords with an input vector of their own, single-subword classes, classes in all.
INPUTS, SINGLE, CLASSES = 2_047, 40, 64
#: Training rounds, of which each window belongs to one; windows of a gradient step.
TRAIN_ROUNDS, BATCH = 4, 256
#: Weights of the network from which the training fold chooses one, as powers of ten.
LADDER = tuple(-3 + 0.25 * k for k in range(12))
#: Words that are worked on at once, words whose probabilities are multiplied before a logarithm is taken.
GROUP_WORDS, TOGETHER = 65_536, 16
#: Bytes of texts whose words are looked up at once, words whose subwords a worker keeps.
TEXT_BYTES, REMEMBERED_WORDS = 4 << 20, 400_000
END_ID = 50_256
END_KEY = np.uint64(0x9AE16A3B2F90404F)


class SubwordTable(PieceTable):
    """Subword ids and keys of the words seen so far; the first place is the end's. One per worker."""

    cleared = 0

    def clear(self) -> None:
        self.cleared += 1
        self.encoder = byte_encoder(*self.vocabulary)[0]
        self.pieces = pa.array([b""], pa.large_binary())
        self.keys = np.array([END_KEY], np.uint64)
        self.ids, self.starts, self.counts = np.array([END_ID], np.uint16), np.zeros(1, np.int64), np.ones(1, np.int64)

    def encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, offsets = bytes_of(pieces)
        keys = range_hashes(data.astype(np.uint64) + np.uint64(1), offsets[:-1], offsets[1:])
        self.keys = np.concatenate([self.keys, keys])
        space, nothing = (pa.scalar(v, pa.large_binary()) for v in (b" ", b""))
        return encode_pieces(*self.vocabulary, pc.binary_join_element_wise(space, pieces, nothing), "replace")


def _word_codes(table: SubwordTable, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end text, places of their words and ends in the table, number of those in each text), some texts at a time."""
    # A column that was cut out of a batch and cast has offsets that begin above 0, which Arrow's ``ascii_lower`` reads wrongly.
    data, offsets = bytes_of(texts)
    texts = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(data))
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, begins = split.values, split.offsets.to_numpy()
    real = pc.greater(pc.binary_length(words), 0)
    first = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[begins]
    codes = table.codes(words.filter(real).cast(pa.large_binary()))
    codes = np.insert(codes[first[0] : first[-1]], first[1:] - first[0], 0)
    first = first - first[0] + np.arange(len(first))
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(first, first[row] + GROUP_WORDS, side="right")) - 1)
        yield row, end, codes[first[row] : first[end]], np.diff(first[row : end + 1])
        row = end


_tables: dict[tuple[str, str], SubwordTable] = {}


def _table(path: str, pattern: str) -> SubwordTable:
    if (path, pattern) not in _tables:
        _tables[path, pattern] = SubwordTable(path, pattern, REMEMBERED_WORDS)
    return _tables[path, pattern]


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from learning: crc32 of its id as text, modulo 7, is 2; a null id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


@dataclass
class LanguageModel:
    """The network, what it knows of subwords, and the counts of frequent words."""

    input_of: np.ndarray
    class_of: np.ndarray
    within: np.ndarray
    inputs: int
    weights: np.ndarray
    path: str
    pattern: str
    keys: np.ndarray | None = None
    counts: np.ndarray | None = None
    total: int = 0
    smooth: float = 1.0

    def counts_of(self, keys: np.ndarray) -> np.ndarray:
        """The count of each word that is held, -1 for others."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        found = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[found] == keys, self.counts[found], -1)

    def batches(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(inputs, target classes, scored, places) of all windows; a sequence begins with the end id."""
        places, real, scored = windows(sizes)
        tokens = self.input_of[_before(ids, sizes)][places]
        tokens[~real] = self.input_of[END_ID]
        return tokens, self.class_of[ids][places], scored, places


def _before(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The id before each id of sequences laid end to end; the end id before the first of each."""
    before = np.concatenate([[END_ID], ids[:-1]])
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = END_ID
    return before


def classes_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(input, class, log10 of the share within the class) of every subword id, from corpus counts.

    The most frequent ids are classes of their own, the others share classes of about equal
    weight; counts are raised by one, so that every id has a share.
    """
    weight = counts + 1.0
    order = np.lexsort((np.arange(len(weight)), -weight))
    rank = np.empty(len(weight), np.int64)
    rank[order] = np.arange(len(weight))
    rest = np.cumsum(weight[order[SINGLE:]])
    groups = np.minimum(CLASSES - SINGLE - 1, (rest - weight[order[SINGLE:]]) * (CLASSES - SINGLE) // rest[-1])
    of = np.empty(len(weight), np.int64)
    of[order[:SINGLE]] = np.arange(SINGLE)
    of[order[SINGLE:]] = SINGLE + groups.astype(np.int64)
    mass = np.bincount(of, weight, CLASSES)
    inputs = np.where(rank < INPUTS, rank, INPUTS + of)
    return inputs, of, np.log10(weight / mass[of])


#: Rows of ``_windows``.
_CUT = "round int, ids binary, kind int, key long, n long"


def _windows(path: str, pattern: str):
    """(round, ids) of all training windows: an id and the ``SPAN`` that follow it, fewer at a text's end, 16 bits each;
    and (kind, key, n): counts of words (kind 0) and subwords (kind 1) of a task's documents.

    Windows do not overlap, so every id is learned from once. A window's round follows from its ids.
    """

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return keys, np.bincount(inverse, np.concatenate([p[1] for p in parts])).astype(np.int64)

    def counted(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        n = len(keys)
        columns = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.array(np.full(n, kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, names=["round", "ids", "kind", "key", "n"])

    def cut(ids: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        at, real, _ = windows(sizes, 0)
        rows = np.concatenate([_before(ids, sizes)[at[:, :1]], ids[at]], axis=1).astype(np.uint16)
        kept = np.concatenate([np.ones((len(rows), 1), bool), real], axis=1)
        rounds = mix((rows.astype(np.uint64) * kept) @ (np.arange(1, SPAN + 2, dtype=np.uint64) * np.uint64(0x9E3779B1)))
        ends = np.concatenate([[0], np.cumsum(kept.sum(axis=1) * 2)]).astype(np.int32)
        n = len(rows)
        flat = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(rows[kept].tobytes())])
        columns = [pa.array((rounds % np.uint64(TRAIN_ROUNDS)).astype(np.int32)), flat]
        columns += [pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["round", "ids", "kind", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, parts, subwords = _table(path, pattern), [], np.zeros(END_ID + 1, np.int64)
        for batch in chunks(batches, 0, TEXT_BYTES):
            counts = 0
            for _, _, codes, words in _word_codes(table, text_column(batch.column(0))):
                counts = counts + np.bincount(codes, minlength=len(table.keys))
                ids = laid_out(table.ids, table.starts, table.counts, codes).astype(np.int64)
                subwords += np.bincount(ids, minlength=END_ID + 1)
                yield cut(ids, np.add.reduceat(table.counts[codes], np.cumsum(words) - words))
            seen = np.flatnonzero(counts)
            parts.append((table.keys[seen], counts[seen]))
            if sum(len(p[0]) for p in parts) > 2_000_000:
                yield counted(0, *merged(parts))
                parts = []
        if parts:
            yield counted(0, *merged(parts))
        seen = np.flatnonzero(subwords)
        yield counted(1, seen.astype(np.uint64), subwords[seen])

    return run


def _trained(shared, part: int):
    """Gradient steps on the windows of a task that belong to this round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        learner, used, turn = Adam(model.weights, model.inputs, CLASSES), 0, 0
        end = model.input_of[END_ID]
        for batch in batches:
            order = np.random.default_rng([part, turn]).permutation(len(batch))
            turn += 1
            for a in range(0, len(order), BATCH):
                some = batch.column(0).take(pa.array(order[a : a + BATCH]))
                ends = np.frombuffer(some.buffers()[1], np.int32)[some.offset : some.offset + len(some) + 1]
                real = np.arange(SPAN + 1) < np.diff(ends)[:, None] // 2
                ids = np.zeros(real.shape, np.int64)
                ids[real] = np.frombuffer(some.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(np.uint16)
                counted = real[:, 1:]
                tokens = np.where(counted, model.input_of[ids[:, :-1]], end)
                learner.step(tokens, model.class_of[ids[:, 1:]], counted)
                used += len(some)
        if used:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(learner.vector), dtype=np.int32)), pa.array(learner.vector.astype(np.float64) * used),
                 pa.array(np.full(len(learner.vector), used, np.int64))],
                names=["at", "value", "used"],
            )

    return run


def train(cut: DataFrame, path: str, pattern: str, subword_counts: np.ndarray) -> LanguageModel:
    """A model from the windows (round, ids) of all training texts: rounds of local steps and averages.

    Every window is learned from once, in one of the rounds.
    """
    spark = cut.sparkSession
    inputs_of, class_of, within = classes_of(subword_counts)
    inputs = INPUTS + CLASSES
    model = LanguageModel(inputs_of, class_of, within, inputs, start_weights(inputs, CLASSES), path, pattern)
    model.weights[-CLASSES:] = np.log(np.bincount(class_of, subword_counts + 1.0, CLASSES) / (subword_counts + 1.0).sum())
    for part in range(TRAIN_ROUNDS):
        shared = spark.sparkContext.broadcast(model)
        own = cut.filter(F.col("round") == part).select("ids")
        steps = own.mapInArrow(_trained(shared, part), "at int, value double, used long")
        averaged = steps.groupBy("at").agg((F.sum("value") / F.sum("used")).alias("value"))
        with wide_batches(spark):
            found = averaged.toPandas()  # one row per weight of the network
        if not len(found):
            break
        weights = model.weights.copy()
        weights[found["at"].to_numpy()] = found["value"].to_numpy(np.float32)
        model = LanguageModel(inputs_of, class_of, within, inputs, weights, path, pattern)
    return model


def _mixed_log10(counts: np.ndarray, smooth: float, network: np.ndarray, weight: float) -> np.ndarray:
    """log10 of the mixture of a word's smoothed share of the counts and the network's log10 probability."""
    return np.log10((1 - weight) * ((counts + 1.0) / smooth) + weight * 10.0**network)


def _mixed_sums(shares: np.ndarray, network: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The sum of the mixture's log10 over the words of each text, a column for each weight of the ladder.

    Probabilities of ``TOGETHER`` words are multiplied before a logarithm is taken: a share is no
    less than one of all tokens, so the product stays in the range of a double.
    """
    groups = -(-words // TOGETHER)
    of = np.repeat(np.arange(len(words)), groups)
    number = np.arange(len(of)) - np.repeat(np.cumsum(groups) - groups, groups)
    begins = np.cumsum(words) - words
    at = (begins[of] + number * TOGETHER) + np.arange(TOGETHER)[:, None]
    real = at < (begins + words)[of]
    at = np.minimum(at, len(shares) - 1)
    counted, spelled = (np.where(real, v[at], 1.0) for v in (shares, network))
    columns = []
    for power in LADDER:
        w = 10.0**power
        columns.append(np.bincount(of, np.log10(np.multiply.reduce((1 - w) * counted + w * spelled, axis=0)), len(words)))
    return np.stack(columns, axis=1)


def _scored(shared):
    """Base and model scores of whole documents, and the words whose counts must be joined.

    Until then those words count as unseen; ``rare_network`` is the network's log10 probability of each.
    ``mixed`` has the document's score for each weight of the ladder, ``left_out`` the same with
    each word left out of its own count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table, weights = _table(model.path, model.pattern), prepared(unpack(model.weights, model.inputs, CLASSES))
        none = in_table = np.zeros(0, np.int64)
        cleared = table.cleared
        for batch in chunks(batches, 1, TEXT_BYTES):
            for start, end, codes, words in _word_codes(table, text_column(batch.column(1))):
                begins = np.cumsum(words) - words
                ids = laid_out(table.ids, table.starts, table.counts, codes)
                subwords = table.counts[codes]
                sizes = np.add.reduceat(subwords, begins)
                log10 = texts_log10(weights, model.input_of[_before(ids, sizes)], model.class_of[ids], sizes) + model.within[ids]
                # Below 1e-300 a word's probability would leave the range of a double.
                by_word = np.maximum(np.add.reduceat(log10, np.cumsum(subwords) - subwords), -300.0)
                if cleared != table.cleared or len(in_table) < len(table.keys):
                    # Counts of the words that came to the table since the last look.
                    in_table = in_table if cleared == table.cleared else none
                    in_table, cleared = np.concatenate([in_table, model.counts_of(table.keys[len(in_table) :])]), table.cleared
                own_counts = in_table[codes]
                known = own_counts >= 0
                counts = np.maximum(own_counts, 0).astype(np.float64)
                total = lambda v: np.add.reduceat(v, begins)
                spelled = np.exp(by_word * np.log(10))
                rare = ~known
                ends = pa.array(np.concatenate([[0], np.cumsum(total(rare.astype(np.int64)))]).astype(np.int32))
                steps = pa.array(np.arange(len(words) + 1, dtype=np.int32) * len(LADDER))
                mixed = _mixed_sums((counts + 1) / model.smooth, spelled, words)
                left_out = _mixed_sums((np.maximum(counts - 1, 0) + 1) / max(1.0, model.smooth - 1), spelled, words)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        pa.array(words.astype(np.int64)),
                        pa.array(total(known.astype(np.int64))),
                        pa.array(total(np.log10((counts + 1.0) / model.smooth))),
                        pa.array(total(by_word)),
                        pa.ListArray.from_arrays(steps, pa.array(mixed.ravel())),
                        pa.ListArray.from_arrays(steps, pa.array(left_out.ravel())),
                        pa.ListArray.from_arrays(ends, pa.array(table.keys[codes[rare]].view(np.int64))),
                        pa.ListArray.from_arrays(ends, pa.array(by_word[rare])),
                    ],
                    names=["doc_id", "n_tokens", "n_known", "base", "network", "mixed", "left_out", "rare", "rare_network"],
                )

    return run


def _joined_gain(n: Column, smooth: float, network: Column, weight: float) -> Column:
    """What a word's count adds to its log10 probability in the mixture, over a count of 0."""
    spelled = weight * F.pow(F.lit(10.0), network)
    return F.log10((1 - weight) * (n + 1.0) / smooth + spelled) - F.log10((1 - weight) / smooth + spelled)


def _joined_counts(scored: DataFrame, rare: DataFrame, smooth: float) -> DataFrame:
    """What the counts of joined words add to the scores of each row: (row, more, more_mixed, more_left_out, known).

    A word goes to its row as its count and one probability. The sums, two for each weight of the ladder,
    are formed there: formed before, they would be as many as the words, and ten times as wide.
    """
    n, network = F.col("n"), F.col("network")
    ladder = [10.0**p for p in LADDER]
    return (
        scored.select("row", F.explode(F.arrays_zip("rare", "rare_network")).alias("w"))
        .select("row", F.col("w.rare").alias("key"), F.col("w.rare_network").alias("network"))
        .join(rare, "key")
        .select("row", "n", "network")
        .repartition("row")
        .groupBy("row")
        .agg(
            F.sum(F.log10(n + 1.0)).alias("more"),
            F.array(*[F.sum(_joined_gain(n, smooth, network, w)) for w in ladder]).alias("more_mixed"),
            F.array(*[F.sum(_joined_gain(n - 1, max(1.0, smooth - 1), network, w)) for w in ladder]).alias("more_left_out"),
            F.count(F.lit(1)).alias("known"),
        )
    )


def score_documents(
    docs: DataFrame, ranks_path: str, pattern: str, dictionary: int = DICTIONARY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, network_score), one per row of ``docs``.

    Tokens are lower-cased words and one end per document. Counts of frequent words, at most
    ``dictionary`` of them, are broadcast; the others are joined, so no score depends on the
    size of the dictionary. Null texts are empty and consist of the end alone; a null id belongs to
    the training fold; rows that repeat an id are scored and counted each on their own. Other
    columns play no part, whatever they are called. No rows give no rows.

    Texts are scored whole: a task's memory grows with its longest text, by about 50 bytes for each of its bytes.
    """
    spark = docs.sparkSession
    texts = documents_of(docs, id_col, text_col)
    training = texts.filter(~held_out()).select("text")
    # Texts are cut into windows of ids and their words are counted in one reading.
    cut = stored(training.mapInArrow(_windows(ranks_path, pattern), _CUT), "windows")
    counted = stored(
        cut.filter("kind is not null").groupBy("kind", "key").agg(F.sum("n").alias("n")),
        "word-counts",
    )
    words = counted.filter("kind = 0")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    subwords = np.zeros(END_ID + 1)
    for row in counted.filter("kind = 1").collect():  # at most one row per id of the vocabulary
        subwords[row["key"]] = row["n"]
    model = train(cut, ranks_path, pattern, subwords)
    least = _threshold(words, dictionary)
    often = words.filter(F.col("n") >= least).select("key", "n").toPandas()
    keys = often["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    model.keys, model.counts = keys[order], often["n"].to_numpy(np.int64)[order]
    model.total, model.smooth = total, float(total + distinct + 1)
    shared = spark.sparkContext.broadcast(model)
    schema = "doc_id long, n_tokens long, n_known long, base double, network double"
    schema += ", mixed array<double>, left_out array<double>, rare array<long>, rare_network array<double>"
    scored = stored(texts.mapInArrow(_scored(shared), schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = words.filter(F.col("n") < least).select("key", "n")
    extra = _joined_counts(scored, rare, model.smooth)
    ladder = LADDER
    none = F.array(*[F.lit(0.0) for _ in ladder])
    joined = scored.drop("rare", "rare_network").join(extra, "row", "left").withColumns(
        {
            "base_score": F.col("base") + F.coalesce("more", F.lit(0.0)),
            "mixed": F.zip_with("mixed", F.coalesce("more_mixed", none), lambda a, b: a + b),
            "left_out": F.zip_with("left_out", F.coalesce("more_left_out", none), lambda a, b: a + b),
        }
    )
    joined = stored(joined, "mixed-scores")
    likely = joined.filter(~held_out()).agg(*[F.sum(F.col("left_out")[k]) for k in range(len(ladder))]).first()
    best = max(range(len(ladder)), key=lambda k: (likely[k] if likely[k] is not None else 0.0, -k))
    return joined.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        F.col("mixed")[best].alias("score"),
        F.col("network").alias("network_score"),
    )


def _threshold(words: DataFrame, dictionary: int) -> int:
    """The least count such that at most ``dictionary`` words have it, found from a histogram of counts by octave.

    The octave in which the dictionary is full is cut finer and finer, down to single counts, so
    the dictionary holds the most frequent words however many are frequent.
    """
    low, high, held = 1, 1 << 62, 0
    while low < high:
        # Sixteen steps of a like ratio between the counts that are still open.
        cuts = sorted({low + int((high - low) * (2.0 ** (k / 2) - 1) / (2.0**32 - 1)) for k in range(64)} | {high})
        step = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("n")))
        inside = words.filter((F.col("n") >= low) & (F.col("n") < high))
        bins = {r["step"]: r["words"] for r in inside.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()}
        full = None
        for k in range(len(cuts) - 1, 0, -1):
            if held + bins.get(k, 0) > dictionary:
                full = k
                break
            held += bins.get(k, 0)
        if full is None:
            return low
        if cuts[full] - cuts[full - 1] <= 1:
            return cuts[full]
        low, high = cuts[full - 1], cuts[full]
    return low
