"""Token ids in training order, in binary shards of fixed stride.

Documents are encoded and cut into sequences; a keyed Feistel permutation with cycle-walking
gives every sequence its slot in the training order, without a sort of random numbers and
reproducible from the key. Slots are dealt by range: a shard is a run of slots, every record
has the same size, so slot s stands at byte ``(s mod shard) * stride`` of shard ``s // shard``.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_broadcast, bytes_of, chunks, documents_of, mix, stored, text_column

#: Tokens of a sequence, sequences of a shard, bytes before the tokens of a record.
LENGTH, SHARD, HEADER = 512, 4_096, 16
END_ID = 50_256
ROUNDS = 4
#: Pieces, and bytes of pieces, whose ids a worker keeps.
REMEMBERED, REMEMBERED_BYTES = 1_000_000, 64 << 20

_encoders: dict[tuple[str, str], tuple] = {}
#: First bytes of the characters of three bytes among which there are blanks.
_BLANK_LEADS = np.zeros(256, bool)
_BLANK_LEADS[[0xE1, 0xE2, 0xE3]] = True


def byte_encoder(path: str, pattern: str):
    """The encoder of a rank file, the ids of pieces already encoded and the bytes of each id; one per worker."""
    if (path, pattern) not in _encoders:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        sizes[list(ranks.values())] = list(map(len, ranks))
        _encoders[path, pattern] = (encoder, {}, sizes)
    return _encoders[path, pattern]


def encode_text(encoder, known: dict[str, bytes], text: str) -> bytes:
    """The ids of a whole text as 16-bit words.

    A space between two visible characters always begins a piece of these byte-level
    vocabularies, so pieces are encoded once and remembered, by what follows their space.
    """
    first, *rest = text.split(" ")
    # Pieces that begin or end with a blank are never remembered: such texts come to the long way.
    if first and not first[-1].isspace():
        try:
            return _ids(encoder, first) + b"".join(map(known.__getitem__, rest))
        except KeyError:
            pass
    held, pieces = first, []
    for part in rest:
        if held and part and not held[-1].isspace() and not part[0].isspace():
            pieces.append(held)
            held = part
        else:
            held = f"{held} {part}"
    pieces.append(held)
    if len(known) > REMEMBERED:
        known.clear()
    out = [_ids(encoder, pieces[0])]
    for piece in pieces[1:]:
        ids = known.get(piece)
        if ids is None:
            ids = _ids(encoder, f" {piece}")
            if not piece[-1].isspace():
                known[piece] = ids
        out.append(ids)
    return b"".join(out)


def _after_blank(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a blank may end at each of ``ends``; some other characters count as blanks too."""
    one, two, three = (data[np.maximum(ends - k, 0)] for k in (1, 2, 3))
    return (one <= 0x20) | (one >= 0x80) & ((two == 0xC2) | _BLANK_LEADS[three])


def cut_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(pieces of texts that can be encoded one by one, first piece of each text and the end).

    A space between two visible characters always begins a piece of these byte-level
    vocabularies. Spaces beside characters that may be blanks are not cut at.
    """
    data, offsets = bytes_of(texts)
    inner = np.concatenate([data[1:], np.zeros(min(1, len(data)), np.uint8)])
    at = np.flatnonzero((data == 0x20) & (inner > 0x20))
    after = inner[at]
    at = at[~_after_blank(data, at) & (after != 0xC2) & ~_BLANK_LEADS[after] & (at > 0)]
    # What stands at a text's border follows from that text alone: its first byte begins a piece anyway.
    begins = np.zeros(len(data) + 1, bool)
    begins[at] = True
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(begins[:-1])
    pieces = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)]
    )
    return pieces, np.searchsorted(starts, offsets)


def encode_pieces(
    path: str, pattern: str, pieces: pa.Array, errors: str = "strict"
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, first place in them, number of ids) of distinct pieces, most of them encoded in one call.

    A piece that begins with a space is encoded alike behind any that ends with a visible character.
    ``errors`` says what becomes of bytes that are not UTF-8, as in ``bytes.decode``.
    """
    encoder, known, id_bytes = byte_encoder(path, pattern)
    data, offsets = bytes_of(pieces)
    sizes = np.diff(offsets)
    joint = sizes > 1
    joint[joint] = data[offsets[:-1][joint]] == 0x20
    joint[joint] &= ~_after_blank(data, offsets[1:][joint])
    together, ends = bytes_of(pieces.filter(pa.array(joint)))
    try:
        text = together.tobytes().decode("utf-8")
    except UnicodeDecodeError:
        if errors == "strict":
            raise
        joint[:], text, ends = False, "", ends[:1]
    ids = np.array(encoder.encode_ordinary(text), np.uint16)
    id_ends = np.cumsum(id_bytes[ids])
    last = np.searchsorted(id_ends, ends[1:])
    if not np.array_equal(id_ends[last], ends[1:]):
        raise ValueError("an id spans two pieces")
    alone = np.flatnonzero(~joint)
    if len(known) > REMEMBERED:
        known.clear()
    texts = (data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", errors) for i in alone)
    own = [np.frombuffer(encode_text(encoder, known, t), np.uint16) for t in texts]
    counts = np.zeros(len(pieces), np.int64)
    counts[joint] = np.diff(last + 1, prepend=0)
    counts[alone] = [len(o) for o in own]
    starts = np.zeros(len(pieces), np.int64)
    starts[joint] = np.cumsum(counts[joint]) - counts[joint]
    starts[alone] = len(ids) + np.cumsum(counts[alone]) - counts[alone]
    return np.concatenate([ids, *own]), starts, counts


def laid_out(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The ids of pieces end to end, each given by its place in ``starts`` and ``counts``."""
    n = counts[codes]
    ends = np.cumsum(n)
    return ids[np.repeat(starts[codes] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]


class PieceTable:
    """Ids of the pieces seen so far, each encoded once; one per worker."""

    def __init__(self, path: str, pattern: str, remembered: int | None = None):
        self.vocabulary, self.remembered = (path, pattern), remembered
        self.clear()

    def clear(self) -> None:
        self.pieces = pa.array([], pa.large_binary())
        self.ids, self.starts, self.counts = np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def codes(self, pieces: pa.Array) -> np.ndarray:
        """The place of each piece in ``starts`` and ``counts``, until the next call."""
        if len(self.pieces) > (self.remembered or REMEMBERED) or self.pieces.nbytes > REMEMBERED_BYTES:
            self.clear()
        have = len(self.pieces)
        # The known pieces are distinct and come first, so they keep their places.
        coded = pa.concat_arrays([self.pieces, pieces]).dictionary_encode()
        self.pieces = coded.dictionary
        ids, starts, counts = self.encode(self.pieces.slice(have))
        self.starts = np.concatenate([self.starts, starts + len(self.ids)])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids])
        return coded.indices.to_numpy()[have:]

    def encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return encode_pieces(*self.vocabulary, pieces)


_tables: dict[tuple[str, str], PieceTable] = {}


def piece_table(path: str, pattern: str) -> PieceTable:
    if (path, pattern) not in _tables:
        _tables[path, pattern] = PieceTable(path, pattern)
    return _tables[path, pattern]


class EncodedTexts:
    """Texts as pieces that are encoded once each: ids by piece, pieces by text."""

    def __init__(self, path: str, pattern: str, texts: pa.Array):
        table = piece_table(path, pattern)
        pieces, self.first = cut_texts(texts)
        self.codes = table.codes(pieces)
        self.ids, self.starts, self.counts = table.ids, table.starts, table.counts

    def sizes(self) -> np.ndarray:
        """The number of ids of each text."""
        return np.diff(np.concatenate([[0], np.cumsum(self.counts[self.codes])])[self.first])

    def texts(self) -> Iterator[bytes]:
        """The ids of each text as 16-bit words."""
        flat = laid_out(self.ids, self.starts, self.counts, self.codes)
        ends = np.cumsum(self.sizes())
        return (flat[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends))


def _ids(encoder, piece: str) -> bytes:
    return array("H", encoder.encode_ordinary(piece)).tobytes()


def feistel(index: np.ndarray, size: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """A permutation of 0..size-1: a Feistel network over the next even number of bits, walked
    on until it lands below ``size``."""
    half = max(1, ((max(size - 1, 1)).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key & (1 << 64) - 1))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & low)
        return left << np.uint64(half) | right

    out = once(np.asarray(index, np.uint64))
    away = np.flatnonzero(out >= np.uint64(size))
    while len(away):
        out[away] = once(out[away])
        away = away[out[away] >= np.uint64(size)]
    return out.astype(np.int64)


def sequences(
    docs: DataFrame, ranks_path: str, pattern: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (doc_id, seq, n_tokens, ids): whole texts with a closing id, cut into ``length`` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 1):
            rows, seqs, sizes, ids = [], [], [], []
            for row, data in enumerate(EncodedTexts(ranks_path, pattern, text_column(part.column(1))).texts()):
                data += np.uint16(END_ID).tobytes()
                for seq, start in enumerate(range(0, len(data), 2 * length)):
                    piece = data[start : start + 2 * length]
                    rows.append(row)
                    seqs.append(seq)
                    sizes.append(len(piece) // 2)
                    ids.append(piece)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(seqs, pa.int32()),
                    pa.array(sizes, pa.int32()),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "seq", "n_tokens", "ids"],
            )

    return documents_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, seq int, n_tokens int, ids binary")


def _sizes(path: str, pattern: str, length: int):
    """(doc_id, n): the number of sequences of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 1):
            n = EncodedTexts(path, pattern, text_column(part.column(1))).sizes() // length + 1
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64())], names=["doc_id", "n"])

    return run


def _record(doc_id: int | None, seq: int, ids: bytes, length: int) -> bytes:
    pad = struct.pack("<H", END_ID) * (length - len(ids) // 2)
    return struct.pack("<qii", -1 if doc_id is None else doc_id, seq, len(ids) // 2) + ids + pad


def _dealt(places: list[int], records: list[bytes], size: int, key: int) -> pa.RecordBatch:
    slots = feistel(np.array(places, np.int64), size, key) if size else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(slots), pa.array(records, pa.binary())], names=["slot", "record"])


def _records(path: str, pattern: str, size: int, key: int, length: int):
    """(slot, record) of the sequences of texts (doc_id, text, start, n) that begin at ``start``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = struct.pack("<H", END_ID)
        for part in chunks(batches, 1):
            ids, starts, sizes = (part.column(k).to_pylist() for k in (0, 2, 3))
            places, records = [], []
            for doc_id, data, start, n in zip(ids, EncodedTexts(path, pattern, text_column(part.column(1))).texts(), starts, sizes):
                data += end
                if -(-len(data) // (2 * length)) != n:
                    raise ValueError(f"the text of document {doc_id} is another one than at the first reading")
                places.extend(range(start, start + n))
                records.extend(_record(doc_id, k, data[2 * length * k : 2 * length * (k + 1)], length) for k in range(n))
                if len(places) > 512:
                    yield _dealt(places, records, size, key)
                    places, records = [], []
            if places:
                yield _dealt(places, records, size, key)

    return run


def _slots(size: int, key: int, length: int):
    """(slot, record) of sequences (doc_id, seq, ids, place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, seqs, data, places = (batch.column(k).to_pylist() for k in range(4))
            yield _dealt(places, [_record(i, s, b, length) for i, s, b in zip(ids, seqs, data)], size, key)

    return run


def write_shards(
    docs: DataFrame,
    path: str,
    ranks_path: str,
    pattern: str,
    key: int = 0,
    length: int = LENGTH,
    shard: int = SHARD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> int:
    """Write all sequences of ``docs`` below ``path``, as ``shard=<k>/`` with one file each; gives their number.

    A record is doc_id (8 bytes, little endian), sequence number (4), tokens (4), then
    ``length`` ids of 16 bits, the rest filled with the closing id, then one byte 0x0A:
    ``stride(length)`` bytes. Spark's own writer commits the files, so a task that runs again
    writes nothing twice, and any storage that Spark writes to will do.

    Sequences are numbered by doc_id, so the order depends on the key and the data alone. Null
    and empty texts have one sequence with the closing id only. A null id is written as -1.
    ``docs`` is read and encoded twice, once for the number of sequences of each text and once for
    the ids, so ids are on disk only in one shuffle and in the shards; both readings must give
    the same texts, else the job fails.
    Rows that repeat an id are all written, in the order of their ids' bytes. No rows write
    no shard.
    """
    spark = docs.sparkSession
    texts = documents_of(docs, id_col, text_col)
    sizes = texts.mapInArrow(_sizes(ranks_path, pattern, length), "doc_id long, n long")
    starts = _starts(sizes)
    total = starts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    repeated = not starts.filter("copies > 1").isEmpty()
    shared = bounded_broadcast(starts, 1_000_000)
    found = texts.join(shared, texts["doc_id"].eqNullSafe(shared["id"])).select("doc_id", "text", "start", "n", "copies")
    slotted = "slot long, record binary"
    single = found.filter("copies = 1") if repeated else found
    placed = single.select("doc_id", "text", "start", "n").mapInArrow(
        _records(ranks_path, pattern, total, key, length), slotted
    )
    if repeated:
        # Rows that repeat an id are told apart by the rank of their sequences.
        rows = sequences(found.filter("copies > 1").select("doc_id", "text"), ranks_path, pattern, length)
        rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("seq", "ids")) - 1
        several = bounded_broadcast(starts.filter("copies > 1").select("id", "start"), 1_000_000)
        ranked = rows.withColumn("rank", rank).join(several, rows["doc_id"].eqNullSafe(several["id"]))
        ranked = ranked.select("doc_id", "seq", "ids", (F.col("start") + F.col("rank")).alias("place"))
        placed = placed.unionByName(ranked.mapInArrow(_slots(total, key, length), slotted))
    shards = max(1, -(-total // shard))
    parts = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards // 64))
    (
        placed.withColumn("shard", F.floor(F.col("slot") / shard))
        # The range of a shard is known, so nothing is sampled.
        .repartitionById(parts, F.floor(F.col("shard") * parts / shards).cast("int"))
        .sortWithinPartitions("shard", "slot")
        .select(F.col("record").cast("string").alias("record"), "shard")
        .write.partitionBy("shard")
        .text(path, lineSep="\n")
    )
    return total


def _starts(sizes: DataFrame) -> DataFrame:
    """(id, start, n, copies) of every id: its first place by doc_id, its sequences, its rows.

    Only the number of sequences of each id is sorted. Within tasks of that sort the numbers
    are running sums; what the tasks before hold is added from one row per task.
    """
    # Written before the sort, which samples its input: no text is encoded for the sample.
    counts = stored(sizes.groupBy("doc_id").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("copies")), "sequence-counts")
    ranged = stored(
        counts.repartitionByRange(F.col("doc_id").asc_nulls_last()).withColumn("part", F.spark_partition_id()),
        "sorted-counts",
    )
    order = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("part").agg(F.sum("n").alias("rows"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("ahead"))
    start = F.col("ahead") + F.coalesce(F.sum("n").over(before), F.lit(0))
    starts = ranged.join(F.broadcast(offsets), "part").select(F.col("doc_id").alias("id"), start.alias("start"), "n", "copies")
    return stored(starts, "sequence-starts")


def stride(length: int = LENGTH) -> int:
    return HEADER + 2 * length + 1


def read_slots(path: str, first: int, count: int, length: int = LENGTH, shard: int = SHARD) -> Iterator[tuple]:
    """(slot, doc_id, seq, ids) of a run of slots, from local files: seeks to the first and reads on."""
    import glob

    size = stride(length)
    for slot in range(first, first + count):
        if slot == first or slot % shard == 0:
            name = glob.glob(f"{path}/shard={slot // shard}/part-*")[0]
            file = open(name, "rb")
            file.seek(slot % shard * size)
        record = file.read(size)
        n = int.from_bytes(record[12:16], "little")
        ids = np.frombuffer(record[HEADER : HEADER + 2 * n], np.uint16)
        yield slot, int.from_bytes(record[:8], "little", signed=True), int.from_bytes(record[8:12], "little"), ids


def read_shards(spark: SparkSession, path: str, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Rows (slot, shard, byte_offset, doc_id, seq, n_tokens, ids_sha256) of written shards.

    Each file is read by Spark and cut at the fixed stride; a file has at most ``shard`` records.
    """
    size = stride(length)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.regexp_extract("path", r"shard=(\d+)", 1).cast("long").alias("shard"), "content")
    )
    records = files.select(
        "shard", "content", F.explode(F.sequence(F.lit(0), (F.length("content") / size).cast("int") - 1)).alias("k")
    ).select("shard", "k", F.substring("content", F.col("k") * size + 1, F.lit(size)).alias("r"))

    little = lambda at, width: F.conv(
        F.concat(*[F.hex(F.substring("r", at + j, 1)) for j in reversed(range(width))]), 16, -10
    ).cast("long")
    n = little(13, 4)
    return records.select(
        (F.col("shard") * shard + F.col("k")).alias("slot"),
        "shard",
        (F.col("k") * size).cast("long").alias("byte_offset"),
        little(1, 8).alias("doc_id"),
        little(9, 4).cast("int").alias("seq"),
        n.cast("int").alias("n_tokens"),
        F.sha2(F.substring(F.col("r"), F.lit(HEADER + 1), (n * 2).cast("int")), 256).alias("ids_sha256"),
    )
