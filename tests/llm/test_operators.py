import collections
import hashlib
import itertools
import math
import random
import types
import zlib
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwatch.llm import attention, common, fingerprints, lm_scores, mixing, near_dups, packing, quality, repeats
from shelfwatch.llm import token_counts, token_shards, vector_search
from shelfwatch.llm.common import Words, slices, text_column
from shelfwatch.llm.queries import ORACLES, QUERIES

from ..oracle import connect, differences
from .helpers import SF, awkward, groups, nothing, repeats as brute_repeats, shingle_set

tokenizers_of_box = pytest.importorskip("public_tokenizers")
RANKS, PATTERN = tokenizers_of_box.path("byte_bpe_50k.tiktoken"), tokenizers_of_box.PATTERN


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# near duplicates


def near_copies(n, seed=1):
    """Copies of one text with a few words changed in each: links close to the threshold."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3, 5])):
            words[rng.randrange(60)] = f"n{i}_{rng.random()}"
        out.append((1000 + i, " ".join(words), "a"))
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_near_dups_equal_all_pairs(spark, texts, k):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in near_dups.near_duplicates(docs, words=k).collect()}
    assert {i: r.component_id for i, r in got.items()} == groups(texts, k)
    assert all(got[i].n_shingles == len(shingle_set(t, k)) and got[i].kept == (got[i].component_id == i) for i, t in texts.items())


def test_near_dups_in_a_large_bucket(spark):
    docs = awkward(spark, near_copies(180))
    rows = near_dups.near_duplicates(docs, words=2).collect()
    known = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == groups(known, 2)
    assert len(rows) == docs.count()
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]
    assert all(r.n_shingles == 0 and r.kept for r in rows if r.doc_id in (2, 3, 4))


def test_near_dups_of_nothing(spark):
    assert near_dups.near_duplicates(nothing(spark)).collect() == []


# repeated passages


def found_words(rows):
    cut, keep = collections.defaultdict(set), collections.defaultdict(set)
    for r in rows:
        for s in r.spans:
            (cut if s.cut else keep)[r.doc_id].update(range(s.start, s.stop))
    return dict(cut), dict(keep)


def test_repeats_equal_every_run(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found_words(repeats.repeated_passages(docs).collect()) == brute_repeats(texts)


def test_repeats_of_awkward_rows(spark):
    loop = " ".join(["again"] * 200)
    docs = awkward(spark, [(20, loop, "a"), (21, "start " + " ".join(f"w{i % 97}x{i}" for i in range(100, 160)) + " end", "a")])
    known = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    passages = repeats.repeated_passages(docs)
    cut, keep = found_words(passages.collect())
    assert (cut, keep) == brute_repeats(known)
    rest = {(r["doc_id"], r["n_chars"]): r["text"] for r in repeats.cut_repeats(docs, passages).collect()}
    by_id = {i: t for (i, _), t in rest.items()}
    assert repeats.cut_repeats(docs, passages).columns == docs.columns
    assert 7 not in by_id and by_id[21].split() == ["start", "end"] and by_id[20].split() == ["again"] * 50
    assert by_id[8].split() == ["tail"] and by_id[2] is None and by_id[None] == known[1]
    assert all(n == len(t or "") for (_, n), t in rest.items())
    assert sum(r["doc_id"] == 10 for r in repeats.cut_repeats(docs, passages).collect()) == 2


def seen_before(texts, n=50):
    """{doc: words cut} by listing every run of n words: a word goes if a run that stands earlier covers it,
    other than a first run that the later one overlaps; what only such overlaps cover goes outside first runs."""
    docs = sorted((i, (t or "").encode().split()) for i, t in texts.items())
    places, gone, own, kept = collections.defaultdict(list), *(collections.defaultdict(set) for _ in range(3))
    for i, w in docs:
        for p in range(len(w) - n + 1):
            places[tuple(w[p : p + n])].append((i, p))
    for (j, q), *later in places.values():
        if later:
            kept[j].update(range(q, q + n))
        for i, p in later:
            (own if i == j and p - q < n else gone)[i].update(range(p, p + n))
    cut = {i: gone[i] | own[i] - kept[i] for i, _ in docs}
    return {i: v for i, v in cut.items() if v}


def test_repeats_seen_before(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = {i for i, t in texts.items() if min(j for j in texts if (texts[j] or "").split() == (t or "").split()) < i}
    cut, _ = found_words(repeats.repeated_passages(docs).collect())
    wanted = seen_before({i: t for i, t in texts.items() if i not in whole})
    assert {i: v for i, v in cut.items() if i not in whole} == wanted


def test_repeats_between_equal_words(spark):
    shared = " ".join(f"p{i}" for i in range(60))
    loop = " ".join(f"r{i % 30}" for i in range(140))
    edges = [("a", "b"), ("x", "y"), ("x", "z"), ("q", "y"), ("x", "y"), ("c", "d"), ("q", "z")]
    texts = {i: f"l{i} {a} {shared} {b} t{i}" for i, (a, b) in enumerate(edges)}
    texts |= {20: f"before {loop} after", 21: f"other {loop} end", 22: f"{shared} {loop}"}
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in texts.items()], "doc_id long, text string, n_chars long")
    passages = repeats.repeated_passages(docs)
    cut, _ = found_words(passages.collect())
    assert cut == seen_before(texts)
    rest = {r["doc_id"]: r["text"].split() for r in repeats.cut_repeats(docs, passages).collect()}
    assert all(("p30" in rest[i]) == (i == 0) and f"l{i}" in rest[i] and f"t{i}" in rest[i] for i in range(len(edges)))
    assert not any(w.startswith("p") for i in range(1, len(edges)) for w in rest[i])
    assert rest[20][1:61] == loop.split()[:60] or rest[20][1:51] == loop.split()[:50]


def test_repeats_of_nothing(spark):
    assert repeats.repeated_passages(nothing(spark)).collect() == []


# mixing


def test_mix_equals_sql(spark):
    assert differences(QUERIES["op5_mix"](spark, SF), connect(SF), ORACLES["op5_mix"]) == []


def test_mix_of_awkward_rows(spark):
    docs = awkward(spark)
    rows = mixing.mixed_sizes(docs).collect()
    total = sum(r["size"] for r in rows)
    targets = {r["source"]: (r["target"], r["source_size"]) for r in rows}
    assert len(rows) == docs.count() and set(targets) == {"a", "b", "c", None}
    assert sum(t for t, _ in targets.values()) == pytest.approx(1.5 * total)
    assert all(t <= 2 * n + 1e-6 for t, n in targets.values()) and all(r["copies"] in (0, 1, 2) for r in rows)
    taken = collections.Counter(r["doc_id"] for r in rows for _ in range(r["copies"]))
    mixed = mixing.mix_sources(docs)
    assert mixed.columns == docs.columns
    assert collections.Counter(r["doc_id"] for r in mixed.collect()) == taken
    assert mixing.mixed_sizes(nothing(spark)).collect() == [] and mixing.mix_sources(nothing(spark)).collect() == []


# packing


def test_ceilings_are_the_best():
    rng = random.Random(3)
    for _ in range(20):
        lengths = sorted(rng.sample(range(1, 40), 7))
        counts = [rng.randrange(1, 9) for _ in lengths]
        padding = lambda tops: sum(c * min(t for t in tops if t >= x) for x, c in zip(lengths, counts))
        best = min(padding((*some, lengths[-1])) for n in range(3) for some in itertools.combinations(lengths[:-1], n))
        found = packing.best_ceilings(lengths, counts, 3)
        assert len(found) <= 3 and padding(found) == best


def test_packing_places_every_word_once(spark):
    docs = awkward(spark)
    rows = packing.pack(docs, max_length=500, buckets=4, budget=2000).collect()
    words = collections.Counter()
    for r in rows:
        words[r["doc_id"]] += r["n_words"]
    expected = collections.Counter()
    for r in docs.collect():
        expected[r["doc_id"]] += len((r["text"] or "").encode().split())
    assert +words == +expected
    batches = collections.defaultdict(list)
    for r in rows:
        assert r["n_words"] <= r["bucket_words"] <= 500
        batches[r["bucket_words"], r["batch_id"]].append(r["slot"])
    for (bucket, batch), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) * bucket <= 2000
        assert len(slots) == 2000 // bucket or (bucket, batch + 1) not in batches
    assert packing.pack(nothing(spark)).collect() == []


# quality


def test_quality_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op10_quality"](spark, sf).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) >= 0.95


def test_quality_of_awkward_rows(spark):
    docs, labels = awkward(spark), spark.createDataFrame([(1, 1), (8, 0), (None, 1), (99, 0)], "doc_id long, quality int")
    model = quality.fit_votes(docs, labels)
    rows = quality.score_quality(docs, model).collect()
    score = {r["doc_id"]: r["quality_score"] for r in rows}
    assert len(rows) == docs.count() and all(0 <= s <= 1 for s in score.values()) and score[1] == score[7] == score[None]
    unlearned = quality.fit_votes(docs, labels.limit(0))
    assert {r["quality_score"] for r in quality.score_quality(docs, unlearned).collect()} == {0.5}
    assert quality.score_quality(nothing(spark), model).collect() == []


# token counts


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    path = tokenizers_of_box.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = awkward(spark, [(30, "a <|endoftext|> b<|startoftext|>", "a"), (31, "don't  re-do it é ́x İ", "a")])
    count = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    expected = sorted((r["doc_id"] or 0, len((r["text"] or "").encode()), count(r["text"])) for r in docs.collect())
    for huge in (32_768, 200):
        got = token_counts.count_tokens(docs, path, huge=huge).collect()
        assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in got) == expected
        assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)
    text = " ".join(f"word{i} x" + "ab" * (i % 40) for i in range(800))
    assert token_counts.count_huge(library, text, 1000, 16) == count(text)
    assert token_counts.count_huge(library, "ab" * 3000, 1000, 16) == count("ab" * 3000)
    assert token_counts.count_tokens(nothing(spark), path).collect() == []


# shards


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1000, 4097])
def test_feistel_is_a_permutation(size):
    slots = token_shards.feistel(np.arange(size), size, 12345)
    assert sorted(slots.tolist()) == list(range(size))
    assert size < 17 or slots.tolist() != token_shards.feistel(np.arange(size), size, 54321).tolist()


def test_encode_text_remembers_no_blank_at_the_end_of_a_piece():
    encoder = token_shards.byte_encoder(RANKS, PATTERN)[0]
    known = {}
    texts = ["a b\n", "a b\n c", "a b c", " a", "a  b", "", " ", "a ", "b\t c  d\n\n e", "x\u00a0 y z", "a b\n c", "c b a c", "a b  c"]
    texts += ["I'd say thhe, \u00e9t\u00e9s. 12345 \u4e2d\u6587 it's \U0001f600! don't", "x y, z. x; \u2028 y"]
    for text in texts * 2:
        assert np.frombuffer(token_shards.encode_text(encoder, known, text), np.uint16).tolist() == encoder.encode_ordinary(text)


def blank_texts(n, seed=3):
    """Texts with blanks of all kinds beside visible characters of one to four bytes."""
    rng = random.Random(seed)
    parts = [" "] * 8 + ["a", "The", "\u00e9", "\u4e2d", "\u304b", "\U0001f600", "\u2014", "\u00ab", "'s", "1", "23", ".", "\x7f", "\u200b"]
    parts += ["\n", "\t", "\r\n", "\x1c", "\x85", "\u00a0", "\u2009", "\u3000", "\u1680"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(n)] + ["", " ", None, "x" * 5000, " y"]


@pytest.mark.parametrize("remembered", [10**6, 20])
def test_texts_encoded_by_pieces_equal_the_library(monkeypatch, remembered):
    monkeypatch.setattr(token_shards, "REMEMBERED", remembered)
    monkeypatch.setattr(token_shards, "_tables", {})
    encoder, some = token_shards.byte_encoder(RANKS, PATTERN)[0], blank_texts(3000)
    for part in (some[:1000], some[1000:], [], [None]):
        encoded = token_shards.EncodedTexts(RANKS, PATTERN, text_column(pa.array(part, pa.string())))
        wanted = [encoder.encode_ordinary(t or "") for t in part]
        assert [np.frombuffer(b, np.uint16).tolist() for b in encoded.texts()] == wanted
        assert encoded.sizes().tolist() == [len(w) for w in wanted]


def test_new_pieces_of_many_texts_are_encoded_together(monkeypatch):
    encoder, calls = token_shards.byte_encoder(RANKS, PATTERN)[0], []
    counting = types.SimpleNamespace(encode_ordinary=lambda t: calls.append(t) or encoder.encode_ordinary(t))
    rest = token_shards.byte_encoder(RANKS, PATTERN)[2:]
    monkeypatch.setattr(token_shards, "byte_encoder", lambda *_: (counting, {}, *rest))
    monkeypatch.setattr(token_shards, "_tables", {}, raising=False)
    some = [" ".join(f"w{i}x{j}" for j in range(300)) for i in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array(some, pa.string())], names=["doc_id", "text"])
    sizes = [r["n"] for out in token_shards._sizes(RANKS, PATTERN, 64)(iter([batch.slice(0, 7), batch.slice(7)])) for r in out.to_pylist()]
    assert sizes == [len(encoder.encode_ordinary(t)) // 64 + 1 for t in some]
    # One call for what follows a space in any text, one for the beginning of each.
    assert len(calls) <= 21


def test_chunks_hold_all_rows_in_order(monkeypatch):
    monkeypatch.setattr(common, "CHUNK_BYTES", 100)
    monkeypatch.setattr(common, "CHUNK_ROWS", 9)
    draw = random.Random(2)
    some = [draw.choice([None, "", "a" * 500, "b" * draw.randrange(60)]) for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array(some, pa.string())], names=["doc_id", "text"])
    parts = list(common.chunks(iter([batch.slice(a, 13) for a in range(0, 200, 13)]), 1))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict() and len(parts) < 150
    for p in parts:
        assert 0 < len(p) <= 9 and (len(p) == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 100)


def test_shards_keep_no_second_copy_of_the_ids(spark, tmp_path):
    rows = [(i, " ".join(f"w{i * 400 + j}" for j in range(400))) for i in range(100)]
    docs, out = spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path / "shards")
    held = lambda: sum(p.stat().st_size for p in Path(spark.conf.get("spark.checkpoint.dir")).rglob("*.parquet"))
    before = held()
    total = token_shards.write_shards(docs, out, RANKS, PATTERN, length=64, shard=500)
    assert held() - before < total * 64 * 2 / 5


def test_shards_round_trip(spark, tmp_path):
    docs, out = awkward(spark), str(tmp_path / "shards")
    total = token_shards.write_shards(docs, out, RANKS, PATTERN, key=7, length=64, shard=50)
    encoder = token_shards.byte_encoder(RANKS, PATTERN)[0]
    expected = []
    for r in docs.collect():
        ids = [*encoder.encode_ordinary(r["text"] or ""), token_shards.END_ID]
        expected += [(-1 if r["doc_id"] is None else r["doc_id"], k // 64, ids[k : k + 64]) for k in range(0, len(ids), 64)]
    got = list(token_shards.read_slots(out, 0, total, length=64, shard=50))
    assert [g[0] for g in got] == list(range(total))
    assert sorted((i, s, ids.tolist()) for _, i, s, ids in got) == sorted(expected)
    rows = {r["slot"]: r for r in token_shards.read_shards(spark, out, length=64, shard=50).collect()}
    assert len(rows) == total
    for slot, i, s, ids in got:
        r = rows[slot]
        assert (r["doc_id"], r["seq"], r["n_tokens"]) == (i, s, len(ids))
        assert r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
    # Any run of slots can be read on its own.
    assert [g[1:3] for g in token_shards.read_slots(out, 45, 10, length=64, shard=50)] == [g[1:3] for g in got[45:55]]
    assert token_shards.write_shards(nothing(spark), str(tmp_path / "none"), RANKS, PATTERN) == 0


# fingerprints


def test_fingerprints(spark, texts):
    rows = {r["doc_id"]: r for r in QUERIES["op8_fingerprints"](spark, SF).collect()}
    ids = sorted(texts)
    for a, b in zip(ids, ids[1:] + ids[:1]):
        t, u = texts[a], texts[b]
        half = len(t) // 2
        edited = t[: len(t) - half] + u[:half]
        assert rows[a]["n_chars"] == len(t) and rows[a]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[a]["near_next"] <= 1 and 0 <= rows[a]["near_edited"] <= 1
    by_text = collections.defaultdict(set)
    for i, t in texts.items():
        by_text[t].add(rows[i]["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values()) and len(set.union(*by_text.values())) == len(by_text)
    assert np.mean([r["near_edited"] > r["near_next"] for r in rows.values()]) > 0.9


def test_fingerprints_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(fingerprints.id_stretches, "__defaults__", (7, 50))
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    rows = fingerprints.with_next(docs, ["text"]).collect()
    assert {r["doc_id"]: r["next_text"] for r in rows} == {i: f"text {(i + 1) % 100}" for i in range(100)}


def test_sketches_merge_and_contain(spark):
    words = [f"w{i}" for i in range(3000)]
    df = spark.createDataFrame([(" ".join(words), " ".join(words[:300]))], "long string, part string")
    a, b = fingerprints.sketch(F.col("long")), fingerprints.sketch(F.col("part"))
    r = df.select(
        fingerprints.containment(b, a).alias("c"),
        (fingerprints.merged(a, b) == a).alias("m"),
        (fingerprints.sketch_of(fingerprints.fingerprint(F.col("long"), a)) == a).alias("f"),
    ).first()
    assert r["c"] == 1.0 and r["m"] and r["f"]
    awk = {x["doc_id"]: x for x in fingerprints.fingerprint_edits(awkward(spark)).collect()}
    assert awk[1]["fingerprint"] == awk[7]["fingerprint"] and awk[2]["n_chars"] == 0
    assert fingerprints.fingerprint_edits(nothing(spark)).collect() == []


# language model


def test_context_places_need_no_prediction():
    rng = np.random.default_rng(5)
    w = attention.unpack(attention.start_weights(7, 5), 7, 5)
    tokens, targets = rng.integers(0, 7, (6, attention.SPAN)), rng.integers(0, 5, (6, attention.SPAN))
    whole = attention.class_log10(w, tokens, targets)
    part = attention.class_log10(w, tokens, targets[:, attention.OVERLAP :], attention.OVERLAP)
    assert np.allclose(part, whole[:, attention.OVERLAP :], atol=1e-5)


def test_class_log10_where_logits_are_large():
    rng = np.random.default_rng(8)
    for scale in (1, 6):
        w = {k: v * np.float32(scale) for k, v in attention.unpack(attention.start_weights(7, 5), 7, 5).items()}
        tokens, targets = rng.integers(0, 7, (6, attention.SPAN)), rng.integers(0, 5, (6, attention.SPAN))
        logits = attention._logits(w, tokens)[0].astype(np.float64)
        assert (np.abs(logits).max() == 60) == (scale > 1)
        wanted = logits[np.arange(len(logits)), targets.ravel()] - np.log(np.exp(logits).sum(1))
        assert np.allclose(attention.class_log10(attention.prepared(w), tokens, targets).ravel(), wanted / np.log(10), atol=1e-2 if scale > 1 else 1e-5)


def test_mixed_sums_take_few_logarithms(monkeypatch):
    rng = np.random.default_rng(9)
    words = np.array([1, 40, 16, 3, 200])
    counts, network = rng.integers(0, 9, words.sum()), -rng.random(words.sum()) * 20
    network[:3] = -300
    wanted = np.stack([lm_scores._mixed_log10(counts, 1e15, network, 10.0**p) for p in lm_scores.LADDER], axis=1)
    taken, log10 = [], np.log10
    monkeypatch.setattr(np, "log10", lambda x: taken.append(x.size) or log10(x))
    got = lm_scores._mixed_sums((counts + 1) / 1e15, 10.0**network, words)
    assert sum(taken) == len(lm_scores.LADDER) * sum(-(-n // 16) for n in words)
    assert np.allclose(got, np.add.reduceat(wanted, np.cumsum(words) - words, axis=0), rtol=1e-12)


def test_words_are_counted_where_windows_are_cut(monkeypatch):
    monkeypatch.setattr(lm_scores, "GROUP_WORDS", 20)
    monkeypatch.setattr(lm_scores, "_tables", {})
    some = [t.lower() if t and i % 2 else t for i, t in enumerate(blank_texts(400, 6))] + ["The the THE \u00c9 \u00e9"]
    batch = pa.RecordBatch.from_arrays([pa.array(some, pa.string())], names=["text"])
    cut = pa.Table.from_batches(lm_scores._windows(RANKS, PATTERN)(iter([batch])))
    found = [r for r in cut.to_pylist() if r["kind"] is not None]
    words = collections.Counter(w for t in some for w in (*(t or "").encode().lower().split(), None))
    data = b" ".join(w for w in words if w)
    split = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), lower=True)
    keys = dict(zip((w for w in words if w), split.hashes)) | {None: lm_scores.END_KEY}
    assert {r["key"] % 2**64: r["n"] for r in found if r["kind"] == 0} == {int(keys[w]): n for w, n in words.items()}
    subwords = collections.Counter(i for t in some for i in subwords_of(t or "")[0])
    assert {r["key"]: r["n"] for r in found if r["kind"] == 1} == subwords


def test_words_of_a_part_of_a_batch(monkeypatch):
    # Each text is a part of its own, so all but the first stand behind others in their batch.
    monkeypatch.setattr(lm_scores, "TEXT_BYTES", 40)
    monkeypatch.setattr(lm_scores, "_tables", {})
    some = [f"Word{i} the The {'x' * i}" for i in range(20, 60)]
    for kind in (pa.string(), pa.large_string()):
        batch = pa.RecordBatch.from_arrays([pa.array(some, kind)], names=["text"])
        found = [r for out in lm_scores._windows(RANKS, PATTERN)(iter([batch])) for r in out.to_pylist() if r["kind"] == 0]
        table = lm_scores._table(RANKS, PATTERN)
        words = dict(zip(table.keys.tolist(), table.pieces.to_pylist()))
        assert {words[r["key"] % 2**64]: r["n"] for r in found} == collections.Counter(w for t in some for w in (*t.encode().lower().split(), b""))


def test_joined_words_are_summed_at_their_row_only(spark):
    rng = np.random.default_rng(6)
    keys = rng.integers(0, 40, (20, 15))
    networks = -rng.random((20, 15)) * 9
    scored = spark.createDataFrame(
        [(r, k.tolist(), v.tolist()) for r, (k, v) in enumerate(zip(keys, networks))], "row long, rare array<long>, rare_network array<double>"
    )
    rare = spark.createDataFrame([(k, k + 1) for k in range(30)], "key long, n long")
    found = lm_scores._joined_counts(scored, rare, 1000.0)
    # No sums cross the shuffle between the words and their rows.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" not in plan.split("Exchange hashpartitioning(row")[1]
    got = {r["row"]: r for r in found.collect()}
    for r in range(20):
        own = keys[r] < 30
        n, v = keys[r][own] + 1.0, networks[r][own]
        assert got[r]["known"] == own.sum() and math.isclose(got[r]["more"], np.log10(n + 1).sum())
        for k, power in enumerate(lm_scores.LADDER):
            w = 10.0**power
            gain = lambda c, s: lm_scores._mixed_log10(c, s, v, w) - lm_scores._mixed_log10(0 * c, s, v, w)
            assert math.isclose(got[r]["more_mixed"][k], gain(n, 1000.0).sum(), rel_tol=1e-9)
            assert math.isclose(got[r]["more_left_out"][k], gain(n - 1, 999.0).sum(), rel_tol=1e-9, abs_tol=1e-12)


def test_attention_gradient():
    rng = np.random.default_rng(0)
    v = attention.start_weights(7, 5).astype(np.float64)
    tokens, targets = rng.integers(0, 7, (3, attention.SPAN)), rng.integers(0, 5, (3, attention.SPAN))
    counted = rng.random(tokens.shape) < 0.7

    def loss(x):
        return -(attention.class_log10(attention.unpack(x, 7, 5), tokens, targets) * counted).sum() * math.log(10) / counted.sum()

    g = attention.gradient(attention.unpack(v, 7, 5), tokens, targets, counted)
    g = np.concatenate([g[n].ravel() for n in attention.shapes(7, 5)])
    for i in rng.choice(len(v), 40, replace=False):
        step = np.zeros_like(v)
        step[i] = 1e-5
        assert (loss(v + step) - loss(v - step)) / 2e-5 == pytest.approx(g[i], abs=1e-6)


def test_a_gradient_step_works_on_a_few_windows_at_a_time(monkeypatch):
    rng = np.random.default_rng(2)
    w = attention.unpack(attention.start_weights(7, 5), 7, 5)
    tokens, targets = rng.integers(0, 7, (75, attention.SPAN)), rng.integers(0, 5, (75, attention.SPAN))
    counted = rng.random(tokens.shape) < 0.7
    taken, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda x, **more: taken.append(len(x.reshape(-1, x.shape[-1]))) or exp(x, **more))
    got = attention.gradient(w, tokens, targets, counted)
    assert max(taken) <= 32 * attention.SPAN
    # The sums of single windows' gradients, each weighed by its counted places.
    shares = counted.sum(1) / counted.sum()
    parts = [attention.gradient(w, *(x[i : i + 1] for x in (tokens, targets, counted))) for i in range(len(tokens))]
    for name in attention.shapes(7, 5):
        assert np.allclose(got[name], sum(p[name] * s for p, s in zip(parts, shares)), atol=1e-6)


def test_gradient_where_logits_are_large():
    rng = np.random.default_rng(5)
    tokens, targets = rng.integers(0, 7, (3, attention.SPAN)), rng.integers(0, 5, (3, attention.SPAN))
    counted = np.ones(tokens.shape, bool)
    start = attention.unpack(attention.start_weights(7, 5), 7, 5)
    g = attention.gradient({k: v * np.float32(6) for k, v in start.items()}, tokens, targets, counted)
    wide = attention.gradient({k: v.astype(np.float64) * 6 for k, v in start.items()}, tokens, targets, counted)
    for name in g:
        assert np.isfinite(g[name]).all() and np.allclose(g[name], wide[name], rtol=1e-2, atol=1e-2 * np.abs(wide[name]).max())


def test_texts_are_scored_as_in_windows(monkeypatch):
    rng = np.random.default_rng(4)
    w = attention.prepared(attention.unpack(attention.start_weights(50, 9), 50, 9))
    for sizes in ([0, 1, 16, 31, 32, 33, 47, 48, 49, 64, 65, 200, 0, 5], [0, 0], [33], [700] * 40 + [40] * 90):
        sizes = np.array(sizes)
        tokens, targets = rng.integers(0, 50, sizes.sum()), rng.integers(0, 9, sizes.sum())
        got = attention.texts_log10(w, tokens, targets, sizes)
        places, _, scored = attention.windows(sizes)
        wanted = np.full(sizes.sum(), np.nan)
        if len(places):
            wanted[places[scored]] = attention.class_log10(w, tokens[places], targets[places])[scored]
        assert np.allclose(got, wanted, rtol=1e-4, atol=1e-5)


def test_windows_score_each_place_once():
    sizes = np.array([0, 1, 31, 32, 33, 200])
    places, real, scored = attention.windows(sizes)
    assert sorted(places[scored].tolist()) == list(range(sizes.sum()))


def test_later_windows_see_half_a_window_before():
    sizes = np.array([0, 1, 31, 32, 33, 48, 200])
    places, _, scored = attention.windows(sizes)
    begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
    row, at = np.nonzero(scored)
    within = places[row, at] - begin[places[row, at]]
    assert (at >= np.minimum(within, attention.SPAN // 2)).all()


def small_model():
    inputs_of, class_of, within = lm_scores.classes_of(np.ones(lm_scores.END_ID + 1))
    inputs = lm_scores.INPUTS + lm_scores.CLASSES
    weights = attention.start_weights(inputs, lm_scores.CLASSES)
    return lm_scores.LanguageModel(inputs_of, class_of, within, inputs, weights, RANKS, PATTERN)


def subwords_of(text):
    """(ids, word of each id) of a text, word by word, with the end id last."""
    encoder = lm_scores._table(RANKS, PATTERN).encoder
    ids = [encoder.encode_ordinary(" " + w.decode()) for w in text.encode().lower().split()] + [[lm_scores.END_ID]]
    return [i for word in ids for i in word], [n for n, word in enumerate(ids) for _ in word]


def test_every_id_is_learned_from_once(texts, monkeypatch):
    model, learned = small_model(), []

    def step(self, tokens, targets, counted):
        assert (tokens[~counted] == model.input_of[lm_scores.END_ID]).all()
        learned.extend((t[c].tobytes(), g[c].tobytes()) for t, g, c in zip(tokens, targets, counted))

    monkeypatch.setattr(lm_scores.Adam, "step", step)
    some = list(texts.values())[:60]
    batch = pa.RecordBatch.from_arrays([pa.array(some, pa.string())], names=["text"])
    cut = pa.Table.from_batches(lm_scores._windows(RANKS, PATTERN)(iter([batch]))).combine_chunks()
    used = 0
    for part in range(lm_scores.TRAIN_ROUNDS):
        own = cut.filter(pa.compute.equal(cut.column("round"), part)).select(["ids"])
        assert len(own)
        for out in lm_scores._trained(types.SimpleNamespace(value=model), part)(iter(own.to_batches())):
            used += out.column(2)[0].as_py()
    wanted = collections.Counter()
    for text in some:
        ids = np.array(subwords_of(text or "")[0])
        before = np.concatenate([[lm_scores.END_ID], ids[:-1]])
        for a in range(0, len(ids), attention.SPAN):
            wanted[model.input_of[before[a : a + attention.SPAN]].tobytes(), model.class_of[ids[a : a + attention.SPAN]].tobytes()] += 1
    assert collections.Counter(learned) == wanted and used == wanted.total()


def test_scores_equal_a_word_by_word_mixture(texts):
    model, some = small_model(), [t for t in texts.values() if t][:20] + [""]
    words = [w for t in some for w in (*t.encode().lower().split(), None)]
    counts = collections.Counter(words[::2])
    data = b" ".join(w for w in counts if w)
    split = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), lower=True)
    keys = dict(zip((w for w in counts if w), split.hashes)) | {None: lm_scores.END_KEY}
    order = sorted(counts, key=lambda w: int(keys[w]))
    model.keys = np.array([keys[w] for w in order], np.uint64)
    model.counts, model.total = np.array([counts[w] for w in order]), sum(counts.values())
    model.smooth = float(model.total + len(counts) + 1)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(some))), pa.array(some, pa.string())], names=["doc_id", "text"])
    rows = [r for out in lm_scores._scored(types.SimpleNamespace(value=model))(iter([batch])) for r in out.to_pylist()]
    weights = attention.unpack(model.weights, model.inputs, lm_scores.CLASSES)
    for text, row in zip(some, rows):
        ids, of = subwords_of(text)
        tokens, targets, scored, at = model.batches(np.array(ids), np.array([len(ids)]))
        log10 = model.within[ids].copy()
        part = attention.class_log10(weights, tokens, targets)
        log10[at[scored]] += part[scored]
        network = np.bincount(of, log10)
        own = [counts[w] for w in (*text.encode().lower().split(), None)]
        for k, power in enumerate(lm_scores.LADDER):
            w = 10.0**power
            plain = sum(math.log10((1 - w) * (c + 1) / model.smooth + w * 10**n) for c, n in zip(own, network))
            less = sum(math.log10((1 - w) * (max(c - 1, 0) + 1) / (model.smooth - 1) + w * 10**n) for c, n in zip(own, network))
            assert row["mixed"][k] == pytest.approx(plain, rel=1e-4) and row["left_out"][k] == pytest.approx(less, rel=1e-4)


def test_counts_are_looked_up_again_where_words_were_forgotten(texts, monkeypatch):
    model, some = small_model(), [t for t in texts.values() if t][:40]
    words = sorted({w for t in some for w in t.encode().lower().split()})
    split = Words(np.frombuffer(b" ".join(words), np.uint8), np.array([0, len(b" ".join(words))]), lower=True)
    model.keys = np.unique(np.append(split.hashes[::2], lm_scores.END_KEY))
    model.counts, model.smooth = np.arange(1, len(model.keys) + 1), 1e6
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(some))), pa.array(some, pa.string())], names=["doc_id", "text"])
    found = []
    for remembered, size in ((10**6, 4 << 20), (30, 2_000)):
        monkeypatch.setattr(lm_scores, "_tables", {})
        monkeypatch.setattr(lm_scores, "REMEMBERED_WORDS", remembered)
        monkeypatch.setattr(lm_scores, "TEXT_BYTES", size)
        found.append([r for out in lm_scores._scored(types.SimpleNamespace(value=model))(iter([batch])) for r in out.to_pylist()])
        assert (lm_scores._table(RANKS, PATTERN).cleared > 3) == (remembered == 30)
    for one, other in zip(*found, strict=True):
        assert all(one[c] == other[c] for c in ("doc_id", "n_tokens", "n_known", "rare"))
        assert one["base"] == pytest.approx(other["base"], rel=1e-12) and one["network"] == pytest.approx(other["network"], rel=1e-5)


def test_the_dictionary_holds_the_most_frequent_words(spark):
    draw = random.Random(4)
    counts = [draw.choice([1, 1, 1, 2, 3, 5, 40, 9_999, 10_000, 20_000, 10**9, 10**13]) + draw.randrange(3) for _ in range(400)]
    words = spark.createDataFrame(list(enumerate(counts)), "key long, n long").persist()
    for size in (0, 1, 7, 150, 399, 400, 1000):
        least = lm_scores._threshold(words, size)
        held = sum(n >= least for n in counts)
        assert held <= size and (held == 400 or held + sum(n == max(m for m in counts if m < least) for n in counts) > size)
    assert lm_scores._threshold(words.filter("false"), 5) == 1


@pytest.mark.parametrize("dictionary", [1_000_000, 50])
def test_lm_base_scores(spark, texts, dictionary):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(900, None), (901, "")], "doc_id long, text string"))
    texts = {**texts, 900: None, 901: ""}
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = collections.Counter(w for i, ts in tokens.items() if not held[i] for w in ts)
    total, smooth = sum(counts.values()), sum(counts.values()) + len(counts) + 1
    rows = lm_scores.score_documents(docs, RANKS, PATTERN, dictionary=dictionary).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = tokens[r["doc_id"]]
        assert (r["held_out"], r["train_tokens"], r["n_tokens"]) == (held[r["doc_id"]], total, len(own))
        assert r["n_known"] == sum(counts[w] > 0 for w in own)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / smooth) for w in own))
        assert r["base_score"] + 2 * r["n_tokens"] > r["score"] and r["network_score"] + lm_scores.LADDER[0] * r["n_tokens"] <= r["score"] < 0
    rows = lm_scores.score_documents(awkward(spark), RANKS, PATTERN).collect()
    assert len(rows) == awkward(spark).count() and all(math.isfinite(r["score"]) for r in rows)
    assert lm_scores.score_documents(nothing(spark), RANKS, PATTERN).collect() == []


def test_lm_scores_do_not_depend_on_the_dictionary(spark, texts, monkeypatch):
    monkeypatch.setattr(lm_scores, "TRAIN_ROUNDS", 1)
    docs = spark.createDataFrame([(i, t) for i, t in texts.items() if i < 80], "doc_id long, text string")
    whole, small, none = (
        {r["doc_id"]: r for r in lm_scores.score_documents(docs, RANKS, PATTERN, dictionary=n).collect()}
        for n in (1_000_000, 50, 0)
    )
    for other in (small, none):
        for i, r in whole.items():
            for c in ("score", "base_score", "network_score"):
                assert other[i][c] == pytest.approx(r[c], rel=1e-4), (i, c)
            assert other[i]["n_known"] == r["n_known"]


# vectors


def test_vector_search_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    found = collections.defaultdict(list)
    for r in QUERIES["op1_neighbours"](spark, SF).collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    vectors = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in rows}
    hits = 0
    for q in (i for i in vectors if i % 20 == 0):
        best = sorted((-float(v @ vectors[q]), i) for i, v in vectors.items() if i != q)[:20]
        got = sorted(found[q])
        assert [g[0] for g in got] == list(range(1, 21)) and got == sorted(got, key=lambda g: (-g[2], g[1]))
        assert all(s == pytest.approx(float(vectors[i] @ vectors[q])) for _, i, s in got)
        hits += len({i for _, i in best} & {g[1] for g in got})
    assert hits >= 0.9 * 20 * len(found)


def test_vector_scores_do_not_depend_on_the_block():
    rng = np.random.default_rng(5)
    values = rng.standard_normal((400, 77))
    values[200:260] = values[100]
    frame = pd.DataFrame({"vec_id": np.arange(400), "vec": list(values)})
    together = vector_search._compared(20)(None, frame, frame.iloc[:90]).set_index(["query_id", "vec_id"])["score"]
    for q in range(0, 90, 7):
        for part in (frame, frame.iloc[::3], frame.iloc[100:261]):
            alone = vector_search._compared(20)(None, part, frame.iloc[q : q + 1])
            assert list(zip(-alone["score"], alone["vec_id"])) == sorted(zip(-alone["score"], alone["vec_id"]))
            both = alone.set_index(["query_id", "vec_id"])["score"]
            both = both[both.index.isin(together.index)]
            assert (both == together[both.index]).all()
            best = sorted((-math.fsum(values[q] * values[i]), i) for i in part["vec_id"] if i != q)[:20]
            assert alone["score"].tolist() == pytest.approx([-s for s, _ in best])
    copies = vector_search._compared(20)(None, frame, frame.iloc[100:101])
    assert copies["vec_id"].tolist() == list(range(200, 220))


def test_vector_search_gives_each_neighbour_once(spark):
    found = collections.defaultdict(list)
    for r in QUERIES["op1_neighbours"](spark, SF.replace("0.001", "0.01")).collect():
        found[r["query_id"]].append(r["vec_id"])
    assert found and all(len(v) == len(set(v)) for v in found.values())


def test_vector_search_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, 5.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (9, []), (10, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (1, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("list", F.lit("x"))
    got = vector_search.nearest_neighbours(df, df.filter("vec_id in (0, 4, 5)"), k=20).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 3, -1.0)]
    assert vector_search.nearest_neighbours(df.limit(0), df.limit(0)).collect() == []
