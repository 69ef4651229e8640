import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from shelfwatch.llm import periodic
from shelfwatch.llm.queries import QUERIES

from .helpers import SF, awkward, nothing


def every_run(words):
    """(start, length, period) of every run, by looking at every lag."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(6, 4 * q):
                best.setdefault((start, length), q)
            i = j
    return sorted((s, n_, q) for (s, n_), q in best.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def made_periodic(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_runs_of_random_words_equal_every_lag():
    rng = random.Random(5)
    docs = []
    for _ in range(400):
        words = []
        while len(words) < rng.randrange(1, 160):
            phrase = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randrange(1, 14))]
            words += phrase * rng.choice([1, 1, 2, 4, 5, 9])
        docs.append(words)
    docs += [[], [7] * 5, [7] * 6, [7] * 3000, [1, 1, 2, 2] * 40, list(range(50)) * 5]
    found = collections.defaultdict(list)
    ids = np.array([w for d in docs for w in d])
    for of, *run in zip(*periodic.find_runs(ids, np.array([len(d) for d in docs]))):
        found[of].append(tuple(int(v) for v in run))
    assert [found[i] for i in range(len(docs))] == [every_run(d) for d in docs]
    assert sum(map(len, found.values())) > 200


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op12_runs"](spark, SF).collect()
    assert len(rows) == len(texts) and sum(r.n_runs > 0 for r in rows) > 5
    for r in rows:
        words = made_periodic(r.doc_id, (texts[r.doc_id] or "").encode().split())
        runs = every_run(words)
        longest = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (longest or (None, None, None))
        assert r.exponent_milli == (1000 * longest[1] // longest[2] if longest else None)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()


@pytest.mark.parametrize("loops", [False, True])
def test_awkward_rows(spark, loops):
    loop = "start " + "again and " * 1000 + "end"
    docs = awkward(spark, [(20, loop, "a"), (20, "is is is is is is\tis", "a"), (21, "x " * 4000, "a"), (-3, "no run", None)])
    got = collections.Counter(
        (r.doc_id, tuple(tuple(x) for x in r.runs), r.collapsed) for r in periodic.periodic_runs(docs, loops).collect()
    )
    wanted = collections.Counter()
    for r in docs.collect():
        words = (r.text or "").encode().split()
        words = made_periodic(r.doc_id, words) if loops else words
        runs = every_run(words)
        wanted[(r.doc_id, tuple(runs), b" ".join(collapsed(words, runs)).decode())] += 1
    assert got == wanted


def test_very_long_texts():
    """A text of one word, and one of few words, take no more than a little time for each scale."""
    rng = np.random.default_rng(3)
    ids = np.concatenate([np.zeros(1_000_000, np.int64), rng.integers(0, 4, 1_000_000)])
    of, start, length, period = periodic.find_runs(ids, np.array([1_000_000, 1_000_000]))
    assert (of[0], start[0], length[0], period[0]) == (0, 0, 1_000_000, 1) and sum(of == 0) == 1
    words = ids[1_000_000:].tolist()
    for s, n, q in list(zip(start, length, period))[1:400]:
        assert words[s : s + n - q] == words[s + q : s + n] and n >= max(6, 4 * q)
        assert s == 0 or words[s - 1] != words[s - 1 + q]
        assert s + n == len(words) or words[s + n] != words[s + n - q]


def test_no_rows(spark):
    assert periodic.periodic_runs(nothing(spark)).collect() == []
