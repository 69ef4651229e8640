"""Small tables with every awkward row, and brute-force versions of the operators."""

from __future__ import annotations

from collections import defaultdict

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, key string, size int, bands string"


def awkward(spark, extra=()):
    """Null, empty, blank, one-word, long and repeated texts, null ids and sources, clashing columns."""
    words = " ".join(f"w{i % 97}x{i}" for i in range(3000))
    texts = [
        (1, words, "a"), (2, None, "a"), (3, "", None), (4, " \t\n", "b"), (5, "One", "b"), (6, "one", "b"),
        (7, words, None), (8, words + " tail", "a"), (None, words, "a"), (9, "é ü 漢字 two words", "c"),
        (10, "same row twice here now yes", "c"), (10, "same row twice here now yes", "c"), (11, "x" * 50_000, "c"), *extra,
    ]
    rows = [(i, t, "en", s, len(t or ""), 1, "k", 2, "b") for i, t, s in texts]
    return spark.createDataFrame(rows, SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return set(zip(*[w[j:] for j in range(k)])) if len(w) >= k else ({tuple(w)} if w else set())


def groups(texts, k, percent=80):
    """{doc_id: smallest linked doc_id} by comparing all pairs."""
    sets = {i: shingle_set(t, k) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                shared = len(x & y)
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    a1, b1 = find(a), find(b)
                    parent[max(a1, b1)] = min(a1, b1)
    return {i: find(i) for i in ids}


def repeats(texts, n=50):
    """({doc: words cut}, {doc: words of first occurrences}) by listing every run of n words.

    A word goes if a run that stands earlier covers it, other than a first run that the later one
    overlaps in its own document; what only such overlaps cover goes outside first runs. Of
    documents with the same words all but the first go whole.
    """
    docs = sorted((i, (t or "").encode().split()) for i, t in texts.items())
    first = {}
    for i, w in docs:
        first.setdefault(tuple(w), i)
    copies = {i for i, w in docs if len(w) >= n and first[tuple(w)] != i}
    seen, gone, own, keep = defaultdict(list), defaultdict(set), defaultdict(set), defaultdict(set)
    for i, w in docs:
        for p in range(len(w) - n + 1 if i not in copies else 0):
            seen[tuple(w[p : p + n])].append((i, p))
    for (j, q), *later in seen.values():
        if later:
            keep[j].update(range(q, q + n))
        for i, p in later:
            (own if i == j and p - q < n else gone)[i].update(range(p, p + n))
    cut = {i: gone[i] | (own[i] - keep[i]) for i, _ in docs}
    keep = defaultdict(set, {i: v - cut.get(i, set()) for i, v in keep.items()})
    whole = dict(docs)
    for i in copies:
        cut[i] = set(range(len(whole[i])))
        origin = first[tuple(whole[i])]
        if not cut.get(origin) and not keep[origin]:
            keep[origin] = set(range(len(whole[origin])))
    return {i: v for i, v in cut.items() if v}, {i: v for i, v in keep.items() if v}
