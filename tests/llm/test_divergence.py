import collections
import random

from shelfwatch.llm import divergence
from shelfwatch.llm.queries import ORACLES, QUERIES

from ..oracle import connect, differences
from .helpers import SF, awkward, nothing


def by_hand(rows, min_docs, top):
    """The rows of the audit from plain counts, (text, lang, source) at a time."""
    import re

    held, count, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(divergence.TERM, text)
        groups.add((lang, source))
        held.update((lang, t) for t in set(terms))
        count.update((lang, source, t) for t in terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (at, t), n in held.items() if at == lang and n >= min_docs)
        sources = sorted(s for at, s in groups if at == lang)

        def weights(counts):
            total = sum(counts)
            return {t: 1 + 10**9 * (n + 5) // (total + 5 * len(kept)) for t, n in zip(kept, counts)}

        p = {s: weights([count[lang, s, t] for t in kept]) for s in sources}
        q = weights([sum(count[lang, s, t] for s in sources) for t in kept])
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if count[lang, s, t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                shown = ranked[:top] if part == "term" else ranked
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(shown, 1)]
    return sorted(out)


def plain(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_query_equals_sql(spark):
    assert differences(QUERIES["op13_divergence"](spark, SF), connect(SF), ORACLES["op13_divergence"]) == []


def test_many_sources_of_uneven_size(spark):
    rng = random.Random(2)
    rows = []
    for n in range(600):
        source = rng.choice(["hot"] * 6 + ["b", "c", None, "", "É"])
        words = [f"T{int(rng.paretovariate(0.5))}x{rng.choice('abc')}" for _ in range(rng.randrange(0, 60))]
        rows.append((" ".join(words), rng.choice(["en", "de", None]), source, n))
    rows += [(None, "fr", "only", 0), ("", "it", "one", 1), ("-", "it", "two", 2)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string, n long")
    docs = docs.selectExpr("*", "1 as word", "2 as bits", "3 as zero", "'x' as term", "4 as p", "5 as v")
    wanted = by_hand([r[:3] for r in rows], 5, 7)
    assert plain(divergence.source_divergence(docs, min_docs=5, top=7)) == wanted
    assert {r[3] for r in wanted if r[0] == "it"} == {"one", "two"}


def test_counts_beyond_32_bits(spark):
    cells = spark.createDataFrame([(3 * 10**12, 5 * 10**12, 1000)], "n long, total long, v long")
    got = cells.select(divergence._weight("n", "total", "v", 5)).first()[0]
    assert got == 1 + 10**9 * (3 * 10**12 + 5) // (5 * 10**12 + 5000)


def test_awkward_and_no_rows(spark):
    docs = awkward(spark)
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert plain(divergence.source_divergence(docs, min_docs=2)) == by_hand(rows, 2, 50)
    assert divergence.source_divergence(nothing(spark)).collect() == []
