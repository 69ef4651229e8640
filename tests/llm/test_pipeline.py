import collections

import corpus_pipeline
from shelfwatch.llm.common import stored

from .helpers import SF, awkward, groups, nothing, repeats


def stages(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "stage")
        out.append(docs)
    return out


def test_each_stage_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good, single, cut, mixed, packed = stages(spark, docs)
    texts = {r["doc_id"]: r["text"] for r in good.collect()}
    junk = {r["doc_id"] for r in docs.collect()} - set(texts)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert junk and sum(labels.get(i, 0) for i in junk) == 0
    kept = {i for i, root in groups(texts, 5).items() if i == root}
    assert {r["doc_id"] for r in single.collect()} == kept
    words, _ = repeats({i: texts[i] for i in kept})
    after = {r["doc_id"]: (r["text"] or "").encode().split() for r in cut.collect()}
    for i in kept:
        own = [w for n, w in enumerate(texts[i].encode().split()) if n not in words.get(i, ())]
        assert after.get(i, []) == own
    copies = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert set(copies) <= set(after) and max(copies.values()) <= 2
    placed = collections.Counter()
    for r in packed.collect():
        placed[r["doc_id"]] += r["n_words"]
    assert +placed == +collections.Counter({i: n * len(after[i]) for i, n in copies.items()})
    for frame in (good, single, cut, mixed):
        assert frame.columns == docs.columns


def test_awkward_and_empty_documents(spark):
    for docs in (awkward(spark), nothing(spark)):
        frames = stages(spark, docs)
        assert all(f.columns == docs.columns for f in frames[:-1])
    assert frames[-1].collect() == []


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
