import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwatch.llm import vector_dups
from shelfwatch.llm.queries import QUERIES

from .helpers import SF

SCHEMA = "vec_id long, embedding array<double>, label int, node long, key string, copies long, first long"


def table(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [float(x) if x is not None else None for x in v], 0, 1, "k", 2, 3) for i, v in rows], SCHEMA)


def brute(rows, threshold=0.95):
    """{(id, vector): (links, component)} by comparing all pairs of distinct rows that take part."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    good = sorted(good, key=lambda r: r[0])
    parent, links = list(range(len(good))), [0] * len(good)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    units = []
    for _, v in good:
        a = np.array(v, float)
        a = np.ldexp(a, -int(np.frexp(np.abs(a).max())[1]))
        units.append(a / np.sqrt((a * a).sum()))
    for x in range(len(good)):
        for y in range(x + 1, len(good)):
            if len(units[x]) == len(units[y]) and (units[x] * units[y]).sum() >= threshold:
                links[x] += 1
                links[y] += 1
                a, b = find(x), find(y)
                parent[max(a, b)] = min(a, b)
    return {k: (n, good[find(i)][0]) for i, (k, n) in enumerate(zip(good, links))}


def around(rng, base, n, spread):
    noise = rng.standard_normal((n, len(base)))
    return base / np.linalg.norm(base) + spread * noise / np.sqrt(len(base))


def ids_of(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("spread", [0.08, 0.2])
def test_dense_groups_chains_and_pairs_equal_all_pairs(spark, spread):
    rng = np.random.default_rng(4)
    parts = [around(rng, rng.standard_normal(24), n, spread) for n in (150, 70, 20, 5, 2, 2, 2)]
    chain = [rng.standard_normal(24)]
    for _ in range(12):
        step = rng.standard_normal(24)
        step -= step @ chain[-1] / (chain[-1] @ chain[-1]) * chain[-1]
        chain.append(chain[-1] + 0.3 * step / np.linalg.norm(step) * np.linalg.norm(chain[-1]))
    vectors = np.concatenate([*parts, chain, rng.standard_normal((300, 24))])
    order = rng.permutation(len(vectors))
    rows = [(int(i) * 3 + 1, vectors[i].tolist()) for i in order]
    wanted = {i: found for (i, _), found in brute(rows).items()}
    assert max(n for n, _ in wanted.values()) > vector_dups.LONGEST and len({c for n, c in wanted.values() if n}) > 4
    got = ids_of(vector_dups.near_duplicate_vectors(table(spark, rows)))
    assert got == wanted


def test_awkward_rows(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.05]
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [1.0, math.nan, 2.0]), (6, [1.0, math.inf, 0.0]),
        (7, v), (8, v), (8, v), (9, w), (10, [-x for x in v]), (11, [1e300 * x for x in v]), (12, [1e-300 * x for x in v]),
        (13, [1.0, 2.0]), (14, [2.0, 4.0]), (15, [5.0, -1.0, 0.5]), (15, w), (None, v), (None, None), (16, [-0.0, 1.0, 0.0]), (17, [0.0, 1.0, 0.0]),
    ]
    df = vector_dups.near_duplicate_vectors(table(spark, rows))
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = df.collect()
    known = brute(rows)
    linked = sorted((r.vec_id, r.n_links, r.component_id) for r in got if r.vec_id is not None and r.vec_id > 6)
    assert linked == sorted((i, n, c) for (i, _), (n, c) in known.items())
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)] * 1
    assert all((r.n_links, r.component_id, r.kept) == (0, r.vec_id, True) for r in got if r.vec_id in range(1, 7))
    assert all(r.kept == (r.component_id == r.vec_id) for r in got if r.vec_id is not None)


def test_no_rows_and_no_vectors(spark):
    assert vector_dups.near_duplicate_vectors(table(spark, [])).collect() == []
    assert ids_of(vector_dups.near_duplicate_vectors(table(spark, [(1, None), (2, [0.0])]))) == {1: (0, 1), 2: (0, 2)}


def test_copies_of_one_vector(spark):
    rows = [(i, [3.0, 4.0]) for i in range(100, 400)] + [(7, [4.0, -3.0])]
    got = ids_of(vector_dups.near_duplicate_vectors(table(spark, rows)))
    assert got.pop(7) == (0, 7) and set(got.values()) == {(299, 100)}


def test_audit_counts_what_is_missing(spark):
    rng = np.random.default_rng(2)
    vectors = around(rng, rng.standard_normal(16), 40, 0.05)
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "node long, vector array<double>")
    linked = spark.createDataFrame([(i, 39) for i in range(20)], "node long, nodes long")
    assert vector_dups.audit(linked, nodes, 0.95) == 0.5


def test_query_equals_all_pairs(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    near = [(i + 100_000, [x + 0.02 * (-1) ** k for k, x in enumerate(v)]) for i, v in rows[:60]]
    assert ids_of(QUERIES["op11_vector_dups"](spark, SF)) == {i: found for (i, _), found in brute(rows).items()}
    got = ids_of(vector_dups.near_duplicate_vectors(table(spark, rows + near)))
    wanted = {i: found for (i, _), found in brute(rows + near).items()}
    assert got == wanted and sum(n > 0 for n, _ in wanted.values()) >= 120


def test_repeats_and_extra_columns(spark):
    rows = [(i, [float(i % 5) + 1, 2.0, float(i % 3)]) for i in range(60)]
    df = table(spark, rows)
    assert ids_of(vector_dups.near_duplicate_vectors(df)) == ids_of(
        vector_dups.near_duplicate_vectors(df.withColumn("embedding", F.col("embedding").cast("array<float>")))
    )
