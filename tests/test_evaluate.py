import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import evaluate
from shelfwatch.plans.jobs import gate_job


def overlap_scorer(max_tokens):
    """Stand-in: entailment when every word of the answer is in the context."""
    assert max_tokens == 512

    def score(texts):
        results = []
        for text in texts:
            context, answer = text.lower().split(evaluate.SEPARATOR.lower())
            words = set(answer.strip(".").split())
            share = len(words & set(context.replace(".", "").replace(",", "").split())) / len(words)
            results.append(("entailment", share) if share >= 0.5 else ("CONTRADICTION", 1 - share))
        return results

    return score


def silent_scorer(max_tokens):
    return lambda texts: [None] * len(texts)


def letter_embedder():
    return lambda texts: [[t.lower().count(c) + 0.0 for c in "abcdefghijklmnopqrstuvwxyz"] for t in texts]


GOOD = [
    ("Where does the river start?", "the river starts in the hills near the old mill", "the river starts in the hills"),
    ("How long does bread bake?", "bread does bake for forty minutes in a hot oven", "bread does bake for forty minutes"),
]
BAD = [
    ("Who painted the gate?", "the gate was painted by the baker", "zebras jump quickly"),
    ("Which day is market day?", "market day is on friday", "xylophones buzz"),
]


def frame(spark, data):
    return spark.createDataFrame(data, "question string, context string, answer string")


def test_faithfulness_follows_the_label(spark):
    scored = evaluate.score_faithfulness(frame(spark, GOOD + BAD), overlap_scorer).collect()
    assert [r["faithfulness"] for r in scored] == [1.0, 1.0, 0.0, 0.0]


def test_no_result_is_neutral(spark):
    scored = evaluate.score_faithfulness(frame(spark, GOOD), silent_scorer).collect()
    assert {r["faithfulness"] for r in scored} == {0.5}


def test_embeddings_have_length_one(spark):
    df = evaluate.embed_text(frame(spark, GOOD + [("123", "c", "45")]), ["question", "answer"], letter_embedder)
    norms = df.select(F.sqrt(F.aggregate("question_vec", F.lit(0.0), lambda t, x: t + x * x)).alias("n")).collect()
    assert [round(r["n"], 5) for r in norms] == [1.0, 1.0, 0.0]


def test_gate_passes_and_fails(spark):
    scores = evaluate.score_answers(frame(spark, GOOD), overlap_scorer, letter_embedder)
    gate = evaluate.eval_gate(scores, 0.6)
    row = evaluate.require_pass(gate)
    assert row["overall"] and row["n"] == 2 and row["mean_precision"] == 1.0 and row["shown_precision"] == "1.00"
    with pytest.raises(evaluate.GateFailed, match="precision"):
        evaluate.require_pass(evaluate.eval_gate(evaluate.score_answers(frame(spark, BAD), overlap_scorer, letter_embedder)))
    with pytest.raises(evaluate.GateFailed, match="no rows"):
        evaluate.require_pass(evaluate.eval_gate(scores.limit(0)))


def test_gate_compares_full_values(spark):
    scores = spark.createDataFrame([(0.6999, 0.9, 0.7)], "faithfulness double, relevance double, precision double")
    row = evaluate.eval_gate(scores, 0.7).first()
    assert row["shown_faithfulness"] == "0.70" and not row["pass_faithfulness"]
    assert row["pass_precision"] and not row["overall"]


def test_gate_job(spark, tmp_path):
    lines = [f'{{"question": "{q}", "context": "{c}", "answer": "{a}"}}' for q, c, a in GOOD]
    (tmp_path / "set.jsonl").write_text("\n".join(lines))
    row = gate_job(spark, str(tmp_path), overlap_scorer, letter_embedder, 0.6, str(tmp_path / "scores"))
    assert row["overall"]
