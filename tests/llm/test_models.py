"""The two trained models: held-out accuracy, what they may not see, and their defined edge cases."""

import numpy as np

from adjudica.llm import quality_nbsvm, toxicity_mil
from adjudica.llm.common import bounded_sample, held_out, sample_texts, table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def by_label(spark, scored, label):
    rows = scored.join(table(spark, SF, "labels"), "doc_id").where("held_out").select(label, "score", "predicted").collect()
    return [(r[label], r["score"], r["predicted"]) for r in rows]


def auc(rows):
    ones, zeros = [s for y, s, _ in rows if y == 1], [s for y, s, _ in rows if y == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])


def test_quality_on_held_out_rows(spark, frame):
    scored = quality_nbsvm.op4_quality_nbsvm(spark, SF)
    assert scored.count() == table(spark, SF, "documents").count()
    rows = by_label(spark, scored, "quality")
    assert auc(rows) > 0.97 and all(p == (s >= 0.3) for _, s, p in rows)
    assert np.mean([p for y, _, p in rows if y == 1]) > 0.97


def test_toxicity_on_held_out_rows(spark, frame):
    rows = by_label(spark, toxicity_mil.op9_toxicity_mil(spark, SF), "toxic")
    assert auc(rows) > 0.9 and np.mean([p for y, _, p in rows if y == 0]) < 0.05


def test_sample_is_bounded_and_leaves_out_held_out_rows(frame):
    rows = [(i, i % 2) for i in range(500)] + [(None, 1), (7, None), (1000, 0), (1000, 1), (3, 1)]
    labels = frame(rows, "doc_id long, quality int")
    got = bounded_sample(labels, "quality", 100).collect()
    assert len(got) == 100
    everything = bounded_sample(labels, "quality", 10_000)
    assert everything.where(held_out(F.col("doc_id"))).count() == 0
    ids = [r["doc_id"] for r in everything.collect()]
    assert len(ids) == len(set(ids)) and 1000 not in ids


def test_sample_has_one_row_for_an_id(frame):
    docs = frame([(1, "b"), (1, "a"), (1, None), (2, "c"), (2, "c"), (4, "d")], "doc_id long, text string")
    labels = frame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    got = sorted(map(tuple, sample_texts(docs, labels, "quality", 10).collect()))
    learnt = {r["doc_id"] for r in bounded_sample(labels, "quality", 10).collect()}
    assert got == [r for r in [(1, 1, ""), (2, 0, "c"), (4, 0, "d")] if r[0] in learnt]


def test_without_labels(spark, frame):
    docs = frame([(1, None, "a"), (2, "", "b"), (3, "some words here", "c"), (3, "some words here", "c")], "doc_id long, text string, score string")
    none = frame([], "doc_id long, quality int, toxic int")
    scores = [r["score"] for r in quality_nbsvm.quality_scores(docs, quality_nbsvm.train_quality(docs, none)).collect()] if docs.count() else []
    assert scores == [0.5] * 4
    got = {r["doc_id"]: r["score"] for r in toxicity_mil.toxicity_scores(docs, toxicity_mil.train_toxicity(docs, none)).collect()}
    assert got[1] == got[2] == 0 and 0 < got[3] < 0.01


def test_offending_sentence_is_located():
    good = ["The day was fine. We went home! All was well", "Nothing to see here.\nMove along now"]
    bad = ["The day was fine. You awful zorgle! All was well", "Nothing to see here.\nOnly a zorgle says so"]
    docs = [toxicity_mil.document_columns(x) for x in (good + bad) * 30]
    model = toxicity_mil.fit(docs, np.array([0, 0, 1, 1] * 30))
    text = "Été fine. The zorgle came… Home now."
    logits, spans = model.sentences(text, 0.0)
    assert [text[a:b] for a, b, _ in spans] == [" The zorgle came… Home now"]
    assert model.score(text) > 0.5 > model.score("Été fine. Home now.")
    assert len(logits) == 2


def test_noisy_or():
    p = np.array([0.1, 0.5, 0.9])
    assert np.isclose(toxicity_mil.noisy_or(list(np.log(p / (1 - p)))), 1 - np.prod(1 - p))
    assert toxicity_mil.noisy_or([]) == 0 and toxicity_mil.noisy_or([900.0]) == 1


def test_descent_reaches_the_dual_optimum():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(20, 6, replace=False)) for _ in range(40)]
    y = np.where([5 in r or 7 in r for r in rows], 1.0, -1.0)
    values = [np.full(6, 6**-0.5) for _ in rows]
    w = quality_nbsvm.descend(rows, values, y, 20)
    limit = quality_nbsvm.COST / (2 * np.where(y > 0, (y > 0).mean(), (y < 0).mean()))

    def objective(w):
        return w @ w / 2 + sum(c * max(0, 1 - t * (w[r] @ v)) for r, v, t, c in zip(rows, values, y, limit))

    best = objective(w)
    assert all(best <= objective(w + d) + 0.05 for d in rng.normal(0, 0.3, (300, 20)))
