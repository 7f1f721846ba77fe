"""The registered functions on a whole small table against plain versions, and very long texts through the operators."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from adjudica.llm import byte_bpe, mixing, ngram_join, pii, quality_nbsvm, quality_rules, topk_search, toxicity_mil, warc
from adjudica.llm.common import table
from adjudica.llm.components import components
from test_ngram_join import plain_components, plain_links, plain_set
from test_tables_and_pipeline import plain_search
from test_text_operators import TIKTOKEN, plain_measures, plain_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").select("doc_id", "text").collect()}


def by_id(df, key="doc_id"):
    rows = df.collect()
    assert len({r[key] for r in rows}) == len(rows)
    return {r[key]: r for r in rows}


def test_op1_pii(spark, frame, texts):
    got = by_id(pii.op1_pii(spark, SF))
    assert got.keys() == texts.keys()
    for i, x in texts.items():
        spans = plain_spans(x or "")
        n = Counter(k for k, _, _ in spans)
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        r = got[i]
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (n["email"], n["ip"], n["card"], n["phone"])
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert set(said.split(",")) - {""} <= set(r["spans"].split(","))


def test_op2_ngram_join(spark, frame, texts):
    got = by_id(ngram_join.op2_ngram_join(spark, SF))
    rows = sorted(texts.items())
    assert sorted((i, r["n_shingles"], r["component_id"]) for i, r in got.items()) == sorted(plain_components(rows))
    links = Counter(a for a, _ in plain_links([plain_set(x) for _, x in rows]))
    assert {i: r["n_links"] for i, r in got.items()} == {i: links[k] for k, (i, _) in enumerate(rows)}


def test_op5_byte_bpe(spark, frame, texts):
    got = by_id(byte_bpe.op5_byte_bpe(spark, SF))
    assert got.keys() == texts.keys()
    for i, x in texts.items():
        ids = TIKTOKEN.encode_ordinary(x or "")
        assert tuple(got[i])[1:] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((x or "").encode()).hexdigest())


def test_op7_warc(spark, frame):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in table(spark, SF, "pages").collect()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    got = by_id(warc.op7_warc(spark, SF), "page_id")
    assert got.keys() == pages.keys()
    for i, body in pages.items():
        f = first[body]
        want = (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if f == i else "revisit", None if f == i else f)
        assert tuple(got[i])[1:] == want


def test_op8_mixing(spark, frame):
    docs = {r["doc_id"]: r["source"] for r in table(spark, SF, "documents").collect()}
    got = by_id(mixing.op8_mixing(spark, SF))
    assert {i: r["source"] for i, r in got.items()} == docs and sorted(r["position"] for r in got.values()) == list(range(len(docs)))
    counts = Counter(docs.values())
    order = sorted(counts, key=lambda s: "" if s is None else f"={s}")
    share = mixing.shares([counts[s] ** mixing.SMOOTHING for s in order])
    slots = {(order[s], j): t for t, s, j in mixing.block_schedule(share, [-(-counts[s] // mixing.BLOCK_ROWS) for s in order])}
    assert {(r["source"], r["block"]): r["slot"] for r in got.values()} == slots
    by_position = [r["slot"] for r in sorted(got.values(), key=lambda r: r["position"])]
    assert by_position == sorted(by_position)


def test_op10_quality_rules(spark, frame, texts):
    got = by_id(quality_rules.op10_quality_rules(spark, SF))
    assert got.keys() == texts.keys()
    for i, x in texts.items():
        r, want = got[i], plain_measures(x or "")
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r["base_failed"] and r["kept"])


def held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_op4_scores_follow_from_its_model(spark, frame, texts):
    docs = table(spark, SF, "documents")
    model = quality_nbsvm.train_quality(docs, table(spark, SF, "labels"))
    ratio, weights = model.ratio.astype(float), model.weights.astype(float)
    got = by_id(quality_nbsvm.op4_quality_nbsvm(spark, SF))
    assert got.keys() == texts.keys()
    for i, x in texts.items():
        columns = set(quality_nbsvm.features(x).tolist())
        length = sum(ratio[c] ** 2 for c in columns) ** 0.5
        margin = sum(weights[c] for c in columns) / length if length else 0.0
        want = 1 / (1 + np.exp(-(model.slope * margin + model.offset)))
        r = got[i]
        assert abs(r["score"] - want) < 1e-4 and r["held_out"] == held_out(i) and r["predicted"] == (r["score"] >= 0.3)


def test_op9_scores_follow_from_its_model(spark, frame, texts):
    model = toxicity_mil.train_toxicity(table(spark, SF, "documents"), table(spark, SF, "labels"))
    got = by_id(toxicity_mil.op9_toxicity_mil(spark, SF))
    assert got.keys() == texts.keys()
    for i, x in texts.items():
        logits = model.sentences(x, np.inf)[0]
        none = 1.0
        for z in logits:
            none *= 1 - 1 / (1 + np.exp(-z))
        r = got[i]
        assert abs(r["score"] - (1 - none)) < 1e-6 and r["held_out"] == held_out(i) and r["predicted"] == (r["score"] >= 0.5)
    # a sentence counts as its words do: joining texts by a stop multiplies the chances of none
    a, b = [texts[i] for i in sorted(texts)[:2]]
    one = lambda x: 1 - model.score(x)
    assert abs(one(f"{a}. {b}") - one(a) * one(b)) < 1e-6


LONG = " ".join(f"word{i % 4001} and{i % 13}" for i in range(60_000)) + ".\n"


def test_long_texts_through_the_operators(spark, frame):
    rows = [(1, LONG, 5), (2, LONG + "one more", 5), (3, "short text of a few words", 5), (4, None, 5)]
    d = frame(rows, "doc_id long, text string, score int")
    small = [(i, x) for i, x, _ in rows]
    near = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(d).collect()))
    assert near == plain_components(small)
    found = sorted((r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in topk_search.bm25_top_k(d, d.selectExpr("doc_id AS query", "text"), k=3).collect())
    want = sorted(plain_search(small, small, 3))
    assert [f[:3] for f in found] == [w[:3] for w in want] and all(abs(f[3] - w[3]) < 2e-4 for f, w in zip(found, want))
    measures = {r["doc_id"]: r for r in quality_rules.quality_rules(d).collect()}
    r = measures[1]
    assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain_measures(LONG)
    none = frame([], "doc_id long, quality int, toxic int")
    empty = d.limit(0)
    for train, score in ((quality_nbsvm.train_quality, quality_nbsvm.quality_scores), (toxicity_mil.train_toxicity, toxicity_mil.toxicity_scores)):
        model = train(d, none)
        scores = {r["doc_id"]: r["score"] for r in score(d, model).collect()}
        assert scores.keys() == {1, 2, 3, 4} and all(0 <= s <= 1 for s in scores.values())
        assert scores[1] == pytest.approx(model.score(LONG)) and score(empty, train(empty, none)).count() == 0


def test_components_of_a_long_chain_in_order(frame):
    edges = [("n%05d" % i, "n%05d" % (i + 1)) for i in range(4000)] + [("m%d" % i, "m%d" % (i + 1)) for i in range(30)]
    got = {r["node"]: r["label"] for r in components(frame(edges, "a string, b string")).collect()}
    assert len({got["n%05d" % i] for i in range(4001)}) == 1 and len({got["m%d" % i] for i in range(31)}) == 1 and len(set(got.values())) == 2


def test_pipeline_keeps_columns_of_any_name(spark, frame):
    import corpus_pipeline

    rows = [(1, "a text of more than five words here", 77, 1, "x"), (2, "another text of more than five words", 78, 2, "y")]
    d = frame(rows, "doc_id long, text string, _row int, row int, doc string")
    got = sorted(map(tuple, dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, d, SF).collect()))
    assert got == sorted(rows)
