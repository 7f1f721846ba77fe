"""Url rules, WARC, search, mixing and the pipeline against plain versions."""

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

import corpus_pipeline
from adjudica.llm import mixing, pii, topk_search, url_filters, warc
from adjudica.llm.byte_bpe import VOCABULARY
from adjudica.llm.common import shared_folder, table
from test_ngram_join import plain_components
from test_text_operators import TIKTOKEN

SF = "/root/testdata/sf0.001"


def plain_rule(host, path, rules):
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:] if fits else None


def test_url_rules_equal_each_rule_tried(spark, frame):
    rng = random.Random(2)
    hosts = ["com", "example.com", "www.example.com", "a.www.example.com", "net", "x.net", "ample.com", "com.net", "", "EXAMPLE.com", "example.com."]
    paths = ["", "/", "/en", "/en/", "/en/x/y", "/es/", "/fr/1"]
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("www.example.com", "/en/x", "block"), ("net", "/es/", "block"), ("x.net", "/", "allow"), ("net", "", "block"), ("net", "", "allow")]
    rows = [(i, f"{rng.choice(['http', 'x'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?a://b', '#c'])}", "z") for i in range(400)]
    rows += [(500, None, None), (501, "no scheme", "z"), (501, "no scheme", "z"), (None, "http://com/", "z")]
    d = frame(rows, "page_id long, url string, host string")
    got = {r["page_id"]: r for r in url_filters.url_verdicts(d, url_filters.rule_table(spark, tuple(rules)), rows_per_run=50).collect()}
    for i, url, _ in rows:
        r = got[i]
        rest = url.split("://", 1)[1] if url and "://" in url else None
        end = len(rest) if rest is not None else 0
        host = path = ""
        if rest is not None:
            cut = min([rest.find(c) for c in "/?#" if c in rest] or [end])
            host, tail = rest[:cut].lower(), rest[cut:]
            path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
        assert (r["host"], r["path"]) == (host, path), url
        want = plain_rule(host, path, rules)
        assert (r["rule"], r["verdict"]) == (want or (None, "allow")), url
    assert url_filters.url_verdicts(d.limit(0), url_filters.rule_table(spark, tuple(rules))).count() == 0


def plain_records(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        f = first.get(html or "")
        revisit = i is not None and f != i
        out.append((i, len(body), warc.digest32(body), "revisit" if revisit else "response", f if revisit else None))
    return Counter(out)


@pytest.mark.parametrize("range_bytes", [64, 999, 1 << 20])
def test_warc_round_trip(spark, frame, range_bytes):
    rows = [(i, f"http://x/{i}\r\nBad: 1", [None, "", "abc", "é" * 4000, "WARC/1.1\r\n\r\n", "z" * 200_000][i % 6]) for i in range(120)]
    rows += [(3, "u", "é" * 4000), (None, None, "abc"), (None, "u", "own")]
    d = frame([(*r, "x") for r in rows], "page_id long, url string, html string, payload_bytes string").repartition(4)
    folder = shared_folder(spark, "warc-test")
    records = warc.read_warc(spark, folder, warc.write_warc(d, folder), range_bytes).where("record_type <> 'warcinfo'").collect()
    ident = lambda u: None if u is None or u == "<urn:page:>" else int(u[10:-1])
    assert Counter((ident(r["record_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], ident(r["refers_to"])) for r in records) == plain_records(rows)
    html = {i: h or "" for i, _, h in rows if i is not None}
    assert all(r["payload"].decode() == html[ident(r["record_id"])] for r in records if r["record_type"] == "response" and ident(r["record_id"]) is not None)


def test_warc_of_nothing(spark, frame):
    folder = shared_folder(spark, "warc-test")
    manifest = warc.write_warc(frame([], "page_id long, url string, html string"), folder)
    assert warc.read_warc(spark, folder, manifest).count() == 0


def test_warc_files_are_plain_gzip(spark, frame, tmp_path):
    import gzip

    folder = str(tmp_path / "w")
    manifest = warc.write_warc(frame([(1, "http://a", "x"), (2, "http://b", "x")], "page_id long, url string, html string").coalesce(1), folder)
    name = manifest.first()["path"]
    text = gzip.decompress((tmp_path / "w" / name).read_bytes()).decode()
    assert text.count("WARC/1.1\r\n") == 3 and "WARC-Refers-To: <urn:page:1>" in text


def plain_search(docs, queries, k):
    import re

    words = [Counter(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))) for _, x in docs]
    n = [sum(w.values()) for w in words]
    mean = sum(n) / len(docs)
    df = Counter(t for w in words for t in w)
    out = []
    for q, x in queries:
        terms = set(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or "")))
        scores = []
        for (i, _), w, size in zip(docs, words, n):
            s = sum(np.log(1 + (len(docs) - df[t] + 0.5) / (df[t] + 0.5)) * w[t] * 2.2 / (w[t] + 1.2 * (0.25 + 0.75 * size / mean)) for t in terms if w[t])
            if round(s, 4) > 0:
                scores.append((-round(s, 4), i))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.mark.parametrize("dense", [0, 4, 256])
def test_search_equals_scoring_everything(spark, frame, monkeypatch, dense):
    monkeypatch.setattr(topk_search, "DENSE_TERMS", dense)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(80)]
    docs = [(i, " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(80)], k=rng.randint(0, 60)))) for i in range(500)]
    docs += [(900, docs[0][1]), (901, None), (902, "")]
    queries = [(q, docs[q][1]) for q in range(0, 60, 5)] + [(77, "unknown"), (78, None)]
    d, q = frame([(*x, "c") for x in docs], "doc_id long, text string, score string").repartition(2), frame(queries, "query long, text string")
    got = sorted((r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in topk_search.bm25_top_k(d, q, k=7).collect())
    assert got == sorted(plain_search(docs, queries, 7))


@pytest.mark.parametrize("shard_docs", [1, 40, 8192])
def test_search_over_many_shards_leaves_k_rows_a_query(spark, frame, monkeypatch, shard_docs):
    monkeypatch.setattr(topk_search, "SHARD_DOCS", shard_docs)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 3)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(200)] + [(300 + i, "copies of one text") for i in range(30)]
    docs += [(None, docs[3][1]), (5, docs[3][1]), (5, None)]
    queries = [(q, x) for q, x in docs if q is not None and q % 10 == 0] + [(310, "copies of one text"), (1, None), (2, "unknown")]
    d, q = frame([(*x, 1) for x in docs], "doc_id long, text string, lang int").repartition(3), frame(queries, "query long, text string")
    found = topk_search.bm25_top_k(d, q, k=4)
    assert "Window" not in found._jdf.queryExecution().toString()
    got = sorted(map(repr, ((r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in found.collect())))
    assert got == sorted(map(repr, plain_search_nulls_last(docs, queries, 4)))


def plain_search_nulls_last(docs, queries, k):
    last = 1 << 40
    return [(q, r, None if i == last else i, float(s)) for q, r, i, s in plain_search([(last if i is None else i, x) for i, x in docs], queries, k)]


@pytest.mark.parametrize("share", [[1], [500, 500], [333, 333, 334], [700, 200, 50, 50], [1] * 7 + [993], [15, 25, 60]])
def test_schedule_stays_within_one_block(share):
    period, placed = sum(share), [0] * len(share)
    for t, (s, j) in enumerate(mixing.pfair_schedule(share), 1):
        assert j == placed[s]
        placed[s] += 1
        assert all(abs(n - a * t / period) < 1 for n, a in zip(placed, share))
    assert placed == share


def test_mixture_places_every_row_once(spark, frame):
    rows = [(i, f"t{i}", ["a", "a", "a", "b", None][i % 5], 1) for i in range(3000)] + [(None, "n", "b", 1), (4, "again", "a", 1)]
    d = frame(rows, "doc_id long, text string, source string, position int").repartition(5)
    weights = {"a": 0.5, "b": 0.3, None: 0.2}
    placed = mixing.mixed(d, weights, block_rows=8, period=100, rows_per_run=100).select("row.doc_id", "row.source", "slot", "position").collect()
    assert sorted(r["position"] for r in placed) == list(range(len(rows)))
    counts = Counter()
    ends = {s: max(r["position"] for r in placed if r["source"] == s) for s in weights}
    for r in sorted(placed, key=lambda r: r["position"]):
        counts[r["source"]] += 1
        t = sum(counts.values())
        if t <= min(ends.values()):
            assert all(abs(counts[s] - w * t) <= 2 * 8 for s, w in weights.items())
    ordered = mixing.in_order(mixing.mixed(d, weights, block_rows=8, period=100))
    assert ordered.columns == d.columns and ordered.count() == len(rows)
    assert mixing.mixed(d.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.mixed(d, {"a": 1.0, "b": 1.0})
    with pytest.raises(ValueError):
        mixing.mixed(d, {"a": 1.0, "b": 1.0, None: 0.0})


@pytest.mark.parametrize("weights, rows", [
    ({"a": 0.9, "b": 0.1}, {"a": 18_000, "b": 2_000}),  # a period of ten slots, 2000 times
    ({"a": 0.99999, "b": 0.00001}, {"a": 20_000, "b": 3}),
    ({"a": Fraction(1, 3), "b": Fraction(2, 7), "c": 0.123456789}, {"a": 6_000, "b": 5_000, "c": 2_000}),  # no short period
    (None, {"a": 9_000, "b": 1_000, "c": 77}),
])
def test_mixture_keeps_the_given_weights(spark, weights, rows):
    d = spark.createDataFrame([(i, s) for s, n in rows.items() for i in range(n)], "doc_id long, source string")
    given = weights or {s: n ** mixing.SMOOTHING for s, n in rows.items()}
    total = sum(Fraction(str(w)) for w in given.values())
    share = {s: Fraction(str(w)) / total for s, w in given.items()}
    got = sorted(mixing.mixed(d, weights, block_rows=1).select("slot", "row.source", "block", "position").collect())
    assert [r["position"] for r in got] == list(range(sum(rows.values()))) and len({r["slot"] for r in got}) == len(got)
    for r in got:
        assert int(r["block"] / share[r["source"]]) <= r["slot"] < -int(-(r["block"] + 1) / share[r["source"]] // 1)
    counts = Counter()
    for t, r in enumerate(got, 1):
        counts[r["source"]] += 1
        if any(counts[s] == n for s, n in rows.items()):
            break
        assert r["slot"] == t - 1 and all(abs(counts[s] - w * t) < 1 for s, w in share.items())


def test_mixture_of_more_sources_than_a_period(frame):
    rows = [(i, f"s{i % 1500}") for i in range(4000)] + [(i, None) for i in range(40)]
    d = frame(rows, "doc_id long, source string")
    for weights in (None, {None: 5} | {f"s{i}": 1 + i % 3 for i in range(1500)}):
        placed = mixing.mixed(d, weights, block_rows=2).select("position", "row.source").collect()
        assert sorted(r["position"] for r in placed) == list(range(len(rows)))
        assert Counter(r["source"] for r in placed) == Counter(s for _, s in rows)


def test_pipeline_equals_plain_stages(spark, frame, tmp_path):
    docs = table(spark, SF, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "ngram_jaccard_join", "pii", "mixing", "byte_bpe"]
    out = docs
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out, SF).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        seen[name] = out
        if k < 4:
            assert out.dtypes == docs.dtypes
    first = {r["doc_id"] for r in seen["quality_classifier"].collect()}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    assert np.mean([i in first for i in texts if labels.get(i) == 1]) > 0.97
    rows = sorted((i, texts[i]) for i in first)
    kept = {key for key, _, component in plain_components(rows) if key == component}
    assert {r["doc_id"] for r in seen["ngram_jaccard_join"].collect()} == kept
    clean = {r["doc_id"]: r["text"] for r in seen["mixing"].collect()}
    assert set(clean) == kept and all(r["n_chars"] == len(r["text"]) for r in seen["pii"].collect())
    assert all((clean[i] != texts[i]) == bool(pii.find_spans(texts[i])) for i in kept)
    final = {r["doc_id"]: r for r in out.collect()}
    assert set(final) == kept and all(r["round_trip"] for r in final.values())
    assert all(np.frombuffer(final[i]["ids"], "<u4").tolist() == TIKTOKEN.encode_ordinary(clean[i]) for i in kept)
    assert VOCABULARY.endswith(".tiktoken")


def test_pipeline_stages_on_odd_rows(spark, frame):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "some text of five words or more", "en", None, 3)]
    docs = frame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for d in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, d, SF)
            assert got.count() <= d.count() and (name == "byte_bpe" or got.columns == docs.columns)


def test_registered_queries(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 14):
        assert any(x.startswith(f"op{n}_") for x in names)
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op3_topk_search", "op6_url_filters", "op11_spelling_variants", "op13_merkle_manifest"])
def test_oracle_sql(spark, frame, name):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(entry.oracle_sql()[name]).fetchall()
    columns = [c[0] for c in con.description]
    got = [tuple(r[c] for c in columns) for r in entry.queries()[name](spark, SF).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and got
