"""The Jaccard join, the prefix trie and the components against plain versions."""

import random
import re

import numpy as np

from adjudica.llm.components import components
from adjudica.llm import ngram_join
from adjudica.llm.ngram_join import near_duplicates, similar_sets
from adjudica.llm.prefix_trie import PrefixTrie, enough, local_ranks
from adjudica.llm.word_hash import word_hashes

WORD = r"[^\x20\x09-\x0D]+"


def plain_set(x):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_components(rows):
    sets = [plain_set(x) for _, x in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        r = find(i)
        if key is not None:
            least[r] = min(least.get(r, key), key)
    return sorted(((key, len(s), least.get(find(i))) for i, ((key, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(400)
    passage = [word() for _ in range(40)]
    texts = [None, "", "  \n", "One two", "one TWO", "one two three four five", "ONE two three\tfour five"]
    for _ in range(25):
        base = [word() for _ in range(rng.randint(5, 90))]
        if rng.random() < 0.4:
            base[3:3] = passage
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    keys = list(range(len(texts)))
    rng.shuffle(keys)
    rows = list(zip(keys, texts))
    return rows + [rows[10], (None, texts[12]), (None, "alone in the world with a null")]


def test_components_equal_all_pairs(frame):
    for seed in (1, 2):
        rows = corpus(seed)
        d = frame([(k, x, "z") for k, x in rows], "doc_id long, text string, component_id string").repartition(3)
        got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(d).collect()), key=str)
        assert got == plain_components(rows)


def plain_links(sets):
    return {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j and a and b and 100 * len(a & b) >= 75 * len(a | b)}


def test_every_link_is_listed_and_counted(frame, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 5)
    rng = random.Random(7)
    base = ["f%d" % i for i in range(120)]
    texts = [x for _, x in corpus(3)] + [" ".join(base)] * 2
    for i in range(40):
        copy = base[: rng.randint(70, 120)]
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = "c%d" % rng.randrange(50)
        texts.append(" ".join(copy))
    sets = [plain_set(x) for x in texts]
    want = plain_links(sets)
    d = frame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["n_links"] for r in near_duplicates(d, with_links=True).collect()}
    assert got == {i: sum(a == i for a, _ in want) for i in range(len(texts))}
    links, members = similar_sets(d)
    rows = {}
    for r in members.collect():
        rows.setdefault(bytes(r["digest"]), []).append(r["doc_id"])
    pairs = [frozenset((rows[bytes(r["a"])][0], rows[bytes(r["b"])][0])) for r in links.collect()]
    first = {i: v[0] for v in rows.values() for i in v}
    assert len(pairs) == len(set(pairs)) and set(pairs) == {frozenset((first[a], first[b])) for a, b in want if sets[a] != sets[b]}
    assert near_duplicates(frame([], "doc_id long, text string"), with_links=True).count() == 0


def test_empty_table(frame):
    assert near_duplicates(frame([], "doc_id long, text string")).count() == 0
    assert [tuple(r) for r in near_duplicates(frame([(7, None)], "doc_id long, text string")).collect()] == [(7, 0, 7)]


def test_large_family_needs_few_links(frame):
    rng = random.Random(5)
    base = ["f%d" % i for i in range(60)]
    rows = [(0, " ".join(base))]
    for i in range(1, 300):
        copy = list(base)
        copy[rng.randrange(60)] = "c%d" % i
        rows.append((i, " ".join(copy)))
    got = near_duplicates(frame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {0}


def test_trie_equals_all_pairs():
    rng = np.random.default_rng(1)
    for _ in range(60):
        sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint64) for _ in range(rng.integers(1, 30))]
        extra = [int(rng.integers(0, 4)) for _ in sets]  # elements that no other set has
        sizes = [len(s) + e for s, e in zip(sets, extra)]
        count = {v: sum(v in s for s in sets) for v in range(60)}
        ranks = local_ranks([(s, np.array([count[int(v)] for v in s], np.uint32)) for s in sets])
        found = PrefixTrie(ranks[1:], sizes[1:]).similar(ranks[0], sizes[0])
        want = [i for i in range(len(sets) - 1) if enough(len(np.intersect1d(sets[0], sets[i + 1])), sizes[0] + sizes[i + 1])]
        assert sorted(found) == want


def test_components_of_chains_stars_and_loops(frame):
    edges = [("n%03d" % i, "n%03d" % (i + 1)) for i in range(60)] + [("hub", "s%d" % i) for i in range(50)] + [("x", "x")]
    got = {r["node"]: r["label"] for r in components(frame(edges, "a string, b string")).collect()}
    assert len({got["n%03d" % i] for i in range(61)}) == 1
    assert len({got["s%d" % i] for i in range(50)} | {got["hub"]}) == 1
    assert got["hub"] != got["n000"] and "x" not in got


def test_words_of_long_texts_are_cut_at_spaces(monkeypatch):
    from adjudica.llm import word_hash

    text = " ".join("word%d" % i for i in range(5000)) + "\tÉté\x0bend"
    whole = word_hashes(text, shapes=True)
    monkeypatch.setattr(word_hash, "SEGMENT_BYTES", 100)
    parts = word_hashes(text, shapes=True)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all() and len(whole[0]) == 5002
    assert word_hashes("ABC")[0][0] == word_hashes("abc")[0][0] != word_hashes("abd")[0][0]
