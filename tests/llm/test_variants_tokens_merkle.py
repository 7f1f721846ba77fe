"""Spelling variants, token files and Merkle manifests against plain versions."""

import os
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from adjudica.llm import merkle_manifest, spelling_variants, token_files
from adjudica.llm.common import shared_folder, table

SF = "/root/testdata/sf0.001"


# Spelling variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_variants(counts, factor=5):
    near = defaultdict(list)
    for a, b in combinations(counts, 2):
        if abs(len(a) - len(b)) < 2 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x))
        if counts[best] >= factor * counts[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def plain_words(rows):
    counts = Counter()
    lower = str.maketrans(spelling_variants.UPPER, spelling_variants.LOWER)
    for i, x in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", x or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 5}


def some_words(rng, letters, sizes, n, edits):
    out = set()
    while len(out) < n:
        w = "".join(rng.choices(letters, k=rng.choice(sizes)))
        out.add(w)
        for _ in range(edits):
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]])
            out.add(w)
    return sorted(w for w in out if len(w) >= 6)


@pytest.mark.parametrize("seed, letters, sizes, bytes_", [(1, "ab", [6, 7, 8], 1 << 20), (2, "abcé", [6, 9], 40), (3, "aÿ", [6, 12, 80, 200], 300), (4, "ab", [6, 7], 1)])
def test_variants_equal_all_pairs(spark, frame, monkeypatch, seed, letters, sizes, bytes_):
    monkeypatch.setattr(spelling_variants, "PARTITION_BYTES", bytes_)  # small: hot partitions are halved down to a position
    rng = random.Random(seed)
    counts = {w: rng.choice([5, 6, 30, 200, 2000]) for w in some_words(rng, letters, sizes, 150, 4)}
    got = spelling_variants.spelling_variants(frame(list(counts.items()), "word string, n long").repartition(3)).collect()
    assert len(got) == len(counts) and {tuple(r) for r in got} == plain_variants(counts)


def test_acceptor_is_minimal_and_accepts_its_words():
    words = sorted({"tap", "taps", "top", "tops", "stop", "stops"})
    a = spelling_variants.Acceptor(words)
    assert sorted(spelling_variants.Both(a, a)(a.start, a.start)) == words
    assert len(a.arcs) == 7  # t-a-p-s and t-o-p-s share everything behind the vowel
    rng = random.Random(5)
    middles = some_words(rng, "abc", [6], 200, 3)
    short, long = [w for w in middles if len(w) == 6], [w for w in middles if len(w) == 7]
    got = list(spelling_variants.partition_pairs(short, long, True))
    want = {frozenset(p) for p in combinations(short, 2) if one_edit(*p)} | {frozenset((x, y)) for x in short for y in long if one_edit(x, y)}
    assert len(got) == len(set(map(frozenset, got))) and set(map(frozenset, got)) == want


def test_word_counts_of_odd_rows(spark, frame):
    rows = [(i % 40, "Kitten SITTING Écoles écoles naïveté x1kittens_sitting " * (1 + i % 3)) for i in range(300)]
    rows += [(None, "kitten naïveté"), (None, None), (7, ""), (8, "a" * 50_000), (9, " ".join("longwordß" + "x" * (i % 9) for i in range(30_000)))]
    rows += [(8, "a" * 50_000)] * 5
    d = frame([(*r, "c") for r in rows], "doc_id long, text string, word string").repartition(4)
    want = plain_words(rows)
    assert {r["word"]: r["n"] for r in spelling_variants.word_counts(d).collect()} == want
    got = spelling_variants.spelling_variants(spelling_variants.word_counts(d)).collect()
    assert {tuple(r) for r in got} == plain_variants(want) and "a" * 50_000 in want
    nothing = spelling_variants.spelling_variants(spelling_variants.word_counts(d.limit(0)))
    assert nothing.count() == 0


# Token files


def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    t.encode_special_tokens = True
    return t


def plain_tokens(rows):
    at, out = 0, []
    t = library()
    for i, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(x or "", add_special_tokens=False).ids, token_files.END_ID]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def odd_texts():
    texts = [None, "", " ", "\n\n  x", "it's we'll 12 345 ", "naïve façade ÿ", "日本語 text ①", "😀 ok", "<|endoftext|> is text", "͸ unassigned", "a" * 30_000]
    texts += [" ".join(f"word{i % 91} and more," for i in range(20_000)), "   spaces \u0085"]
    rng = random.Random(6)
    return texts + ["".join(rng.choices(" \n'stéñ12日,ab", k=rng.randint(1, 80))) for _ in range(200)]


def test_token_files_equal_the_library(spark, frame):
    rows = [(3 * i - 100, x) for i, x in enumerate(odd_texts())]
    random.Random(1).shuffle(rows)
    d = frame([(*r, 5, "c") for r in rows], "doc_id long, text string, start int, shard string").repartition(7)
    folder = shared_folder(spark, "token-test")
    manifest = token_files.write_tokens(d, folder, public_tokenizers.path(token_files.VOCABULARY))
    got = token_files.read_tokens(spark, folder, manifest).collect()
    want = plain_tokens(rows)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(want)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in got)
    # The same files, opened anew by position; and read raw by their format.
    again = token_files.read_manifest(spark, folder)
    files = token_files.TokenFiles(folder, again.collect())
    assert len(files) == len(rows) and all(zlib.crc32(files[p].astype("<u4").tobytes()) == w[3] for p, w in enumerate(want))
    first = again.orderBy("shard").first()
    raw = np.fromfile(f"{folder}/{first['ids_file']}", "<u2")
    index = np.fromfile(f"{folder}/{first['idx_file']}", "<i8")
    assert len(raw) == first["n_tokens"] and len(index) == 3 * first["n_docs"] + 1 and index[first["n_docs"]] == first["n_tokens"]
    with pytest.raises(IndexError):
        files[len(rows)]


def test_token_files_of_ties_nulls_and_nothing(spark, frame, monkeypatch):
    monkeypatch.setattr(token_files, "DOCS_PER_RANGE", 7)
    rows = [(None, "null id"), (None, "null id"), (4, "b"), (4, "a text"), (4, "a text"), (1, None)] + [(9, "hot")] * 300
    d = frame(rows, "doc_id long, text string").repartition(5)
    folder = shared_folder(spark, "token-test")
    got = token_files.read_tokens(spark, folder, token_files.write_tokens(d, folder, public_tokenizers.path(token_files.VOCABULARY))).collect()
    order = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order] == [None] * 2 + [1] + [4] * 3 + [9] * 300
    ends = np.cumsum([r["n_tokens"] for r in order])
    assert [r["start"] for r in order] == [0, *ends[:-1].tolist()]
    assert Counter(r["ids_crc32"] for r in got) == Counter(w[3] for w in plain_tokens(rows))
    folder = shared_folder(spark, "token-test")
    assert token_files.read_tokens(spark, folder, token_files.write_tokens(d.limit(0), folder, public_tokenizers.path(token_files.VOCABULARY))).count() == 0
    with pytest.raises(TypeError):
        token_files.write_tokens(d.withColumn("doc_id", F.col("doc_id").cast("string")), folder, public_tokenizers.path(token_files.VOCABULARY))


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_piece_cache_changes_nothing(monkeypatch, vocabulary):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "CACHED_PIECES", 20)
    path = public_tokenizers.path(vocabulary)
    with open(path, encoding="utf-8") as f:
        encoder = token_files.Encoder(f.read(), None)
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    texts = odd_texts()
    for at in range(0, len(texts), 9):
        for x, ids in zip(texts[at : at + 9], encoder.encode(texts[at : at + 9])):
            assert np.frombuffer(ids, f"<u{encoder.width}").tolist() == t.encode(x or "", add_special_tokens=False).ids, x


# Merkle manifest


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_proofs(rows, arity=2):
    """rows: (doc_id, source, lang, n_chars, text)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: digest(*map(field, r))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(*out[-1][i : i + arity]) for i in range(0, len(out[-1]), arity)])
        return out

    def path(tree, i):
        for level in tree[:-1]:
            run = level[i - i % arity : i - i % arity + arity]
            yield run[: i % arity], run[i % arity + 1 :]
            i //= arity

    groups = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    members = {g: sorted(((r[0] is not None, r[0] or 0, leaf(r), r) for r in rows if r[2] == g), key=lambda x: x[:3]) for g in groups}
    trees = {g: levels([m[2] for m in members[g]]) for g in groups}
    top = levels([trees[g][-1][0] for g in groups])
    out = []
    for k, g in enumerate(groups):
        for i, (_, _, own, r) in enumerate(members[g]):
            steps = [*path(trees[g], i), *path(top, k)]
            shown = leaf((*r[:3], r[3] + 1, r[4])) if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else own
            for before, after in steps:
                shown = digest(*before, shown, *after)
            out.append((r[0], own, trees[g][-1][0], top[-1][0], digest(*[x for before, after in steps for x in before + after]), shown, shown == top[-1][0]))
    return Counter(out)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, block int"


def proofs(d, arity=2):
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return Counter(tuple(r) for r in merkle_manifest.merkle_proofs(d, arity=arity, presented={"n_chars": changed}).select(COLUMNS).collect())


@pytest.mark.parametrize("span, fan, arity", [(1024, 10, 2), (4, 2, 2), (9, 3, 3)])
def test_merkle_equals_a_plain_tree(spark, frame, monkeypatch, span, fan, arity):
    monkeypatch.setattr(merkle_manifest, "SPAN", span)
    monkeypatch.setattr(merkle_manifest, "FAN_BITS", fan)
    rng = random.Random(span)
    langs = [None, "", "de", "dé", "en", "z"]
    ids = rng.sample(range(-5000, 5000), 60) + [2**62, -(2**62)] + list(range(9000, 9100))
    rows = [(i, rng.choice([None, "s"]), "en" if i >= 9000 else rng.choice(langs), rng.choice([None, 0, 7]), rng.choice([None, "", "é", "x:1"])) for i in ids]
    rows += [(1, "s", "lone", 3, "ü" * 70_000)]
    d = frame([(*r, "c", 1) for r in rows], DOCS).repartition(5)
    assert proofs(d, arity) == plain_proofs(rows, arity)


def test_merkle_of_ties_nulls_and_nothing(spark, frame, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "COPIES_PER_ROW", 16)
    monkeypatch.setattr(merkle_manifest, "SPAN", 8)
    rows = [(5, "s", "en", 1, f"t{i}") for i in range(40)] + [(5, "s", "en", 1, "same")] * 90 + [(i, "s", "en", 1, "x") for i in range(12)]
    rows += [(None, "s", "en", 1, "null id"), (None, "s", "en", 1, "null id"), (None, None, None, None, None), (63, "a", "de", 1, "x"), (64, "a", "de", 1, "x"), (64, "a", "de", 1, "x")]
    d = frame([(*r, "c", 1) for r in rows], DOCS).repartition(3)
    assert proofs(d) == plain_proofs(rows)
    assert proofs(d.limit(0)) == Counter()
    one = frame([(*rows[0], "c", 1)], DOCS)
    assert proofs(one) == plain_proofs(rows[:1])
    with pytest.raises(ValueError):
        merkle_manifest.merkle_proofs(d, arity=1)


def test_queries_equal_plain_versions(spark):
    docs = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert Counter(map(tuple, merkle_manifest.op13_merkle_manifest(spark, SF).select(COLUMNS).collect())) == plain_proofs(docs)
    texts = [(r[0], r[4]) for r in docs]
    assert sorted(map(tuple, token_files.op12_token_files(spark, SF).collect())) == sorted(plain_tokens(texts))
    assert {tuple(r) for r in spelling_variants.op11_spelling_variants(spark, SF).collect()} == plain_variants(plain_words(texts))
