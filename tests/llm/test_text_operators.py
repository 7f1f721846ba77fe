"""Personal data, token ids and quality rules against plain versions, and their defined edge cases."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from adjudica.llm import byte_bpe, pii, quality_rules

WORD = r"[^\x20\x09-\x0D]+"


def plain_spans(x):
    luhn = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 8 <= len(digits(m)) <= 15]
    return out


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a1.@+- (_5b2é)", max_size=60))
def test_base_spans_equal_the_patterns(x):
    assert [(s.kind, s.start, s.end) for s in pii.find_spans(x) if s.kind in pii.BASE_KINDS] == plain_spans(x)


def test_added_kinds_need_checksum_or_context():
    kinds = lambda x: [s.kind for s in pii.find_spans(x)]
    assert kinds("GB82 WEST 1234 5698 7654 32") == ["iban"]
    assert "iban" not in kinds("GB83 WEST 1234 5698 7654 32")
    assert kinds("number 123-45-6789") == [] and kinds("her SSN is 123-45-6789") == ["national_id"]
    near, far = pii.find_spans("mail to a@b.cd")[0], pii.find_spans("x a@b.cd")[0]
    assert near.score > far.score


@pytest.mark.parametrize("before", ["", "IBAN ", "AB12 ", "DE89 "])
@pytest.mark.parametrize("iban", ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82WEST12345698765432", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S",
                                  "DZ58 0002 1000 0111 3000 0005 70"])
@pytest.mark.parametrize("after", ["", " BIC COBADEFFXXX", " EUR 20", " 2024", " 20 A 1 B", " und", ".", " NO93 8601 1117 947"])
def test_iban_before_other_words(before, iban, after):
    x = before + iban + after
    want = [iban] + [after[1:]] * after.startswith(" NO")
    assert [x[s.start : s.end] for s in pii.find_spans(x) if s.kind == "iban"] == want


def test_iban_has_its_countrys_length():
    assert pii.mod97("DE5137040044053201300") and "iban" not in [s.kind for s in pii.find_spans("DE51 3704 0044 0532 0130 0")]
    assert not [s for s in pii.find_spans("DE89 3704 0044 0532 0130 00x") if s.kind == "iban"]


def test_redacted_iban_before_other_words(frame):
    d = frame([(1, "pay DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX")], "doc_id long, text string")
    assert pii.redacted(d).first()["text"] == "pay [IBAN] BIC COBADEFFXXX"


def test_long_texts_take_linear_time():
    for x in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1 " * 100_000, "1 " * 150_000):
        pii.find_spans(x)


def test_pii_rows(frame):
    rows = [(1, None, "x"), (2, "", "x"), (3, "é a@b.cd +1 234 567 89", "x"), (3, "é a@b.cd +1 234 567 89", "x"), (None, "1.2.3.4", None)]
    d = frame(rows, "doc_id long, text string, spans string")
    got = [(r["doc_id"], [(s["kind"], s["start"], s["end"], s["text"]) for s in r["spans"]]) for r in pii.pii_spans(d).collect()]
    mail = [("email", 2, 8, "a@b.cd"), ("phone", 9, 22, "+1 234 567 89")]
    assert sorted(got, key=str) == sorted([(1, []), (2, []), (3, mail), (3, mail), (None, [("ip", 0, 7, "1.2.3.4")])], key=str)
    clean = {r["doc_id"]: r["text"] for r in pii.redacted(d).collect()}
    assert clean[3] == "é [EMAIL] [PHONE]" and clean[1] is None
    assert pii.pii_spans(d.limit(0)).count() == 0 and pii.redacted(d).columns == d.columns


def encoder():
    ranks = byte_bpe.load_ranks(public_tokenizers.path(byte_bpe.VOCABULARY))
    return byte_bpe.TextCodec(ranks, public_tokenizers.PATTERN), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


CODEC, TIKTOKEN = encoder()


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=80), st.lists(st.sampled_from(["the", "ing", " ", "\n", "aaaa", "é", "'s", "1", "中", "՘", "\U000323b0", "!"]), max_size=80).map("".join)))
def test_ids_equal_tiktoken(x):
    ids = CODEC.encode(x)
    assert np.frombuffer(ids, "<u4").tolist() == TIKTOKEN.encode_ordinary(x)
    assert CODEC.pairs.decode(ids) == x.encode()


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=120), st.binary(max_size=120), st.binary(max_size=120))
def test_join_is_exact_and_associative(a, b, c):
    p = CODEC.pairs
    left = p.join(p.join(p.tree(a), p.tree(b)), p.tree(c))
    assert left == p.join(p.tree(a), p.join(p.tree(b), p.tree(c))) == p.merge(a + b + c)


@pytest.mark.parametrize("x", ["a" * 40_000, " " * 30_000 + "x", "the" * 15_000, "".join(random.Random(1).choices("abcdefgh", k=40_000))])
def test_long_pieces(x):
    assert np.frombuffer(CODEC.encode(x), "<u4").tolist() == TIKTOKEN.encode_ordinary(x)


def test_bpe_rows(frame):
    d = frame([(1, None, 0), (2, "", 0), (3, "Größe, the end", 0), (3, "Größe, the end", 1), (None, "x", 1)], "doc_id long, text string, ids int")
    got = byte_bpe.token_digests(byte_bpe.bpe_round_trip(d, public_tokenizers.path(byte_bpe.VOCABULARY))).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in got} == {
        (1, 0, empty), (2, 0, empty), (3, len(TIKTOKEN.encode_ordinary("Größe, the end")), hashlib.sha256("Größe, the end".encode()).hexdigest()),
        (None, 1, hashlib.sha256(b"x").hexdigest())}
    assert len(got) == 5


def plain_measures(x):
    w = re.findall(WORD, x)
    seen = {}
    for k in range(len(w) - 7):
        seen.setdefault(tuple(w[k : k + 8]), []).append(k)
    covered = {i for at in seen.values() if len(at) > 1 for k in at for i in range(k, k + 8)}
    lines = [y for y in x.split("\n") if re.search(WORD, y)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(frame):
    rng = random.Random(3)
    texts = ["", " \n\t ", "a", "é x y\x0bz", "a b\na b\n a b\n\n", "x " * 30, "a b c d e f g h " * 5]
    texts += ["".join(rng.choice(["a ", "b ", "cd ", "#", "é", "\n", "\t", "| ", "a b c d e f g h "]) for _ in range(rng.randint(0, 80))) for _ in range(150)]
    rows = [(i, x, "clash") for i, x in enumerate(texts)] + [(None, None, None)]
    d = frame(rows, "doc_id long, text string, kept string")
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(d).collect()}
    for i, x in enumerate(texts):
        r = got[i]
        n, chars, symbols, dup, repeated = plain_measures(x)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeated), x
        assert r["base_failed"] == (n < 20 or 100 * repeated > 30 * n)
        assert not (r["kept"] and r["base_failed"])
    assert got[None]["n_words"] == 0 and not got[None]["kept"]
    assert quality_rules.quality_rules(d.limit(0)).count() == 0


def test_a_long_text_is_kept(frame):
    measures = {"n_words": 5_000_000, "word_chars": 25_000_000, "n_symbols": 0, "n_marks": 0, "n_stop": 500_000, "n_same": 0, "n_dup_lines": 0, "n_lines": 1}
    m = frame([tuple(measures.values())], ", ".join(f"{c} long" for c in measures))
    assert list(m.select(*[r.passed().alias(r.name) for r in quality_rules.RULES]).first()) == [True] * len(quality_rules.RULES)


def test_quality_rules_run_without_python(frame):
    plan = quality_rules.quality_rules(frame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Pandas|MapIn|Exchange", plan)
