"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust their score.

Kinds, in the order of a text's span list: email, ip, card (Luhn), phone, iban (mod 97), local_phone, national_id.
The first four are reported wherever the pattern and its check hold; context words only move their score. The other
three are reported if their score, after checksum and context, reaches ``threshold``.

An IBAN has the length of its country (ISO 13616). A country that isn't in the table may have any length from 15 to 34; the
longest one that ends with a token and passes mod 97 counts.

Every pattern runs in time linear in the text: quantifiers over classes that cannot match what follows are possessive
or bounded, and an email is found from its ``@``. Spans are code point offsets into the whole text, end exclusive.

Defined cases: a null or empty text has no spans; repeated rows are searched one by one; an empty table gives an empty
result; other columns of the input are neither read nor returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "local_phone", "national_id")
THRESHOLD = 0.5
CONTEXT_BEFORE, CONTEXT_AFTER, CONTEXT_GAIN = 48, 24, 0.3

# Words whose nearness makes a kind likelier.
CONTEXT = {
    "email": {"email", "mail", "contact", "correo", "courriel"},
    "ip": {"ip", "address", "host", "server", "adresse"},
    "card": {"card", "credit", "visa", "mastercard", "karte", "tarjeta", "carte"},
    "phone": {"phone", "tel", "call", "mobile", "telefon", "fax", "teléfono", "téléphone"},
    "iban": {"iban", "account", "bank", "konto", "cuenta", "compte"},
    "local_phone": {"phone", "tel", "call", "mobile", "telefon", "fax", "teléfono", "téléphone"},
    "national_id": {"ssn", "social", "security"},
}
# Score that the pattern alone (with its checksum, where it has one) earns.
START_SCORE = {"email": 0.7, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7, "local_phone": 0.3, "national_id": 0.3}

# Lengths of IBANs by country (ISO 13616 registry).
IBAN_LENGTH = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 "
    "FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 "
    "LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 "
    "SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
).split()}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_IBAN_OF = {n: re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){%d}(?![A-Za-z0-9])" % (n - 4)) for n in range(15, 35)}
_LOCAL_PHONE = re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
_NATIONAL_ID = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check of an IBAN without spaces: first four characters moved to the end, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)  # no later local part can reach across this sign
        at = text.find("@", done)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m[0].split("."))
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 40:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGIT.findall(m[0])) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for start in _IBAN_START.finditer(text):
        if start.start() < done:
            continue
        length = IBAN_LENGTH.get(start[0][:2])
        for n in [length] if length else range(34, 14, -1):
            m = _IBAN_OF[n].match(text, start.start())
            if m and mod97(m[0].replace(" ", "")):
                yield m.span()
                done = m.end()
                break


_PROPOSE = {
    "email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans,
    "local_phone": lambda t: (m.span() for m in _LOCAL_PHONE.finditer(t)),
    "national_id": lambda t: (m.span() for m in _NATIONAL_ID.finditer(t)),
}


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT_BEFORE) : start] + " " + text[end : end + CONTEXT_AFTER]
    found = any(w.lower() in CONTEXT[kind] for w in _WORD.findall(near))
    return min(1.0, START_SCORE[kind] + CONTEXT_GAIN * found)


def find_spans(text: str | None, threshold: float = THRESHOLD) -> list[Span]:
    """All spans of a text, by kind as listed, then start."""
    if not text:
        return []
    has_digit = _DIGIT.search(text) is not None
    out = []
    for kind, propose in _PROPOSE.items():
        if has_digit or kind == "email":
            for start, end in propose(text):
                score = _score(text, kind, start, end)
                if kind in BASE_KINDS or score >= threshold:
                    out.append(Span(kind, start, end, score))
    return out


SPAN_TYPE = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("score", T.DoubleType()), T.StructField("text", T.StringType()),
]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("text", pa.string())]))


def pii_spans(documents: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """key and spans (kind, start, end, score, text) of each row; a narrow pass without a shuffle."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [
                [{"kind": s.kind, "start": s.start, "end": s.end, "score": s.score, "text": x[s.start : s.end]} for s in find_spans(x, threshold)]
                for x in b.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, _ARROW_SPANS)], names=["_key", "spans"])

    d = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    out = T.StructType([T.StructField("_key", d.schema["_key"].dataType), T.StructField("spans", SPAN_TYPE)])
    return d.mapInArrow(search, out).select(F.col("_key").alias(key), "spans")


def redacted(documents: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The input with every span of ``text`` replaced by its kind in brackets, e.g. ``[EMAIL]``; all columns stay.

    Overlapping spans become one, named by the first. A null text stays null.
    """
    if documents.schema[text].dataType != T.StringType():
        raise TypeError(f"{text} must be a string column")

    def clean(x: str | None) -> str | None:
        if not x:
            return x
        parts, done = [], 0
        for s in sorted(find_spans(x, threshold), key=lambda s: (s.start, -s.end)):
            if s.start >= done:
                parts += [x[done : s.start], f"[{s.kind.upper()}]"]
            done = max(done, s.end)
        return "".join(parts) + x[done:] if parts else x

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(text)
            yield b.set_column(at, b.schema.field(at), pa.array([clean(x) for x in b.column(at).to_pylist()], b.schema.field(at).type))

    return documents.mapInArrow(rewrite, documents.schema)


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pii_spans(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return d.select("doc_id", *counts, F.sha2(span_list(base).cast("binary"), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))
