"""Personal data against plain Python: the patterns as stated, no possessive runs, spans compared pair by pair."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from annexport.llm import pii, queries

SF = "/root/testdata/sf0.001"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                or kind == "card" and 14 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 10 <= len(digits) <= 15
            ):
                yield m.start(), pii.KINDS.index(kind), m.end(), kind


def further_spans(text):
    before = 0
    for m in re.finditer(pii.FURTHER, text):
        gap, value = text[before : m.start()][-pii.NEAR :].lower(), m[0]
        before = m.end()
        touching = text[max(0, m.start() - 1) : m.start()] + text[m.end() : m.end() + 1]
        # The match before ends where this gap begins; a character of it does not touch.
        if m.start() and not gap:
            touching = text[m.end() : m.end() + 1]
        after = re.search(pii.FURTHER, text[m.end() :])
        if after and after.start() == 0:
            touching = gap[-1:]
        if any(c.isalpha() or c in "0123456789" for c in touching):
            continue
        digits = re.sub("[^0-9]", "", value)
        near = lambda kind: re.search(rf"(?:^|[^\W\d_]{{0}}(?<![^\W\d_]))(?:{pii.CONTEXT[kind]})(?![^\W\d_])", gap)
        if re.fullmatch(pii.IBAN, value):
            plain = value.replace(" ", "")
            if int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                yield m.start(), 4, m.end(), "iban"
        elif re.fullmatch(pii.SSN, value):
            a, b, c = value.split("-")
            if a not in ("000", "666") and a[0] != "9" and b != "00" and c != "0000" and near("ssn"):
                yield m.start(), 5, m.end(), "ssn"
        elif re.fullmatch(pii.IPV6, value):
            yield m.start(), 1, m.end(), "ip"
        elif len(digits) == 13 and luhn(digits):
            if near("card"):
                yield m.start(), 2, m.end(), "card"
        elif 8 <= len(digits) <= 12 and near("phone"):
            yield m.start(), 3, m.end(), "phone"


def brute(text):
    base = sorted(base_spans(text or ""))
    more = [
        s for s in further_spans(text or "")
        if s[3] == "iban" or not any(b[0] < s[2] and s[0] < b[2] for b in base)
    ]
    return base, sorted(base + more)


def digest(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


PIECES = [
    "a@b.c_d@e.f", "x@y", "Ann.Lee+1%x@mail-7.example.com.", "1.2.3.4.5.6.7.8", "256.1.1.1", "010.001.000.0255", "1.2.3",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "49927398716", "4222222222222", "visa 4222222222222", "+1 (017) 555-7713",
    "+1", "+49 (0) 30.901820-", "+(1", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "DE89 3704 0044 0532 0130 01",
    "DE89370400440532013000x", "Tel. 030 901820 12", "phone: (030) 90 18 20", "ssn 123-45-6789", "123-45-6789", "ssn 666-45-6789",
    "2001:db8:0:0:0:0:2:1", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "é😀", "\n", " ", "und.", "0", "+", "@", ".", "-", "mobil ",
    "tel 12 34 56 78 +1 (017) 555-7713", "card 1234567812345670", "héllo", "fax 555-0199 555 01",
]


def texts():
    rng = random.Random(5)
    out = [None, "", " \n\t", "x" * 5000, "1" * 5000, "a@" * 3000, "+1" + "(" * 4000, "0." * 3000, "ab1@c.d " * 400]
    out += PIECES
    for _ in range(1500):
        out.append("".join(rng.choice(PIECES) + rng.choice(["", " ", " ", ", "]) for _ in range(rng.randint(1, 9))))
    for _ in range(300):
        out.append("".join(rng.choice("12@.+- ()aZ:é😀") for _ in range(rng.randint(1, 60))))
    return out


def test_spans_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = pii.personal_data(docs).select(
        "doc_id", pii.listed(F.filter("pii", lambda s: s["base"])).alias("base"), pii.listed(F.col("pii")).alias("spans")
    ).collect()
    assert len(found) == len(rows)
    for r in found:
        base, spans = brute(rows[r.doc_id][1])
        assert (r.base, r.spans) == (digest(base), digest(spans)), rows[r.doc_id][1]


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op13_pii"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(docs) and any(r.spans for r in rows)
    for r in rows:
        base, spans = brute(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in base) for k in pii.BASE]
        assert r.base_sha256 == hashlib.sha256(digest(base).encode()).hexdigest()
        assert r.spans == digest(spans)


@pytest.mark.parametrize("text,spans", [
    ("IBAN: DE89 3704 0044 0532 0130 00.", "iban:6:33"),
    ("DE89 3704 0044 0532 0130 01", ""),
    ("My phone is 030 901820 12", "phone:12:25"),
    ("Order 030 901820 12", ""),
    ("his SSN: 123-45-6789", "ssn:9:20"),
    ("range 123-45-6789", ""),
    ("credit card 4222222222222 here", "card:12:25"),
    ("item 4222222222222 here", ""),
    ("😀 a@b.co", "email:2:8"),
])
def test_further_spans(spark, text, spans):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.personal_data(docs).select(pii.listed(F.col("pii")).alias("s")).first().s == spans


def test_very_many_matches(spark):
    """A text of 40,000 matches of two kinds and as many further spans."""
    text = "a@b.co tel 030 901820 12 " * 40_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = pii.personal_data(docs).select(F.size("pii").alias("n"), F.element_at("pii", -1)["end"].alias("e")).first()
    assert (row.n, row.e) == (80_000, len(text) - 1)


def test_odd_tables(spark):
    """NULLs, repeated rows, clashing names in any column, an empty table."""
    kind = "doc_id long, text string, pii int, _pii_text string, _pii_base int, start int, `_PII_at_ip` string"
    rows = [(1, "a@b.co", 5, "q", 1, 2, "r"), (1, "a@b.co", 5, "q", 1, 2, "r"), (None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, kind)
    found = pii.personal_data(docs).select("doc_id", "_pii_text", "_pii_base", "start", "_PII_at_ip", F.size("pii").alias("n"))
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "q", 1, 2, "r", 1), (1, "q", 1, 2, "r", 1), (None, None, None, None, None, 0)]
    assert pii.personal_data(docs.limit(0)).count() == 0


def test_native(spark):
    plan = pii.personal_data(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
