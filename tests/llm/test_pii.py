"""PII spans against a plain Python reading of the rules."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from cases import odd_docs, odd_rows

from martforge.llm import pii
from pyspark.sql import functions as F

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def keep(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items()
            for m in re.finditer(p, text or "") if keep(k, m[0])]


CARD, IBAN = "4111 1111-1111 1111", "GB82 WEST 1234 5698 7654 32"
TEXTS = [
    None, "", "a@b.c_d@e.f", "x.y+z@mail-1.example.co.uk, @no a@b", "ééé 😀 joe@x.org 😀 10.0.0.255",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.4 1.2.3", f"card {CARD} and 4111111111111112",
    "4111111111111111 4111111111111111", "12 34-56  78", "+1 (555) 010-9999 call +12 345 +1.2",
    "+49 30 901820-", "+1234567890123456 +12345678", f"iban {IBAN}. {IBAN[:-1]}3",
    "ssn 123-45-6789 or social security: 219-09-9999", "plain 123-45-6789", "000-12-3456 ssn",
    "a" * 60_000 + "@", "1" * 60_000, "1 " * 40_000, "a.b@c.de " * 1200 + CARD, "@" * 5000,
    "a@" * 20_000 + "b.c", "1." * 20_000, "+1" + "(" * 50_000,
]


@pytest.fixture(scope="module")
def random_texts():
    rng = random.Random(8)
    parts = ["a@b.co", "@", ".", "-", " ", "+", "1", "22", "255.1.2.3", "4111111111111111", "é",
             "x_", "(", ")", "+1 555 010 99 99", "\n", "😀", "a%b", "9" * 14, "0"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(600)]


def test_base_spans(spark, random_texts):
    texts = TEXTS + random_texts
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.personal_data(df).collect()}
    for i, text in enumerate(texts):
        want, r = base_spans(text), rows[i]
        got = [s for s in r.spans.split(",") if s and s.split(":")[0] in BASE]
        assert got == want, text
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        kinds = Counter(s.split(":")[0] for s in want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds[k] for k in BASE]


def test_added_spans_and_scores(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = {TEXTS[r.doc_id]: r for r in pii.personal_data(df).collect()}
    r = rows[f"iban {IBAN}. {IBAN[:-1]}3"]
    assert r.spans == f"iban:5:{5 + len(IBAN)}"
    assert r.scores == "1.00"
    assert [s.split(":")[0] for s in rows[TEXTS[13]].spans.split(",")] == ["ssn", "ssn"]
    assert rows["plain 123-45-6789"].spans == "" and rows["000-12-3456 ssn"].spans == ""
    assert rows[TEXTS[6]].scores == "1.00"  # a context word raises the card's score


def test_context_reaches_over_other_matches(spark):
    some, far = "123-45-6789, 219-09-9999, 078-05-1120", "x" * 34
    texts = {
        f"ssn: {some}": (3, "0.60,0.60,0.60"), f"{some} (ssn)": (3, "0.60,0.60,0.60"),
        f"😀 ssn: 000-45-6789, {some}": (2, "0.60,0.60"),  # the third is too far
        f"ssn {far} 123-45-6789": (1, "0.60"), f"ssn {far}xx 123-45-6789": (0, ""),
        f"123-45-6789 {far}x ssn": (1, "0.60"), f"123-45-6789 {far}xxx ssn": (0, ""),
        "é" * 250 + f" ssn: {some} " + "é" * 250: (3, "0.60,0.60,0.60"),
        "ssn 123-45-6789 " * 1000: (1000, ",".join(["0.60"] * 1000))}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.personal_data(df).collect():
        text = list(texts)[r.doc_id]
        assert (r.spans.count("ssn:"), r.scores) == texts[text], text[:80]


def iban(country, account):
    """An account number of ``country`` with its check digits."""
    number = int("".join(str(int(c, 36)) for c in f"{account}{country}00"))
    return f"{country}{98 - number % 97:02d}{account}"


def spaced(account):
    return " ".join(account[i:i + 4] for i in range(0, len(account), 4))


def test_account_numbers_beside_other_words(spark):
    de, own, odd = "DE89370400440532013000", iban("MT", "MALT01100AB12MTLCAST001S0"[:27]), iban("ZZ", "9" * 14)
    assert iban("GB", IBAN[4:].replace(" ", "")) == IBAN.replace(" ", "")
    texts = {
        f"iban {IBAN} Please pay": [IBAN], f"{de} BIC COBADEFF": [de], f"{de} 2024-01-01": [de],
        f"{de} {IBAN}": [de, IBAN], f"{IBAN} {de}": [IBAN, de], f"{spaced(de)} {IBAN} 7": [spaced(de), IBAN],
        f"{spaced(de)} {spaced(de)} {spaced(de)}": [spaced(de)] * 3, f"{spaced(own)} A1": [spaced(own)],
        f"é😀 {IBAN}\n{de}": [IBAN, de], f"{odd} IBAN": [odd], f"{spaced(odd)} {odd}": [spaced(odd), odd],
        f"x{de} {de}1 {de}x": [], f"{IBAN[:-1]}3 AB": [], "AB12 " * 300 + de: [de],
        f"{de} " * 700: [de] * 700, "😀" * 255 + f" {IBAN} Z": [IBAN]}
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in pii.with_spans(df).collect():
        got = [r.text[s.start:s.end] for s in r["__spans"] if s.kind == "iban"]
        assert got == texts[r.text], r.text[:80]


def test_redaction(spark):
    text = f"é joe@x.org😀 +1 (555) 010-9999, {CARD} end"
    df = spark.createDataFrame([(text,), ("clean",), ("",)], "text string")
    out = pii.with_spans(df).select(pii.redacted(F.col("text"), F.col("__spans"))).collect()
    assert [r[0] for r in out] == ["é [email]😀 [phone], [card] end", "clean", ""]


def test_odd_documents(spark):
    got = Counter((r.doc_id, r.spans) for r in pii.personal_data(odd_docs(spark)).collect())
    assert got == Counter((r[0], ",".join(base_spans(r[1]))) for r in odd_rows())
    assert pii.personal_data(odd_docs(spark, [])).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = pii.personal_data(odd_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowEvalPython", "Arrow")


def plain_redacted(text, spans):
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_redaction_of_many_spans(spark):
    rng = random.Random(4)
    words = ["word ", "mail a.b@c.org, ", "+1 (555) 010-9999 ", "10.0.0.9 ", "é😀 ", "x" * 700 + " ", f"{CARD} ",
             "ssn: 123-45-6789 ", "\n"]
    texts = ["".join(rng.choices(words, k=n)) for n in (0, 1, 5, 300, 3000)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = df.select("text", pii.find_spans(F.col("text")).alias("s"), pii.redact(F.col("text")).alias("r")).collect()
    for r in rows:
        assert r.r == plain_redacted(r.text, [(s.start, s.end, s.kind) for s in r.s])
    assert max(len(r.s) for r in rows) > 3 * pii.CHUNK


def test_redaction_overlapping_spans(spark):
    rng = random.Random(5)
    for n in (1, 2, 600):
        spans = [(a, a + rng.randint(1, 90), rng.choice("xyz")) for a in (rng.randint(0, 4000) for _ in range(n))]
        text = "".join(rng.choices("abé😀 ", k=4100))
        row = spark.createDataFrame([(text, spans)], "t string, s array<struct<start:int,end:int,kind:string>>")
        assert row.select(pii.redacted(F.col("t"), F.col("s"))).first()[0] == plain_redacted(text, spans)


def test_time_grows_with_the_text(spark):
    part = "mail a.b@c.org, or 10.0.0.9 today and +1 (555) 010-9999 " * 400  # about 50 spans a KB

    def seconds(times):
        df = spark.createDataFrame([(part * times,)], "text string").select(pii.redact(F.col("text")).alias("r"))
        begun = time.perf_counter()
        assert df.first().r.count("[email]") == 400 * times
        return time.perf_counter() - begun

    seconds(40)
    small, large = seconds(40), seconds(160)
    assert large < 10 * small  # four times the text; a quadratic pass takes sixteen times as long
