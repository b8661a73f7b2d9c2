"""Spans of personal data against a plain reading with Python's re, and against SQL."""

import hashlib
import re

from riskfeatures.llm import pii
from riskfeatures.llm.queries import op4_pii

TEXTS = [
    "a@b.c_d@e.f, x@y.z@q.w and no@host; mail: me.too@site.example.org.",
    "1.2.3.4.5.6.7.8 host 256.1.1.1 and 0255.000001.1.1 ip 99999999999.1.1.1",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 and 0000000000000",
    "+49 (30) 123-4567 call +1 2 and +123456789012345678 +1234567890",
    "IBAN DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432 or GB82WEST12345698765433",
    "ssn 123-45-6789, 123-45-6789 far away and then more words follow here up to 123-45-6788 social 000-12-3456",
    "é\U0001f600 x@y.zz é +49123456789, 4111111111111111",
    "", None, "a" * 30_000 + "@x", "1" * 30_000, "1 " * 20_000, "a.b@" * 5_000, "x@y.z " * 300, "+" * 9_000 + "1" * 9_000,
]


def brute(text):
    text, out = text or "", []
    for rank, kind in enumerate(pii.BASE):
        for m in re.finditer(pii.PLAIN[kind], text):
            d = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 12 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0,
                "phone": lambda: 9 <= len(d) <= 15,
            }[kind]
            if good():
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def frame(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)) + [(2, TEXTS[2])], "doc_id long, text string").selectExpr("*", "1 as pii")


def test_base_spans(spark):
    for r in pii.digests(pii.pii_spans(frame(spark))).collect():
        want = brute(TEXTS[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), TEXTS[r.doc_id][:80]
        assert {s for s in r.spans.split(",") if s} >= set(want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k in pii.BASE]


def test_more_spans(spark):
    spans = {r.doc_id: r.spans for r in pii.digests(pii.pii_spans(frame(spark))).collect()}
    assert spans[4] == "iban:5:32,iban:36:58"
    assert spans[5] == "ssn:4:15,ssn:17:28"


def test_masked(spark):
    out = {r.doc_id: r for r in pii.mask_pii(frame(spark)).collect()}
    assert out[6].text == "é\U0001f600 [EMAIL] é [PHONE], [CARD]" and out[6].pii == 1
    assert out[7].text == "" and out[8].text is None
    assert pii.mask_pii(frame(spark).where("doc_id < 0")).collect() == []


def test_sql_agrees(spark, agrees):
    agrees(op4_pii(spark, "/root/testdata/sf0.001"), pii.oracle())
    few = frame(spark).where("length(text) < 3000 or text is null").select("doc_id", "text")
    agrees(pii.digests(pii.pii_spans(few)), pii.oracle(), documents=few)


def test_no_python(spark):
    plan = op4_pii(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
