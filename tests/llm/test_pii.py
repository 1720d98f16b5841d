import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from propensight.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    twice = [int(c) * 2 for c in d[-2::-2]]
    return (sum(map(int, d[-1::-2])) + sum(x // 10 + x % 10 for x in twice)) % 10 == 0


def fits(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": all(int(p) <= 255 for p in m.split(".")) if kind == "ip" else False,
            "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if fits(k, m[0])]


def found(spark, texts):
    df = pii.find_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    return {r.doc_id: r for r in df.select("doc_id", "pii_spans").collect()}


def described(spans, base=True):
    return [f"{s.kind}:{s.start}:{s.end}" for s in spans if not base or s.kind in pii.BASE]


def test_base_spans_equal_plain_regular_expressions(spark):
    rnd = random.Random(1)
    parts = ["a@b.c", "x.y@m-1.example.com", "_@", "@", ".", "..", "1.2.3.4", "256.1.1.1", "0255.9.9.9", "4539 1488 0343 6467", "4111-1111-1111-1111",
             "+1 (988) 555-2485", "+49..30..123456", "+", " ", "é", "𝒳", "-", "5555", "0", "%", "(", "\n", "z_q@r.s.t.u", "1234567812345670"]
    texts = [None, "", *("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14))) for _ in range(300))]
    rows = found(spark, texts)
    for i, t in enumerate(texts):
        assert described(rows[i].pii_spans) == brute(t), t


def test_added_kinds_need_checksum_or_context(spark):
    texts = ["pay to DE89 3704 0044 0532 0130 00 now", "pay to DE89 3704 0044 0532 0130 01 now", "my ssn is 123-45-6789", "part 123-45-6789"]
    rows = found(spark, texts)
    assert [described(rows[i].pii_spans, False) for i in range(4)] == [["iban:7:34"], [], ["ssn:10:21"], []]
    scores = found(spark, ["card 4111111111111111", "order 4111111111111111"])
    assert scores[0].pii_spans[0].score > scores[1].pii_spans[0].score


def test_mask_joins_overlaps_and_keeps_the_rest(spark):
    df = spark.createDataFrame([(1, "a é b@c.de, 4111111111111111 z +1 4111111111111 q", "x"), (2, None, "y"), (3, "none", "z")], "doc_id long, text string, pii_note string")
    rows = {r.doc_id: r for r in pii.mask(df).collect()}
    assert rows[1].text == "a é [EMAIL], [CARD] z [PHONE] q"
    assert rows[2].text is None and rows[3].text == "none" and rows[1].pii_note == "x"
    assert not any(brute(r.text) for r in rows.values())


def test_long_texts_and_many_matches_stay_linear(spark):
    start = time.time()
    many = "a@b.cd " * 3000
    rows = found(spark, ["a" * 400_000, "1" * 400_000, "a." * 200_000, "a@" + "b." * 200_000, many])
    assert time.time() - start < 60
    assert described(rows[4].pii_spans) == brute(many)


def test_empty_table_and_digest(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_spans(empty).count() == 0 and pii.mask(empty).count() == 0
    row = pii.find_spans(spark.createDataFrame([(1, "x@y.zz")], "doc_id long, text string")).select(
        F.sha2(pii.described(F.col("pii_spans")), 256).alias("h")).first()
    assert row.h == hashlib.sha256(b"email:0:6").hexdigest()
