import re
from collections import Counter

import numpy as np
import pytest

from harness.check import connect, difference
from propensight.llm import phrases as P

SCHEMA = "doc_id long, lang string, text string, n long, word string, chunk int, phrase string"
PIECE, WORD = re.compile("[.,;:!?\x0a-\x0d]"), re.compile("[^ \t]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, lang, text, 1, "x", 2, "y") for i, (lang, text) in enumerate(rows)], SCHEMA)


def brute(rows, least, longest):
    f = Counter()
    n = Counter()
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in PIECE.split(text):
            w = WORD.findall(piece)
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang or "und", tuple(w[i:i + k])] += 1
    chosen = {x: a for x, a in f.items() if a >= least and len(x[1]) >= 2}
    out = set()
    for (lang, w), a in chosen.items():
        inside = [b for (other, v), b in chosen.items() if other == lang and len(v) > len(w)
                  and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))]
        if any(100 * b >= 80 * a for b in inside):
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.add((lang, len(w), " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def texts(seed, docs):
    rng = np.random.default_rng(seed)
    vocabulary = ["the", "of", "New", "york", "city", "hall", "a", "é", "日本", "b\x1cc", "x" * 40, "İ"]
    out = []
    for i in range(docs):
        w = rng.choice(vocabulary, int(rng.integers(0, 40)), p=[.2, .15, .1, .1, .1, .1, .05, .05, .05, .04, .03, .03])
        joins = rng.choice([" ", "  ", "\t", ". ", "\n", ", "], len(w) + 1, p=[.8, .05, .05, .04, .03, .03])
        out.append(([None, "en", "fr", "und"][i % 4 if i % 3 else 1], "".join(a + b for a, b in zip(w, joins, strict=False))))
    return out


@pytest.mark.parametrize("size", [200, 1 << 20])
def test_against_brute_force(spark, size):
    rows = texts(size, 120) + [("en", None), ("en", ""), (None, "..."), ("fr", "new york city hall " * 100), ("fr", "new york. city hall, " * 60)]
    got = found(P.collocations(frame(spark, rows).repartition(3), 6, 4, size))
    assert got == brute(rows, 6, 4) and {len(r[2].split(" ")) for r in got} == {2, 3, 4}


def test_nothing_frequent_and_empty_table(spark):
    rows = [("en", "one two three"), ("en", None)]
    assert P.collocations(frame(spark, rows)).count() == 0
    assert P.collocations(frame(spark, rows).limit(0)).count() == 0


def test_long_texts_are_cut_between_pieces():
    text = (b"Aa bb. " * 1000) + b"c" * 5000 + b" d, e"
    cut = P.parts(text, 100)
    assert P.END.join(cut) == text.translate(P.FOLDED) and max(map(len, cut)) > 5000 and len(cut) > 60


def test_bit_field_rules_out_no_frequent_group(spark):
    rows = [(i << 33 | i, i) for i in range(500)]
    field = P.bit_field(spark.createDataFrame(rows, "p long, q long"))
    p, q = np.array(rows).T
    at = P.places(p, q)
    assert ((field[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all() and np.unpackbits(field).sum() <= 500


def test_counts_beyond_64_bits_in_products(spark):
    big = 2 ** 62
    df = spark.createDataFrame([(big, [big, big - 1, big], [big + 5, big, big])], "a long, heads array<long>, tails array<long>")
    r = P.weakest_cut(df, 3).first()
    assert (r.score, r.l, r.r) == min((2_000_000 * big // (x + y), x, y) for x, y in ((big, big), (big - 1, big + 5)))


def test_given_table_and_twin(spark):
    sf = "/root/testdata/sf0.01"
    mine = P.op12_phrases(spark, sf).toPandas()
    assert len(mine) and difference(mine, connect(sf).sql(P.SQL["op12_phrases"]).df()) == ""
