import hashlib
import random

from hypothesis import given, settings, strategies as st

from propensight.llm import substrings as S
from propensight.llm.suffix_sort import common, deep_shallow


def brute(rows, width=100):
    first, out = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - width + 1):
            if first.setdefault(data[k:k + width], (i, k)) < (i, k):
                gone[k:k + width] = b"\1" * width
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(rnd.choice([5, 16, 18, 40, 120])) for _ in range(6)]
    rows = []
    for i in range(40):
        parts = [rnd.choice(passages) if rnd.random() < 0.4 else text(rnd.randint(0, 40)) for _ in range(rnd.randint(0, 5))]
        rows.append((i, "".join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1] + "x"), (102, None), (103, ""), (104, "ab" * 400), (105, "z" + "ab" * 300), (106, "x" * 99), (107, "x" * 99),
             (108, "q" * 100), (109, "q" * 101)]
    rnd.shuffle(rows)
    return rows


def got(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.dedup(df).collect()}


def test_equal_to_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, sha string").repartition(5)
        assert got(df) == brute(rows)


def test_hot_anchors_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", 1)
    rows = corpus(3)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)) == brute(rows)


def test_edges(spark):
    long = "a long text that comes twice " * 9
    rows = [(1, long), (1, long), (2, long), (None, long), (3, "other " + long)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((r.doc_id, r.n_removed) for r in S.dedup(df).collect()), key=str)
    n, own = len(long), brute([(1, long)])[1][1]
    third = brute([(1, long), (3, "other " + long)])[3][1]
    assert out == sorted([(1, own), (1, own), (2, n), (None, 0), (3, third)], key=str)
    assert S.dedup(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=60), max_size=40), st.text("ab", max_size=20))
def test_deep_shallow_sorts(strings, start):
    data = [(start + s).encode() for s in strings]
    order = deep_shallow(data, len(start))
    assert [data[i] for i in order] == sorted(data) and sorted(order) == list(range(len(data)))


def test_common_prefix():
    assert [common(a, b) for a, b in ((b"", b"a"), (b"ab", b"ab"), (b"abc", b"abd"), (b"\0a", b"\0\0"), (b"abc", b"ab"))] == [0, 2, 2, 1, 2]
