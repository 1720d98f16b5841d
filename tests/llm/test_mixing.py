import hashlib
import math

from propensight.llm import mixing


def inverse(u, mean):
    p = c = math.exp(-mean)
    k = 0
    while c <= u:
        k += 1
        p *= mean / k
        c += p
    return k


def drawn(doc_id, text, rate, seed=17):
    ident = str(doc_id) if doc_id is not None else hashlib.md5((text or "").encode()).hexdigest()
    parts = max(1, math.ceil(rate / mixing.PART))
    return sum(inverse(int(hashlib.md5(f"{seed}|{ident}|{j}".encode()).hexdigest()[:13], 16) / 2 ** 52, rate / parts) for j in range(1, parts + 1))


def test_copies_follow_the_inverted_distribution(spark):
    rows = [(i, "x" * (5 + i % 7), "big" if i % 3 else "small", "n") for i in range(600)] + [(None, "null id", "small", "n"), (900, None, None, "n"), (901, "lone", None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copy string")
    rates = {r.mix_source: r.rate for r in mixing.target_rates(df, budget=3.0).collect()}
    size = {}
    for _, t, s, _ in rows:
        size[s] = size.get(s, 0) + len(t or "")
    total, wish = sum(size.values()), sum(math.sqrt(x) for x in size.values())
    for s, x in size.items():
        assert abs(rates[s] - 3 * total * math.sqrt(x) / wish / x) < 1e-8
    out = mixing.poisson_mix(df, budget=3.0).collect()
    want = {(i, t): drawn(i, t, rates[s]) for i, t, s, _ in rows}
    have = {}
    for r in out:
        have.setdefault((r.doc_id, r.text), []).append(r.copy)
    assert {k: sorted(v) for k, v in have.items()} == {k: list(range(1, n + 1)) for k, n in want.items() if n}
    keys = [r.shuffle_key for r in out]
    assert keys == sorted(keys) and [r.doc_id for r in out] != sorted((r.doc_id for r in out), key=lambda x: (x is None, x))


def test_weights_large_rates_and_empty_table(spark):
    df = spark.createDataFrame([(i, "abcd", "a" if i < 4 else "b") for i in range(404)], "doc_id long, text string, source string")
    out = mixing.poisson_mix(df, weights={"a": 1.0, "b": 0.0})
    per = [r["count"] for r in out.groupBy("doc_id").count().collect()]
    assert len(per) == 4 and all(50 < n < 160 for n in per)  # mean 101
    assert mixing.poisson_mix(df.limit(0)).count() == 0


def test_texts_without_characters_have_rate_one(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, None, "a")], "doc_id long, text string, source string")
    assert [r.rate for r in mixing.target_rates(df).collect()] == [1.0]
    mixing.poisson_mix(df).collect()
