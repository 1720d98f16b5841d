import math

import numpy as np
import pytest

from harness.check import connect, difference
from propensight.llm import top_k as T

SCHEMA = "vec_id long, embedding array<double>, part int, level string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)


def brute(rows, k, every):
    whole = {(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if i is not None and v is not None
             and all(c is not None and math.isfinite(c) for c in v)}
    out = []
    for q in sorted({i for i, _ in whole if i % every == 0}):
        mine = min(v for i, v in whole if i == q)
        score = {}
        for i, v in whole:
            if i != q:
                score[i] = max(score.get(i, -1 << 70), sum(a * b for a, b in zip(mine, v, strict=False)))
        out += [(q, n + 1, i, score[i]) for n, i in enumerate(sorted(score, key=lambda i: (-score[i], i))[:k])]
    return out


def found(df):
    return [tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").orderBy("query_id", "rank").collect()]


@pytest.mark.parametrize("few", [4, 64])
def test_against_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(T, "FEW", few)
    rng = np.random.default_rng(few)
    x = rng.normal(size=(900, 12)) * rng.uniform(0, 0.4, size=12)
    x[rng.integers(0, 900, 300)] = x[7]  # ties: a third of all rows hold one vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert found(T.highest_products(frame(spark, rows), 5, 50, block=250, group=7)) == brute(rows, 5, 50)


def test_nulls_lengths_repeated_ids_and_wide_numbers(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -2.0]), (1, [0.5, 0.5]), (2, [nan, 1.0]), (3, [inf, 0.0]), (4, None), (5, [None, 1.0]), (None, [9.0, 9.0]),
            (6, [0.0, 0.0]), (7, [3.0]), (8, []), (9, [1.0, -1.0, 5.0]), (9, [2.0, 1.0]), (9, [2.0, 1.0]), (50, [1e8, -1e8]),
            (50, [-1.0, 0.001]), (100, [0.0, 0.0]), (150, []), (11, [1e8, 1e8])]
    assert found(T.highest_products(frame(spark, rows))) == brute(rows, 5, 50)
    assert T.highest_products(frame(spark, rows).limit(0)).count() == 0


def test_scores_beyond_64_bits_are_cut(spark):
    rows = [(0, [1e10, 1e10]), (1, [1e10, 1e10]), (2, [-1e10, -1e10]), (3, [1e300, 0.0])]
    got = found(T.highest_products(frame(spark, rows)))
    assert [r[2:] for r in got] == [(1, T.LONG), (3, T.LONG), (2, -T.LONG - 1)]


def test_stops_early_only_on_proof(monkeypatch):
    """Where a few vectors stand out the search ends before the last segment and keeps all that can be among the best."""
    import pyarrow as pa

    early = []
    rng = np.random.default_rng(3)
    x = np.floor(256 * np.abs(rng.normal(size=(2000, 8)) ** 5) / 50).astype(np.int64)
    block = pa.table({"block": pa.array([0] * 2000, pa.int32()), "vec_id": np.arange(2000), "v": pa.array(list(x))})
    postings = T.Postings(T.segments_of(block))
    taken = []

    class Counted(list):
        def __iter__(self):
            for i, members in enumerate(super().__iter__()):
                taken.append(i)
                yield members

    impact = np.maximum(np.abs(postings.low), np.abs(postings.high)) // (1 << T.SHIFT)
    assert (np.diff(impact) <= 0).all()
    postings.members = Counted(postings.members)
    for q in range(40):
        taken.clear()
        possible = postings.possible(x[q:q + 1], 5)[0]
        score = x @ x[q]
        assert set(np.lexsort((np.arange(2000), -score))[:6]) <= set(possible)
        assert len(set(taken)) == len(taken)
        early.append(len(taken) < len(postings.dim) and len(possible) < 200)
    assert sum(early) > 20


def test_given_table_and_twin(spark):
    sf = "/root/testdata/sf0.01"
    mine = T.op13_top_k(spark, sf).toPandas()
    assert difference(mine, connect(sf).sql(T.SQL["op13_top_k"]).df()) == ""
