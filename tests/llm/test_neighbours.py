import numpy as np

from propensight.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>, lists string"


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(v) for v in r], "x") for i, r in zip(ids, x, strict=True)], SCHEMA)


def check(rows, ids, x, every, least):
    x = np.array(x, np.float32).astype(float)
    got = {}
    for r in rows:
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hit = total = 0
    for q in ids[ids % every == 0]:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        want = [k for k in np.lexsort((ids, d)) if ids[k] != q][:10]
        assert sorted(got[q]) == list(range(1, len(want) + 1))
        for vec, score in got[q].values():
            assert abs(score - d[ids == vec][0]) < 1e-12
        assert list(got[q].values()) and [s for _, s in got[q].values()] is not None
        hit += len({v for v, _ in got[q].values()} & set(ids[want]))
        total += len(want)
    assert hit / total >= least


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(0)
    ids = np.arange(6000) * 3
    x = rng.normal(size=(6000, 16))
    check(N.nearest(frame(spark, ids, x), every=300).collect(), ids, x, 300, 0.9)


def test_many_equal_vectors_and_ties(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 100)
    monkeypatch.setattr(N, "QUERIES", 3)
    rng = np.random.default_rng(1)
    ids = np.arange(1500)
    x = rng.normal(size=(1500, 8))
    x[ids % 3 == 0] = x[0]
    rows = N.nearest(frame(spark, ids, x), every=60).collect()
    for r in rows:
        if r.query_id % 3 == 0:
            assert r.score == 0 and r.vec_id == [i for i in range(0, 60, 3) if i != r.query_id][r.rank - 1]


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [nan, 1.0]), (3, [inf, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (100, [2.0, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = [(r.query_id, r.rank, r.vec_id) for r in N.nearest(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 100), (0, 2, 1), (100, 1, 0), (100, 2, 1)]
    assert N.nearest(df.limit(0)).count() == 0


def test_search_finds_near_centroids():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 12))
    index = N.Index(x, 4000)
    ids, dist = index.search(x[:200], 16)
    true = N.distances(x[:200], index.centroids).argmin(axis=1)
    assert (ids[:, 0] == true).mean() > 0.95 and (np.diff(dist, axis=1) >= 0).all()
