import zlib

import numpy as np

from propensight.llm import language as L


def test_held_out_accuracy(spark):
    from propensight.llm.common import table
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = {r.doc_id: r for r in L.op3_language(spark, "/root/testdata/sf0.01").collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert len(rows) == len(truth)
    out = [i for i in rows if rows[i].held_out]
    assert set(out) == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([rows[i].lang_pred == truth[i] for i in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_codewords_differ_and_split():
    for k in (2, 3, 4, 6, 7, 30):
        code = L.codewords(k)
        assert len({tuple(r) for r in code}) == k
        assert all(set(c) == {-1.0, 1.0} for c in code.T)


def test_edges(spark):
    rows = [(i, ("the cat sat on that mat " if i % 2 else "der hund und das haus ") * 3, "en" if i % 2 else "de", "s") for i in range(60)]
    rows += [(100, None, "en", "s"), (101, "", None, "s"), (102, "12 34 !!", "de", "s"), (None, "the cat", None, "s"), (103, "Жж", None, "s"), (5, "the mat", "en", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lettered string")
    told = L.identify(df.select("doc_id", "text"), L.learn_split(df)).collect()
    by = {}
    for r in told:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].lang_pred == "en" and by[2][0].lang_pred == "de" and len(by[5]) == 2
    assert [(by[i][0].lang_pred, by[i][0].score) for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert by[103][0].lang_pred in ("en", "de") and by[103][0].ambiguous
    kept = {r.doc_id for r in L.keep_known(df).collect()}
    assert not kept & {100, 101, 102} and {1, 2, None, 103} <= kept


def test_without_labels_and_without_rows(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in L.identify(df.select("doc_id", "text"), L.learn_split(df)).collect()] == [("und", 0.0)]
    assert L.identify(df.limit(0).select("doc_id", "text"), L.learn_split(df)).count() == 0
    one = spark.createDataFrame([(i, "abc", "xx") for i in range(6)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in L.identify(one.select("doc_id", "text"), L.learn_split(one)).collect()} == {"xx"}
