import re

from pyspark.sql import functions as F

import corpus_pipeline as P
from propensight.llm import contamination, near_dups, pii
from propensight.llm.common import DOCUMENT_COLUMNS, table

SF = "/root/testdata/sf0.001"


def least_of_each(texts, like):
    """Brute force over all pairs: the least id of each group linked at ``like`` per cent."""
    def shingles(text):
        w = [x for x in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = {i: shingles(t) for i, t in texts.items()}
    of = {i: i for i in sets}
    by = {}
    for i, own in sets.items():
        for g in own:
            by.setdefault(g, []).append(i)
    common = {}
    for ids in by.values():
        for n, a in enumerate(ids):
            for b in ids[:n]:
                common[a, b] = common.get((a, b), 0) + 1

    def find(i):
        while of[i] != i:
            i = of[i]
        return i

    for (a, b), c in common.items():
        if 100 * c >= like * (len(sets[a]) + len(sets[b]) - c):
            x, y = find(a), find(b)
            of[max(x, y)] = min(x, y)
    return {i for i in sets if find(i) == i}


def test_stages_in_order(spark):
    assert len(P.STAGES) == 5
    docs = table(spark, SF, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    benchmark = table(spark, SF, "benchmark")
    frames = []
    for _, stage in P.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), None) if frames is None else stage(spark, docs, SF)
        docs = docs.cache()
        frames.append(docs)
    known, single, clean, private, mixed = frames
    for f in frames[:4]:
        assert f.columns == list(DOCUMENT_COLUMNS)
    assert all(any(c.isalpha() for c in r.text) for r in known.collect())
    assert known.count() == sum(r.text is not None and any(c.isalpha() for c in r.text) for r in before.values())
    kept = {r.doc_id for r in near_dups.link(known, P.LIKE).filter("kept").collect()}
    assert {r.doc_id for r in single.collect()} == kept == least_of_each({r.doc_id: r.text for r in known.collect()}, P.LIKE)
    assert contamination.find_matches(clean, benchmark).filter(F.size("ranges") > 0).isEmpty()
    hit = {r.doc_id for r in contamination.find_matches(single, benchmark).filter(F.size("ranges") > 0).collect()}
    same = {r.doc_id: r.text for r in clean.collect()}
    assert all(same[r.doc_id] == r.text for r in single.collect() if r.doc_id not in hit)
    assert pii.find_spans(private).filter(F.size(F.filter("pii_spans", lambda s: s["kind"].isin("email", "card", "phone", "ip"))) > 0).isEmpty()
    assert all(r.n_chars == len(r.text) for r in private.collect())
    ids = {r.doc_id for r in private.collect()}
    assert {r.doc_id for r in mixed.collect()} <= ids and mixed.count() > 0
    for f in frames:
        f.unpersist()


def test_stages_take_empty_tables(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_stages_keep_unlike_texts_under_one_id(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra int, near_dups_key string"
    words = "The quick brown fox jumps over the lazy dog while seventeen green parrots discuss the weather of a distant island".split()
    line = lambda k: " ".join(words[k:] + words[:k]) + f" and number {k} closes it"
    rows = [(1, line(1), "en", "a", None, 1, "x"), (1, line(5), "en", "a", 1, 1, "x"), (1, line(5), "en", "a", 1, 2, "x"), (2, line(9), None, "a", 1, 1, "x"),
            (2, line(5) + " x", "en", None, 1, 1, "x"), (None, line(1), "en", "a", 1, 1, "x"), (3, None, "en", "a", 1, 1, "x"), (3, "", "en", "a", 1, 1, "x"), (4, line(1), "en", "a", 1, 1, "x")]
    docs = spark.createDataFrame(rows, schema)
    got = sorted(((r.doc_id, r.text) for r in near_dups.keep_one(docs, 80).collect()), key=str)
    assert got == sorted([(1, line(1)), (1, line(5)), (2, line(9)), (None, line(1)), (3, None), (3, "")], key=str)
    one, two = (near_dups.link(docs, 80).filter(F.col("doc_id") == i).collect() for i in (1, 2))
    assert {r.component_id for r in one} == {1} and len(one) == 3 and {r.component_id for r in two} == {1, 2}
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert {line(1), line(9)} >= {r.text for r in docs.collect()} - {line(5), line(5) + " x"}
