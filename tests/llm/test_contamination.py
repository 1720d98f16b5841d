import random

from pyspark.sql import functions as F

from propensight.llm import contamination as C


def brute(text, items, window):
    words = C.words_of((text or "").encode())
    hit, found = set(), set()
    for name, t in items:
        own = C.words_of((t or "").encode())
        n = min(window, len(own))
        grams = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i:i + n]) in grams:
                hit.update(range(i, i + n))
                found.add(name)
    return len(words), hit, found


def random_case(seed, n_docs=60):
    rnd = random.Random(seed)
    make = lambda n: " ".join(rnd.choice("ab cB dé 1".split()) + rnd.choice(["", "!", "\n", "--"]) for _ in range(n))
    items = [(i, make(rnd.choice([0, 1, 3, 4, 6, 9]))) for i in range(12)] + [(20, None), (3, "zz zz zz zz zz"), (None, "ab ab ab ab")]
    docs = [(i, make(rnd.randint(0, 40)), "x") for i in range(n_docs)] + [(100, None, "x"), (101, "", "x"), (7, "ab", "x")]
    docs += [(200 + i, f"q {t} q", "x") for i, t in items if t and i is not None]
    return docs, items


def test_windows_equal_brute_force_in_one_and_many_blocks(spark):
    docs, items = random_case(3)
    df = spark.createDataFrame(docs, "doc_id long, text string, items string")
    table = spark.createDataFrame(items, "item_id long, text string")
    for window, block in ((4, 1000), (4, 8), (2, 1000)):
        rows = C.find_matches(df, table, window, block).collect()
        assert len(rows) == len(docs)
        want = sorted((i, *[len(x) if not isinstance(x, int) else x for x in brute(t, items, window)[:2]],
                       sorted(str(x) for x in brute(t, items, window)[2] if x is not None)) for i, t, _ in docs)
        have = sorted((r.doc_id, r.n_words, sum(b - a for a, b in r.ranges), sorted(r["items"])) for r in rows)
        assert have == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.ranges for r in C.find_matches(docs, none).collect()] == [[]]
    assert C.find_matches(docs.limit(0), none).count() == 0


def test_decontaminate_leaves_no_window_and_clean_documents_alone(spark):
    item = "one two three four five six"
    docs = [(1, f"Start here, {item}. And it goes on for a while longer than that", 0, "k"), (2, "clean text, Nothing else!", 25, "k"),
            (3, item, 0, "k"), (4, "a b c one two three " + item + " four five six d e f g h i", 0, "k"), (5, None, None, "k")]
    df = spark.createDataFrame(docs, "doc_id long, text string, n_chars long, longest string")
    out = {r.doc_id: r for r in C.decontaminate(df, spark.createDataFrame([(9, item)], "item_id long, text string"), 6).collect()}
    assert set(out) == {1, 2, 4, 5} or set(out) == {1, 2, 5}
    assert out[2].text == "clean text, Nothing else!" and out[1].text.startswith("Start here, ") and out[1].n_chars == len(out[1].text)
    assert not any(brute(r.text, [(9, item)], 6)[1] for r in out.values())


def test_places_of_words_are_those_of_the_scan():
    for text in ("Ab cD, EF1é--Gh", "É ÀB x", "", "ALL CAPS HERE"):
        assert [m[0].lower() for m in C.re.finditer(C.ANY_WORD, text) if m[0].isascii()] == [
            w.decode() for w in C.words_of(text.encode()) if w.isascii()]
    assert C.without("Say: ONE Two three. End", [[1, 4]]) == "Say:  . End"


def test_longest_match_is_tracked(spark):
    got = C.find_matches(spark.createDataFrame([(1, "x a b c d y")], "doc_id long, text string"),
                         spark.createDataFrame([(1, "z a b c d w")], "item_id long, text string"), 5).select(F.col("longest")).first()
    assert got.longest == 4


def test_a_row_repeated_past_the_limit_counts_once(spark):
    rows = [(1, "a b c")] * 50 + [(None, "d e")] * 50 + [(2, "f g h"), (2, "f g h i"), (3, "a b c"), (4, None), (4, "")]
    items = spark.createDataFrame(rows, "item_id long, text string")
    blocks = list(C.item_blocks(items, 4))
    assert sorted((str(i), len(w)) for b in blocks for i, w in b) == [("1", 3), ("2", 3), ("2", 4), ("3", 3), ("None", 2)]
    assert all(sum(len(w) for _, w in b) <= 8 for b in blocks)
    docs = spark.createDataFrame([(1, "x a b c y")], "doc_id long, text string")
    assert C.find_matches(docs, items, 3, 4).first()["items"] == ["1", "3"]
