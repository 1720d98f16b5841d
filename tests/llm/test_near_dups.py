import math
import random
import re

import numpy as np

from propensight.llm import near_dups as N, shingling
from propensight.llm.shingling import shingle_sets


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def corpus(seed, n=25, size=80):
    rnd = random.Random(seed)
    vocab = [f"W{k}é" for k in range(300)]
    rows, key = [], 0
    for _ in range(n):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(1, size))]
        for _ in range(rnd.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            base = copy if rnd.random() < 0.5 else base  # chains
            rows.append((key, rnd.choice([" ", "\n", " \t "]).join(copy)))
            key += 1
    rnd.shuffle(rows)
    return rows + [(9000, None), (9001, ""), (9002, " \n"), (9003, "one"), (9004, "ONE")]


def test_components_equal_brute_force(spark):
    rows = corpus(5)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, sketch string")
    want = brute(rows)
    got = {r.doc_id: r for r in N.link(df).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())
    assert any(i != c for i, (_, c) in want.items())


def test_all_pairs_round_alone_finds_the_same(spark):
    rows = corpus(8, 12)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in N.link(df, leader_rounds=0).collect()}
    assert got == {i: c for i, (_, c) in brute(rows).items()}


def test_edges_and_keep_one(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(5, text, "a", "s", 1), (3, text.upper(), "a", "s", 1), (None, text, "a", "s", 1), (7, "other words are here now", "a", None, 2), (7, "other words are here now", "a", None, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.component_id, r.kept) for r in N.link(df).collect()]
    assert sorted(got, key=str) == sorted([(5, 3, False), (3, 3, True), (None, None, True), (7, 7, True), (7, 7, True)], key=str)
    assert sorted((r.doc_id or 0) for r in N.keep_one(df).collect()) == [0, 3, 7]
    assert N.link(df.limit(0)).count() == 0


def test_shingle_sets_count_distinct_shingles():
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(["a", "bb", "É", "the"]) for _ in range(rnd.randint(0, 60))) for _ in range(80)] + ["x" * 5_000_000 + " y", ""]
    sets = shingle_sets([t.encode() for t in texts])
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert all((np.diff(s.astype(object)) > 0).all() for s in sets if len(s) > 1)


def test_long_lists_are_compared_in_blocks(spark, monkeypatch):
    rnd = random.Random(4)
    vocab = [f"v{k}" for k in range(500)]
    base = [rnd.choice(vocab) for _ in range(90)]
    rows = []
    for i in range(70):  # most pairs are just below the threshold
        copy = list(base)
        for _ in range(rnd.choice([1, 1, 2])):
            copy[rnd.randrange(90)] = rnd.choice(vocab)
        rows.append((i, " ".join(copy)))
    monkeypatch.setattr(N, "LARGE", 3)
    monkeypatch.setattr(N, "BLOCK", 16)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: c for i, (_, c) in brute(rows).items()}
    for rounds in (0, 2):
        assert {r.doc_id: r.component_id for r in N.link(df, leader_rounds=rounds).collect()} == want
    assert 1 < len(set(want.values())) < 70


def test_overlaps_count_common_values(monkeypatch):
    monkeypatch.setattr(N, "COLUMNS", 7)
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (0, 5, 30, 30, 50, 1)]
    assert (N.overlaps(sets, sets[2:]) == [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets]).all()


def test_sets_do_not_depend_on_slices(monkeypatch):
    texts = [b"", b"a b", b"  A b\tc d e f ", b"x" * 50 + b" " + b" ".join(b"w%d" % (i % 40) for i in range(300)), b"a b c d e f"] * 3
    whole = [s.tolist() for s in shingling.shingle_sets(texts)]
    monkeypatch.setattr(shingling, "SLICE", 40)
    assert [s.tolist() for s in shingling.shingle_sets(texts)] == whole
    assert whole[2] == whole[4] and whole[0] == []


def linked(rows, like):
    """Components of brute force at any similarity."""
    sets = [(i, shingles(t)) for i, t in rows]
    label = {i: i for i, _ in rows}
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= like * len(a | b):
                low, high = sorted((label[i], label[j]))
                label = {x: low if c == high else c for x, c in label.items()}
    return label


def pairs_of_similarity(lows, n=60):
    """Two texts of ``n`` distinct words for each number of words that the second has new at its end."""
    rows = []
    for k, new in enumerate(lows):
        base = [f"p{k}w{i}" for i in range(n)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:n - new] + [f"p{k}x{i}" for i in range(new)]))]
    return rows


def test_the_stage_links_at_its_own_similarity(spark):
    import corpus_pipeline as P

    rows = corpus(11) + [(20_000 + i, t) for i, t in pairs_of_similarity(range(3, 10), 64)]
    df = spark.createDataFrame([(i, t, "a", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    at_80, at_85 = linked(rows, 80), linked(rows, 85)
    assert {r.doc_id for r in P.one_of_each(spark, df, "").collect()} == {i for i, c in at_80.items() if i == c}
    assert {r.doc_id: r.component_id for r in N.link(df, 80).collect()} == at_80
    assert {r.doc_id: r.component_id for r in N.link(df).collect()} == at_85
    assert at_80 != at_85


def test_long_lists_at_a_lower_similarity(spark, monkeypatch):
    rnd = random.Random(6)
    base = [f"v{k}" for k in range(90)]
    rows = []
    for i in range(50):
        copy = list(base)
        for _ in range(rnd.choice([1, 2, 3])):
            copy[rnd.randrange(90)] = f"n{rnd.randrange(500)}"
        rows.append((i, " ".join(copy)))
    monkeypatch.setattr(N, "LARGE", 3)
    monkeypatch.setattr(N, "BLOCK", 16)
    got = N.link(spark.createDataFrame(rows, "doc_id long, text string"), 80, leader_rounds=0).collect()
    assert {r.doc_id: r.component_id for r in got} == linked(rows, 80) != linked(rows, 85)


def test_floor_follows_the_similarity():
    for like in (80, 85, 95):
        need = math.ceil(N.floor_of(like) * N.K)
        tail = lambda m: sum(math.comb(N.K, i) * (like / 100)**i * (1 - like / 100)**(N.K - i) for i in range(m))  # noqa: E731, B023
        assert tail(need) <= N.LOSS < tail(need + 1)


def test_members_meet_although_their_leader_has_another_size(spark):
    words_ = [f"w{i}" for i in range(49)]
    more = [f"a{i}" for i in range(15)]
    order = [r.id for r in spark.range(1, 12).selectExpr("id", "xxhash64(0, id) AS h").orderBy("h").collect()]
    rows = [(order[0], " ".join(words_ + more)), (order[1], " ".join(words_)), (order[2], " ".join([*words_, "c"]))]
    rows += [(i, " ".join([f"d{i}x{k}" for k in range(30)] + words_[-4:] + more)) for i in order[3:7]]
    got = N.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = linked(rows, 85)
    assert {r.doc_id: r.component_id for r in got} == want and want[order[1]] == want[order[2]]
