import functools
import hashlib
from collections import Counter

import numpy as np
import pytest

from propensight.llm import alignment as A
from propensight.llm.common import table

SCHEMA = "doc_id long, text string, chunk long, a int, docs string"
ODD = ["", None, " ", "  ", "a", " a ", "a  b", "a b", "\x00", "\x1c x", "x \x1c", "a▁b", "▁", "<|endoftext|>", "a <s></s><unk> b <0x41>",
       "ﬁ x́", "é a ́b", " a  b", "a\r\n b\t c", "it's we 'll go", "日本語 テキスト 🙂🙃", "x" * 5000, "1234 5678  90", "a   b",
       "　全角 空白　", "<|endoftext|> <|endoftext|>", "İI ı", "a﻿b ﻿ c", "\U0001F468‍\U0001F469"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, 8, "x") for i, t in rows], SCHEMA)


@functools.cache
def loaded():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{A.FOLDER}/{A.A_FILE}")
    t.encode_special_tokens = True
    return t, SentencePieceProcessor(model_file=f"{A.FOLDER}/{A.B_FILE}")


def tokens(text):
    """Ids and bytes of both sides from the whole text in one go."""
    t, sp = loaded()
    symbols = A.byte_symbols()
    a = [(i, bytes(symbols[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in sp.encode(text):
        name = sp.id_to_piece(i)
        b.append((i, bytes([int(name[3:5], 16)]) if sp.is_byte(i) else name.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if text and b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def brute(rows):
    per, links = [], Counter()
    for doc, text in rows:
        a, b = tokens(text or "")
        a_end, b_end = ([(i, int(e)) for (i, _), e in zip(x, np.cumsum([len(s) for _, s in x]), strict=True)] for x in (a, b))
        last_a, last_b = ({e: i for i, e in x} for x in (a_end, b_end))
        both = sorted(last_a.keys() & last_b.keys())
        own = [(last_a[e], last_b[e]) for e in both]
        groups, i, j = [], 0, 0
        for e in both:
            first_i, first_j = i, j
            while i < len(a_end) and a_end[i][1] <= e:
                i += 1
            while j < len(b_end) and b_end[j][1] <= e:
                j += 1
            groups.append(",".join(str(x) for x, _ in a_end[first_i:i]) + "|" + ",".join(str(x) for x, _ in b_end[first_j:j]))
        links.update(own)
        per.append((doc, len(a), len(b), len(groups), own, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = {}
    for (_, j), n in links.items():
        most[j] = max(n, most.get(j, 0))
    return sorted(((doc, n_a, n_b, n_g, len(own), sum(links[x] == most[x[1]] for x in own), sum(links[x] for x in own), digest)
                   for doc, n_a, n_b, n_g, own, digest in per), key=str)


def found(chunks):
    out = A.link_counts(chunks, A.linked_pairs(chunks))
    return sorted((tuple(r) for r in out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)


@pytest.mark.parametrize("size", [50, 1 << 24])
def test_odd_texts_against_brute_force(spark, monkeypatch, size):
    rng = np.random.default_rng(0)
    rows = list(enumerate(ODD)) + [(None, "null id"), (3, "the id again"), (3, "the id again")]
    for i in range(40):
        rows.append((100 + i, " ".join(rng.choice([x for x in ODD if x and len(x) < 50], 6))))
    assert found(A.aligned(frame(spark, rows).repartition(2), size=size)) == brute(rows)


def test_given_texts_against_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 4000]
    some = docs.filter("text is null or length(text) < 4000")
    assert found(A.aligned(some)) == brute(rows)


def test_empty_table_and_only_empty_texts(spark):
    assert found(A.aligned(frame(spark, [(1, "x")]).limit(0))) == []
    assert found(A.aligned(frame(spark, [(1, None), (2, "")]))) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_windows_of_a_long_text_give_what_the_whole_gives(monkeypatch):
    text = " ".join(["One line of text, isn't it? 12345  two"] * 300) + " " + "y" * 3000
    pair = A.pair_of(A.files(A.FOLDER))
    results = []
    for size in (1 << 20, 500):
        doc = A.Document(1)
        for _, windows in A.slices(iter([(0, text)]), size):
            t, sound = pair.align(windows)
            texts, n_a, n_b, n_groups, links = pair.groups(t, len(windows))
            cuts = np.cumsum(n_groups)
            assert sound.all()
            for w in range(len(windows)):
                doc.add(texts[w], [n_a[w], n_b[w], n_groups[w]], links[:, cuts[w] - n_groups[w]:cuts[w]])
        results.append((doc.row(), np.concatenate(doc.links, axis=1).tolist()))
        assert len("".join(windows)) <= len(text)
    assert results[0] == results[1] and results[0][0][1] > 3000


def test_overlaps_are_all_pairs_that_share_bytes(spark, monkeypatch):
    monkeypatch.setattr(A, "SLICE", 40)
    rows = [(i, t) for i, t in enumerate(ODD) if t and len(t) < 200] + [(99, "unbelievable tokenization of counterrevolutionaries " * 4)]
    got = {tuple(r) for r in A.overlapping_tokens(frame(spark, rows)).collect()}
    want = set()
    for doc, text in rows:
        a, b = tokens(text)
        spans = []
        for side in (a, b):
            ends = np.cumsum([len(s) for _, s in side]).tolist()
            spans.append([(i, e - len(s), e) for (i, s), e in zip(side, ends, strict=True)])
        want |= {(doc, *x, *y, x[2] == y[2]) for x in spans[0] for y in spans[1] if x[1] < y[2] and y[1] < x[2]}
    assert got == want
