"""Language identification with error-correcting output codes.

Each language has a codeword. For each bit a binary classifier over byte trigrams (log odds of the languages whose bit
is 1 against the others) gives a margin; the decoder adds, over the bits, the logistic loss of the margin against the codeword,
weighted by how often the bit is right, and takes the language with the least loss. Up to ``EXHAUSTIVE`` languages the code
has every split of them, beyond that ``8 log2`` random columns of which the ones farthest apart are kept.

Trigram counts are sums over all labelled documents, so nothing is sampled there; the weights of the bits come from
at most about ``WEIGHT_ROWS`` documents per language, picked by a hash of the id. What reaches the driver is one
count for each language and trigram bucket.

``lang_pred`` is ``und`` with score 0 if the text is null or has no letter, or if nothing was learned. ``ambiguous`` is set where
the score, the softmax of the losses, is below ``AMBIGUOUS``. Rows with null id are neither held out nor learned from.
Repeated rows are learned as often as they occur. Other columns are kept, but for those named like a result of ``identify``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from propensight.llm.common import shielded, table

BUCKETS = 1 << 16
EXHAUSTIVE = 6
WEIGHT_ROWS = 1000
AMBIGUOUS = 0.6
SLICE = 1 << 16  # characters whose weights are in memory at once
# ASCII letters in lower case, bytes above 0x7F as they are, all others blank.
FOLD = np.array([b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256)], np.uint8)


def trigrams(texts: list[bytes]):
    """Slices of the buckets of all trigrams: buckets, the text each belongs to. Runs of blanks count as one."""
    joined = np.frombuffer(b"".join(b" " + t + b" " for t in texts), np.uint8)
    ends = np.cumsum([len(t) + 2 for t in texts])
    for start in range(0, len(joined), SLICE):
        part = FOLD[joined[start:start + SLICE + 2]].astype(np.uint32)
        if len(part) < 3:
            continue
        blank = part == 32
        good = ~(blank[:-2] & blank[1:-1] | blank[1:-1] & blank[2:])
        bucket = ((part[:-2] << 16 | part[1:-1] << 8 | part[2:]) * np.uint32(2654435761)) >> np.uint32(16)
        at = np.flatnonzero(good)
        owner = np.searchsorted(ends, start + at, "right")
        yield bucket[at], owner


def count_trigrams(batches):
    """Rows (language, bucket, number) of a partition."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        texts = batch.column(1).to_pylist()
        for lang in set(langs):
            total = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for bucket, _ in trigrams([t for t, x in zip(texts, langs, strict=True) if x == lang]):
                total += np.bincount(bucket, minlength=BUCKETS)
    for lang, total in sums.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                          pa.array(total[at])], names=["lang", "bucket", "n"])


def codewords(k: int) -> np.ndarray:
    """One row of +1 and -1 per language."""
    if k <= 1:
        return np.ones((k, 1))
    if k <= EXHAUSTIVE:  # every split into two sides once
        sides = [s for n in range(1, k) for s in combinations(range(k), n) if 0 in s]
        return np.array([[1.0 if i in s else -1.0 for s in sides] for i in range(k)])
    rng = np.random.default_rng(k)
    n = 8 * int(np.ceil(np.log2(k)))
    best, apart = None, -1
    for _ in range(64):
        code = rng.choice([-1.0, 1.0], (k, n))
        code[0, np.abs(code.sum(axis=0)) == k] *= -1  # no column without two sides
        distance = (n - code @ code.T) / 2 + n * np.eye(k)
        if distance.min() > apart:
            best, apart = code, distance.min()
    return best


class Model:
    """Languages, their codewords, the classifiers' weights by bucket and bit, and the weight of each bit."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.langs = sorted(counts)
        self.code = codewords(len(self.langs))
        share = np.array([(counts[x] + 0.5) / (counts[x].sum() + 0.5 * BUCKETS) for x in self.langs]).reshape(-1, BUCKETS)
        bits = []
        for column in self.code.T:
            one, other = column > 0, column < 0
            if one.any() and other.any():
                bits.append(np.log(share[one].mean(axis=0)) - np.log(share[other].mean(axis=0)))
            else:
                bits.append(np.zeros(BUCKETS))
        self.weights = np.array(bits, np.float32).reshape(-1, BUCKETS).T.copy()
        self.reliable = np.ones(self.weights.shape[1])

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """Log odds per bit, by the root of the number of trigrams."""
        out = np.zeros((len(texts), self.weights.shape[1]))
        n = np.zeros(len(texts))
        for bucket, owner in trigrams(texts):
            if len(bucket):
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                out[owner[first]] += np.add.reduceat(self.weights[bucket], first, axis=0, dtype=np.float64)
                n[owner[first]] += np.diff(np.r_[first, len(bucket)])
        return out / np.sqrt(np.maximum(n, 1))[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language with the least loss, and its softmax."""
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None]) @ self.reliable
        best = loss.argmin(axis=1)
        odds = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return best, 1 / odds.sum(axis=1)


def learn(labelled: DataFrame, weight_rows: int = WEIGHT_ROWS) -> Model:
    """From columns ``doc_id, lang, text``, none of them null."""
    rows = labelled.select("lang", F.col("text").cast("binary").alias("text"))
    # One row for each language and bucket: at most 65,536 per language.
    sums = rows.mapInArrow(count_trigrams, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = {}
    for lang, part in sums.groupby("lang"):
        counts[lang] = np.zeros(BUCKETS, np.int64)
        counts[lang][part["bucket"].to_numpy()] = part["n"].to_numpy()
    model = Model(counts)
    if len(model.langs) < 2:
        return model
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    few = labelled.join(F.broadcast(sizes), "lang").filter(  # one row per language
        F.pmod(F.xxhash64(F.lit("bits"), "doc_id"), F.lit(1_000_000)) < F.lit(1e6 * weight_rows) / F.col("n"))
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def right(batches):
        m = shared.value
        at = {x: i for i, x in enumerate(m.langs)}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            z = m.margins(batch.column(1).to_pylist())
            good = (z * m.code[[at.get(x, 0) for x in langs]] > 0).astype(float)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(good.tolist(), pa.list_(pa.float64()))],
                                             names=["lang", "good"])

    checked = few.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(right, "lang string, good array<double>")
    by_lang = checked.select("lang", F.posexplode("good").alias("bit", "good")).groupBy("lang", "bit").agg(F.avg("good").alias("p"))
    for row in by_lang.groupBy("bit").agg(F.avg("p").alias("p")).collect():
        model.reliable[row.bit] = min(1.0, max(0.05, 2 * row.p - 1))
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (with a column ``text``) and ``lang_pred, score, ambiguous`` of each whole text."""
    docs = docs.drop("lang_pred", "score", "ambiguous", "lettered")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ready = docs.select("*", F.when(F.regexp_like("text", F.lit(r"\p{L}")), F.col("text").cast("binary")).alias("lettered"))

    def run(batches):
        m = shared.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            lang, score = ["und"] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if t is not None] if m.langs else []
            if known:
                best, sure = m.decode(m.margins([texts[i] for i in known]))
                for i, b, s in zip(known, best, sure, strict=True):
                    lang[i], score[i] = m.langs[b], round(float(min(1.0, s)), 6)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array([s < AMBIGUOUS for s in score], pa.bool_())], names=[*batch.schema.names[:-1], "lang_pred", "score", "ambiguous"])

    schema = docs.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "ambiguous": F.lit(False)}).schema
    return ready.mapInArrow(run, schema)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn_split(docs: DataFrame) -> Model:
    """Learns from the documents that are not held out."""
    return learn(docs.select("doc_id", "lang", "text").filter(~held_out()).dropna())


def keep_known(docs: DataFrame) -> DataFrame:
    """Documents whose language can be told; those without letters go. Columns stay, ``lang`` is as it was."""
    rows, restored = shielded(docs, ("text",))
    return restored(identify(rows, learn_split(docs)).filter("lang_pred <> 'und'"))


def op3_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = identify(docs.select("doc_id", "text"), learn_split(docs))
    return told.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
