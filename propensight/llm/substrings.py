"""Removal of repeated 100-byte strings by suffix sorting, deep-shallow, over the whole corpus.

A byte goes if a 100-byte string that covers it also starts earlier: in a document with a smaller id, or earlier in its own.

1. Texts that are equal as a whole: only the one with the least id takes part, the others go altogether (narrow table of digests).
2. One scan cuts each text into stretches of windows with a common anchor (see ``anchors``). A stretch is shuffled as its
   anchor's hash, a digest of its bytes and its place, not with its text. What repeats inside a batch is settled
   there, so text that repeats itself sends one row.
3. Stretches with equal anchor and digest: all but the first go. An anchor seen once has no repeat. The first ones of
   anchors with different digests are left over: copies that change near the anchor.
4. Their bytes are fetched and grouped by anchor. Suffixes to the right of the anchor and reversed prefixes to its left are
   sorted by deep-shallow sorting; neighbours' common prefixes tell for each offset of the window which
   windows are equal. All but the first go. Anchors with more than ``HOT`` different stretches (a line in very many documents)
   are not one group: their windows are dealt out one by one by a hash of their bytes and settled the same way.
5. Removed stretches meet the text again by id, and only texts that lose something are shuffled.

Null and empty texts have no bytes. Rows with null id stay as they are and remove nothing. Repeated rows are one document: a
text keeps what no earlier document has. Of different texts under one id only the one with the least digest is compared with
others, the rest stays as it is. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from propensight.llm.anchors import SPAN, WINDOW, anchors
from propensight.llm.common import table, utf8
from propensight.llm.shingling import mix, powers
from propensight.llm.suffix_sort import common, deep_shallow
from propensight.session import materialize

HOT = 5_000
GROUPED = 4_096  # rows that are sorted together, at the end of a group
BROADCAST_IDS = 2_000_000
_BASE = 0x9E6D62D06F6A9A9B
_BACK = pow(_BASE, -1, 1 << 64)


def stretch_digests(data: np.ndarray, place: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64 bits of the bytes of each stretch, its number of windows and the place of its anchor."""
    out = np.empty(len(start), np.uint64)
    step = 1 << 22
    first = 0
    while first < len(start):
        base = int(start[first])
        last = max(first + 1, int(np.searchsorted(start, base + step, "right")))
        stop = int((start[first:last] + size[first:last]).max()) + WINDOW - 1
        up, down = powers(_BASE, stop - base + 1), powers(_BACK, stop - base + 1)
        sums = np.zeros(stop - base + 1, np.uint64)
        np.cumsum((data[base:stop].astype(np.uint64) + np.uint64(1)) * up[:stop - base], out=sums[1:])
        a = start[first:last] - base
        shape = (size[first:last] * WINDOW + place[first:last] - start[first:last]).astype(np.uint64)
        out[first:last] = mix(mix((sums[a + size[first:last] + WINDOW - 1] - sums[a]) * down[a]) ^ shape)
        first = last
    return out


def spans_of(owner: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of spans, given in order of owner and start: first row of each, start, end."""
    if not len(start):
        return start, start, end
    reach = np.maximum.accumulate(end)
    new = np.r_[True, (start[1:] > reach[:-1]) | (owner[1:] != owner[:-1])]
    at = np.flatnonzero(new)
    return at, start[at], reach[np.r_[at[1:], len(start)] - 1]


STRETCH = "key bigint, digest bigint, doc_id bigint, start bigint, n int, off int"


def stretches(texts: DataFrame) -> DataFrame:
    """Rows of ``STRETCH`` from ``doc_id, text`` (bytes). Rows with ``off`` -1 are spans of ``n`` bytes that go for certain."""
    def run(batches):
        for batch in batches:
            ids = np.array(batch.column(0).to_pylist(), np.int64)
            raw = batch.column(1).to_pylist()
            order = np.argsort(ids, kind="stable")
            data = np.frombuffer(b"".join(raw[i] for i in order), np.uint8)
            limits = np.r_[0, np.cumsum([len(raw[i]) for i in order])].astype(np.int64)
            ids = ids[order]
            owner, key, place, start, size = anchors(data, limits)
            digest = stretch_digests(data, place, start, size)
            # Places in the batch are in order of id and start: the first of equal rows is the first of all.
            _, first = np.unique(np.stack([key, digest], 1).view("u8,u8").ravel(), return_index=True)
            gone = np.ones(len(key), bool)
            gone[first] = False
            kept = np.flatnonzero(~gone)
            lost = np.flatnonzero(gone)
            at, a, b = spans_of(owner[lost], start[lost], (start + size + WINDOW - 1)[lost])
            who = owner[lost][at]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.r_[key[kept], mix((ids[who] * 31 + a).astype(np.uint64))].view(np.int64)),
                pa.array(np.r_[digest[kept], np.zeros(len(a), np.uint64)].view(np.int64)),
                pa.array(np.r_[ids[owner[kept]], ids[who]]),
                pa.array(np.r_[start[kept] - limits[owner[kept]], a - limits[who]]),
                pa.array(np.r_[size[kept], b - a].astype(np.int32)),
                pa.array(np.r_[(place - start)[kept], np.full(len(a), -1)].astype(np.int32)),
            ], names=["key", "digest", "doc_id", "start", "n", "off"])

    return texts.mapInArrow(run, STRETCH)


def settled(rows: DataFrame) -> DataFrame:
    """Spans that go (``off`` -1) and the first stretches of anchors with several digests (``many``: how many)."""
    same = Window.partitionBy("key", "digest").orderBy("doc_id", "start")
    anchor = Window.partitionBy("key")
    marked = rows.withColumn("nth", F.row_number().over(same))
    marked = marked.withColumn("many", F.sum(F.when((F.col("nth") == 1) & (F.col("off") >= 0), 1).otherwise(0)).over(anchor))
    over = (F.col("off") < 0) | (F.col("nth") > 1)
    length = F.when(F.col("off") < 0, F.col("n")).otherwise(F.col("n") + WINDOW - 1)
    return marked.filter(over | (F.col("many") > 1)).select(
        "key", "doc_id", "start", F.when(over, length).otherwise(F.col("n")).alias("n"), F.when(over, -1).otherwise(F.col("off")).alias("off"),
        (F.col("many") > HOT).alias("hot"))


PIECE = "key bigint, doc_id bigint, start bigint, n int, off int, piece binary"


def pieces(wanted: DataFrame) -> DataFrame:
    """Bytes of the asked stretches; hot ones as single windows, dealt by their bytes, of equal ones in a batch the first.
    Rows with ``off`` -1 are spans that go."""
    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            seen: dict[bytes, tuple] = {}
            for doc, text, asked in zip(*(batch.column(j).to_pylist() for j in range(3)), strict=True):
                for q in asked:
                    key, start, n, off = q["key"], q["start"], q["n"], q["off"]
                    if not q["hot"]:
                        out.append((key, doc, start, n, off, text[start:start + n + WINDOW - 1]))
                        continue
                    for s in range(start, start + n):
                        window = text[s:s + WINDOW]
                        had = seen.get(window)
                        if had is None or (doc, s) < had:
                            seen[window] = (doc, s)
                            doc_gone, s_gone = had or (None, None)
                        else:
                            doc_gone, s_gone = doc, s
                        if doc_gone is not None:
                            out.append((key ^ doc_gone, doc_gone, s_gone, WINDOW, -1, b""))
            for window, (doc, s) in seen.items():
                key = int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "big", signed=True)
                out.append((key, doc, s, 1, 0, window))
            columns = list(zip(*out, strict=True)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=["key", "doc_id", "start", "n", "off", "piece"])

    return wanted.mapInArrow(run, PIECE)


def classes(group: np.ndarray, strings: list[bytes], shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings by group and content, and the common prefix of each with the one before (-1 where a group begins)."""
    order, prefix = [], []
    bounds = np.r_[0, np.flatnonzero(group[1:] != group[:-1]) + 1, len(group)]
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = [a + i for i in deep_shallow(strings[a:b], shared)]
        order += own
        prefix.append(-1)
        prefix += [common(strings[x], strings[y]) for x, y in zip(own, own[1:], strict=False)]
    return np.array(order), np.array(prefix)


def repeated(rows: list[tuple]) -> list[tuple]:
    """Spans that go, of whole groups of pieces in order of key, id and start."""
    group = np.array([r[0] for r in rows])
    size, off = np.array([r[3] for r in rows]), np.array([r[4] for r in rows])
    right, before = classes(group, [r[5][r[4]:] for r in rows], 0)
    left, before_left = classes(group, [r[5][:r[4]][::-1] for r in rows], 0)
    out = []
    gone = np.zeros((len(rows), SPAN), bool)
    for o in range(SPAN):  # windows that begin o bytes before the anchor
        has = np.flatnonzero((off >= o) & (off - o < size))
        if len(has) < 2:
            continue
        r = np.empty(len(rows), np.int64)
        r[right] = np.cumsum(before < WINDOW - o)
        v = np.empty(len(rows), np.int64)
        v[left] = np.cumsum(before_left < o)
        _, first = np.unique(r[has] << 32 | v[has], return_index=True)
        later = np.ones(len(has), bool)
        later[first] = False
        gone[has[later], o] = True
    for i in np.flatnonzero(gone.any(axis=1)).tolist():
        starts = rows[i][2] + rows[i][4] - np.flatnonzero(gone[i])[::-1]
        cut = np.flatnonzero(np.r_[True, np.diff(starts) > WINDOW])
        for a, b in zip(cut, np.r_[cut[1:], len(starts)], strict=True):
            out.append((rows[i][1], int(starts[a]), int(starts[b - 1] - starts[a]) + WINDOW))
    return out


def compared(found: DataFrame) -> DataFrame:
    """``doc_id, start, n``: spans that go, by suffix sorting within each key."""
    def run(batches):
        rows: list[tuple] = []

        def batch_of(spans):
            columns = list(zip(*spans, strict=True)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32())],
                                              names=["doc_id", "start", "n"])

        for batch in batches:
            new = list(zip(*(batch.column(j).to_pylist() for j in range(6)), strict=True))
            yield batch_of([(r[1], r[2], r[3]) for r in new if r[4] < 0])
            rows += [r for r in new if r[4] >= 0]
            if len(rows) >= GROUPED:
                end = len(rows)
                while end and rows[end - 1][0] == rows[-1][0]:
                    end -= 1
                if end:
                    yield batch_of(repeated(rows[:end]))
                    rows = rows[end:]
        if rows:
            yield batch_of(repeated(rows))

    return found.repartition("key").sortWithinPartitions("key", "doc_id", "start").mapInArrow(run, "doc_id bigint, start bigint, n int")


def only(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows with or without one of ``ids``, which are broadcast if there are few enough."""
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, ["doc_id", "sha"], how)


def dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs``."""
    whole = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8(F.col("text")).alias("text")).withColumn("sha", F.sha2("text", 256))
    rows = whole.select("doc_id", "sha", F.octet_length("text").cast("bigint").alias("n_bytes"))
    firsts = rows.groupBy("sha").agg(F.min("doc_id").alias("first"))
    chosen = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("sha").alias("chosen"), F.count("*").alias("rows"))
    narrow = materialize(rows.join(firsts, "sha").join(chosen, "doc_id", "left").select(
        "doc_id", "sha", "n_bytes", "rows", (F.col("doc_id") > F.col("first")).alias("copy"),
        ((F.col("n_bytes") >= WINDOW) & (F.col("doc_id") == F.col("first")) & (F.col("sha") == F.col("chosen"))).alias("takes_part")), "narrow")
    # Most texts take part: those that don't are the shorter list.
    others = materialize(narrow.filter("doc_id is not null and not takes_part").select("doc_id", "sha").distinct(), "others")
    texts = only(whole.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= WINDOW)), others, "left_anti")
    repeated = materialize(narrow.filter("takes_part and rows > 1").select("doc_id", "sha").distinct(), "repeated")
    if not repeated.isEmpty():
        texts = only(texts, repeated, "left_anti").unionByName(only(texts, repeated, "left_semi").dropDuplicates(["doc_id"]))
    state = materialize(settled(stretches(texts.select("doc_id", "text"))), "settled")

    asked = state.filter("off >= 0").groupBy("doc_id").agg(F.collect_list(F.struct("key", "start", "n", "off", "hot")).alias("asked"))
    asked = materialize(asked.join(narrow.filter("takes_part").select("doc_id", "sha").distinct(), "doc_id"), "asked")
    wanted = only(texts, asked.select("doc_id", "sha"), "left_semi").join(asked, ["doc_id", "sha"]).select("doc_id", "text", "asked")
    gone = materialize(state.filter("off < 0").select("doc_id", "start", "n").unionAll(compared(pieces(wanted))), "gone")

    spans = gone.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    spans = materialize(spans.join(narrow.filter("takes_part").select("doc_id", "sha").distinct(), "doc_id"), "spans")
    losing = only(texts, spans.select("doc_id", "sha"), "left_semi").join(spans, ["doc_id", "sha"]).select("doc_id", "sha", "text", "spans")

    def cut(batches):
        for batch in batches:
            removed, parts, kept = [], [], []
            for text, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                pairs = np.array(sorted((s["start"], s["start"] + s["n"]) for s in own))
                _, a, b = spans_of(np.zeros(len(pairs)), pairs[:, 0], pairs[:, 1])
                rest = hashlib.sha256()
                for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)], strict=True):
                    rest.update(text[x:y])
                removed.append(int((b - a).sum()))
                parts.append(len(a))
                kept.append(rest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(parts, pa.int64()),
                                              pa.array(kept, pa.string())], names=["doc_id", "sha", "r", "s", "k"])

    lost = losing.mapInArrow(cut, "doc_id bigint, sha string, r bigint, s bigint, k string")
    long_copy = F.col("copy") & (F.col("n_bytes") >= WINDOW)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return narrow.join(lost, ["doc_id", "sha"], "left").select(
        "doc_id", "n_bytes", F.when(long_copy, F.col("n_bytes")).otherwise(F.coalesce("r", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(long_copy, 1).otherwise(F.coalesce("s", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(long_copy, nothing).otherwise(F.coalesce("k", "sha")).alias("kept_sha256"))


def op6_substrings(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


SQL = {"op6_substrings": f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, k, substr(h, k * 2 + 1, {2 * WINDOW}) AS g FROM d, unnest(range(0, n - {WINDOW - 1})) AS r(k) WHERE n >= {WINDOW}),
l AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY g ORDER BY doc_id, k) AS x FROM w) WHERE x > 1),
s AS (SELECT doc_id, k, k > lag(k + {WINDOW}) OVER (PARTITION BY doc_id ORDER BY k) AS apart FROM l),
t AS (SELECT doc_id, k, sum(CASE WHEN apart IS NULL OR apart THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM s),
u AS (SELECT doc_id, run, min(k) AS a, max(k) + {WINDOW} AS b FROM t GROUP BY ALL),
v AS (SELECT doc_id, list(a ORDER BY a) AS a, list(b ORDER BY b) AS b, sum(b - a) AS r FROM u GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(r, 0)::BIGINT AS n_removed, coalesce(len(a), 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN a IS NULL THEN h ELSE array_to_string(list_transform(range(1, len(a) + 2), lambda i: substr(h,
           CASE WHEN i = 1 THEN 0 ELSE b[i - 1] END * 2 + 1,
           (CASE WHEN i > len(a) THEN n ELSE a[i] END - CASE WHEN i = 1 THEN 0 ELSE b[i - 1] END) * 2)), '') END)) AS kept_sha256
FROM d LEFT JOIN v USING (doc_id)"""}
