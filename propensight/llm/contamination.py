"""Benchmark decontamination with a generalised suffix automaton.

The words of all test items form one automaton; a document's words run through it one by one, and the automaton tells the
longest match that ends at each word. Where it is at least ``window`` words long, the last ``window`` words are a window of
some item and are hit; an item of fewer words is hit where its whole text ends. Which items a window belongs to is stored
at the state where strings of that length begin.

Test items are taken in blocks of at most ``BLOCK_WORDS`` words (checked before an automaton is built), one pass over the documents
for each, so what the workers hold has a fixed size whatever the number of items. A pass streams: nothing is shuffled.

Null texts have no words. Items without words match nothing; equal ids count once; an item with null id hits words but is
in no list. Repeated rows are judged alike. Columns besides the text are kept; those named like a result are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from propensight.llm.common import ascii_lower, shielded, table, utf8
from propensight.session import materialize

WINDOW = 10
BLOCK_WORDS = 200_000
PASSES = 4  # passes between two cuts of the lineage
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_WORD = WORD.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")  # before A-Z are made lower case
# Bytes of words keep their value or become lower case, all others become blanks; bytes above 0x7F are in words.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Automaton:
    """States of the generalised suffix automaton of ``items``: pairs of id and words."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.codes: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends = []
        for name, words in items:
            last, path = 0, []
            for w in words:
                last = self._extend(last, self.codes.setdefault(w, len(self.codes)))
                path.append(last)
            ends.append((name, path))
        self._annotate(items, window)

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of q for the strings up to one longer than p."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:  # known from an item before
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _annotate(self, items, window: int) -> None:
        """Per state: the least match length that matters, the state of its last ``window`` words, short items that end there."""
        n = len(self.length)
        order = sorted(range(1, n), key=self.length.__getitem__)
        at_window = [0] * n
        for s in order:
            if self.length[s] >= window:
                up = self.link[s]
                at_window[s] = s if self.length[up] < window else at_window[up]
        self.at_window = at_window
        self.items: dict[int, set] = {}
        own: dict[int, dict[int, set]] = {}
        for name, words in items:
            state = 0
            for w in words:
                state = self.next[state][self.codes[w]]
                if at_window[state]:
                    self.items.setdefault(at_window[state], set()).add(name)
            if 0 < len(words) < window:
                own.setdefault(state, {}).setdefault(len(words), set()).add(name)
        self.short: dict[int, dict[int, set]] = {}
        none = 1 << 60
        self.least = [none] * n
        for s in order:
            mine = {**self.short.get(self.link[s], {}), **own.get(s, {})}
            if mine:
                self.short[s] = mine
            self.least[s] = min([window] * (self.length[s] >= window) + list(mine), default=none)

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set, int]:
        """Hit words as ranges without overlap (end exclusive), ids of the items found, and the longest match."""
        nexts, link, length, least, window = self.next, self.link, self.length, self.least, self.window
        root = nexts[0]
        ranges: list[list[int]] = []
        states, names, longest = set(), set(), 0
        state = size = 0
        for i, c in enumerate(map(self.codes.get, words)):
            if c is None:
                state = size = 0
                continue
            to = nexts[state].get(c)
            if to is None:
                state = link[state]
                while state > 0 and c not in nexts[state]:
                    state = link[state]
                if state <= 0:
                    state, size = root[c], 1
                else:
                    size = length[state] + 1
                    state = nexts[state][c]
            else:
                state = to
                size += 1
            if size >= least[state]:
                span = 0
                if size >= window:
                    span = window
                    states.add(self.at_window[state])
                for n, ids in self.short.get(state, {}).items():
                    if n <= size:
                        span = max(span, n)
                        names |= ids
                start, end = i + 1 - span, i + 1
                while ranges and start <= ranges[-1][1]:
                    start = min(start, ranges.pop()[0])
                ranges.append([start, end])
            if size > longest:
                longest = size
        return ranges, names.union(*(self.items[s] for s in states)), longest


def item_blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items with words, in blocks whose number of words is checked before they are fetched. Repeated rows, which no number of parts
    would separate, are dropped first."""
    rows = materialize(items.select(F.col("item_id").cast("string").alias("item_id"), utf8(F.col("text")).alias("text"))
                       .distinct().withColumn("n", F.size(F.regexp_extract_all(ascii_lower(F.col("text").cast("string")), F.lit(WORD), F.lit(0))))
                       .filter("n > 0").withColumn("h", F.xxhash64("item_id", "text")), "items")
    total, widest = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    parts = max(1, -(-total // block_words))
    while parts > 1 and rows.groupBy(F.pmod("h", F.lit(parts)).alias("b")).agg(F.sum("n").alias("n")).agg(
            F.max("n")).first()[0] > 2 * max(block_words, widest):
        parts *= 2
    for b in range(parts):
        yield [(r.item_id, words_of(bytes(r.text))) for r in rows.filter(F.pmod("h", F.lit(parts)) == b).orderBy("h", "item_id").collect()]


def union(ranges: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


MATCH_TYPES = {"n_words": pa.int64(), "ranges": pa.list_(pa.list_(pa.int64())), "items": pa.list_(pa.string()), "longest": pa.int64()}


def find_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` (with a column ``text``) and per row ``n_words``, ``ranges`` of hit words, ids of ``items``, the ``longest`` match."""
    spark = docs.sparkSession
    docs = docs.drop(*MATCH_TYPES)
    names = docs.columns
    state = docs.withColumn("text", F.col("text").cast("binary")).select(
        *names, F.lit(0).cast("long").alias("n_words"), F.array().cast("array<array<bigint>>").alias("ranges"),
        F.array().cast("array<string>").alias("items"), F.lit(0).cast("long").alias("longest"))
    for k, block in enumerate(item_blocks(items, block_words)):
        shared = spark.sparkContext.broadcast(Automaton(block, window))

        def run(batches, shared=shared):
            auto = shared.value
            for batch in batches:
                found: dict[str, list] = {c: [] for c in MATCH_TYPES}
                before = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("ranges", "items", "longest")]
                for text, *old in zip(batch.column(batch.schema.get_field_index("text")).to_pylist(), *before, strict=True):
                    words = words_of(text or b"")
                    ranges, ids, longest = auto.scan(words)
                    found["n_words"].append(len(words))
                    found["ranges"].append(union(old[0] + ranges) if old[0] else ranges)
                    found["items"].append(sorted({*old[1], *(x for x in ids if x is not None)}))
                    found["longest"].append(max(old[2], longest))
                columns = [pa.array(found[f.name], MATCH_TYPES[f.name]) if f.name in found else batch.column(j)
                           for j, f in enumerate(batch.schema)]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        state = state.mapInArrow(run, state.schema)
        if (k + 1) % PASSES == 0:
            state = materialize(state, "matches")
    return state.withColumn("text", F.col("text").cast("string"))


def without(text: str, ranges: list[list[int]]) -> str:
    """The text less the hit words and what lies between them."""
    places = [m.span() for m in re.finditer(ANY_WORD, text)]
    out, at = [], 0
    for start, end in ranges:
        out.append(text[at:places[start][0]])
        at = places[end - 1][1]
    return " ".join([*out, text[at:]])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = 0.5) -> DataFrame:
    """Drops documents with more than ``max_coverage`` of their words hit and cuts the hit words out of the others, again
    until nothing is hit (what is left may meet anew). ``n_chars``, if there, follows the text. Other columns stay."""
    rows, restored = shielded(docs, ("text", "n_chars"))
    names = rows.columns
    columns = [F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in names]
    found = materialize(find_matches(rows, items, window), "found")
    clean = found.filter("size(ranges) = 0").select(*names)
    while not found.filter("size(ranges) > 0").isEmpty():
        hit = found.filter(F.size("ranges") > 0).filter(
            F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0]) <= F.col("n_words") * max_coverage)

        def cut(batches):
            for batch in batches:
                text = batch.schema.get_field_index("text")
                cuts = [without(t, r) for t, r in zip(batch.column(text).to_pylist(),
                                                      batch.column(batch.schema.get_field_index("ranges")).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(cuts, pa.string()) if j == text else batch.column(j)
                                                  for j in range(batch.num_columns)], names=batch.schema.names)

        found = materialize(find_matches(hit.mapInArrow(cut, hit.schema).select(*columns), items, window), "found")
        clean = clean.unionByName(found.filter("size(ranges) = 0").select(*names))
    return restored(clean)


def op2_contamination(spark, sf_dir: str) -> DataFrame:
    found = find_matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = f"regexp_extract_all({_LOWER}, '{WORD}')"
SQL = {"op2_contamination": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_SPLIT}, []) AS w FROM documents),
i AS (SELECT DISTINCT item_id, {_SPLIT} AS w FROM benchmark WHERE text IS NOT NULL),
q AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[k:k + least(len(w), {WINDOW}) - 1], ' ') AS g
      FROM i, unnest(range(1, greatest(1, len(w) - {WINDOW - 1}) + 1)) AS r(k) WHERE len(w) > 0),
z AS (SELECT DISTINCT n FROM q),
p AS (SELECT rid, n, k, array_to_string(w[k:k + n - 1], ' ') AS g FROM z, d, unnest(range(1, len(w) - n + 2)) AS r(k)),
m AS (SELECT DISTINCT rid, k, p.n, item_id FROM p JOIN q ON p.g = q.g AND p.n = q.n),
h AS (SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS x FROM m) GROUP BY rid),
s AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS x FROM m GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(x, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN h USING (rid) LEFT JOIN s USING (rid)"""}
