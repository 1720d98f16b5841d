"""Exact top-k search by inner product over an impact-ordered index, score at a time.

1. Components become integers, ``floor(256 * x)``. Vectors are dealt to blocks of about ``BLOCK`` by a hash. A block's index is
   written as posting segments: one row per (dimension, quantised impact ``value >> SHIFT``) with the members and the least and
   greatest value among them, dimensions and impacts in order. Every component is posted, zeros too.
2. Queries take the segments of a block by descending impact, ``TOGETHER`` at a time; a segment's members get the weight times the middle of
   its values. From the widths of the segments taken and the greatest values not taken follows how far an accumulator can be
   off, and from that which vectors can still be among the ``k`` best of the block: one whose upper bound is below the ``k``-th best lower
   bound cannot.
3. The search stops when for every query these are few, or at the end of the postings, and only these are scored
   exactly on the integer vectors. So a stop is always backed by a proof, and the result is exact.
4. The bests of all blocks are merged by a ranked limit that Spark applies before the shuffle.

Every block meets every group of ``QUERIES`` queries in its own task; no task depends on how often a vector or id occurs. Only
the number of rows comes to the driver, nothing is broadcast.

Vectors that are null or hold null or non-finite values take no part, nor rows with null id; zero vectors do. Of vectors of different length
the missing components count as 0. Equal rows count once; different vectors under one id are all candidates, and a
query lists an id once, with its highest score; the query of a repeated id is its least vector. Components beyond 64 bits are cut to
the largest long, so are scores. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from propensight.llm.common import table
from propensight.session import materialize

SCALE, SHIFT = 256, 3
BLOCK, QUERIES = 16_384, 512
TOGETHER, CHECKS, FEW = 64, 4, 64
LONG = 2 ** 63 - 1


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` (array of bigint) of the rows that take part, equal rows once."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x")).filter(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", odd))
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * SCALE).cast("bigint")).alias("v")).dropDuplicates()


def matrix(lists: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Integer vectors as rows, filled up with 0 to the longest."""
    flat = lists.combine_chunks()
    ends = np.concatenate([[0], np.cumsum(flat.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1])[None] < sizes[:, None]] = flat.flatten().to_numpy(zero_copy_only=False)
    return out


SEGMENTS = "block int, dim int, level bigint, low bigint, high bigint, members array<int>, ids array<bigint>, v array<array<bigint>>"


def segments_of(block: pa.Table) -> pa.Table:
    """Posting segments of a block in order of dimension and impact; the first row has the ids and vectors."""
    block = block.sort_by("vec_id")
    x = matrix(block["v"])
    number = block["block"][0].as_py()
    rows: dict[str, list] = {"dim": [-1], "level": [0], "low": [0], "high": [0], "members": [[]],
                             "ids": [block["vec_id"].to_pylist()], "v": [list(x)]}
    for d in range(x.shape[1]):
        order = x[:, d].argsort(kind="stable")
        value = x[order, d]
        cuts = np.flatnonzero(np.diff(value >> SHIFT)) + 1
        for members, own in zip(np.split(order, cuts), np.split(value, cuts), strict=True):
            for name, cell in (("dim", d), ("level", int(own[0] >> SHIFT)), ("low", int(own[0])), ("high", int(own[-1])),
                               ("members", np.sort(members).astype(np.int32)), ("ids", None), ("v", None)):
                rows[name].append(cell)
    kinds = {"dim": pa.int32(), "level": pa.int64(), "low": pa.int64(), "high": pa.int64(), "members": pa.list_(pa.int32()),
             "ids": pa.list_(pa.int64()), "v": pa.list_(pa.list_(pa.int64()))}
    return pa.table({"block": pa.array([number] * len(rows["dim"]), pa.int32())} | {k: pa.array(rows[k], t) for k, t in kinds.items()})


def index(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, int]:
    """The written index of ``vec_id, v`` and its number of blocks."""
    blocks = max(1, -(-rows.count() // block))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))
    return materialize(dealt.groupBy("block").applyInArrow(segments_of, SEGMENTS), "impacts"), blocks


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products as whole numbers, also where 64 bits do not hold the sums."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * max(abs(int(q.max(initial=0))), abs(int(q.min(initial=0))))
    if most * max(1, len(q)) < LONG:
        return x @ q
    return np.array([max(-LONG - 1, min(LONG, sum(int(a) * int(b) for a, b in zip(r, q, strict=True)))) for r in x], np.int64)


class Postings:
    """One block's index in memory, its segments by descending impact."""

    def __init__(self, segments: pa.Table):
        segments = segments.sort_by([("dim", "ascending"), ("level", "ascending")])
        own, rest = segments.slice(0, 1), segments.slice(1)
        self.ids = np.array(own["ids"][0].as_py(), np.int64)
        self.x = matrix(pa.chunked_array([own["v"].combine_chunks().flatten()]))
        level = rest["level"].to_numpy()
        order = np.argsort(-np.maximum(level, -1 - level), kind="stable")  # as far from zero on both sides
        self.dim, self.low, self.high = (rest[c].to_numpy()[order].astype(t) for c, t in (("dim", np.int64), ("low", float), ("high", float)))
        members = rest["members"].combine_chunks()
        sizes = members.value_lengths().to_numpy(zero_copy_only=False)
        own = np.split(members.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)[:-1]) if len(rest) else []
        self.members = [own[i] for i in order]
        self.sizes = sizes[order]
        self.repeated = len(self.ids) - len(np.unique(self.ids))

    def best(self, query_id: int, q: np.ndarray, possible: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the ``k`` best of ``possible`` but for the query's own."""
        possible = possible[self.ids[possible] != query_id]
        width = min(len(q), self.x.shape[1])
        score = exact(self.x[possible, :width], q[:width])
        order = np.lexsort((self.ids[possible], ~score))  # ~s falls as s rises, and holds for the least long too
        ids = self.ids[possible][order]
        _, first = np.unique(ids, return_index=True)
        first = np.sort(first)[:k]
        return ids[first], score[order][first]

    def possible(self, queries: np.ndarray, k: int) -> list[np.ndarray]:
        """For each of a few queries the vectors that can be among its ``k`` best, proven by bounds.

        An accumulator holds twice the score, as if every member of a segment taken had the middle of its least and greatest value and
        every other component were 0. Per dimension a vector is off by no more than the widest segment taken or twice the
        greatest value not taken, times the weight.
        """
        n, dims = self.x.shape
        needed = k + 1 + self.repeated  # the query itself and further vectors of an id do not count
        if n <= needed or not len(self.dim):
            return [np.arange(n)] * len(queries)
        weight = np.zeros((dims, len(queries)))
        width = min(dims, queries.shape[1])
        weight[:width] = queries[:, :width].T
        most = 2 * (np.abs(weight).sum(axis=0) * max(np.abs(self.low).max(), np.abs(self.high).max())).max()
        kind = np.float32 if most < 2 ** 24 else np.float64  # sums of whole numbers are exact below
        room = 0.0 if most < 2 ** 52 else 1e-12 * most * dims
        middle = weight.astype(kind)
        total = np.zeros((n, len(queries)), kind)
        taken, left = np.zeros(dims), np.zeros(dims)
        checks = {int(i) for i in np.searchsorted(np.cumsum(self.sizes), np.linspace(0, self.sizes.sum(), CHECKS + 1)[1:])}
        alive = [np.arange(n)] * len(queries)
        for s, members in enumerate(self.members):
            d = self.dim[s]
            total[members] += middle[d] * kind(self.low[s] + self.high[s])
            taken[d] = max(taken[d], self.high[s] - self.low[s])
            if s in checks or s + 1 == len(self.members):
                left[:] = 0
                np.maximum.at(left, self.dim[s + 1:], 2 * np.maximum(np.abs(self.low[s + 1:]), np.abs(self.high[s + 1:])))
                off = np.abs(weight).T @ np.maximum(taken, left)
                bound = np.partition(total, n - needed, axis=0)[n - needed] - 2 * (off + room)
                there = total >= bound
                if s + 1 == len(self.members) or there.sum(axis=0).max() <= max(FEW, n >> 5):
                    return [np.flatnonzero(own) for own in there.T]
        return alive


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def search(rows: DataFrame, queries: DataFrame, k: int, block: int = BLOCK, group: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each of ``queries`` (``vec_id, v``) the ``k`` best of ``rows`` but for rows of its id."""
    rows, asked = materialize(rows, "vectors"), materialize(queries, "queries")
    stored, blocks = index(rows, block)
    groups = max(1, -(-asked.count() // group))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = stored.withColumn("part", every(groups))
    wanted = asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")).withColumn("block", every(blocks))

    def best(own: pa.Table, ask: pa.Table) -> pa.Table:
        found: list[pa.Table] = []
        if own.num_rows and ask.num_rows:
            postings = Postings(own)
            asked_ids, asked_v = ask["vec_id"].to_pylist(), matrix(ask["v"])
            for i in range(0, len(asked_ids), TOGETHER):
                some = asked_v[i:i + TOGETHER]
                for q, v, possible in zip(asked_ids[i:i + TOGETHER], some, postings.possible(some, k), strict=True):
                    ids, score = postings.best(q, v, possible, k)
                    found.append(pa.table([pa.array(np.full(len(ids), q)), pa.array(ids), pa.array(score)], schema=FOUND))
        return pa.concat_tables(found) if found else FOUND.empty_table()

    keys = ["block", "part"]
    part = held.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(best, "query_id bigint, vec_id bigint, score bigint")
    once = part.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def highest_products(vectors: DataFrame, k: int = 5, every: int = 50, block: int = BLOCK, group: int = QUERIES) -> DataFrame:
    """Queries are the rows whose id is divisible by ``every``, against all other rows."""
    rows = integer_vectors(vectors)
    asked = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    return search(rows, asked, k, block, group)


def op13_top_k(spark, sf_dir: str) -> DataFrame:
    return highest_products(table(spark, sf_dir, "embeddings"))


SQL = {"op13_top_k": """
WITH rows AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
asked AS (SELECT vec_id AS query_id, min(v) AS q FROM rows WHERE vec_id % 50 = 0 GROUP BY vec_id),
scored AS (
  SELECT query_id, vec_id, max(CAST(coalesce(list_sum(list_transform(generate_series(1, least(len(q), len(v))),
           lambda i: CAST(q[i] AS HUGEINT) * v[i])), 0) AS BIGINT)) AS score
  FROM asked JOIN rows ON vec_id <> query_id GROUP BY query_id, vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5"""}
