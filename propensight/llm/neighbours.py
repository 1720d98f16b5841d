"""Nearest neighbours by balanced posting lists.

1. Fit on a sample of about ``SAMPLE`` vectors (by a hash of the id): halving along the widest direction at the median gives
   clusters of equal size, their means are the centroids (one per ``LIST`` vectors, at most ``CENTROIDS``, so every worker can hold them).
2. Centroids form a graph of near neighbours with a few far links; a best-first search over it, for a whole batch of vectors at
   once, finds the centroids near a vector.
3. Every vector goes to the list of its nearest centroid, vectors near a boundary also to further ones (within ``CLOSE`` of the least
   distance, at most ``COPIES``, skipping a centroid that lies nearer to one already chosen than to the vector).
4. A query searches the lists whose centroid is within ``1 + ratio`` of the nearest one's distance. The ratio is fitted on the sample
   so that ``RECALL`` of the true neighbours are in those lists; in the whole, neighbours are nearer than in the sample.
5. Short lists are bundled, long ones split, into blocks of about ``BLOCK`` vectors and ``QUERIES`` queries, so that a list of many
   equal vectors is no single task; each block gives its best for each query, computed in double precision on the original vectors.

Vectors that are null, zero, or hold null or non-finite values take no part, nor rows with null id or of another length than
most. Of repeated ids each row is a candidate; a query's result lists an id once, with its least distance. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from propensight.llm.common import table
from propensight.session import materialize

SAMPLE, CENTROIDS, LIST = 20_000, 4_096, 128
DEGREE, FAR, ENTRIES = 16, 4, 32
CLOSE, COPIES = 0.02, 4
RECALL, PROBES = 0.97, 256
BLOCK, QUERIES = 4_096, 512
ROWS = 1_000


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T))


def balanced(points: np.ndarray, n: int) -> np.ndarray:
    """Means of ``n`` parts of nearly equal size."""
    parts, out = [(points, n)], []
    while parts:
        own, k = parts.pop()
        if k <= 1 or len(own) < 2:
            out.append(own.mean(axis=0))
            continue
        off = own - own.mean(axis=0)
        axis = off[(off * off).sum(1).argmax()]
        for _ in range(3):  # towards the widest direction
            axis = off.T @ (off @ axis)
            size = np.sqrt((axis * axis).sum())
            if size == 0:
                break
            axis = axis / size
        order = (off @ axis).argsort(kind="stable")
        cut = max(1, min(len(own) - 1, len(own) * (k // 2) // k))
        parts += [(own[order[:cut]], k // 2), (own[order[cut:]], k - k // 2)]
    return np.array(out)


class Index:
    """Centroids, their graph, and the distance ratio of a search."""

    def __init__(self, sample: np.ndarray, n: int):
        points = np.unique(sample, axis=0)
        self.centroids = balanced(points, max(1, min(CENTROIDS, n // LIST, len(points) // 8 or 1)))
        k = len(self.centroids)
        between = distances(self.centroids, self.centroids)
        near = between.argsort(axis=1, kind="stable")[:, 1:DEGREE + 1]
        far = np.random.default_rng(0).integers(0, k, (k, FAR))
        self.links = np.concatenate([near, far], axis=1)
        self.entries = np.linspace(0, k - 1, min(k, ENTRIES)).astype(int)
        self.ratio = self._fitted(points)

    def _fitted(self, points: np.ndarray) -> float:
        if len(points) < 2:
            return 1.0
        ask = points[np.linspace(0, len(points) - 1, min(len(points), PROBES)).astype(int)]
        true = distances(ask, points).argsort(axis=1, kind="stable")[:, 1:11]
        lists = self.lists(points)
        d = distances(ask, self.centroids)
        near = np.maximum(d.min(axis=1), 1e-12)
        ratios = [min(d[i, c] for c in lists[t]) / near[i] - 1 for i in range(len(ask)) for t in true[i]]
        return float(np.quantile(ratios, RECALL))

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first over the graph with a list of ``width`` candidates for each row: their ids and distances, nearest first.
        ``ROWS`` rows at a time, which bounds the memory."""
        parts = [self._search(x[i:i + ROWS], width) for i in range(0, len(x), ROWS)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        rows, k = len(x), len(self.centroids)
        width = min(width, k)
        seen = np.zeros((rows, k), bool)
        seen[:, self.entries] = True
        ids = np.broadcast_to(self.entries, (rows, len(self.entries))).copy()
        dist = distances(x, self.centroids[self.entries])
        done = np.zeros(ids.shape, bool)
        while True:
            order = dist.argsort(axis=1, kind="stable")[:, :width]
            ids, dist, done = (np.take_along_axis(v, order, 1) for v in (ids, dist, done))
            open_ = ~done & np.isfinite(dist)
            live = np.flatnonzero(open_.any(axis=1))
            if not len(live):
                fill = min(width, k) - ids.shape[1]  # so that all parts are of one width
                return np.pad(ids, ((0, 0), (0, fill))), np.pad(dist, ((0, 0), (0, fill)), constant_values=np.inf)
            nxt = open_[live].argmax(axis=1)
            done[live, nxt] = True
            to = self.links[ids[live, nxt]]
            known = seen[live[:, None], to]
            seen[live[:, None], to] = True
            d = np.sqrt(((x[live, None, :] - self.centroids[to]) ** 2).sum(-1))
            d[known] = np.inf
            # A link that is listed twice counts once.
            ranked = to.argsort(axis=1, kind="stable")
            twice = np.zeros(to.shape, bool)
            ordered = np.take_along_axis(to, ranked, 1)
            np.put_along_axis(twice, ranked, np.c_[np.zeros(len(to), bool), ordered[:, 1:] == ordered[:, :-1]], 1)
            d[twice] = np.inf
            more_ids, more = np.zeros((rows, to.shape[1]), int), np.full((rows, to.shape[1]), np.inf)
            more_ids[live], more[live] = to, d
            ids, dist = np.c_[ids, more_ids], np.c_[dist, more]
            done = np.c_[done, np.zeros(more.shape, bool)]

    def lists(self, x: np.ndarray) -> list[list[int]]:
        """Lists of each vector."""
        ids, dist = self.search(x, 4 * COPIES)
        out = []
        for own, d in zip(ids.tolist(), dist.tolist(), strict=True):
            chosen = [own[0]]
            for c, r in zip(own[1:], d[1:], strict=True):
                if len(chosen) == COPIES or r > d[0] * (1 + CLOSE):
                    break
                if all(((self.centroids[c] - self.centroids[o]) ** 2).sum() > r * r for o in chosen):
                    chosen.append(c)
            out.append(chosen)
        return out

    def probes(self, x: np.ndarray) -> list[list[int]]:
        """Lists a query searches: all within the distance ratio. The search widens until the farthest found is beyond it."""
        width = 64
        while True:
            ids, dist = self.search(x, width)
            within = dist <= dist[:, :1] * (1 + self.ratio) + 1e-12
            if width >= len(self.centroids) or not within[:, -1].any():
                return [i[w].tolist() for i, w in zip(ids, within, strict=True)]
            width *= 2


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` (doubles) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).filter(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", odd) & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1)
    top = sizes.first()
    return rows.filter(F.size("v") == (top.dim if top else 0))


def fit(rows: DataFrame, sample: int = SAMPLE) -> Index | None:
    """From about ``sample`` vectors, picked by a hash of the id and the vector."""
    n = rows.count()
    if not n:
        return None
    share = min(1.0, sample / n)
    picked = rows.filter(F.pmod(F.xxhash64("vec_id", "v"), F.lit(1_000_000)) < math.ceil(share * 1e6)).select("v").collect()
    points = [r.v for r in picked] or [rows.first().v]
    return Index(np.array(points), n)


def listed(rows: DataFrame, index: Index, queries: bool) -> DataFrame:
    """``list, vec_id, v``: where vectors are stored, or where queries look."""
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        own = shared.value
        for batch in batches:
            x = np.array(batch.column(1).to_pylist()).reshape(batch.num_rows, -1)
            if not len(x):
                continue
            found = own.probes(x) if queries else own.lists(x)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), *batch.columns], names=["lists", "vec_id", "v"])

    placed = rows.select("vec_id", "v").mapInArrow(run, "lists array<int>, vec_id bigint, v array<double>")
    return placed.select(F.explode("lists").alias("list"), "vec_id", "v")


def bundles(stored: DataFrame, looking: DataFrame) -> list[tuple[int, int, int, int]]:
    """Per list its bundle, blocks of vectors and groups of queries: neighbouring short lists fill a bundle up to ``BLOCK`` vectors."""
    sizes = stored.groupBy("list").agg(F.count("*").alias("n")).join(
        looking.groupBy("list").agg(F.count("*").alias("q")), "list").orderBy("list").collect()  # at most CENTROIDS rows
    groups: list[list] = []
    for r in sizes:
        if groups and sum(x.n for x in groups[-1]) + r.n <= BLOCK:
            groups[-1].append(r)
        else:
            groups.append([r])
    return [(r.list, b, -(-sum(x.n for x in own) // BLOCK), -(-max(x.q for x in own) // QUERIES)) for b, own in enumerate(groups) for r in own]


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``every``, against all other ids."""
    out = "query_id bigint, rank int, vec_id bigint, score double"
    spark = vectors.sparkSession
    rows = valid_vectors(vectors)
    index = fit(rows, sample)
    if index is None:
        return spark.createDataFrame([], out)
    asked = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).dropDuplicates(["vec_id"])
    stored = materialize(listed(rows, index, False), "lists")
    looking = materialize(listed(asked, index, True), "probes")
    dealt = bundles(stored, looking)

    def parts() -> DataFrame:
        return F.broadcast(spark.createDataFrame(dealt, "list int, bundle int, blocks int, groups int"))  # at most CENTROIDS rows

    block, group = F.pmod(F.xxhash64("vec_id"), F.col("blocks")), F.pmod(F.xxhash64("vec_id"), F.col("groups"))
    held = stored.join(parts(), "list").withColumn("block", block.cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).select("bundle", "block", "part", "list", "vec_id", "v")
    wanted = looking.join(parts(), "list").withColumn("part", group.cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("bundle", "block", "part", "list", "vec_id", "v")

    def best(own: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(ask):
            own = own.sort_values("vec_id", kind="stable")
            ids, x, lists = own["vec_id"].to_numpy(), np.stack(own["v"].to_numpy()), own["list"].to_numpy()
            for q, probes in ask.groupby("vec_id"):
                at = np.flatnonzero(np.isin(lists, probes["list"].to_numpy()) & (ids != q))
                d = np.sqrt(((x[at] - probes["v"].iloc[0]) ** 2).sum(axis=1))
                order = d.argsort(kind="stable")  # ties stay in the order of ids
                _, first = np.unique(ids[at[order]], return_index=True)
                order = order[np.sort(first)][:k]
                found.append(pd.DataFrame({"query_id": q, "vec_id": ids[at[order]], "score": d[order]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["bundle", "block", "part"]
    partial = held.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInPandas(best, "query_id bigint, vec_id bigint, score double")
    once = partial.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
