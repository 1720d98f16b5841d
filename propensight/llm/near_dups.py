"""Near-duplicates by bottom-k sketches, inverted lists, an estimate over the union's sketch, and exact Jaccard.

1. One scan gives each text the size and a digest of its shingle set and the ``k`` least hashes of it (bottom-k, one hash function).
   Texts with equal sets become one node, represented by the least id: copies are never paired.
2. Inverted lists of retained values. Two sets that are similar enough share at least ``ceil(floor * k)`` values, so each
   node is listed only under its rarest ``k - ceil(floor * k) + 1`` values (prefix filter): passages that many documents have make
   no lists, values that occur once need none.
3. Candidates: in ``leader rounds`` each member of a list is paired with one member of it, which joins large groups of near copies
   with few pairs; then all pairs of a list of at most ``LARGE`` members whose ends are still in different components. Pairs with too
   different sizes go, then those whose estimate over the bottom-k of the union is below ``floor``. Longer lists that still hold several
   components are texts of one mould that are just not similar enough; lists with common members form a cluster, its
   texts are dealt to tasks in pairs of blocks of ``BLOCK``, and each task returns only links that join components.
4. The estimate is lenient: ``floor`` follows from the similarity asked for, so that a pair just at it is lost with a probability of at
   most ``LOSS`` (binomial tail of ``k`` values: 3.5e-8 at 0.85, 8.2e-8 at 0.80). For sets of at most ``k`` shingles it is exact.
5. Survivors are compared on the full sets. Components contract each node to the neighbour with the least hash of the round.

The similarity is a parameter, ``like`` per cent of the union: op9 links at ``LIKE``, the pipeline's stage at its own value.

Only pairs and ids are shuffled, texts for the ends of surviving pairs. Those ids are broadcast if there are at most ``BROADCAST_IDS`` of
them, so the scan drops other texts before the shuffle; else both sides are shuffled.

Null, empty and blank texts have an empty set and are linked with nothing. Rows with null id are not linked (component null, kept).
Equal rows count once. Different texts under one id are linked as texts of their own, each named by a 64-bit hash of id and text. Sets are
compared as sets of 64-bit hashes of their shingles (two shingles are taken for one with a probability of about 5e-20). Other columns are not read; `keep_one` keeps them.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from propensight.llm.common import shielded, table, utf8
from propensight.llm.shingling import WORDS, shingle_sets
from propensight.session import materialize

K = 64
LOSS = 1e-7  # probability to lose a pair just at the similarity asked for
LEADER_ROUNDS = 3
BROADCAST_IDS = 2_000_000  # 16 MB of ids
LARGE = 64
BLOCK = 400
COLUMNS = 4_096  # shingles compared at once
LIKE = 85  # per cent of the union


def floor_of(like: int, k: int = K) -> float:
    """The greatest share of ``k`` values that a pair with a similarity of ``like`` per cent misses with probability ``LOSS`` at most."""
    p, below, need = like / 100, 0.0, 0
    while need < k and below + math.comb(k, need) * p**need * (1 - p)**(k - need) <= LOSS:
        below += math.comb(k, need) * p**need * (1 - p)**(k - need)
        need += 1
    return max(0.0, need - 0.5) / k  # between two counts, so that rounding does not matter


def sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """``doc_id, n_shingles, set_id, sketch`` per row; set_id is null for empty sets."""
    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist())
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets]
            least = pa.array([s[:k].view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.string()), least],
                names=["doc_id", "n_shingles", "set_id", "sketch"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", utf8(F.col("text")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_shingles bigint, set_id string, sketch array<bigint>")


def inverted_lists(nodes: DataFrame, k: int, floor: float) -> DataFrame:
    """``value, node, n`` for the rarest values of each node that others have too."""
    values = nodes.select("node", "n", F.size("sketch").alias("s"), F.explode("sketch").alias("value"))
    common = values.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1")
    shared = values.join(common, "value").groupBy("node", "n", "s").agg(
        F.array_sort(F.collect_list(F.struct("df", "value"))).alias("rare"))  # at most k entries
    length = F.col("s") - F.ceil(F.lit(floor) * F.col("s")) + 1 - (F.col("s") - F.size("rare"))
    chosen = shared.withColumn("length", F.greatest(F.lit(0), length).cast("int")).filter("length > 0")
    return chosen.select(F.explode(F.slice("rare", F.lit(1), F.col("length"))).alias("r"), "node", "n").select("r.value", "node", "n")


def similar_size(a, b, like: int):
    return (F.least(a, b) * 100 >= F.greatest(a, b) * like)


def estimated(pairs: DataFrame, nodes: DataFrame, k: int, floor: float) -> DataFrame:
    """Pairs whose share of common values among the ``k`` least of the union reaches ``floor``."""
    one = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("x"))
    other = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("y"))
    both = pairs.join(one, "a").join(other, "b")
    # The order of the values is that of unsigned numbers.
    order = lambda v: v.bitwiseXOR(F.lit(-(1 << 63)))
    union = F.slice(F.array_sort(F.transform(F.array_union("x", "y"), order)), 1, k)
    common = F.transform(F.array_intersect("x", "y"), order)
    return both.withColumns({"u": union, "c": common}).filter(
        F.size(F.array_intersect("u", "c")) >= F.ceil(F.size("u") * F.lit(floor))).select("a", "b")


def texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, text`` of the ids, which are broadcast if there are few enough, so that other texts are not shuffled."""
    needed = materialize(ids.select("node").distinct(), "needed_ids")
    small = needed.count() <= BROADCAST_IDS
    chosen = docs.select(F.col("doc_id").alias("node"), utf8(F.col("text")).alias("text")).join(
        F.broadcast(needed) if small else needed, "node", "left_semi")
    return materialize(chosen, "needed_texts")


def overlaps(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of ``one`` with each of ``other``."""
    owner = np.repeat(np.arange(len(one) + len(other)), [len(x) for x in [*one, *other]])
    values = np.concatenate([*one, *other])
    _, ids, counts = np.unique(values, return_inverse=True, return_counts=True)
    again = counts[ids] > 1
    ids, owner = np.unique(ids[again], return_inverse=True)[1], owner[again]
    order = ids.argsort(kind="stable")
    ids, owner = ids[order], owner[order]
    out = np.zeros((len(one), len(other)), np.float32)
    for first in range(0, int(ids[-1]) + 1 if len(ids) else 0, COLUMNS):
        a, b = np.searchsorted(ids, [first, first + COLUMNS])
        has = np.zeros((len(one) + len(other), COLUMNS), np.float32)
        has[owner[a:b], ids[a:b] - first] = 1
        out += has[:len(one)] @ has[len(one):].T
    return out


def links_of_blocks(group: pd.DataFrame, like: int) -> pd.DataFrame:
    """Links between two blocks (or within one) that join components, as few as do."""
    group = group.sort_values("node")
    i, j = group["i"].iloc[0], group["j"].iloc[0]
    left = np.flatnonzero((group["block"] == i).to_numpy())
    right = np.flatnonzero((group["block"] == j).to_numpy())
    sets = shingle_sets(group["text"].tolist())
    common = overlaps([sets[x] for x in left], [sets[y] for y in right])
    size = np.array([len(x) for x in sets])
    similar = 100 * common >= like * (size[left][:, None] + size[right][None] - common)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    node, component, found = group["node"].tolist(), group["component"].tolist(), []
    for x, y in np.argwhere(similar):
        p, q = left[x], right[y]
        u, v = find(component[p]), find(component[q])
        if u != v:
            root[max(u, v)] = min(u, v)
            found.append((min(node[p], node[q]), max(node[p], node[q])))
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def links_of_large_lists(large: DataFrame, docs: DataFrame, block: int, like: int) -> DataFrame:
    """Links between members of common lists, from ``value, node, component``."""
    lead = large.groupBy("value").agg(F.min("node").alias("a"))
    stars = large.join(lead, "value").filter("node <> a").select("a", F.col("node").alias("b")).distinct()
    clusters = materialize(components(materialize(stars, "stars")).select("node", F.col("component").alias("cluster")), "clusters")
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    members = (clusters.join(sizes, "cluster").join(large.select("node", "component").distinct(), "node")
               .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    placed = members.join(texts_of(clusters, docs), "node")
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "component", "text")
    return dealt.groupBy("cluster", "i", "j").applyInPandas(lambda group: links_of_blocks(group, like), "a bigint, b bigint")


def verified(pairs: DataFrame, docs: DataFrame, like: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    texts = texts_of(pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))), docs)
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b"))

    def run(batches):
        for batch in batches:
            a, b, x, y = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a", "b", "x", "y"))
            known = dict(zip(a, x, strict=True)) | dict(zip(b, y, strict=True))
            sets = dict(zip(known, shingle_sets(list(known.values())), strict=True))
            good = []
            for p, q in zip(a, b, strict=True):
                common = len(np.intersect1d(sets[p], sets[q], assume_unique=True))
                good.append(100 * common >= like * (len(sets[p]) + len(sets[q]) - common))
            kept = [i for i, g in enumerate(good) if g]
            yield pa.RecordBatch.from_arrays([pa.array([v[i] for i in kept], pa.int64()) for v in (a, b)], names=["a", "b"])

    return both.mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for all ends of ``edges``; the component is its least node."""
    ends = edges.select(F.col("a").alias("node")).unionAll(edges.select(F.col("b").alias("node"))).distinct()
    labels = ends.withColumn("label", F.col("node"))
    left = edges.select("a", "b")
    turn = 0
    while True:
        both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("v"))  # noqa: E731, B023
        hook = materialize(both.groupBy("a").agg(F.least(F.min(order("b")), F.min(order("a")))["v"].alias("to")), "hooks")
        labels = materialize(labels.join(hook.withColumnRenamed("a", "label"), "label", "left")
                             .select("node", F.coalesce("to", "label").alias("label")), "labels")
        left = materialize(left.join(hook.select("a", F.col("to").alias("p")), "a").join(hook.select(F.col("a").alias("b"), F.col("to").alias("q")), "b")
                           .filter("p <> q").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(), "edges")
        turn += 1
        if left.isEmpty():
            break
    least = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(least, "label").select("node", "component")


def repeated_ids(docs: DataFrame) -> DataFrame:
    """Ids of more than one row."""
    counts = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
    return materialize(counts.filter("n > 1").select("doc_id"), "repeated_ids")


def keyed(docs: DataFrame, repeated: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a ``node_key`` that names one text: the id, or a hash of id and text where an id has several rows. Equal rows of such an
    id are one; rows without an id are left out."""
    known = docs.filter("doc_id is not null").join(repeated.select(F.col("doc_id").alias("again")), F.col("doc_id") == F.col("again"), "left")
    key = F.when(F.col("again").isNull(), F.col("doc_id").cast("bigint")).otherwise(F.xxhash64("doc_id", "text"))
    rows = known.withColumn("node_key", key)
    return (rows.filter("again is null").select(*columns, "node_key")
            .unionAll(rows.filter("again is not null").dropDuplicates(["node_key"]).select(*columns, "node_key")))


def linked_keys(docs: DataFrame, repeated: DataFrame, like: int, k: int, leader_rounds: int) -> DataFrame:
    """``node_key, n_shingles, component, doc_id, first`` where ``first`` is the least (id, key) of the component."""
    rows = keyed(docs, repeated, ["doc_id", "text"])
    found = materialize(linked(rows.select(F.col("node_key").alias("doc_id"), "text"), like, k, leader_rounds).select(
        F.col("doc_id").alias("node_key"), "n_shingles", F.col("component_id").alias("component")), "linked_keys")
    named = found.join(rows.select("doc_id", "node_key"), "node_key")
    first = named.groupBy("component").agg(F.min(F.struct("doc_id", "node_key")).alias("first"))
    return materialize(named.join(first, "component"), "components_of_keys")


def mixed_lists(placed: DataFrame) -> DataFrame:
    """``value, members`` of the lists that hold several components."""
    return placed.groupBy("value").agg((F.min("component") != F.max("component")).alias("mixed"), F.count("*").alias("members")).filter(
        "mixed").select("value", "members")


def link(docs: DataFrame, like: int = LIKE, k: int = K, leader_rounds: int = LEADER_ROUNDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``; ``like`` per cent of the union of two sets links them.

    Rows that share an id are linked by their own texts.
    """
    repeated = repeated_ids(docs)
    if repeated.isEmpty():
        return linked(docs, like, k, leader_rounds)
    found = linked_keys(docs, repeated, like, k, leader_rounds)
    keys = keyed(docs, repeated, ["doc_id", "text"]).join(found.select("node_key", "n_shingles", F.col("first.doc_id").alias("component_id")), "node_key")
    rows = docs.filter("doc_id is not null").select("doc_id", F.col("text").alias("own")).join(
        keys.withColumnRenamed("doc_id", "other_id"), (F.col("doc_id") == F.col("other_id")) & F.col("own").eqNullSafe(F.col("text")))
    known = rows.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    return known.unionAll(linked(docs.filter("doc_id is null"), like, k, leader_rounds))


def linked(docs: DataFrame, like: int, k: int, leader_rounds: int) -> DataFrame:
    """The same for rows without repeated ids."""
    floor = floor_of(like, k)
    rows = materialize(sketches(docs, k), "sketches")
    nodes = materialize(rows.filter("set_id is not null and doc_id is not null").groupBy("set_id").agg(
        F.min("doc_id").cast("bigint").alias("node"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "nodes")
    lists = materialize(inverted_lists(nodes, k, floor), "lists")
    placed = lists.withColumn("component", F.col("node"))
    found: list[DataFrame] = []
    tested: list[DataFrame] = []
    for turn in range(leader_rounds + 1):
        if turn < leader_rounds:
            order = F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), F.col("node").alias("lead"), F.col("component").alias("lead_component"),
                             F.col("n").alias("lead_n"))
            leads = placed.groupBy("value").agg(F.min(order).alias("l")).select("value", "l.lead", "l.lead_component", "l.lead_n")
            met = placed.join(leads, "value").filter(F.col("component") != F.col("lead_component")).filter(
                similar_size(F.col("n"), F.col("lead_n"), like)).select(F.col("node").alias("x"), F.col("lead").alias("y"))
        else:  # exact: whatever is still apart
            apart = materialize(placed.join(mixed_lists(placed), "value"), "apart")
            short = apart.filter(F.col("members") <= LARGE)
            other = short.select("value", F.col("node").alias("y"), F.col("n").alias("m"), F.col("component").alias("other"))
            met = short.join(other, "value").filter((F.col("component") < F.col("other")) & similar_size(F.col("n"), F.col("m"), like)).select(
                F.col("node").alias("x"), "y")
        pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        for t in tested:
            pairs = pairs.join(t, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        tested.append(pairs)
        new = verified(materialize(estimated(pairs, nodes, k, floor), "likely"), docs, like)
        if turn == leader_rounds:
            new = new.unionAll(links_of_large_lists(apart.filter(F.col("members") > LARGE), docs, BLOCK, like))
        new = materialize(new, "links")
        if new.isEmpty():
            if turn < leader_rounds and pairs.isEmpty() and mixed_lists(placed).isEmpty():
                break
            continue
        found.append(new)
        places = materialize(components(reduce(DataFrame.unionAll, found)), "components")
        placed = materialize(lists.join(places, "node", "left").select("value", "node", "n", F.coalesce("component", "node").alias("component")), "placed")
    if found:
        sets = nodes.join(places, "node", "left").select("set_id", F.coalesce("component", "node").alias("component_id"))
    else:
        sets = nodes.select("set_id", F.col("node").alias("component_id"))
    out = rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_id")).alias("set_id")).join(sets, "set_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, like: int = LIKE) -> DataFrame:
    """The document with the least id of each component, and all rows without an id. Of rows that share an id equal ones are one, linked
    ones are in one component, and unlike ones all stay."""

    def small(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    repeated = repeated_ids(docs)
    if repeated.isEmpty():
        gone = materialize(link(docs, like).filter("not kept").select("doc_id").distinct(), "gone")
        return docs.join(small(gone), "doc_id", "left_anti").select(*docs.columns)
    found = linked_keys(docs, repeated, like, K, LEADER_ROUNDS)
    gone = materialize(found.filter(F.col("node_key") != F.col("first.node_key")).select("node_key"), "gone")
    rows, restored = shielded(docs, ("doc_id", "text"))
    left = keyed(rows, repeated, rows.columns).join(small(gone), "node_key", "left_anti").select(*rows.columns)
    return restored(left.unionAll(rows.filter("doc_id is null")))


def op9_near_dups(spark, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents").select("doc_id", "text"), LIKE)


SQL = {"op9_near_dups": f"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + {WORDS - 1}], ' ') AS g
      FROM d, unnest(range(1, greatest(1, len(w) - {WORDS - 1}) + 1)) AS r(k) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= {LIKE} * (x.n + y.n - c)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT DISTINCT a AS x, a AS y FROM u UNION SELECT r.x, u.b FROM r JOIN u ON r.y = u.a),
m AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
       coalesce(component_id, d.doc_id) = d.doc_id AS kept FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN m ON d.doc_id = m.x"""}
