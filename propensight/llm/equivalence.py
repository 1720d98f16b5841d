"""Equivalence classes of tokens, and the template that the valid ones nest into.

A page is a stream of tokens: elements opened (a hash of the path), closed (its complement), and blocks of text (path and text).

1. *Vectors.* The occurrence vector of a token holds how often each page of the host has it. Its digest is an aggregate that adds up over
   pages, so no host is gathered in one task. Pages with the same main text count once.
2. *Roles.* The tokens with the vector of the root (once in every page) are the root class. If its order is the same in every page, all
   tokens are told apart by the gap of the root class they stand in, and the vectors are taken anew.
3. *Classes.* Tokens of one host with equal vectors are a class; it counts if it has at least two tokens (``LARGE``) and is in a share
   ``support`` of the pages.
4. *Validity.* A class is ordered if its tokens follow each other in the same order in each of its occurrences in every page, and nested if
   each occurrence lies in one gap of the class around it. A class that is not falls apart into its elements, opened and closed.
5. *Slots.* The gaps of the innermost open occurrence; a slot is named by the token on its left.

What is kept per host are tokens of at least a share ``support`` of its pages, so at most a page's tokens over ``support``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from propensight.session import materialize

LARGE = 2
TEMPLATE_BYTES = 32 << 20  # templates are broadcast up to this measured size
CACHED = 256  # hosts whose template a task keeps at hand
ROOT = 0
OPEN, CLOSE = -1, -2  # in place of the rank of a text
STREAM = "host string, main bigint, best int, token array<bigint>, chars array<int>, rank array<int>"
MEMBER = "struct<token:bigint,class:bigint,size:int,once:boolean,full:boolean,is_text:boolean>"


def roles(tokens: np.ndarray, ranks: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Tokens told apart by the root token before them; an element opened and closed in one gap keeps complementary roles."""
    if not len(roots):
        return tokens
    is_root = np.isin(tokens, roots)
    gap = tokens[np.maximum.accumulate(np.where(is_root, np.arange(len(tokens)), 0))]  # the root opens every page
    closes = ranks == CLOSE
    x = np.where(closes, ~tokens, tokens).view(np.uint64) ^ (gap.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    named = ((x ^ (x >> np.uint64(31))) >> np.uint64(1)).view(np.int64)
    return np.where(is_root, tokens, np.where(closes, ~named, named))


class Template:
    """Classes of a host by role."""

    def __init__(self, members: list[dict]):
        self.class_of = {m["token"]: m["class"] for m in members}
        self.size = {m["class"]: m["size"] for m in members}
        self.once = {m["token"] for m in members if m["once"] and not m["is_text"]}
        self.texts = {m["token"] for m in members if m["is_text"]}
        self.everywhere = {m["token"] for m in members if m["is_text"] and m["full"]}

    def walk(self, tokens: list[int]):
        """For each token the slot it stands in (after it, if it is the template's); at the end the classes that are not nested."""
        stack: list[list[int]] = []  # class, tokens seen, last token
        opened: set[int] = set()
        broken: set[int] = set()
        slots = []
        for token in tokens:
            c = self.class_of.get(token)
            if c is not None:
                if c in opened:
                    while stack[-1][0] != c:
                        broken.add(stack[-1][0])
                        opened.discard(stack.pop()[0])
                    stack[-1][1] += 1
                    stack[-1][2] = token
                else:
                    stack.append([c, 1, token])
                    opened.add(c)
                if stack[-1][1] >= self.size[c]:
                    opened.discard(stack.pop()[0])
            slots.append(stack[-1][2] if stack else ROOT)
        return slots, broken | {s[0] for s in stack}

    def orders(self, tokens: list[int]) -> dict[int, int | None]:
        """Digest of the order of each class, null where its occurrences differ or are not whole."""
        found: dict[int, list[int]] = {}
        for token in tokens:
            c = self.class_of.get(token)
            if c is not None:
                found.setdefault(c, []).append(token)
        out: dict[int, int | None] = {}
        for c, seen in found.items():
            k = self.size[c]
            first = seen[:k]
            whole = len(seen) % k == 0 and len(set(first)) == k and seen == first * (len(seen) // k)
            out[c] = xxhash.xxh64_intdigest(np.array(first, np.int64).tobytes()) - (1 << 63) if whole else None
        return out


class Hosts:
    """A table with one row per host, for tasks that read pages: broadcast as it is if its measured size allows it, else joined."""

    def __init__(self, table: DataFrame):
        self.table, self.columns = table, [c for c in table.columns if c != "host"]
        sizes = [F.when(F.col(c).isNull(), 0).otherwise(F.size(c) * (40 if c == "members" else 8)) for c, k in table.dtypes if k.startswith("array")]
        size = table.agg(F.coalesce(F.sum(sum(sizes, F.length("host") + 32)), F.lit(0))).first()[0]
        self.shared = table.sparkSession.sparkContext.broadcast(table.toArrow()) if size <= TEMPLATE_BYTES else None

    def beside(self, pages: DataFrame) -> DataFrame:
        return pages if self.shared else pages.join(self.table, "host", "left")

    def finder(self, make):
        """A function of a batch, a row and its host that gives ``make`` of the host's row, or None without one. Free of Spark's objects."""
        shared, columns = self.shared, self.columns
        known: dict = {}
        places: dict = {}

        def find(batch, j: int, host: str):
            if host in known:
                return known[host]
            if len(known) >= CACHED:
                known.clear()
            if shared:
                if not places:
                    places.update({h: i for i, h in enumerate(shared.value.column("host").to_pylist())})
                rows, at = shared.value, places.get(host)
            else:
                rows, at = batch, j
            row = None if at is None else {c: rows.column(c)[at].as_py() for c in columns}
            known[host] = None if row is None or all(v is None for v in row.values()) else make(row)
            return known[host]

        return find


def lists(column) -> list[np.ndarray]:
    """The lists of an Arrow column without nulls as views."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[i:j] for i, j in zip(offsets[:-1], offsets[1:], strict=True)]


def as_array(tokens) -> np.ndarray:
    return np.array(tokens or (), np.int64)


def vectors(streams: DataFrame, roots: Hosts | None) -> DataFrame:
    """``host, token, is_text, support, vector, most``."""
    rows, find = (streams, None) if roots is None else (roots.beside(streams), roots.finder(lambda r: as_array(r["roots"])))

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            hosts, mains = batch.column("host").to_pylist(), batch.column("main").to_pylist()
            for j, (host, main, tokens, ranks) in enumerate(zip(hosts, mains, lists(batch.column("token")), lists(batch.column("rank")), strict=True)):
                own = find(batch, j, host) if find else None
                named = tokens if own is None else roles(tokens, ranks, own)
                token, first, n = np.unique(named, return_index=True, return_counts=True)
                out.append((host, main, token, n, ranks[first] >= 0))
            if out:
                sizes = [len(x[2]) for x in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], pa.string()).take(pa.array(np.repeat(np.arange(len(out)), sizes))),
                     pa.array(np.repeat([x[1] for x in out], sizes)), pa.array(np.concatenate([x[2] for x in out])),
                     pa.array(np.concatenate([x[3] for x in out]).astype(np.int32)), pa.array(np.concatenate([x[4] for x in out]))],
                    names=["host", "main", "token", "n", "is_text"])

    each = rows.mapInArrow(run, "host string, main bigint, token bigint, n int, is_text boolean")
    return each.groupBy("host", "token").agg(
        F.bool_or("is_text").alias("is_text"), F.count("*").alias("support"), F.bit_xor(F.xxhash64("main", "n")).alias("vector"),
        F.max("n").alias("most"))


def classes(streams: DataFrame, roots: Hosts | None, support: float, min_pages: int, full_pages: int) -> DataFrame:
    """``host, members``: tokens of large and frequent classes. Hosts with fewer than ``min_pages`` different pages have none."""
    found = materialize(vectors(streams, roots), "vectors")
    whole = found.filter((F.col("token") == ROOT) & ~F.col("is_text") & (F.col("support") >= min_pages)).select(
        "host", F.col("support").alias("pages"), F.col("vector").alias("root"))
    frequent = found.join(whole, "host").filter((F.col("support") >= F.ceil(F.col("pages") * support)) & (F.col("support") >= min_pages))
    sizes = frequent.groupBy("host", F.col("vector").alias("class")).agg(F.count("*").cast("int").alias("size")).filter(F.col("size") >= LARGE)
    member = F.struct("token", "class", "size", (F.col("most") == 1).alias("once"),
                      ((F.col("vector") == F.col("root")) & (F.col("pages") >= full_pages)).alias("full"), "is_text")
    return frequent.withColumn("class", F.col("vector")).join(sizes, ["host", "class"]).select(
        "host", "root", member.cast(MEMBER).alias("m")).groupBy("host").agg(F.first("root").alias("root"), F.collect_list("m").alias("members"))


def validity(streams: DataFrame, known: DataFrame) -> DataFrame:
    """``host, class, valid``: whether each class of ``known`` (``host, roots, members``) is ordered alike in all pages and nested."""
    hosts = Hosts(known)
    rows = hosts.beside(streams)
    find = hosts.finder(lambda r: (as_array(r["roots"]), Template(r["members"])))

    def run(batches):
        for batch in batches:
            out = []
            for j, (host, tokens, ranks) in enumerate(zip(batch.column("host").to_pylist(), lists(batch.column("token")),
                                                          lists(batch.column("rank")), strict=True)):
                own = find(batch, j, host)
                if own is None:
                    continue
                root, template = own
                named = [t for t in roles(tokens, ranks, root).tolist() if t in template.class_of]
                orders = template.orders(named)
                broken = template.walk([t for t in named if orders[template.class_of[t]] is not None])[1]
                out += [(host, c, order, c not in broken) for c, order in orders.items()]
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.bool_()), strict=True)],
                                             names=["host", "class", "way", "nested"])

    each = rows.mapInArrow(run, "host string, class bigint, way bigint, nested boolean")
    return each.groupBy("host", "class").agg(
        (F.bool_and("nested") & (F.count("way") == F.count("*")) & (F.min("way") == F.max("way"))).alias("valid"))


def deduce(streams: DataFrame, support: float, min_pages: int, full_pages: int) -> tuple[DataFrame, DataFrame]:
    """Per host the tokens of its root class by which roles are told apart, and the members of its valid classes."""
    first = materialize(classes(streams, None, support, min_pages, full_pages), "classes")
    none = F.lit(None).cast("array<bigint>").alias("roots")
    root_only = first.select("host", none, F.filter("members", lambda m: m["class"] == F.col("root")).alias("members"))
    sound = validity(streams, root_only).filter("valid").select("host")
    roots = materialize(root_only.join(sound, "host").select("host", F.transform("members", lambda m: m["token"]).alias("roots")), "roots")
    known = materialize(classes(streams, Hosts(roots), support, min_pages, full_pages).drop("root").join(roots, "host", "left"), "roles")
    valid = validity(streams, known)
    each = known.select("host", F.explode("members").alias("m")).select("host", "m.*").join(valid, ["host", "class"])
    whole = each.filter("valid").drop("valid")
    # Roles of an element opened and closed in one gap are complements of each other.
    split = each.filter("not valid and not is_text").withColumn("class", F.when(F.col("token") < 0, F.bitwise_not("token")).otherwise(F.col("token")))
    twos = split.groupBy("host", "class").agg(F.count("*").alias("n")).filter("n = 2").drop("n")
    pairs = split.join(twos, ["host", "class"]).withColumn("size", F.lit(2))
    members = whole.unionByName(pairs.select(*whole.columns)).select("host", F.struct("token", "class", "size", "once", "full", "is_text").cast(
        MEMBER).alias("m")).groupBy("host").agg(F.sort_array(F.collect_list("m")).alias("members"))
    return roots, materialize(members, "members")
