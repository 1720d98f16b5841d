"""Phrase collocations by SETM: relations of occurrences, sorted and written, joined with themselves by piece and adjacent position.

1. Texts are folded and cut into pieces and words. A task packs its documents into chunks of about ``CHUNK`` bytes. The relation
   of occurrences of a chunk is its positions in order, pieces apart by a free position, each with the local number of its
   word; the chunk lists its different words with their counts. It is written.
2. Group count: the lists of all chunks are summed by (language, word), later by the two phrases joined; groups seen ``least`` times or
   more get a number.
3. Semi-join: the frequent groups go back to the chunks that hold them, once per chunk whatever their number of occurrences. For words
   this needs no further shuffle: sums and numbers are taken in windows over the entries, which spill where a word is in very many chunks.
4. Merge join: the sorted relation of frequent phrases of k words is joined with itself at the next position of the piece, which gives
   the occurrences of phrases of k + 1 words whose first and last k words are frequent. They are grouped within the chunk, and the new
   sorted relation is written. Steps 2 to 4 repeat up to ``longest`` words.

A group is in a chunk's list once, so no key of any shuffle holds more rows than there are chunks, however frequent a word is. Before the semi-join the lists are thinned by a bit field of ``BITS`` bits over hashes
of the frequent groups, which is all that comes to the driver (8 MB at any size); the join after it is exact. Texts longer than a chunk are cut
between pieces. A frequent phrase carries the counts of its heads and tails from level to level, so cuts need no further join, and what a longer
phrase covers follows from the two phrases it was joined from.

Null and empty texts have no words; a null language is ``und``. Repeated rows count each. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from propensight.llm.common import LOWER, UPPER, discard, table, utf8
from propensight.session import materialize

LEAST, LONGEST, FIRST = 30, 4, 2000
SCALE, COVERED = 2_000_000, 80
CHUNK = 4 << 20
ROWS = 1 << 16  # of an Arrow batch
BITS, FIELD = 1 << 26, 1 << 15  # the second is the size of Spark's bitmaps
CHUNK_BITS, AT_BITS = 14, 29  # of a word's number: chunks of a partition, entries of a chunk

END = b"\xff"  # a byte that no UTF-8 text holds
FOLDED = bytes.maketrans(UPPER.encode() + b".,;:!?\n\x0b\x0c\r\t", LOWER.encode() + END * 10 + b" ")


def packed(numbers: np.ndarray, kind: type = np.int32) -> bytes:
    return pa.compress(numbers.astype(kind).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, rows: int, kind: type = np.int32) -> np.ndarray:
    size = np.dtype(kind).itemsize * rows
    return np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd"), kind) if rows else np.empty(0, kind)


def parts(text: bytes, size: int) -> list[bytes]:
    """``text``, folded, in parts of at most ``size`` bytes as far as its pieces allow."""
    data, out = text.translate(FOLDED), []
    while len(data) > size:
        cut = data.rfind(END, 0, size)
        cut = data.find(END, size) if cut < 0 else cut
        if cut < 0:
            break
        out.append(data[:cut])
        data = data[cut + 1:]
    return [*out, data]


def words_of(texts: dict[str, list[bytes]]) -> tuple[list[str], list[bytes], np.ndarray, np.ndarray]:
    """Languages, words and counts of a chunk's groups, and its relation: the group at each position, -1 between pieces."""
    langs: list[str] = []
    words: list[bytes] = []
    counts, relation = [], []
    for lang, own in texts.items():
        local = {END: 0}
        found = END.join(own).replace(END, b" " + END + b" ").split()
        codes = np.fromiter((local.setdefault(w, len(local)) for w in found), np.int64, len(found))
        counts.append(np.bincount(codes, minlength=len(local))[1:])
        relation += [np.where(codes > 0, codes + (len(words) - 1), -1), [-1]]
        words += list(local)[1:]
        langs += [lang] * (len(local) - 1)
    whole = [np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in (counts, relation)]
    return langs, words, whole[0], whole[1]


def lists(fields: dict[str, pa.Array]) -> pa.ListArray:
    """One list of structs."""
    values = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def word_relations(docs: DataFrame, size: int = CHUNK) -> DataFrame:
    """The written relations of words: a row per chunk with its groups ``keys``."""

    def chunk(number: int, texts: dict[str, list[bytes]]) -> pa.RecordBatch:
        langs, words, n, relation = words_of(texts)
        # One text for a language and a word, so that rows stay narrow.
        names = [f"{len(lang)}:{lang}{w.decode()}" for lang, w in zip(langs, words, strict=True)]
        keys = lists({"name": pa.array(names, pa.string()), "n": pa.array(n)})
        known = sorted(set(langs))
        owner = np.searchsorted(known, langs) if known else np.empty(0, int)
        totals = lists({"lang": pa.array(known, pa.string()), "n": pa.array(np.bincount(owner, n, len(known)).astype(np.int64))})
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([len(relation)]), pa.array([len(words)]), pa.array([packed(relation)], pa.binary()),
                                           keys, totals], names=["chunk", "size", "groups", "relation", "keys", "totals"])

    def run(batches):
        number, held, texts = TaskContext.get().partitionId() << CHUNK_BITS, 0, {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for part in parts(text.as_py(), size):
                    if held and held + len(part) > size:
                        yield chunk(number, texts)
                        number, held, texts = number + 1, 0, {}
                    texts.setdefault(lang, []).append(part)
                    held += len(part)
        if held:
            yield chunk(number, texts)

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), utf8(F.col("text")).alias("text")).filter(F.length("text") > 0)
    return materialize(rows.mapInArrow(run, "chunk bigint, size bigint, groups bigint, relation binary, keys array<struct<name:string,n:bigint>>, "
                                        "totals array<struct<lang:string,n:bigint>>"), "words")


def places(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Place of a group in the bit field."""
    x = (p.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ (q.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)) % np.uint64(BITS)


def bit_field(frequent: DataFrame) -> np.ndarray:
    """The places of the frequent groups as ``BITS`` bits; of that size however many there are."""
    def run(batches):
        for b in batches:
            at = places(b.column(0).to_numpy(), b.column(1).to_numpy()).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // FIELD), pa.array(at % FIELD)], names=["field", "bit"])

    fields = frequent.select("p", "q").mapInArrow(run, "field bigint, bit bigint").groupBy("field").agg(
        F.bitmap_construct_agg("bit").alias("bits")).collect()
    out = np.zeros((BITS // FIELD, FIELD // 8), np.uint8)
    for r in fields:
        out[r.field] = np.frombuffer(r.bits, np.uint8)
    return out.ravel()


def groups_of(relations: DataFrame, frequent: DataFrame | None = None) -> DataFrame:
    """``chunk, at, p, q, n`` of the groups of all chunks, or of those that the bit field of ``frequent`` does not rule out."""
    shared = relations.sparkSession.sparkContext.broadcast(None if frequent is None else bit_field(frequent))

    def run(batches):
        field = shared.value
        for batch in batches:
            for chunk, groups, before, *parts_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                numbers = unpacked(parts_[0], before, np.int64)
                p, q, n = (unpacked(x, groups) for x in parts_[1:])
                p, q = numbers[p], numbers[q]
                at = np.arange(groups)
                if field is not None:
                    place = places(p, q)
                    at = np.flatnonzero(field[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                for i in range(0, len(at), ROWS):
                    some = at[i:i + ROWS]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), chunk)), pa.array(some), pa.array(p[some]), pa.array(q[some]),
                                                      pa.array(n[some].astype(np.int64))], names=["chunk", "at", "p", "q", "n"])

    return relations.select("chunk", "groups", "before", "numbers", "p", "q", "n").mapInArrow(run, "chunk bigint, at bigint, p bigint, q bigint, n bigint")


def joined(relation: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge join of the sorted frequent occurrences (those whose group has a number) with themselves at the next position: the groups
    ``p, q`` joined, their counts, and the new relation."""
    there = np.append(numbers, -1)[relation] >= 0
    pos = np.flatnonzero(there)
    pos = pos[:-1][pos[1:] == pos[:-1] + 1]
    first, second = relation[pos].astype(np.int64), relation[pos + 1].astype(np.int64)
    keys, group, n = np.unique(first * len(numbers) + second, return_inverse=True, return_counts=True)
    out = np.full(len(relation), -1, np.int32)
    out[pos] = group
    return keys // max(1, len(numbers)), keys % max(1, len(numbers)), n, out


RELATION = "chunk bigint, size bigint, groups bigint, before bigint, relation binary, numbers binary, p binary, q binary, n binary"


def longer(relations: DataFrame, kept: DataFrame) -> DataFrame:
    """Relations of phrases one word longer, from those of ``relations`` whose groups are in ``kept`` (``chunk, at, number``).

    A chunk's groups are pairs of places in its list of ``numbers``.
    """
    kinds = pa.schema([(c.split()[0], pa.binary() if c.endswith("binary") else pa.int64()) for c in RELATION.split(", ")])

    def extend(own: pa.Table, groups: pa.Table) -> pa.Table:
        if not own.num_rows or not groups.num_rows:
            return kinds.empty_table()
        size = own["size"][0].as_py()
        numbers = np.full(own["groups"][0].as_py(), -1, np.int64)
        numbers[groups["at"].to_numpy()] = groups["number"].to_numpy()
        p, q, n, out = joined(unpacked(own["relation"][0].as_py(), size), numbers)
        if not len(p):
            return kinds.empty_table()
        cells = [own["chunk"][0].as_py(), size, len(p), len(numbers), packed(out), packed(numbers, np.int64), packed(p), packed(q), packed(n)]
        return pa.table([pa.array([c], f.type) for c, f in zip(cells, kinds, strict=True)], schema=kinds)

    held = relations.select(F.col("chunk").alias("chunk"), "size", "groups", "relation")  # a column of its own: both sides come from one table
    return materialize(held.groupBy("chunk").cogroup(kept.groupBy("chunk")).applyInArrow(extend, RELATION), "phrases")


def frequent_words(relations: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Frequent words with a number each, and ``entry, number`` of all their entries in chunks, from one shuffle of the entries.

    An entry is a chunk and a place in its list as one number. A word's number is its first entry, so it does not depend on tasks.
    """
    word = Window.partitionBy("name")
    entry = F.shiftleft("chunk", AT_BITS).bitwiseOR(F.col("at").cast("bigint"))
    entries = relations.select("chunk", F.posexplode("keys").alias("at", "key")).select(entry.alias("entry"), "key.*")
    counted = entries.withColumns({"a": F.sum("n").over(word), "number": F.min("entry").over(word)}).filter(F.col("a") >= least)
    kept = materialize(counted.select("entry", "number", F.when(F.col("entry") == F.col("number"), F.struct("name", "a")).alias("named")), "entries")
    name, size = F.col("named.name"), F.substring_index("named.name", ":", 1)
    start = F.length(size) + 2
    lang, phrase = name.substr(start, size.cast("int")), name.substr(start + size.cast("int"), F.length(name))
    words = materialize(kept.filter("named is not null").select(
        "number", lang.alias("lang"), phrase.alias("phrase"), phrase.alias("last"), "named.a", F.array("named.a").alias("heads"),
        F.array("named.a").alias("tails")), "frequent")
    return words, kept.select("entry", "number")


def frequent_phrases(relations: DataFrame, before: DataFrame, least: int) -> DataFrame:
    """Groups of ``relations`` with their phrases; ``heads`` and ``tails`` are the counts of their first and last 1, 2, ... words."""
    counts = groups_of(relations).select("p", "q", "n").groupBy("p", "q").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
    head = before.select(F.col("number").alias("p"), "lang", "phrase", "heads")
    tail = before.select(F.col("number").alias("q"), "last", "tails")
    return materialize(counts.join(head, "p").join(tail, "q").select(
        F.monotonically_increasing_id().alias("number"), "p", "q", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last",
        "a", F.array_append("heads", F.col("a")).alias("heads"), F.array_append("tails", F.col("a")).alias("tails")), "frequent")


def weakest_cut(df: DataFrame, words: int) -> DataFrame:
    """``l, r, score`` of the cut with the lowest score, the first of equal ones. Decimals of 38 digits hold the product."""
    cuts = []
    for k in range(1, words):
        left, right = F.get("heads", F.lit(k - 1)), F.get("tails", F.lit(words - k - 1))
        score = F.call_function("div", F.col("a").cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(7,0)"),
                                left.cast("decimal(20,0)") + right.cast("decimal(20,0)"))
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    return df.withColumn("cut", F.least(*cuts) if len(cuts) > 1 else cuts[0]).select("*", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, size: int = CHUNK) -> DataFrame:
    """``lang, words, phrase, a, l, r, n, score`` of all candidates of 2 to ``longest`` words that no longer one covers."""
    relations = word_relations(docs, size)
    totals = materialize(relations.select(F.inline("totals")).groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    words, entries = frequent_words(relations, least)
    kept = entries.select(F.shiftright("entry", AT_BITS).alias("chunk"), F.col("entry").bitwiseAND((1 << AT_BITS) - 1).alias("at"), "number")
    levels, dead = [words], [relations, entries]
    for k in range(2, longest + 1):
        relations = longer(relations, kept)
        for table_ in dead:  # the new relations are written, nothing reads these again
            discard(table_)
        levels.append(frequent_phrases(relations, levels[-1], least))
        dead = [relations]
        if k < longest:
            kept = groups_of(relations, levels[-1]).select("chunk", "at", "p", "q").join(
                levels[-1].select("p", "q", "number"), ["p", "q"]).select("chunk", "at", "number")
    discard(relations)
    out = None
    for k in range(2, longest + 1):
        own = weakest_cut(levels[k - 1], k)
        if k < longest:  # a phrase covered by one of two words more is covered by one of one word more, which is as frequent or more
            above = levels[k].select(F.explode(F.array("p", "q")).alias("number"), F.col("a").alias("above"))
            most = above.groupBy("number").agg(F.max("above").alias("above"))
            own = own.join(most, "number", "left").filter(F.col("above").isNull() | (100 * F.col("above") < COVERED * F.col("a")))
        own = own.select("lang", F.lit(k).alias("words"), "phrase", "a", "l", "r", "score")
        out = own if out is None else out.unionByName(own)
    return out.join(totals, "lang").select("lang", "words", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark, sf_dir: str) -> DataFrame:
    found = collocations(table(spark, sf_dir, "documents"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= FIRST).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _grams(k: int) -> str:
    return f"""g{k} AS (SELECT lang, array_to_string(w[i:i + {k - 1}], ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, w, unnest(generate_series(1, len(w) - {k - 1})) AS i FROM pieces WHERE len(w) >= {k}) GROUP BY ALL)"""


def _cuts(k: int) -> str:
    """Candidates of ``k`` words with one row for each cut."""
    return " UNION ALL ".join(f"""SELECT c.lang, {k} AS words, c.phrase, c.a, {i} AS cut, x.a AS l, y.a AS r,
  CAST(CAST(2000000 AS HUGEINT) * c.a // (CAST(x.a AS HUGEINT) + y.a) AS BIGINT) AS score
  FROM g{k} c JOIN g{i} x ON x.lang = c.lang AND x.phrase = array_to_string(string_split(c.phrase, ' ')[:{i}], ' ')
  JOIN g{k - i} y ON y.lang = c.lang AND y.phrase = array_to_string(string_split(c.phrase, ' ')[{i + 1}:], ' ')
  WHERE c.a >= 30""" for i in range(1, k))


_INNER = " UNION ALL ".join(
    f"SELECT lang, array_to_string(string_split(phrase, ' ')[{s + 1}:{s + k}], ' ') AS phrase, a FROM g{m} WHERE a >= 30"
    for m in (3, 4) for k in range(2, m) for s in range(m - k + 1))

SQL = {"op12_phrases": f"""
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(text, '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
{", ".join(_grams(k) for k in (1, 2, 3, 4))},
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM g1 GROUP BY lang),
cuts AS ({" UNION ALL ".join(_cuts(k) for k in (2, 3, 4))}),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
above AS (SELECT lang, phrase, max(a) AS above FROM ({_INNER}) GROUP BY lang, phrase),
kept AS (SELECT w.* FROM weakest w LEFT JOIN above v ON v.lang = w.lang AND v.phrase = w.phrase
         WHERE v.above IS NULL OR 100 * v.above < 80 * w.a),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
           FROM kept JOIN totals USING (lang))
SELECT * FROM ranked WHERE rank <= 2000"""}
