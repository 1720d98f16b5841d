"""Alignment of the tokens of two tokenizers over the same bytes, and how often their tokens end together.

1. A task cuts its texts into pieces at single spaces between non-blank characters. Neither tokenizer joins anything across such a space (the
   pattern of the byte-level one starts a word there, no piece of the other goes on after a letter with a space), so tokens of pieces, one after another, are
   the tokens of the text; different pieces are encoded once per task.
2. Starts and ends of all tokens in bytes go through two ``merge_asof`` per batch, keyed by document: each token start finds the other
   side's token that covers it. The union of both directions is the set of overlaps; ends that meet cut the tokens into groups
   and make links.
3. Documents are packed into chunks of about ``CHUNK`` bytes, each with its different pairs of linked ids and their counts, and written. Pairs are
   summed over all chunks; the sums go back once per chunk and pair, so no key holds more rows than there are chunks, and every chunk
   adds up what its documents' links count.

The tokenizers' files are read by the driver from ``folder`` and broadcast (2 MB, fixed); tasks need no local file. Per task the memory is bounded by a slice of
``SLICE`` bytes, the pieces kept (``KEPT``), a chunk, and the links of the longest text; texts are cut into windows before they are encoded.

Null and empty texts and those whose tokens do not give back space + text (such as texts with U+2581) have no tokens: all numbers are 0, the digest is empty.
Special tokens' strings are plain text. Every row has a result, repeated and null ids too; other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from propensight.llm.common import table
from propensight.session import materialize

FOLDER, A_FILE, B_FILE = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
SLICE, CHUNK = 1 << 20, 16 << 20
KEPT, TOGETHER = 500_000, 1_000  # pieces whose tokens a task keeps, and that are encoded at a time
CUT = re.compile(r"(?<=\S) (?=\S)")
SPACE = "▁"


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """One tokenizer: its encoder, the bytes of each id, and the tokens of the pieces seen."""

    def __init__(self, encode, spelled: list[bytes]):
        self.encode, self.spelled = encode, spelled
        self.lengths = np.array([len(s) for s in spelled], np.int64)
        self.reset()

    def reset(self) -> None:
        self.flat = np.empty(0, np.int32)
        self.first, self.n = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, pieces: list[str]) -> list[bool]:
        """Encode further pieces; whether the tokens of each give back its bytes after a space.

        Pieces without blanks at their ends are encoded many at a time with a space between, which is a text cut at the same places.
        """
        first, n = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        flat, base = [self.flat], len(self.flat)
        alone = [i for i, p in enumerate(pieces) if not p or p[0].isspace() or p[-1].isspace()]
        plain = np.delete(np.arange(len(pieces)), alone)
        for k in range(0, len(plain), TOGETHER):
            some = plain[k:k + TOGETHER]
            texts = [pieces[i] for i in some]
            text = " ".join(texts)
            found = self.encode([text])[0]
            if b"".join(map(self.spelled.__getitem__, found)) == b" " + text.encode():
                ends = np.cumsum([len(t.encode()) + 1 for t in texts])
                flat.append(np.array(found, np.int32))
                cuts = np.searchsorted(np.cumsum(self.lengths[flat[-1]]), ends) + 1
                n[some] = np.diff(cuts, prepend=0)
                first[some] = base + cuts - n[some]
                base += len(found)
            else:
                alone += some.tolist()
        sound = [True] * len(pieces)
        for i, own in zip(alone, self.encode([pieces[i] for i in alone]), strict=True):
            flat.append(np.array(own, np.int32))
            first[i], n[i] = base, len(own)
            base += len(own)
            sound[i] = b"".join(map(self.spelled.__getitem__, own)) == b" " + pieces[i].encode()
        self.flat = np.concatenate(flat)
        self.first, self.n = np.concatenate([self.first, first]), np.concatenate([self.n, n])
        return sound

    def tokens(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces' tokens in a row, and how many each piece has."""
        first, n = self.first[codes], self.n[codes]
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        return self.flat[at], n


def byte_level(data: bytes) -> Side:
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(data.decode())
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    symbols, spelled = byte_symbols(), [b""] * t.get_vocab_size()
    for token, i in t.get_vocab().items():
        spelled[i] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
    return Side(lambda pieces: [x.ids for x in t.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)], spelled)


def piece_level(data: bytes) -> Side:
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_proto=data)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    spelled = [bytes([int(n[3:5], 16)]) if sp.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
    return Side(lambda pieces: sp.encode(pieces, num_threads=1), spelled)


class Aligned(NamedTuple):
    """Tokens of a slice: ids, document of each, first byte and byte after the last, both counted through the slice; index pairs of overlapping tokens."""
    a: np.ndarray
    b: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    a_start: np.ndarray
    a_end: np.ndarray
    b_start: np.ndarray
    b_end: np.ndarray
    pairs: tuple[np.ndarray, np.ndarray]


def covering(starts: np.ndarray, docs: np.ndarray, others: np.ndarray, other_docs: np.ndarray) -> np.ndarray:
    """For each token start the token of the other side, by number, that covers it in the same document."""
    left = pd.DataFrame({"start": starts, "doc": docs})
    right = pd.DataFrame({"start": others, "doc": other_docs, "at": np.arange(len(others))})
    return pd.merge_asof(left, right, on="start", by="doc")["at"].to_numpy()


def overlaps(a_start: np.ndarray, a_doc: np.ndarray, b_start: np.ndarray, b_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number pairs of all overlapping tokens: the union of both directions, which share the pairs that start together."""
    b_of, a_of = covering(a_start, a_doc, b_start, b_doc), covering(b_start, b_doc, a_start, a_doc)
    new = np.flatnonzero(a_start[a_of] != b_start)
    return np.concatenate([np.arange(len(a_start)), a_of[new]]), np.concatenate([b_of, new])


class Pair:
    """Both tokenizers in one task."""

    def __init__(self, a: bytes, b: bytes):
        self.a, self.b = byte_level(a), piece_level(b)
        self.known: dict[str, int] = {}
        self.sound: list[bool] = []
        # What a token adds to the text of the groups, by 2 * id + 1 where its group's side ends.
        self.written = [b"%d%b" % (i, e) for i in range(len(self.a.spelled)) for e in (b",", b"|")]
        self.shift = len(self.written)
        self.written += [b"%d%b" % (i, e) for i in range(len(self.b.spelled)) for e in (b",", b";")]

    def codes(self, windows: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the windows' pieces in a row, and how many each window has."""
        pieces = [CUT.split(w) for w in windows]
        if len(self.known) > KEPT:
            self.known, self.sound = {}, []
            self.a.reset(), self.b.reset()
        known, before = self.known, len(self.known)
        codes = np.array([known.setdefault(p, len(known)) for own in pieces for p in own], np.int64)
        new = list(known)[before:]
        if new:
            self.sound += [x and y for x, y in zip(self.a.add(new), self.b.add(new), strict=True)]
        return codes, np.array([len(p) for p in pieces], np.int64)

    def align(self, windows: list[str]) -> tuple[Aligned, np.ndarray]:
        """Tokens and overlaps of windows, and which windows' tokens give back their bytes; the others have no tokens."""
        codes, n = self.codes(windows)
        window = np.repeat(np.arange(len(windows)), n)
        sound = np.ones(len(windows), bool)
        sound[window[~np.array(self.sound)[codes]]] = False
        codes, window = codes[sound[window]], window[sound[window]]
        out = []
        for side in (self.a, self.b):
            ids, many = side.tokens(codes)
            end = np.cumsum(side.lengths[ids])
            out.append((ids, np.repeat(window, many), end - side.lengths[ids], end))
        (a, a_doc, a_start, a_end), (b, b_doc, b_start, b_end) = out
        return Aligned(a, b, a_doc, b_doc, a_start, a_end, b_start, b_end, overlaps(a_start, a_doc, b_start, b_doc)), sound

    def groups(self, t: Aligned, windows: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per window its groups as text, numbers of tokens of both sides and of groups; the linked token numbers."""
        i, j = t.pairs
        linked = np.flatnonzero(t.a_end[i] == t.b_end[j])
        linked = linked[np.argsort(i[linked], kind="stable")]
        i, j = i[linked], j[linked]
        a_last, b_last = np.zeros(len(t.a), np.int64), np.zeros(len(t.b), np.int64)
        a_last[i], b_last[j] = 1, 1
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        spelled = np.empty(len(t.a) + len(t.b), np.int64)
        # A group's A ids stand before its B ids.
        spelled[np.arange(len(t.a)) + np.searchsorted(b_group, a_group, "left")] = 2 * t.a.astype(np.int64) + a_last
        spelled[np.arange(len(t.b)) + np.searchsorted(a_group, b_group, "right")] = self.shift + 2 * t.b.astype(np.int64) + b_last
        n_a, n_b = (np.bincount(d, minlength=windows) for d in (t.a_doc, t.b_doc))
        n_groups = np.bincount(t.a_doc[i], minlength=windows)
        ends = np.cumsum(n_a + n_b).tolist()
        parts, write = spelled.tolist(), self.written.__getitem__
        texts = [b"".join(map(write, parts[s:e])) for s, e in zip([0, *ends[:-1]], ends, strict=True)]
        return texts, n_a, n_b, n_groups, np.stack([t.a[i], t.b[j]])


PAIRS: dict[bytes, Pair] = {}


def pair_of(files: tuple[bytes, bytes]) -> Pair:
    """The tokenizers of a worker, loaded once."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    key = hashlib.sha256(files[0] + files[1]).digest()
    if key not in PAIRS:
        PAIRS[key] = Pair(*files)
    return PAIRS[key]


def windows_of(text: str, size: int = SLICE) -> Iterator[str]:
    """A text in windows of about ``size`` characters, cut where pieces are cut."""
    at = 0
    while len(text) - at > size and (cut := CUT.search(text, at + size)):
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:]


def slices(texts: Iterator[tuple[int, str]], size: int = SLICE) -> Iterator[tuple[list[int], list[str]]]:
    """Windows of many texts, about ``size`` characters at a time, each with the number of its text."""
    numbers, held, total = [], [], 0
    for number, text in texts:
        for w in windows_of(text, size):
            numbers.append(number)
            held.append(w)
            total += len(w)
            if total >= size:
                yield numbers, held
                numbers, held, total = [], [], 0
    if held:
        yield numbers, held


def files(folder: str, a_file: str = A_FILE, b_file: str = B_FILE) -> tuple[bytes, bytes]:
    return tuple(open(f"{folder}/{name}", "rb").read() for name in (a_file, b_file))


class Document:
    """What the windows of a text add up to."""

    def __init__(self, doc_id):
        self.doc_id, self.sound, self.digest, self.ended = doc_id, True, hashlib.sha256(), False
        self.n = np.zeros(3, np.int64)
        self.links: list[np.ndarray] = []

    def add(self, text: bytes, n: list[int], links: np.ndarray) -> None:
        self.digest.update((b";" if self.n[0] else b"") + text[:-1])
        self.n += n
        self.links.append(links)

    def row(self) -> tuple:
        if not self.sound or not self.n[0]:
            return self.doc_id, 0, 0, 0, 0, ""
        return self.doc_id, *self.n.tolist(), int(self.n[2]), self.digest.hexdigest()


def chunk_row(number: int, docs: list[Document]) -> pa.RecordBatch:
    """A chunk: its documents, its different linked pairs with counts, and the pair of every link, document after document."""
    links = [x for d in docs if d.sound for x in d.links]
    both = np.concatenate(links, axis=1).astype(np.int64) if links else np.empty((2, 0), np.int64)
    at, pairs = pd.factorize(both[0] << 32 | both[1])
    rows = list(zip(*[d.row() for d in docs], strict=True))
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    whole = lambda fields: pa.ListArray.from_arrays(pa.array([0, len(next(iter(fields.values())))], pa.int32()),
                                                    pa.StructArray.from_arrays(list(fields.values()), names=list(fields)))
    keys = {"a": pa.array(pairs >> 32), "b": pa.array(pairs & 0xFFFFFFFF), "n": pa.array(np.bincount(at, minlength=len(pairs)))}
    own = {n: pa.array(c, pa.string() if n == "groups_sha256" else pa.int64()) for n, c in zip(names, rows, strict=True)}
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), whole(own), whole(keys), pa.array([pa.compress(at.astype(np.int32).tobytes(), codec="zstd", asbytes=True)], pa.binary())],
        names=["chunk", "docs", "keys", "links"])


CHUNK_SCHEMA = ("chunk bigint, docs array<struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string>>, "
                "keys array<struct<a:bigint,b:bigint,n:bigint>>, links binary")


def aligned(docs: DataFrame, folder: str = FOLDER, size: int = CHUNK) -> DataFrame:
    """The written chunks of ``doc_id, text``."""
    shared = docs.sparkSession.sparkContext.broadcast(files(folder))

    def run(batches):
        pair = pair_of(shared.value)
        number = TaskContext.get().partitionId() << 32
        held: list[Document] = []
        total = 0
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            own = [Document(i) for i in batch.column(0).to_pylist()]
            for numbers, windows in slices((i, t) for i, t in enumerate(texts) if t):
                t, sound = pair.align(windows)
                text, n_a, n_b, n_groups, links = pair.groups(t, len(windows))
                cuts = np.cumsum(n_groups)
                for w, i in enumerate(numbers):
                    if not sound[w]:
                        own[i].sound = False
                    elif own[i].sound:
                        own[i].add(text[w], [n_a[w], n_b[w], n_groups[w]], links[:, cuts[w] - n_groups[w]:cuts[w]].copy())
            for d, t in zip(own, texts, strict=True):
                held.append(d)
                total += len(t)
                if total >= size:
                    yield chunk_row(number, held)
                    number, held, total = number + 1, [], 0
        if held:
            yield chunk_row(number, held)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    return materialize(rows.mapInArrow(run, CHUNK_SCHEMA), "aligned")


def linked_pairs(chunks: DataFrame) -> DataFrame:
    """``a, b, links, best``: how many links of all documents hold the ids, and whether no other ``a`` is linked with ``b`` more often."""
    counts = materialize(chunks.select(F.inline("keys")).groupBy("a", "b").agg(F.sum("n").alias("links")), "pairs")
    most = counts.groupBy("b").agg(F.max("links").alias("most"))
    return counts.join(most, "b").select("a", "b", "links", (F.col("links") == F.col("most")).alias("best"))


RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def link_counts(chunks: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row per document with what its links count over all documents."""
    keys = chunks.select(F.col("chunk").alias("chunk"), F.posexplode("keys").alias("at", "key")).select("chunk", "at", "key.a", "key.b")
    counted = keys.join(pairs, ["a", "b"]).select("chunk", "at", "links", "best")

    def add(own: pa.Table, counts: pa.Table) -> pa.Table:
        docs = own["docs"].combine_chunks().flatten()
        n = docs.field("n_links").to_numpy(zero_copy_only=False)
        known, best = np.zeros(counts.num_rows, np.int64), np.zeros(counts.num_rows, np.int64)
        known[counts["at"].to_numpy()] = counts["links"].to_numpy()
        best[counts["at"].to_numpy()] = counts["best"].to_numpy()
        total = int(n.sum())
        at = np.frombuffer(pa.decompress(own["links"][0].as_py(), decompressed_size=4 * total, codec="zstd"), np.int32) if total else np.empty(0, np.int32)
        ends = np.cumsum(n)
        sums = [np.concatenate([[0], np.cumsum(x[at])]) for x in (best, known)]
        sums = [pa.array(s[ends] - s[ends - n]) for s in sums]
        return pa.table([*(docs.field(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), *sums, docs.field("groups_sha256")],
                        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    held = chunks.select("chunk", "docs", "links")
    return held.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(add, RESULT)


def overlapping_tokens(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """All pairs of overlapping tokens with their byte ranges in space + text: ``doc_id, a, a_start, a_end, b, b_start, b_end``, ``linked``
    where they end together."""
    shared = docs.sparkSession.sparkContext.broadcast(files(folder))
    names = ["doc_id", "a", "a_start", "a_end", "b", "b_start", "b_end", "linked"]

    def run(batches):
        pair = pair_of(shared.value)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sound = [bool(t) and bool(pair.align(list(windows_of(t)))[1].all()) for t in texts]
            passed = np.zeros(len(texts), np.int64)
            for numbers, windows in slices((i, t) for i, t in enumerate(texts) if sound[i]):
                t, _ = pair.align(windows)
                # Bytes count from the start of the text, a window's after those of the windows before.
                sizes = np.array([len(w.encode()) + 1 for w in windows])
                base = passed[numbers] + np.array([sum(s for s, m in zip(sizes[:w], numbers[:w], strict=True) if m == n) for w, n in enumerate(numbers)])
                shift = base - (np.cumsum(sizes) - sizes)
                np.add.at(passed, numbers, sizes)
                i, j = t.pairs
                off = shift[t.a_doc[i]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[numbers[w]] for w in t.a_doc[i]], pa.int64()), *(pa.array(c) for c in (
                        t.a[i], t.a_start[i] + off, t.a_end[i] + off, t.b[j], t.b_start[j] + off, t.b_end[j] + off, t.a_end[i] == t.b_end[j]))],
                    names=names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(run, "doc_id bigint, a int, a_start bigint, a_end bigint, b int, b_start bigint, b_end bigint, linked boolean")


def op11_alignment(spark, sf_dir: str) -> DataFrame:
    chunks = aligned(table(spark, sf_dir, "documents"))
    return link_counts(chunks, linked_pairs(chunks))
