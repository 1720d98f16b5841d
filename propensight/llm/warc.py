"""Deterministic sharded WARC writer, and a reader for what it wrote.

Records are range-sorted by a key of 40 hex digits: the digest of the payload for those that may be revisited, so equal payloads
are neighbours, the one with the largest page_id first; a digest of payload digest and page_id for all others and for revisits. Shards are equal
ranges of the key, which is uniform: bounds and bytes of the files depend on the rows alone, not on how they were partitioned.
Within a shard files roll once their compressed size reaches ``roll_bytes``.

The response of a shared payload is known beforehand from an aggregate of narrow rows, one per payload with copies, joined back without a
hint: revisits carry no payload and are spread over all shards by the digest of payload digest and page_id, however many there are.

A task writes each file under a temporary name and renames it when it is complete; a second attempt writes the same bytes. Names, sizes
and digests of the files are written as a manifest under a temporary name, renamed at the end. A reader takes what
the manifest lists and checks it. The folder must be one that ``pyarrow.fs`` and all executors reach.

Null html is an empty payload, null url an empty target. Of repeated rows one is the response, the others revisit it. A null page_id
counts as the smallest and is null when read back. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from propensight.llm.common import table, utf8
from propensight.session import materialize, shared_dir

REVISIT_BYTES = 1000
SHARD_BYTES = 256 << 20  # of payload
ROLL_BYTES = 64 << 20  # of a compressed file
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, shard int, seq int, records bigint, bytes bigint, sha256 string"


def qualified(spark, folder: str) -> str:
    """The folder with its file system: a path without scheme is on the session's default one, as for Spark's own writers."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(f"file://{uri[5:]}" if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def line(name: str, value) -> bytes:
    """One header; characters that would end it are escaped."""
    text = re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(value))
    return f"{name}: {text}\r\n".encode("utf-8", "surrogatepass")


def record(kind: str, headers: list[tuple[str, object]], block: bytes) -> bytes:
    """A gzip member with one record."""
    head = b"WARC/1.1\r\n" + line("WARC-Type", kind) + b"".join(line(k, v) for k, v in headers if v is not None)
    head += line("WARC-Block-Digest", sha1_label(block)) + line("Content-Length", len(block)) + b"\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id, url: str, payload: bytes | None, size: int, digest: str, refers: tuple | None, nth: int) -> bytes:
    """A response, or where ``refers`` holds page and url of the response, a revisit of it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    headers = [("WARC-Record-ID", record_id(page_id, url, digest, nth)), ("WARC-Date", DATE), ("WARC-Target-URI", url), ("X-Page-ID", page_id),
               ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
               ("Content-Type", "application/http; msgtype=response")]
    if refers is None:
        return record("response", headers, http + payload)
    return record("revisit", [*headers, ("WARC-Profile", PROFILE), ("WARC-Refers-To-Target-URI", refers[1]), ("X-Refers-To-Page-ID", refers[0])], http)


class Roll:
    """The files of one shard: written under temporary names, renamed when complete."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.store, self.base = place(folder)
        self.shard, self.roll_bytes, self.seq, self.out, self.done = shard, roll_bytes, 0, None, []

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.seq:05d}.warc.gz"
            self.temporary = f"{self.base}/_temporary/{self.name}.{uuid.uuid4().hex}"
            self.out, self.hash, self.size, self.records = self.store.open_output_stream(self.temporary, compression=None), hashlib.sha256(), 0, 0
            info = record("warcinfo", [("WARC-Record-ID", record_id(self.name)), ("WARC-Date", DATE), ("WARC-Filename", self.name),
                                       ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            self._write(info)
        self._write(member)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def _write(self, member: bytes) -> None:
        self.out.write(member)
        self.hash.update(member)
        self.size += len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.store.move(self.temporary, f"{self.base}/{self.name}")
            self.done.append((self.name, self.shard, self.seq, self.records, self.size, self.hash.hexdigest()))
            self.out, self.seq = None, self.seq + 1


def manifest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 6
    types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                      names=["file", "shard", "seq", "records", "bytes", "sha256"])


def write(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> str:
    """Writes one record per page below ``folder`` and returns the manifest's path."""
    payload = utf8(F.col("html"))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload")).withColumns(
        {"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("bigint")})
    folder = qualified(pages.sparkSession, folder)
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_bytes))
    # The largest page_id, of equal ones the smallest url; complements turn the order without overflow.
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), F.bitwise_not("page_id").alias("id"), "url"))
    shared = rows.filter(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.count("*").alias("n"), first.alias("first")).filter(
        "n > 1 and not first.none").select("digest", F.bitwise_not("first.id").alias("response_id"), F.col("first.url").alias("response_url"))
    known = rows.join(materialize(shared, "responses"), "digest", "left")  # written, so that Spark knows its size and need not shuffle payloads for it
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    alone = (F.col("size") < REVISIT_BYTES) | revisit
    keyed = known.withColumn("revisit", revisit).withColumn(
        "key", F.when(alone, F.sha1(F.concat_ws("|", "digest", "page_id"))).otherwise(F.col("digest")))
    keyed = keyed.select("key", "digest", "page_id", "url", "size", F.when(~F.col("revisit"), F.col("payload")).alias("payload"),
                         F.when(F.col("revisit"), F.col("response_id")).alias("refers_id"), F.when(F.col("revisit"), F.col("response_url")).alias("refers_url"),
                         F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") * shards / 2.0 ** 32).cast("int").alias("shard"))
    dealt = keyed.repartitionById(shards, F.col("shard")).sortWithinPartitions(
        "shard", "key", "digest", F.col("page_id").desc_nulls_last(), "url")
    store, base = place(folder)
    store.create_dir(f"{base}/_temporary", recursive=True)

    def run(batches):
        roll, response, same = None, None, (None, 0)
        for batch in batches:
            for key, digest, page_id, url, size, body, refers_id, refers_url, shard in zip(
                    *(batch.column(j).to_pylist() for j in range(9)), strict=True):
                if roll is None or roll.shard != shard:
                    if roll:
                        roll.close()
                        yield manifest_rows(roll.done)
                    roll, response = Roll(folder, shard, roll_bytes), None
                refers = (refers_id, refers_url) if body is None else None
                if body is not None and size >= REVISIT_BYTES:
                    if response and response[0] == digest:
                        refers = response[1:]
                    else:
                        response = (digest, page_id, url)
                same = (same[0], same[1] + 1) if same[0] == (key, page_id, url) else ((key, page_id, url), 0)
                roll.add(page_record(page_id, url, body, size, digest, refers, same[1]))
        if roll:
            roll.close()
            yield manifest_rows(roll.done)

    dealt.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/_manifest.tmp")
    store.move(f"{base}/_manifest.tmp", f"{base}/_manifest")
    return f"{folder}/_manifest"


def members(stream, check):
    """The records of a file, one decompressed member at a time."""
    unpack, parts, data = zlib.decompressobj(31), [], b""
    while True:
        if not data:
            data = stream.read(1 << 20)
            if not data:
                break
            check.update(data)
        parts.append(unpack.decompress(data))
        data = unpack.unused_data
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []
    if any(parts):
        raise OSError("a record is cut off")


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(headers["Content-Length"])]
    if sha1_label(block) != headers["WARC-Block-Digest"]:
        raise OSError(f"the digest of {headers['WARC-Record-ID']} is wrong")
    return headers, block


RECORD = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_id string, "
          "target_uri string, file string")


def read(spark, manifest: str) -> DataFrame:
    """Rows of ``RECORD`` from the files that the manifest lists. Files and records are checked against their digests."""
    folder = qualified(spark, manifest.rsplit("/", 1)[0])
    listed = spark.read.parquet(manifest).select("file", "bytes", "records", "sha256")
    files = listed.repartition(max(1, min(listed.count(), 10_000)), "file")
    names = [c.split()[0] for c in RECORD.split(", ")]

    def run(batches):
        store, base = place(folder)
        for batch in batches:
            for name, size, records, sha in zip(*(batch.column(j).to_pylist() for j in range(4)), strict=True):
                check, rows, seen = hashlib.sha256(), [], 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for raw in members(stream, check):
                        headers, block = parsed(raw)
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        http, _, body = block.partition(b"\r\n\r\n")
                        page, to = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
                        is_response = headers["WARC-Type"] == "response"
                        digest = hashlib.sha1(body).hexdigest() if is_response else base64.b32decode(headers["WARC-Payload-Digest"][5:]).hex()
                        length = len(body) if is_response else int(re.search(rb"Content-Length: (\d+)", http)[1])
                        rows.append((page and int(page), length, digest, headers["WARC-Type"], to and int(to), headers["WARC-Record-ID"],
                                     headers.get("WARC-Target-URI"), name))
                        seen += 1
                        if len(rows) >= 1000:
                            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=ARROW)
                            rows = []
                if check.hexdigest() != sha or seen != records:
                    raise OSError(f"{name} is not the file in the manifest")
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=ARROW)

    return files.mapInArrow(run, RECORD)


ARROW = pa.schema([(c.split()[0], pa.int64() if c.endswith("bigint") else pa.string()) for c in RECORD.split(", ")])


def op4_warc(spark, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex[:12]}"
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return read(spark, write(pages, folder)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = {"op4_warc": f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
r AS (SELECT *, first_value(page_id) OVER w AS top, row_number() OVER w AS n FROM p
      WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= {REVISIT_BYTES} AND n > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND n > 1 THEN top END AS refers_to FROM r"""}
