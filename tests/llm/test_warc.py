import gzip
import hashlib
from pathlib import Path

import pytest

from propensight.llm import warc as W

SCHEMA = "page_id long, url string, html string, digest string"


def pages():
    big, other = "<p>é" + "x" * 1200, "<p>" + "y" * 999 + "é"
    rows = [(i, f"http://h/{i}", f"<p>{i}" * (i % 500 + 1), "d") for i in range(120)]
    rows += [(200, "u\r\nX: y", big, "d"), (205, "v", big, "d"), (203, None, big, "d"), (None, "w", big, "d"), (300, "a", other, "d"), (301, "b", other, "d"),
             (400, "s", "short", "d"), (401, "s", "short", "d"), (402, "e", "", "d"), (403, "n", None, "d"), (205, "v", big, "d")]
    return rows


def brute(rows):
    top = {}
    for i, _, h, _ in rows:
        top.setdefault(h or "", []).append(-1 if i is None else i)
    used, out = set(), []
    for i, _, h, _ in rows:
        data = (h or "").encode()
        best = max(top[h or ""])
        first = len(data) < 1000 or (best == (-1 if i is None else i) and h not in used)
        if first:
            used.add(h)
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if first else "revisit", None if first else best))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def files(folder):
    return {p.name: p.read_bytes() for p in Path(folder).glob("*.warc.gz")}


def test_round_trip_and_same_bytes_for_any_partitioning(spark, tmp_path):
    df = spark.createDataFrame(pages(), SCHEMA)
    one = W.write(df.repartition(7), str(tmp_path / "a"), shard_bytes=20_000, roll_bytes=3_000)
    W.write(df.coalesce(1).orderBy("url"), str(tmp_path / "b"), shard_bytes=20_000, roll_bytes=3_000)
    a, b = files(tmp_path / "a"), files(tmp_path / "b")
    assert a == b and len({n[:11] for n in a}) > 2 and any(n.endswith("00001.warc.gz") for n in a)
    assert rows_of(W.read(spark, one)) == brute(pages())
    assert b"".join(gzip.decompress(x) for x in a.values()).count(b"WARC/1.1\r\n") == len(pages()) + len(a)
    assert not list((tmp_path / "a" / "_temporary").iterdir())


def test_same_bytes_whether_responses_are_broadcast_or_joined(spark, tmp_path):
    df = spark.createDataFrame([r for r in pages() for _ in range(3)], SCHEMA)
    one = W.write(df, str(tmp_path / "a"), shard_bytes=20_000)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        W.write(df, str(tmp_path / "b"), shard_bytes=20_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert files(tmp_path / "a") == files(tmp_path / "b")
    assert rows_of(W.read(spark, one)) == brute([r for r in pages() for _ in range(3)])


def test_copies_do_not_fill_a_shard(spark, tmp_path):
    body = "<p>" + "z" * 5000
    rows = [(i, f"http://h/{i}", body, "d") for i in range(4000)]
    W.write(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "c"), shard_bytes=2_000_000)
    shards = {}
    for f in spark.read.parquet(str(tmp_path / "c" / "_manifest")).collect():
        shards[f.shard] = shards.get(f.shard, 0) + f.records
    assert len(shards) == 11 and max(shards.values()) < 600 and sum(shards.values()) == 4000


def test_place_is_on_the_default_file_system(spark, tmp_path):
    assert W.qualified(spark, str(tmp_path)) == f"file:{tmp_path}" and W.place(f"file:{tmp_path}")[1] == str(tmp_path)


def test_damage_is_noticed(spark, tmp_path):
    manifest = W.write(spark.createDataFrame(pages()[:20], SCHEMA), str(tmp_path / "a"))
    path = next((tmp_path / "a").glob("*.warc.gz"))
    path.write_bytes(path.read_bytes()[:-9])
    with pytest.raises(Exception, match="cut off|not the file|Error"):
        W.read(spark, manifest).collect()


def test_empty_table(spark, tmp_path):
    assert W.read(spark, W.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"))).count() == 0
