import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from eddyflow.llm.warc import (archive_round_trip, base32, chunk_rows, open_store, read_chunks, stream_records,
                               write_archives)
from eddyflow.session import shared_path

SCHEMA = "page_id long, url string, html string, record string, sha1 string, keeper long, r_id int, data string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2, "z") for r in rows], SCHEMA)


def rows_of():
    same = "<p>one body</p>" * 50
    return [(1, "http://a/", same), (2, None, same), (3, "http://b/\r\nEvil: x", same), (4, "u", None), (5, "u", ""),
            (6, "u", "é日本\r\n\r\nWARC/1.1\r\n"), (7, "u", "big " * 300_000), (8, "u", "big " * 300_000), (9, "u", same)]


def expected(rows):
    pay = {i: (h or "").encode() for i, _, h in rows}
    out = []
    for i, p in pay.items():
        keeper = max(j for j in pay if pay[j] == p)
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
                    "response" if i == keeper else "revisit", None if i == keeper else keeper))
    return sorted(out)


def test_round_trip(spark):
    got = archive_round_trip(frame(spark, rows_of())).collect()
    assert sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                  for r in got) == expected(rows_of())


def test_chunks_carry_running_digests_and_the_whole_payload(spark):
    rows = rows_of()
    cdx = write_archives(chunk_rows(frame(spark, rows), chunk=1000), shared_path(spark, "w"), archive_bytes=2000)
    assert cdx.select("archive").distinct().count() > 1
    parts = {}
    for r in read_chunks(cdx, chunk=700).collect():
        if r["record_type"] == "response":
            parts.setdefault(r["record"], []).append(r)
    want = {str(i): (h or "").encode() for i, _, h in rows}
    for record, chunks in parts.items():
        chunks.sort(key=lambda r: r["chunk_no"])
        sha, at = hashlib.sha1(), 0
        for k, r in enumerate(chunks):
            assert (r["chunk_no"], r["position"]) == (k, at) and len(r["data"]) == r["n_bytes"] <= 700
            sha.update(r["data"])
            at += r["n_bytes"]
            assert r["running_sha1"] == base32(sha.digest()) and r["is_last"] == (k == len(chunks) - 1)
        assert b"".join(r["data"] for r in chunks) == want[record]


def test_archives_are_read_by_many_tasks(spark):
    rows = [(i, "u", f"page {i} " * 300) for i in range(200)]
    cdx = write_archives(chunk_rows(frame(spark, rows)).repartition(8, "record"), shared_path(spark, "w"))
    for size, tasks in ((64 << 20, 8), (4096, 8)):
        back = read_chunks(cdx, read_bytes=size)
        runs = cdx.selectExpr("archive", f"offset div {size} as no").distinct().count()
        held = back.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(held) == runs >= tasks
        assert sorted(int(r["record"]) for r in back.collect()) == list(range(200))


def test_archives_are_plain_gzip_members_and_the_index_points_at_them(spark):
    cdx = write_archives(chunk_rows(frame(spark, rows_of())), shared_path(spark, "w"))
    for r in cdx.collect():
        store, where = open_store(r["archive"])
        raw = store.open_input_file(where).readall()[r["offset"]:r["offset"] + r["length"]]
        text = gzip.decompress(raw)
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
        assert f"WARC-Record-ID: <urn:record:{r['record']}>".encode() in text
        assert b"\r\nEvil" not in text


def test_damage_is_noticed():
    head = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:1>\r\n"
            b"WARC-Payload-Digest: sha1:%s\r\nX-Payload-Length: 3\r\nContent-Length: 7\r\n\r\nh\r\n\r\n")
    good = gzip.compress(head % base32(hashlib.sha1(b"ab").digest()).encode() + b"ab" + b"\r\n\r\n")
    assert [r[5] for r in stream_records(io.BytesIO(good))] == [2]
    bad = gzip.compress(head % base32(hashlib.sha1(b"xx").digest()).encode() + b"ab" + b"\r\n\r\n")
    with pytest.raises(ValueError, match="digest"):
        list(stream_records(io.BytesIO(bad)))
    with pytest.raises(ValueError, match="ends inside"):
        list(stream_records(io.BytesIO(gzip.compress(gzip.decompress(good)[:-7]))))


def test_repeated_rows_null_ids_and_empty_table(spark):
    got = archive_round_trip(frame(spark, [(1, "u", "a"), (1, "u", "a"), (None, "u", "a"), (None, "u", "b")])).collect()
    assert sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"])) for r in got) == [
        ("1", "response", "None"), ("1", "response", "None"), ("None", "response", "None"),
        ("None", "revisit", "1")]
    alone = archive_round_trip(frame(spark, [(None, "u", "a"), (None, "v", "a")])).collect()
    assert [(r["record_type"], r["refers_to"]) for r in alone] == [("response", None)] * 2
    assert archive_round_trip(frame(spark, [])).count() == 0
