import gzip
import io
import os
import random
import zlib
from collections import Counter
from hashlib import sha256

import duckdb
import pandas as pd
import pytest

from meterflow.llm import warc
from meterflow.llm.common import prepare

SCHEMA = "page_id bigint, url string, html string, digest string, original bigint, path string, bytes bigint"


@pytest.fixture
def pages(spark):
    prepare(spark)

    def build(rows):
        return spark.createDataFrame([(*row, "d", 1, "p", 2) for row in rows], SCHEMA)

    return build


ROWS = [
    (1, "http://a/1", None),
    (2, None, ""),
    (3, "bad\r\nWARC-Type: revisit", "é" * 50),
    (4, "u", "x" * 99),
    (5, "u", "x" * 99),
    (9, "u", "y" * 100),
    (7, "u", "y" * 100),
    (8, "u", "y" * 100),
    (8, "u", "y" * 100),
    (11, "u", "é" * 50),
    (10, "u", "WARC/1.1\r\n\r\n" + "z" * 3_000_000),
    (12, "u", "WARC/1.1\r\n\r\n" + "z" * 3_000_000),
]


def test_round_trip_same_as_sql(pages):
    found = warc.read_archives(warc.write_archives(pages(ROWS), split_bytes=100)).collect()
    frame = pd.DataFrame(ROWS, columns=["page_id", "url", "html"])
    connection = duckdb.connect()
    connection.register("pages", frame)
    assert Counter(map(tuple, found)) == Counter(map(tuple, connection.execute(warc.SQL).fetchall()))


def test_null_ids(pages):
    rows = [(None, "u", "q" * 200), (None, "u", "q" * 200), (3, "u", "w" * 200), (None, "u", "w" * 200)]
    found = warc.read_archives(warc.write_archives(pages(rows))).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in found) == Counter(
        [(None, "response", None), (None, "response", None), (3, "response", None), (None, "revisit", 3)]
    )
    assert warc.read_archives(warc.write_archives(pages([]).limit(0))).count() == 0


def test_archives_are_plain_gzip_members(pages):
    manifest = warc.write_archives(pages(ROWS)).collect()
    text = b"".join(gzip.open(row.path).read() for row in manifest)
    assert text.count(b"\r\nWARC-Record-ID: <urn:x-page:") == len(ROWS) == sum(row.records for row in manifest)
    assert sum(os.path.getsize(row.path) for row in manifest) == sum(row.bytes for row in manifest)


@pytest.mark.parametrize("read_bytes", [50, 4096, 1 << 18])
@pytest.mark.parametrize("split", [997, 30_011, 1 << 30])
def test_every_record_is_owned_once(monkeypatch, read_bytes, split):
    monkeypatch.setattr(warc, "READ_BYTES", read_bytes)
    rng = random.Random(split)
    data, expected = b"", []
    for i in range(60):
        html = rng.randbytes(rng.choice([0, 10, 3000])).hex() + "<p>" * rng.choice([0, 5000])
        packer = zlib.compressobj(rng.choice([0, 6]), wbits=31)
        data += packer.compress(warc.record(i, "u", html, None)) + packer.flush()
        expected.append((i, len(html), sha256(html.encode()).hexdigest(), "response", None))
    found = [
        warc._page(record)
        for begin in range(0, len(data), split)
        for record in warc.records_in(io.BytesIO(data), begin, min(begin + split, len(data)))
    ]
    assert found == expected


def test_magic_inside_a_record_is_no_record():
    """A stored block shows the bytes of its content, here those of gzip members that hold no WARC header."""
    inner = gzip.compress(b"no record") + warc.MAGIC + b"\x00" * 20
    packer = zlib.compressobj(0, wbits=31)
    http = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(inner)
    digest = sha256(inner).hexdigest()
    header = (
        f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:1>\r\nWARC-Payload-Digest: sha256:{digest}\r\n"
        f"Content-Length: {len(http) + len(inner)}\r\n\r\n"
    ).encode()
    data = packer.compress(header + http + inner + b"\r\n\r\n") + packer.flush()
    for split in (10, 50, len(data)):
        found = [r for b in range(0, len(data), split) for r in warc.records_in(io.BytesIO(data), b, min(b + split, len(data)))]
        assert [warc._page(r) for r in found] == [(1, len(inner), digest, "response", None)]


def test_damage_is_reported():
    packer = zlib.compressobj(wbits=31)
    data = packer.compress(warc.record(1, "u", os.urandom(40_000).hex(), None)) + packer.flush()
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records_in(io.BytesIO(data[:-5000]), 0, len(data)))


def tasks_with_rows(df):
    from pyspark.sql import functions as F

    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_ranges_are_read_by_many_tasks(pages):
    rows = [(i, "u", random.Random(i).randbytes(1500).hex()) for i in range(400)]
    manifest = warc.write_archives(pages(rows), split_bytes=16_000)
    ranges = sum(len(row.starts) for row in manifest.collect())
    found = warc.read_archives(manifest)
    assert ranges > 30 and tasks_with_rows(found) >= ranges / 2
    assert Counter(r.page_id for r in found.collect()) == Counter(range(400))


def test_header_of_any_length(pages):
    rows = [(1, "u", "a" * 200), (2, "x" * 2_000_000, "b" * 200), (3, "u", "c" * 200)]
    for split in (100, 1 << 20):
        found = warc.read_archives(warc.write_archives(pages(rows).coalesce(1), split_bytes=split)).collect()
        assert sorted((r.page_id, r.payload_bytes) for r in found) == [(1, 200), (2, 200), (3, 200)]


def test_missing_records_are_reported(pages):
    from pyspark.sql import functions as F

    manifest = warc.write_archives(pages(ROWS).coalesce(1))
    claimed = manifest.withColumn("starts", F.transform("starts", lambda n: n + 1))
    with pytest.raises(Exception, match="records of"):
        warc.read_archives(claimed).collect()
