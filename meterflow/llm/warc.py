"""WARC archives of pages: a writer, and a reader that splits compressed archives anywhere.

Each record is a gzip member of its own. The reader cuts files into byte ranges without
any index. A task looks for the gzip magic from its range's start on, takes a place for a
record only if it inflates to a WARC version line, and from there reads record after
record. It owns those that start inside its range, wherever they end.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.common import BATCH_ROWS, stored
from meterflow.llm.files import open_for_reading, open_for_writing
from meterflow.session import scratch_path

#: Payloads shorter than this are stored each time.
LEAST_SHARED = 100
#: Bytes of one range, and tasks at most for the ranges; beyond, a task reads several.
SPLIT_BYTES, MOST_TASKS = 32 << 20, 20_000
READ_BYTES = 1 << 18
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:x-page:"
END = b"\r\n\r\n"


def with_originals(pages: DataFrame) -> DataFrame:
    """`page_id`, `url`, `html` and `original`: the smallest id among rows of an equal payload, if that is long enough."""
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"))
    shared = (
        keyed.filter(F.octet_length("html") >= LEAST_SHARED)
        .groupBy("digest")
        .agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("original").isNotNull())
        .drop("n")
    )
    return keyed.join(shared, "digest", "left").select("page_id", "url", "html", "original")


def _clean(value: str) -> str:
    return "".join(c if c.isprintable() else "?" for c in value)


def record(page_id: int | None, url: str | None, html: str, original: int | None) -> bytes:
    """One record. A page that repeats another's payload becomes a revisit of it, with headers only."""
    payload = html.encode()
    revisit = original is not None and original != page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    header = [
        VERSION.decode(),
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{RECORD_ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_clean(url or '')}",
        f"WARC-Payload-Digest: sha256:{sha256(payload).hexdigest()}",
    ]
    if revisit:
        header += [f"WARC-Refers-To: <{RECORD_ID}{original}>", f"WARC-Profile: {PROFILE}"]
    header += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(header).encode() + END + block + END


MANIFEST = "path string, bytes bigint, records bigint, split_bytes bigint, starts array<int>"


def write_archives(pages: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write every page into archives, one per task; returns the manifest.

    Besides an archive's bytes and records it states how many records start in each range of
    `split_bytes`, so that a reader can tell whether it found them all.

    A null html is an empty payload and a null url an empty target. Rows that repeat an id
    are written each time: those with the smallest id of a payload all as responses. A
    null id is never an original, and revisits one like any other. An empty table gives no
    archive; other columns are ignored.
    """
    folder = scratch_path(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, size, starts = None, None, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, out = open_for_writing(folder, ".warc.gz")
                packer = zlib.compressobj(wbits=31)
                member = packer.compress(record(row["page_id"], row["url"], row["html"], row["original"])) + packer.flush()
                out.write(member)
                starts += [0] * (size // split_bytes + 1 - len(starts))
                starts[-1] += 1
                size += len(member)
        if out is not None:
            out.close()
            starts += [0] * (-(-size // split_bytes) - len(starts))
            entry = {"path": [path], "bytes": [size], "records": [sum(starts)], "split_bytes": [split_bytes]}
            yield pa.RecordBatch.from_pydict(entry | {"starts": pa.array([starts], pa.list_(pa.int32()))})

    return stored(with_originals(pages).mapInArrow(write, MANIFEST), "warc-manifest")


class _Source:
    """A file read forward in pieces, from a place on."""

    def __init__(self, file, at: int):
        self.file, self.at, self.held = file, at, b""  # `held` begins at `at` and ends where the file was read to
        file.seek(at)

    def fill(self) -> bool:
        """Read one more piece; False at the end."""
        more = self.file.read(READ_BYTES)
        self.held += more
        return bool(more)

    def skip(self, n: int) -> None:
        self.held, self.at = self.held[n:], self.at + n

    def find_magic(self, end: int) -> bool:
        """Go to the next magic that starts before `end`."""
        while self.at < end:
            found = self.held.find(MAGIC)
            if found >= 0:
                self.skip(found)
                return self.at < end
            self.skip(max(0, len(self.held) - len(MAGIC) + 1))
            if not self.fill():
                return False
        return False


class NotARecord(Exception):
    pass


def _header_of(unpacked: bytes) -> tuple[dict[str, str], int]:
    """Fields (names in lower case) of a header at the start of some bytes, and its length."""
    end = unpacked.find(END)
    lines = unpacked[:end].decode("utf-8", "replace").split("\r\n")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}, end + len(END)


def _read_record(source: _Source) -> dict:
    """Read the member at the source's place and go past it.

    The payload is hashed while it is inflated, so a record of any length takes one piece
    of memory besides its header. What does not begin with a version line raises NotARecord,
    with the place unchanged; what does is read as a record, however long its header is.
    """
    inflate = zlib.decompressobj(wbits=31)
    start = source.held
    head, packed, place = b"", start, source.at
    # The header first: it decides whether this is a record at all.
    while END not in head:
        try:
            head += inflate.decompress(packed, READ_BYTES)
        except zlib.error as error:
            raise NotARecord from error
        if not (VERSION + b"\r\n").startswith(head[: len(VERSION) + 2]):
            raise NotARecord
        packed = inflate.unconsumed_tail
        if END not in head and not packed:
            if inflate.eof or not (packed := source.file.read(READ_BYTES)):
                source.held = start
                raise NotARecord
            start += packed
            source.held = start
    fields, body = _header_of(head)
    length = int(fields["content-length"])
    http, digest, size, seen = b"", sha256(), 0, 0
    data = head[body:]
    while True:
        data = data[: max(0, length - seen)]
        seen += len(data)
        if http is not None:
            http += data
            if END in http:
                headers, begin = _header_of(http)
                digest.update(http[begin:])
                size += len(http) - begin
                http = None
        else:
            digest.update(data)
            size += len(data)
        if inflate.eof:
            break
        packed = inflate.unconsumed_tail or source.file.read(READ_BYTES)
        if not packed:
            raise ValueError(f"record at {place} is cut off")
        source.held = packed
        data = inflate.decompress(packed, READ_BYTES)
    source.held = inflate.unused_data
    source.at = source.file.tell() - len(source.held)
    return fields | {"http": headers, "payload_digest": digest.hexdigest(), "payload_bytes": size, "block_bytes": seen, "length": length}


def records_in(file, start: int, end: int) -> Iterator[dict]:
    """The records that start in a range of a file."""
    source = _Source(file, start)
    while source.find_magic(end):
        # More than a magic must be at hand to tell a record.
        if len(source.held) < READ_BYTES:
            source.fill()
        at, held = source.at, source.held
        try:
            found = _read_record(source)
        except NotARecord:
            source.held, source.at = max(source.held, held, key=len), at
            source.skip(1)
            continue
        if found["block_bytes"] != found["length"]:
            raise ValueError(f"record at {at}: {found['block_bytes']} bytes of {found['length']}")
        yield found


def _page(found: dict) -> tuple:
    """A record as page id, payload size, digest, type and original; a revisit states what it doesn't hold."""
    kind, digest = found["warc-type"], found["warc-payload-digest"].removeprefix("sha256:")
    own = found["warc-record-id"].strip("<>").removeprefix(RECORD_ID)
    refers = found.get("warc-refers-to", "").strip("<>").removeprefix(RECORD_ID)
    size = found["payload_bytes"]
    if kind == "revisit":
        size = int(found["http"]["content-length"])
    elif digest != found["payload_digest"]:
        raise ValueError(f"page {own}: payload does not have the digest that its header states")
    return int(own) if own else None, size, digest, kind, int(refers) if refers else None


def read_archives(manifest: DataFrame) -> DataFrame:
    """`page_id`, `payload_bytes`, `payload_digest`, `record_type`, `refers_to` of every record in the archives.

    Ranges are dealt out by a number of tasks that grows with them. A range that does not
    hold as many records as the manifest states raises an error.
    """
    ranges = manifest.select("path", "bytes", "split_bytes", F.posexplode("starts").alias("place", "records"))
    number = manifest.agg(F.sum(F.size("starts"))).first()[0] or 1
    dealt = ranges.repartitionByRange(min(number, MOST_TASKS), "path", "place")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.to_pylist():
                begin = task["place"] * task["split_bytes"]
                end = min(begin + task["split_bytes"], task["bytes"])
                with open_for_reading(task["path"]) as file:
                    rows, n = [], 0
                    for found in records_in(file, begin, end):
                        rows.append(_page(found))
                        n += 1
                        if len(rows) == int(BATCH_ROWS):
                            yield _batch(rows)
                            rows = []
                    yield _batch(rows)
                if n != task["records"]:
                    raise ValueError(f"{task['path']} from {begin} on: {n} records of {task['records']}")

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    ddl = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return dealt.mapInArrow(read, ddl)


SQL = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
originals AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS original
    FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN original IS NULL OR original = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN original <> page_id OR page_id IS NULL THEN original END AS refers_to
FROM originals
"""
