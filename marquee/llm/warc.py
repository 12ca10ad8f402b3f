"""WARC: write archives with an index, and read selected records by byte range.

Each task writes its rows as WARC 1.1 records, every record a gzip member of its
own, into archives of bounded size, and yields an index row per record: archive,
offset, length, URL, digest and the row's id. The index is stored as a Parquet
table; archives of lost or repeated task attempts are in no index row and so are
never read. Reading takes the index rows wanted, sorts them by archive and
offset, merges neighbouring byte ranges, and cuts the records out of each range.

Payloads that are equal (SHA-1 and length) and have at least ``min_bytes`` bytes
are written once: the record with the largest id is a ``response``, the others
are ``revisit`` records that refer to it.

Archives are opened with ``pyarrow.fs``, by the URI of the folder, so any store
that pyarrow knows and all executors see will do.

Defined results: null html is an empty payload; a null url is written without a
WARC-Target-URI; a null id is never referred to, its record is a response; rows that
share the largest id and the payload are all responses; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import arrow_map, lookup_join, stored
from marquee.session import scratch_path

ARCHIVE_BYTES = 64 << 20     # an archive is closed once it is this long
RANGE_GAP = 64 << 10         # unread bytes worth reading to save a request
RANGE_BYTES = 8 << 20        # longest merged range (a longer record is its own range)

INDEX = ("page_id long, url string, archive string, offset long, length long, "
         "payload_digest string, record_type string, refers_to long")
RECORDS = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long")


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id, url: str | None, payload: bytes, digest: str, response, date: str) -> bytes:
    """One record, uncompressed. ``response``: the id it revisits, None for a response."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http + (payload if response is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if response is None else 'revisit'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Bytes: {len(payload)}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        # A header is one line: blanks that would end it are percent-encoded.
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if response is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"X-Refers-To-Page-ID: {response}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of an uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[:int(headers["Content-Length"])]
    return headers, body.partition(b"\r\n\r\n")[2]


def _write(batches: Iterator[pa.RecordBatch], folder: str, date: str, level: int) -> Iterator[pa.RecordBatch]:
    fs, root = pafs.FileSystem.from_uri(folder)
    out, name, at = None, "", 0
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if out is None or at >= ARCHIVE_BYTES:
                if out is not None:
                    out.close()
                name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            payload = (r["html"] or "").encode()
            digest = payload_digest(payload)
            member = gzip.compress(_record(r["page_id"], r["url"], payload, digest, r["refers_to"], date), level)
            out.write(member)
            rows.append({"page_id": r["page_id"], "url": r["url"], "archive": name, "offset": at,
                         "length": len(member), "payload_digest": digest,
                         "record_type": "response" if r["refers_to"] is None else "revisit",
                         "refers_to": r["refers_to"]})
            at += len(member)
        yield pa.RecordBatch.from_pylist(rows, schema=_INDEX_ARROW)
    if out is not None:
        out.close()


_INDEX_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("archive", pa.string()),
                          ("offset", pa.int64()), ("length", pa.int64()), ("payload_digest", pa.string()),
                          ("record_type", pa.string()), ("refers_to", pa.int64())])
_RECORDS_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64())])


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) plus refers_to: the response's id, null for responses.

    Groups of equal payloads are found on narrow rows, pre-aggregated before the
    shuffle; only payloads that occur twice or more are joined back.
    """
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", "url", "html", F.unhex(F.sha1(html)).alias("_sha1"),
                         F.octet_length(html).alias("_bytes"))
    groups = (keyed.filter(F.col("_bytes") >= min_bytes).groupBy("_sha1", "_bytes")
              .agg(F.max("page_id").alias("_response"), F.count("*").alias("_n")))
    groups = stored(groups.filter("_n > 1").drop("_n"), "equal-payloads")
    joined = lookup_join(keyed, groups, ["_sha1", "_bytes"])
    return joined.select("page_id", "url", "html", F.when(
        F.col("page_id") < F.col("_response"), F.col("_response")).alias("refers_to"))


def write_archives(pages: DataFrame, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
                   level: int = 6) -> tuple[str, DataFrame]:
    """Write a record per row of ``pages`` (page_id, url, html).

    Returns the archive folder and the stored index. The index is written before
    it is returned: later jobs read it and never write the archives again.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    uri = folder if ":" in folder.split("/")[0] else f"file://{folder}"
    fs, root = pafs.FileSystem.from_uri(uri)
    fs.create_dir(root, recursive=True)
    index = arrow_map(revisits(pages, min_bytes), lambda it: _write(it, uri, date, level), INDEX)
    return uri, stored(index, "warc-index", rebalance=True)


def _ranges(rows: Iterator[dict]) -> Iterator[tuple[int, int, list[dict]]]:
    """Merge index rows of one archive, sorted by offset, into byte ranges."""
    held: list[dict] = []
    start = end = 0
    for r in rows:
        stop = r["offset"] + r["length"]
        if held and (r["offset"] - end > RANGE_GAP or max(stop, end) - start > RANGE_BYTES):
            yield start, end, held
            held = []
        if not held:
            start, end = r["offset"], stop
        held.append(r)
        end = max(end, stop)
    if held:
        yield start, end, held


def _sorted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    from itertools import groupby

    fs, root = pafs.FileSystem.from_uri(folder)
    for archive, rows in groupby(_sorted_rows(batches), key=lambda r: r["archive"]):
        with fs.open_input_file(f"{root}/{archive}") as f:
            for start, end, wanted in _ranges(rows):
                f.seek(start)
                data = f.read(end - start)
                out = []
                for r in wanted:
                    at = r["offset"] - start
                    headers, payload = parse_record(gzip.decompress(data[at:at + r["length"]]))
                    revisit = headers["WARC-Type"] == "revisit"
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and payload_digest(payload) != digest:
                        raise ValueError(f"damaged record at {archive}:{r['offset']}")
                    uri = headers.get("WARC-Target-URI")
                    out.append({
                        "page_id": int(headers["X-Page-ID"]) if "X-Page-ID" in headers else None,
                        "url": uri and uri.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%"),
                        "payload": None if revisit else payload,
                        "payload_bytes": int(headers["X-Payload-Bytes"]), "payload_digest": digest,
                        "record_type": headers["WARC-Type"],
                        "refers_to": int(headers["X-Refers-To-Page-ID"]) if revisit else None})
                yield pa.RecordBatch.from_pylist(out, schema=_RECORDS_ARROW)


def read_records(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """The records of the index rows ``wanted``: ids, headers, and the payload of responses.

    An archive's rows go to one task (an archive has a bounded size), sorted by offset.
    """
    rows = (wanted.select("archive", "offset", "length").repartition("archive")
            .sortWithinPartitions("archive", "offset"))
    return arrow_map(rows, lambda it: _read(it, folder), RECORDS)
