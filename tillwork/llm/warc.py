"""WARC archives with an index, and reads of selected records by coalesced byte ranges.

Each writing task fills archives of its own, a gzip member per record, and returns the index: file,
offset, length, URL and digest of every record. The index is a Parquet table; only rows of tasks that
succeeded are in it, so an archive that a lost executor left behind is never read. Reading deals the
selected index rows by file and block, sorts them, and reads neighbouring records in one range.

Archives lie in the shared scratch folder (or one that the caller names) and are opened through
pyarrow's file systems, so the folder may be any that pyarrow has a driver for.

Records with equal payloads: the row with the smallest page_id is the response, others are revisits
that refer to it; payloads below ``least_bytes`` are all responses.

Defined cases: a null html is an empty payload; a null URL leaves its header out; line ends in a URL
are percent-encoded. Null page_ids come after all others. Rows that repeat the response's page_id and
payload are responses too. Extra columns of ``pages`` are not archived. An empty table gives an empty
index and no archive.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.common import landed, map_batches, read_table, record_batch
from tillwork.llm.registry import query
from tillwork.session import scratch_path

ARCHIVE_BYTES = 1 << 28
BLOCK_BYTES = 1 << 25
RANGE_BYTES = 1 << 23
GAP_BYTES = 1 << 16
DATE = "2026-01-01T00:00:00Z"

INDEX = pa.schema(
    [
        ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()),
        ("digest", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
    ]
)
INDEX_DDL = "file string, offset long, length long, url string, digest string, page_id long, record_type string"

RECORD = pa.schema(
    [
        ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_digest", pa.string()), ("url", pa.string()), ("payload", pa.binary()),
    ]
)
RECORD_DDL = (
    "page_id long, record_type string, refers_to long, payload_digest string, url string, payload binary"
)


def base32_sha1(payload: bytes) -> str:
    return b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def make_record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields += [("WARC-Profile", profile), ("WARC-Refers-To", _record_id(refers_to, digest))]
        if refers_to is not None:
            fields.append(("X-Refers-To-Page", str(refers_to)))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """A record's fields and payload; a response's payload must have the digest it states."""
    record = zlib.decompress(data, 31)
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    if fields["WARC-Type"] == "response" and fields["WARC-Payload-Digest"] != f"sha1:{base32_sha1(payload)}":
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
    return fields, payload


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        out, name, offset = None, "", 0
        try:
            for batch in batches:
                index = []
                for row in batch.to_pylist():
                    if out is None or offset >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{top}/{name}", compression=None)
                    payload = row["payload"]
                    digest = base32_sha1(payload)
                    revisit = row["revisit"]
                    data = make_record(
                        row["page_id"], row["url"], payload, digest, row["head"], revisit
                    )
                    out.write(data)
                    kind = "revisit" if revisit else "response"
                    index.append((name, offset, len(data), row["url"], digest, row["page_id"], kind))
                    offset += len(data)
                if index:
                    yield record_batch(INDEX, *zip(*index))
        finally:
            if out is not None:
                out.close()

    return write


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Archive every page under ``folder``; the index of the records."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    first = F.min(F.struct(F.col("page_id").isNull().alias("n"), F.col("page_id").alias("id")))
    heads = rows.groupBy("sha").agg(first.alias("first")).select("sha", F.col("first.id").alias("head"))
    together = rows.join(landed(heads, "warc-heads"), "sha").withColumn(
        "revisit",
        (F.octet_length("payload") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("head")),
    )
    records = together.select("page_id", "url", "payload", "head", "revisit")
    return landed(map_batches(records, _writer(folder), INDEX_DDL), "warc-index")


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        for batch in batches:
            rows = list(
                zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")))
            )
            start = 0
            while start < len(rows):
                # Neighbours in the file, as long as gaps and the range as a whole stay small.
                name, first, length = rows[start]
                stop, end = start + 1, first + length
                while (
                    stop < len(rows)
                    and rows[stop][0] == name
                    and 0 <= rows[stop][1] - end <= GAP_BYTES
                    and rows[stop][1] + rows[stop][2] - first <= RANGE_BYTES
                ):
                    end = rows[stop][1] + rows[stop][2]
                    stop += 1
                with store.open_input_file(f"{top}/{name}") as file:
                    data = file.read_at(end - first, first)
                yield record_batch(
                    RECORD, *zip(*(_row(data[o - first : o - first + n]) for _, o, n in rows[start:stop]))
                )
                start = stop

    return read


def _row(data: bytes) -> tuple:
    fields, payload = parse_record(data)
    number = lambda name: int(fields[name]) if name in fields else None
    return (
        number("X-Page-ID"),
        fields["WARC-Type"],
        number("X-Refers-To-Page"),
        fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        fields.get("WARC-Target-URI"),
        payload if fields["WARC-Type"] == "response" else None,
    )


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of the index rows, which may be any selection of an index. A revisit has no
    payload of its own.

    Index rows are small and what they point to is not, so the number of tasks follows from the bytes
    to be read, one for some BLOCK_BYTES; a task gets neighbouring blocks of the archives.
    """
    wanted = index.select("file", "offset", "length")
    tasks = -(-(wanted.agg(F.sum("length")).first()[0] or 1) // BLOCK_BYTES)
    block = F.floor(F.col("offset") / BLOCK_BYTES)
    dealt = wanted.repartitionByRange(tasks, "file", block)
    return map_batches(dealt.sortWithinPartitions("file", "offset"), _reader(folder), RECORD_DDL)


def _base32_sql(digest: str) -> str:
    """Upper-case base32 of a hexadecimal SHA-1: five digits are four characters."""
    five = f"('0x' || substr({digest}, 5 * (i // 4)::INT + 1, 5))::INT"
    digit = f"({five} >> (15 - 5 * (i % 4))::INT) & 31"
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return (
        f"array_to_string(list_transform(range(32), lambda i: substr('{alphabet}', 1 + ({digit})::INT, 1)), '')"
    )


SQL = f"""
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS p FROM pages),
heads AS (SELECT *, sha1(p) AS d, min(page_id) OVER (PARTITION BY p) AS head FROM payloads)
SELECT page_id, octet_length(p)::BIGINT AS payload_bytes, {_base32_sql("d")} AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> head THEN head END AS refers_to
FROM heads
"""


@query(SQL)
def op2_warc(spark, sf_dir):
    """Every page written to archives and read back; a revisit's payload is its response's."""
    folder = scratch_path(spark, "warc")
    index = write_archives(read_table(spark, sf_dir, "pages"), folder)
    records = read_records(index, folder).select(
        "page_id", "record_type", "refers_to", "payload_digest",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )
    records = landed(records, "warc-records")
    sizes = (
        records.where("record_type = 'response'")
        .groupBy("payload_digest")
        .agg(F.max("payload_bytes").alias("full_bytes"))
    )
    return records.join(sizes, "payload_digest").select(
        "page_id", F.col("full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
