"""WARC archives with revisit records for payloads that are there already.

Headers alone are shuffled by payload digest to find the response that a
duplicate revisits. The archives then hold each payload once: a revisit has
fresh headers that name the response, and no payload. Reading parses records and
resolves revisits by joining them to their responses.

Spark writes and reads the files, in any store it can reach. A text row is one
record, and the line separator is the pair of line ends that closes a record.
Files are gzip streams of ``RECORDS_PER_FILE`` records at most.
"""

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeseries.llm.stores import stored

RECORDS_PER_FILE = 500
LINE = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_BASE32_OF_CONV = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
_ARCHIVE = (
    "page_id long, url string, record_type string, payload_digest string, refers_to long, "
    "payload_bytes long, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """Base32 SHA-1: 160 bits are four times 40 bits, each eight base32 digits."""
    digest = F.upper(F.sha1(payload.cast("binary")))
    parts = [
        F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(F.concat(*parts), *_BASE32_OF_CONV)


def revisits(heads: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id``, ``payload_digest``, ``refers_to`` of the records that revisit another.

    ``heads`` has ``page_id``, ``payload_digest``, ``payload_bytes``. Of equal
    payloads of at least ``min_bytes`` the greatest id is the response.
    """
    candidates = heads.where((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    response = candidates.groupBy("payload_digest").agg(
        F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")
    )
    response = response.where("least < refers_to").drop("least")
    return (
        candidates.join(response, "payload_digest")
        .where("page_id < refers_to")
        .select("page_id", "payload_digest", "refers_to")
        .distinct()
    )


def _record(date: str) -> Column:
    """The text of a record, without the separator that closes it."""
    response = F.col("refers_to").isNull()
    id_text = F.coalesce(F.col("page_id").cast("string"), F.lit("unknown"))
    url = F.translate(F.coalesce(F.col("url"), F.lit("")), "\r\n", "  ")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.col("payload_bytes"), F.lit(LINE + LINE),
    )
    block = F.octet_length(http) + F.when(response, F.col("payload_bytes")).otherwise(0)
    head = F.concat(
        F.lit(f"WARC/1.1{LINE}WARC-Type: "), F.when(response, "response").otherwise("revisit"),
        F.lit(f"{LINE}WARC-Record-ID: <urn:page:"), id_text,
        F.lit(f">{LINE}WARC-Date: {date}{LINE}WARC-Target-URI: "), url,
        F.lit(f"{LINE}WARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(response, "").otherwise(
            F.concat(F.lit(f"{LINE}WARC-Profile: {PROFILE}{LINE}WARC-Refers-To: <urn:page:"),
                     F.col("refers_to"), F.lit(">"))),
        F.lit(f"{LINE}Content-Type: application/http; msgtype=response{LINE}Content-Length: "),
        block, F.lit(LINE + LINE),
    )
    return F.concat(head, http, F.when(response, F.col("payload")).otherwise(""))


def write_archives(
    pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", min_bytes: int = 0
) -> None:
    """Write ``pages`` (``page_id``, ``url``, ``html``) as deduplicated archives.

    The payload is ``html`` in UTF-8; null counts as empty. A page without an id
    is a response of its own. Rows with the id of a response and its payload are
    responses too. A null url is empty; line ends in a url become spaces. Other
    columns of ``pages`` are not written.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        base32_sha1(payload).alias("payload_digest"),
    )
    found = revisits(full.select("page_id", "payload_digest", "payload_bytes"), min_bytes)
    records = full.join(found, ["page_id", "payload_digest"], "left").select(
        _record(date).alias("value")
    )
    records.write.option("lineSep", LINE + LINE).option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS_PER_FILE
    ).text(path)


def _members(content: bytes) -> bytes:
    """The bytes of all compressed members of a file, one after another.

    Archives may have a member per record or one for all; zero bytes after the
    last member are padding.
    """
    out, rest = [], content
    while rest.strip(b"\0"):
        member = zlib.decompressobj(wbits=47)
        out.append(member.decompress(rest))
        if not member.eof:
            raise ValueError("a compressed member is not complete")
        rest = member.unused_data
    return b"".join(out)


def parse_archive(content: bytes) -> Iterator[dict]:
    """The records of one archive, of all its members.

    A payload must have the digest of its header. A file that is cut off, or that
    holds anything else, is an error.
    """
    data = _members(content)
    at = 0
    while at < len(data):
        body = data.index(b"\r\n\r\n", at) + 4
        lines = data[at : body - 4].decode().split(LINE)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        end = body + int(head["Content-Length"])
        start = data.index(b"\r\n\r\n", body, end) + 4
        payload = data[start:end]
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        whole = head["WARC-Type"] == "response"
        if whole and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"digest of {head['WARC-Record-ID']} does not fit its payload")
        yield {
            "page_id": _page(head["WARC-Record-ID"]), "url": head["WARC-Target-URI"],
            "record_type": head["WARC-Type"], "payload_digest": digest,
            "refers_to": _page(head.get("WARC-Refers-To", "")),
            "payload_bytes": len(payload) if whole else None,
            "payload": payload if whole else None,
        }
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is not closed")
        at = end + 4


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records as they are stored; ``payload`` is null for revisits, or not wanted."""
    files = spark.read.format("binaryFile").load(path).select("content")
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
         ("payload_digest", pa.string()), ("refers_to", pa.int64()),
         ("payload_bytes", pa.int64()), ("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = list(parse_archive(content.as_py()))
                if not payloads:
                    rows = [r | {"payload": None} for r in rows]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return files.mapInArrow(run, _ARCHIVE)


def resolved(records: DataFrame) -> DataFrame:
    """Records with revisits given the payload length of the response they refer to."""
    heads = stored(records.drop("payload"), "records")
    of = heads.where("record_type = 'response' and page_id is not null").groupBy(
        F.col("page_id").alias("refers_to"), "payload_digest"
    ).agg(F.max("payload_bytes").alias("full"))
    again = heads.where("record_type = 'revisit'").join(of, ["refers_to", "payload_digest"], "left")
    columns = [c for c in heads.columns if c != "payload_bytes"]
    return heads.where("record_type = 'response'").select(*columns, "payload_bytes").unionByName(
        again.select(*columns, F.col("full").alias("payload_bytes"))
    )
