import base64
import collections
import gzip
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lakeseries.llm.stores import fresh_path
from lakeseries.llm.warc import parse_archive, read_archives, resolved, write_archives


def expected(rows, min_bytes=0):
    groups = collections.defaultdict(set)
    for page, _, html in rows:
        if page is not None:
            groups[html or ""].add(page)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        best = max(groups[html or ""], default=None)
        first = page is None or page == best or len(body) < min_bytes
        out.append((page, len(body), digest, "response" if first else "revisit", None if first else best))
    return sorted(out, key=repr)


def written(spark, rows, min_bytes=0, extra=()):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in extra:
        pages = pages.withColumn(name, F.lit("clash"))
    path = fresh_path(spark, "archives")
    write_archives(pages, path, min_bytes=min_bytes)
    return path


def derived(spark, path):
    rows = resolved(read_archives(spark, path)).collect()
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    return sorted(found, key=repr)


ROWS = [
    (1, "http://a/", "<p>one</p>"), (9, "http://b/", "<p>one</p>"), (4, None, "<p>one</p>"),
    (2, "http://c/\r\nWARC-Type: x", None), (3, "", ""), (-5, "http://d/", "é\r\n\r\nWARC/1.1\r\n\r\n"),
    (6, "http://e/", "é\r\n\r\nWARC/1.1\r\n\r\n"), (7, "http://f/", "only: one"), (None, "http://g/", "<p>one</p>"),
    (8, "http://h/", "x" * 200_000), (8, "http://h/", "x" * 200_000), (8, "http://h/", "other"),
]


@pytest.mark.parametrize("min_bytes", [0, 1, 11])
def test_revisits(spark, min_bytes):
    path = written(spark, ROWS, min_bytes, extra=("payload", "refers_to", "value"))
    assert derived(spark, path) == expected(ROWS, min_bytes)


def test_payloads_and_headers_come_back(spark):
    path = written(spark, ROWS)
    rows = read_archives(spark, path).collect()
    whole = sorted(bytes(r.payload) for r in rows if r.record_type == "response")
    first = [x for x in expected(ROWS) if x[3] == "response"]
    assert len(whole) == len(first)
    assert {hashlib.sha1(x).digest() for x in whole} == {base64.b32decode(x[2]) for x in first}
    assert all(r.payload is None for r in rows if r.record_type == "revisit")
    assert {r.url for r in rows if r.page_id == 2} == {"http://c/  WARC-Type: x"}


def test_many_copies_of_one_page(spark):
    rows = [(i, f"http://x/{i}", "same" if i % 3 else f"own {i}") for i in range(600)]
    assert derived(spark, written(spark, rows)) == expected(rows)


def test_an_empty_table(spark):
    assert derived(spark, written(spark, [])) == []


def test_broken_archives_are_errors(spark):
    path = written(spark, ROWS[:2])
    files = spark.read.format("binaryFile").load(path).collect()
    data = b"".join(zlib.decompress(bytes(f.content), wbits=47) for f in files)
    assert len(list(parse_archive(zlib.compress(data)))) == 2
    with pytest.raises(ValueError):
        list(parse_archive(zlib.compress(data.replace(b"<p>one", b"<p>two"))))
    with pytest.raises(ValueError):
        list(parse_archive(zlib.compress(data[:-6])))


def test_archives_with_a_member_per_record(spark, tmp_path):
    path = written(spark, ROWS)
    files = spark.read.format("binaryFile").load(path).collect()
    data = b"".join(zlib.decompress(bytes(f.content), wbits=47) for f in files)
    records, at = [], 0
    while at < len(data):
        body = data.index(b"\r\n\r\n", at) + 4
        size = next(x for x in data[at:body].split(b"\r\n") if x.startswith(b"Content-Length: "))
        end = body + int(size[16:]) + 4
        records.append(data[at:end])
        at = end
    assert len(records) == len(ROWS)
    members = b"".join(gzip.compress(x) for x in records)
    (tmp_path / "members.warc.gz").write_bytes(members + bytes(512))
    assert derived(spark, str(tmp_path)) == expected(ROWS)
    for broken in (members[:-30], members + b"more"):
        with pytest.raises((ValueError, zlib.error)):
            list(parse_archive(broken))
