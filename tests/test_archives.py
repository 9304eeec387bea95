import gzip
import os
import subprocess
import sys
import time
import zlib
from pathlib import Path

import pytest

from archive_files import record, write
from cardex.schemas import RECORDS
from cardex.sources import archives, http_encodings

NESTED = (
    b"see:\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: bogus\r\n"
    b"Content-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\nx@nested.org\r\nWARC/\r\nWARC/"
)


def read(spark, paths, **options):
    rows = archives.read_archives(spark, paths, **options).collect()
    return {row.warc_record_id: row for row in rows}


def test_records(spark, tmp_path):
    path = write(
        tmp_path,
        "1",
        "a.warc.gz",
        record(b"about", "info", kind="warcinfo", http=b"", uri=None),
        record(b"asked", "request", kind="request"),
        record(b"one\r\n\r\ntwo\r\n\r\n", "blank"),
        record(b"bad\xff\xfebyte \xef\xbf\xbd \xef\xb7\x90\xff1 end\xe2\x82", "bytes"),
        record("é ünï 🦉".encode(), "utf8", extra="warc-filename: given.warc"),
        record(b"none", "nouri", uri=None),
        record(b"lf", "lf", http=b"HTTP/1.0 200\nA: b\n\n", uri="<http://c.org/>"),
        record(b"dns text", "dns", http=b"", uri="dns:a.org"),
        record(b"", "empty", http=b""),
        record(b"", "head", http=b"HTTP/1.1 204 None\r\n"),
    )
    found = read(spark, path)
    assert {rid: row.content for rid, row in found.items()} == {
        "blank": "one\r\n\r\ntwo\r\n\r\n",
        "bytes": "badbyte � ﷐1 end",
        "utf8": "é ünï 🦉",
        "nouri": "none",
        "lf": "lf",
        "dns": "dns text",
        "empty": "",
        "head": "",
    }
    assert found["nouri"].url is None
    assert found["lf"].url == "http://c.org/"
    assert found["blank"].warc_filename == "a.warc.gz"
    assert found["utf8"].warc_filename == "given.warc"
    assert found["blank"].timestamp == "2024-01-01T00:00:00Z"


def test_schema(spark, tmp_path):
    path = write(tmp_path, "1", "a.warc.gz", record(b"x", "1"))
    df = archives.read_archives(spark, path)
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in RECORDS
    ]


def test_any_bytes_decode_like_python(spark):
    samples = [os.urandom(60) for _ in range(300)]
    samples += [s.decode("utf-8", "replace").encode() + s for s in samples[:100]]
    samples += [b"\xef\xb7\x90\xff0\xef\xbf\xbd", b"\xed\xa0\x80a", b"\xc0\xafb", b"\xf4\x90\x80\x80c"]
    rows = spark.createDataFrame([(bytearray(s),) for s in samples], "body binary")
    found = [r[0] for r in rows.select(archives.decoded(rows.body)).collect()]
    assert found == [s.decode("utf-8", "ignore") for s in samples]


def test_a_boundary_line_in_a_body_does_not_split_it(spark, tmp_path):
    path = write(
        tmp_path, "1", "a.warc.gz", *(record(NESTED, f"r{i}") for i in range(30))
    )
    found = read(spark, path)
    assert len(found) == 30
    assert {row.content for row in found.values()} == {NESTED.decode()}


def test_rejoining_across_batches(spark, tmp_path):
    path = write(
        tmp_path,
        "1",
        "a.warc.gz",
        *(record(NESTED if i % 3 else b"plain", f"r{i}") for i in range(20)),
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        found = read(spark, path)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == 20
    assert found["r1"].content == NESTED.decode()
    assert found["r3"].content == "plain"


def test_a_declared_length_is_taken_at_its_word(spark, tmp_path):
    lie = gzip.decompress(record(b"a", "lie")).replace(b"Length: 45", b"Length: 99999999999")
    assert b"99999999999" in lie
    path = write(tmp_path, "1", "a.warc.gz", gzip.compress(lie), record(b"b@x.org", "next"))
    found = read(spark, path)
    assert set(found) == {"lie"}
    assert found["lie"].content.endswith("\r\n\r\nb@x.org\r\n\r\n")


def test_a_body_may_inflate_to_any_length(spark, tmp_path, monkeypatch):
    head = http("Content-Encoding: deflate")
    body = zlib.compress(b"0" * 1_000_000 + b" a@x.org")
    path = write(
        tmp_path, "1", "a.warc.gz", *(record(body, str(i), http=head) for i in range(4))
    )
    monkeypatch.setattr(archives, "OUTPUT_BYTES", 1_500_000)
    found = read(spark, path).values()
    assert [row.content[-8:] for row in found] == [" a@x.org"] * 4
    assert {len(row.content) for row in found} == {1_000_008}


@pytest.mark.parametrize("kind", ["inflating", "split"])
def test_what_no_value_can_hold_fails_or_is_counted(spark, tmp_path, monkeypatch, kind):
    if kind == "inflating":
        long = record(zlib.compress(b"0" * 1_000_000), "long", http=http("Content-Encoding: deflate"))
    else:
        long = record((b"0" * 200_000 + b"\r\nWARC/1.0\r\n") * 5, "long")
    write(tmp_path, "1", "a.warc.gz", record(b"a", "1"), long, record(NESTED, "2"))
    monkeypatch.setattr(archives, "LONGEST_VALUE", 900_000)
    glob = archives.archive_glob(str(tmp_path), "CRAWL")
    with pytest.raises(Exception, match="exceeds"):
        read(spark, glob)
    assert set(read(spark, glob, skip_long_records=True)) == {"1", "2"}
    listing = archives.list_archives(spark, str(tmp_path), "CRAWL")
    (row,) = archives.archive_report(spark, listing, glob).collect()
    assert (row.responses, row.too_long) == (3, 1)


def test_many_tiny_members_take_linear_time():
    body = gzip.compress(b"") * 500_000 + gzip.compress(b"a@x.org")
    start = time.perf_counter()
    message = http_encodings.undo_encodings(http("Content-Encoding: gzip") + body, 2**31)
    assert message.endswith(b"\r\n\r\na@x.org")
    assert time.perf_counter() - start < 30


def test_executors_need_not_have_the_package(tmp_path):
    path = write(tmp_path, "1", "a.warc.gz", record(gzip.compress(b"x"), "1", http=http("Content-Encoding: gzip")))
    code = (
        f"import sys; sys.path.insert(0, {str(Path(archives.__file__).parents[2])!r})\n"
        "from cardex.session import build_session\n"
        "from cardex.sources.archives import read_archives\n"
        f"print(read_archives(build_session(), {path!r}).first().content)"
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd="/", env=environment, capture_output=True, text=True
    )
    assert done.stdout.strip().endswith("x"), done.stderr[-2000:]


def test_without_rejoining_no_python_runs(spark, tmp_path):
    path = write(tmp_path, "1", "a.warc.gz", record(b"x", "1"), record(b"y", "2"))
    df = archives.read_archives(spark, path, repair=False)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert {r.content for r in df.collect()} == {"x", "y"}


def test_versions(spark, tmp_path):
    path = write(
        tmp_path,
        "1",
        "a.warc.gz",
        *(record(b"x%d" % i, str(i), version=f"1.{i % 2}") for i in range(4)),
    )
    assert {row.content for row in read(spark, path).values()} == {"x0", "x1", "x2", "x3"}


def test_boundaries_at_any_place_of_a_read_buffer(spark, tmp_path):
    # trailers, empty lines and boundaries move across the 64 kB buffers of the reader
    bodies = {str(i): b"x" * (65536 - 2000 + i) + b"\r\n\r\n\r\n" for i in range(120)}
    path = write(
        tmp_path, "1", "a.warc.gz", *(record(b, rid) for rid, b in bodies.items())
    )
    found = read(spark, path, repair=False)
    assert {rid: row.content for rid, row in found.items()} == {
        rid: body.decode() for rid, body in bodies.items()
    }


def test_bad_files_are_skipped(spark, tmp_path):
    whole = record(b"first", "kept") + record(os.urandom(200_000), "cut")
    write(tmp_path, "1", "cut.warc.gz", whole[:-50_000])
    write(tmp_path, "1", "not_gzip.warc.gz", b"plain text")
    write(tmp_path, "1", "good.warc.gz", record(b"good", "good"))
    write(tmp_path, "1", "notes.txt", b"ignored")
    found = read(spark, archives.archive_glob(str(tmp_path), "CRAWL"), skip_bad_files=True)
    assert set(found) == {"kept", "good"}


def listed(spark, root, limit=None):
    files = archives.list_archives(spark, str(root), "CRAWL", limit)
    return [row.path.rsplit("segments/")[1] for row in files.collect()]


@pytest.fixture
def crawl(tmp_path):
    for segment in ("2", "1"):
        for name in ("b.warc.gz", "a.warc.gz", "c.warc", "d.txt.gz"):
            write(tmp_path, segment, name, record(b"x", name))
    write(tmp_path, "1", "z.warc.gz", record(b"x", "z"), crawl="OTHER")
    return tmp_path


def test_listing(spark, crawl):
    every = ["1/warc/a.warc.gz", "1/warc/b.warc.gz", "2/warc/a.warc.gz", "2/warc/b.warc.gz"]
    assert sorted(listed(spark, crawl)) == every
    assert sorted(listed(spark, crawl, 0)) == every
    assert sorted(listed(spark, crawl, 3)) == every[:3]


def test_listing_and_reading_go_into_deeper_folders(spark, crawl):
    deep = crawl / "crawl-data" / "CRAWL" / "segments" / "1" / "warc" / "more" / "levels"
    deep.mkdir(parents=True)
    (deep / "e.warc.gz").write_bytes(record(b"deep", "e"))
    assert "1/warc/more/levels/e.warc.gz" in listed(spark, crawl)
    assert read(spark, archives.archive_glob(str(crawl), "CRAWL"))["e"].content == "deep"


def test_unknown_crawl_has_no_archives(spark, crawl):
    files = archives.list_archives(spark, str(crawl), "UNKNOWN", 3)
    assert files.schema.names == ["path", "length", "modificationTime"]
    assert files.isEmpty()


def test_listing_reads_no_content(spark, crawl):
    files = archives.list_archives(spark, str(crawl), "CRAWL")
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def http(*headers):
    return "\r\n".join(["HTTP/1.1 200 OK", *headers, "", ""]).encode()


def chunked(*parts):
    return b"".join(b"%x;x=y\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def raw_deflate(body):
    stream = zlib.compressobj(wbits=-zlib.MAX_WBITS)
    return stream.compress(body) + stream.flush()


BODY = b"write to a@x.org " * 5000
ENCODED = {
    "gzip": (http("Content-Encoding: gzip"), gzip.compress(BODY), BODY),
    "members": (
        http("content-encoding:GZIP"), gzip.compress(BODY) + gzip.compress(b"b"), BODY + b"b"
    ),
    "deflate": (http("Content-Encoding: deflate"), zlib.compress(BODY), BODY),
    "bare": (http("Content-Encoding: deflate"), raw_deflate(BODY), BODY),
    "chunked": (http("A: b", "Transfer-Encoding: chunked"), chunked(b"one", b"two"), b"onetwo"),
    "both": (
        http("Transfer-Encoding: chunked", "Content-Encoding: gzip"),
        chunked(gzip.compress(BODY)[:50], gzip.compress(BODY)[50:]),
        BODY,
    ),
    "not gzip": (http("Content-Encoding: gzip"), b"plain", b"plain"),
    "not chunked": (http("Transfer-Encoding: chunked"), b"plain", b"plain"),
    "empty": (http("Content-Encoding: gzip"), b"", b""),
    "other": (http("Content-Encoding: identity"), b"plain", b"plain"),
    "no http": (b"Content-Encoding: gzip\r\n\r\n", b"x", b"Content-Encoding: gzip\r\n\r\nx"),
    "renamed": (http("X-Was-Content-Encoding: gzip"), b"plain", b"plain"),
    "in body": (http(), b"\r\nContent-Encoding: gzip\r\n", b"\r\nContent-Encoding: gzip\r\n"),
    "split": (
        http("Content-Encoding: gzip"),
        gzip.compress(NESTED, compresslevel=0),
        NESTED,
    ),
}


def test_http_encodings_are_undone(spark, tmp_path):
    path = write(
        tmp_path,
        "1",
        "a.warc.gz",
        *(record(body, rid, http=head) for rid, (head, body, _) in ENCODED.items()),
    )
    found = read(spark, path)
    assert {rid: row.content for rid, row in found.items()} == {
        rid: plain.decode() for rid, (_, _, plain) in ENCODED.items()
    }


def test_damaged_gzip_body_keeps_its_beginning(spark, tmp_path):
    noise = os.urandom(200_000).hex().encode()
    body = gzip.compress(noise)[:-20_000]
    path = write(
        tmp_path, "1", "a.warc.gz", record(body, "1", http=http("Content-Encoding: gzip"))
    )
    content = read(spark, path)["1"].content
    assert 100_000 < len(content) < 400_000
    assert noise.decode().startswith(content)


def test_report(spark, tmp_path):
    write(
        tmp_path,
        "1",
        "a.warc.gz",
        record(b"x", "info", kind="warcinfo", http=b"", uri=None),
        record(NESTED, "1"),
        record(b"y", "2"),
    )
    cut = gzip.decompress(record(b"z" * 100, "3"))[:-50]
    write(tmp_path, "1", "b.warc.gz", gzip.compress(cut))
    write(tmp_path, "1", "c.warc.gz", b"not gzip")
    report = archives.archive_report(
        spark,
        archives.list_archives(spark, str(tmp_path), "CRAWL"),
        archives.archive_glob(str(tmp_path), "CRAWL"),
    )
    found = {
        r.path.rsplit("/")[-1]: tuple(r[c] for c in archives.REPORTED) for r in report.collect()
    }
    assert found == {
        "a.warc.gz": (2, 1, 0, 0, 0),
        "b.warc.gz": (1, 0, 1, 0, 0),
        "c.warc.gz": (0, 0, 0, 0, 0),
    }


def test_bad_files_fail_the_task(spark, tmp_path):
    path = write(tmp_path, "1", "bad.warc.gz", b"not gzip")
    with pytest.raises(Exception):
        archives.read_archives(spark, path).count()
