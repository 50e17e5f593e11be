"""WARC: archives by the format, index against plain search, revisits, odd rows."""

import gzip
import hashlib
import io

import pyarrow.fs as fs
import pytest
from pyspark.sql import functions as F

from staylens.llm import warc as W
from staylens.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string"


def by_definition(rows, least=1000):
    keeper = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least and page is not None:
            keeper[data] = max(keeper.get(data, page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        best = keeper.get(data)
        again = best is not None and page != best
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", best if again else None))
    return sorted(out, key=repr)


def digests(found):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect()), key=repr)


def copies(n=400):
    body = ["<p>" + "a" * 1200, "<p>é" + "b" * 997, "<p>" + "c" * 996, "", None]
    hosts = ["http://www.example.com/", "https://example.com:8080/x?y=1#z", "HTTP://user:pw@A.Example.org", "http://net/", "no scheme", ""]
    return [(i, hosts[i % 6] + (str(i) if i % 3 == 0 else ""), body[i % 5] if i % 7 else f"own {i} " * 200) for i in range(n)]


@pytest.fixture(scope="module")
def archive(spark):
    return W.write(spark.createDataFrame(copies(), SCHEMA).repartition(3), archive_bytes=20_000, block_lines=7)


def test_copies_revisit_the_largest_id(spark, archive):
    pages = spark.createDataFrame(copies(), SCHEMA)
    found = W.read(archive, pages)
    assert digests(found) == by_definition(copies())
    html = {p: (h or "").encode() for p, _, h in copies()}
    assert all(bytes(r.payload) == html[r.page_id] for r in found.collect())


def test_archives_are_warc_files(archive):
    files, root = W._store_of(archive.folder)
    names = [f.base_name for f in files.get_file_info(fs.FileSelector(root)) if f.base_name.endswith(".warc.gz")]
    assert len(names) > 3  # archives end at their size
    records = 0
    for name in names:
        with files.open_input_file(f"{root}/{name}") as source:
            whole = io.BytesIO(gzip.decompress(source.read()))
        while line := whole.readline():
            assert line == b"WARC/1.1\r\n"
            headers = {}
            while (line := whole.readline()) != b"\r\n":
                key, value = line.decode().rstrip("\r\n").split(": ", 1)
                headers[key] = value
            block = whole.read(int(headers["Content-Length"]))
            assert whole.read(4) == b"\r\n\r\n"
            if headers["WARC-Type"] == "response":
                payload = block.split(b"\r\n\r\n", 1)[1]
                assert headers["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(payload).hexdigest()
                assert f"Content-Length: {len(payload)}".encode() in block
            records += headers["WARC-Type"] != "warcinfo"
    assert records == len(copies())


def test_index_finds_what_a_plain_search_finds(archive):
    lines = [tuple(r) for r in archive.lines.collect()]
    directory = archive.directory.value
    assert len(directory) >= len(lines) // 7 and directory == sorted(directory)
    index = W._Index(archive.folder, directory)
    for key, page, *_ in lines:
        assert sorted(map(tuple, index.find(key, page))) == sorted(x for x in lines if x[:2] == (key, page))
    for key, page in (("", -1), ("zzz", 1), ("com,example)/", 10**9), ("com,example,www)/", None)):
        assert list(index.find(key, page)) == []


def test_some_pages_with_responses_not_asked_for(spark, archive):
    rows = copies()
    pages = spark.createDataFrame(rows, SCHEMA).where("page_id < 40")
    assert digests(W.read(archive, pages)) == [r for r in by_definition(rows) if r[0] < 40]


def test_keys(spark):
    urls = ["http://www.Example.org:80/a?b", "https://u:p@h.net", "x://h/p://q", "plain", None, "http://a.b/" + "x" * 300, "ht tp://a.b/\r\nc", "ht%20tp://a.b/%0D%0Ac"]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i long, u string")
    keys = [r.k for r in rows.select("i", W.capture_key(F.col("u"), F.col("i")).alias("k")).orderBy("i").collect()]
    assert keys[:5] == ["org,example,www:80)/a?b", "net,h)", "h)/p://q", "plain", "urn:page:4"]
    assert keys[5].startswith("b,a)/xxx") and len(keys[5]) == W.KEY_CHARS + 41
    assert keys[6] == keys[7] == "b,a)/c"


def test_odd_rows(spark):
    big = "z" * 2000
    rows = [
        (None, None, None), (None, "http://n/", big), (1, "http://n/", big), (1, "http://n/", big), (1, "http://m/", big), (0, "http://n/\r\nX: y", big),
        (5, "urn:x", "é" * 1_000_000), (6, "http://" + "h" * 5000 + "/", "\r\n\r\n" * 300), (7, "http://q/", "WARC/1.1\r\n\r\n" * 100), (None, None, "w" * 1500),
        (None, "http://w/", "w" * 1500), (-3, "http://neg/", "\x00" * 1200), (-4, "http://neg/", "\x00" * 1200),
    ]
    pages = spark.createDataFrame(rows, SCHEMA).withColumns({"key": F.lit("k"), "payload": F.lit(1), "offset": F.lit(2)})
    assert digests(W.read(W.write(pages), pages)) == by_definition(rows)
    none = pages.limit(0)
    assert W.read(W.write(none), none).count() == 0


def test_shuffled_groups_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(W, "BROADCAST_BYTES", 0)
    pages = spark.createDataFrame(copies(), SCHEMA)
    assert digests(W.read(W.write(pages), pages, with_payload=False)) == by_definition(copies())


def test_pages_of_a_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert digests(QUERIES["op12_warc"](spark, sf)) == by_definition(rows)
