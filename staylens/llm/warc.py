"""WARC archives with a two-level capture index.

Writing.  Each task writes its pages as gzip members into archives of about
``ARCHIVE_BYTES``, each under a name of its own attempt, and returns one line per record:
key, page, archive, offset, length.  The lines are stored as a table, so a line always names
the archive of the attempt that made it; files of lost attempts are never referred to.
Among pages of equal payload of at least ``least`` bytes the one of largest id is a response
and the others are revisits without payload.

Index.  The key of a capture is its URL with the host reversed (``org,example)/path``).
Lines are range-partitioned and sorted by (key, page), cut into compressed blocks, and one
directory entry per block keeps the block's first (key, page) and place.  A key longer than
``KEY_CHARS`` characters is cut there and ends in a digest of the whole.  A table of n
captures has blocks of ``max(BLOCK_LINES, n / MAX_BLOCKS)`` lines, so the directory has at
most ``MAX_BLOCKS`` entries beside one for each index file.  It alone is sent to all tasks:
65,536 entries of at most 300 characters of key and 90 of place are below 30 MB.

Reading.  Wanted (key, page) pairs are sorted like the index; each is found by binary search
in the directory, then in the block.  What is found is sorted by archive and offset, and
neighbouring ranges are read together.  Files are reached through ``pyarrow.fs``, so the
folder may be any store that executors share.

Cases: null html is an empty payload; a null url is written as ``urn:page:<page id>``;
control characters in a url are percent-encoded in the record's header; rows that share an
id and a payload are all responses if the id is the payload's largest; a null id is below
all others and refers to, but is never referred to; without any id all are responses;
repeated rows give a record each; an empty table gives an empty archive; other columns of
the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.session import checkpoint_dir

from .common import arrow_batches, store

LEAST_BYTES = 1000
ARCHIVE_BYTES = 1 << 30
BLOCK_LINES = 1000
MAX_BLOCKS = 1 << 16
KEY_CHARS = 256
# Neighbouring records of one archive are read together up to this size.
READ_BYTES = 8 << 20
# Groups of equal payloads are broadcast up to this size, counted before.
BROADCAST_BYTES = 16 << 20
BATCH_ROWS = 256
DATE = "2000-01-01T00:00:00Z"

_LINE_NAMES = ["key", "page_id", "archive", "offset", "length"]
_LINES = "key string, page_id long, archive string, offset long, length long"
_BLOCKS = "first_key string, first_page long, file string, offset long, length long"
_CAPTURES = (
    "page_id long, url string, record_type string, refers_to long, refers_to_url string, payload_bytes long, "
    "payload_digest string, told_digest string, payload binary"
)
_CONTROL = re.compile("[\x00-\x20\x7f]")


@dataclass
class Archive:
    """Archives of one write and their index."""

    folder: str
    lines: DataFrame  # one row per record: key, page_id, archive, offset, length
    directory: Broadcast  # sorted (first (key, page), file, offset, length) of all index blocks


def _store_of(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder


def capture_key(url: Column, page: Column) -> Column:
    """``http://www.example.org:80/a?b`` as ``org,example,www:80)/a?b``: captures of one host
    and of its subdomains are neighbours in sort order.  Control characters count for nothing,
    percent-encoded or not, so a record's own URL has the key of the page's."""
    url = F.regexp_replace(url, r"[\x00-\x20\x7F]|%[01][0-9A-F]|%20|%7F", "")
    rest = F.regexp_replace(url, "^[^:/?#]*://", "")
    authority = F.regexp_extract(rest, "^[^/?#]*", 0)
    host = F.lower(F.regexp_extract(authority, "^(?:.*@)?([^@:]*)(:[0-9]*)?$", 1))
    port = F.regexp_extract(authority, "(:[0-9]*)$", 1)
    turned = F.array_join(F.reverse(F.split(host, "[.]")), ",")
    key = F.concat(turned, port, F.lit(")"), F.substr(rest, F.length(authority) + 1))
    unnamed = F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("")))
    whole = F.when(url.contains("://"), key).otherwise(F.coalesce(url, unnamed))
    cut = F.concat(F.substring(whole, 1, KEY_CHARS), F.lit("#"), F.sha1(whole))
    return F.when(F.length(whole) > KEY_CHARS, cut).otherwise(whole)


# ---- writing ---------------------------------------------------------------------------------
def _decided(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int) -> DataFrame:
    """(key, page_id, url, payload, digest, refers_to): ``refers_to`` set for revisits."""
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    page, url = F.col(id_col).cast("long"), F.col(url_col).cast("string")
    rows = pages.select(page.alias("page_id"), url.alias("url"), capture_key(url, page).alias("key"), payload.alias("payload"))
    rows = rows.withColumn("same", F.when(F.octet_length("payload") >= least, F.sha2("payload", 256)))
    groups = rows.where("same IS NOT NULL").groupBy("same").agg(  # a null page is below all others
        F.max(F.struct("page_id", "url")).alias("keeper"), F.count("*").alias("n")
    )
    groups = groups.where("n > 1 AND keeper.page_id IS NOT NULL")
    groups = store(groups.select("same", F.col("keeper.page_id").alias("keeper"), F.col("keeper.url").alias("keeper_url")), "warc-groups")
    # Two ways to one result; the broadcast one, only for few groups, moves no payload.
    weight = groups.agg(F.sum(F.lit(150) + F.octet_length(F.coalesce("keeper_url", F.lit(""))))).first()[0] or 0
    side = F.broadcast(groups) if weight <= BROADCAST_BYTES else groups
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return rows.join(side, "same", "left").select(
        "key", "page_id", "url", "payload", F.sha1("payload").alias("digest"), F.when(revisit, F.col("keeper")).alias("refers_to"),
        F.when(revisit, F.col("keeper_url")).alias("refers_to_url"),
    )


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _named(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def _target(page: int | None, url: str | None) -> str:
    return _named(page)[1:-1] if url is None else _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)


def _capture(
    page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None = None, refers_to_url: str | None = None
) -> bytes:
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _named(page)), ("WARC-Date", DATE),
        ("WARC-Target-URI", _target(page, url)), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response"),
    ]
    if refers_to is not None:
        headers += [
            ("WARC-Refers-To", _named(refers_to)), ("WARC-Refers-To-Target-URI", _target(refers_to, refers_to_url)),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _record(headers, http + (payload if refers_to is None else b""))


def _write_archives(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    files, root = _store_of(folder)
    out, name, at = None, "", 0
    for batch in batches:
        lines = []
        for row in batch.to_pylist():
            if out is not None and at >= archive_bytes:
                out.close()
                out = None
            if out is None:
                name = f"pages-{uuid.uuid4().hex}.warc.gz"
                out = files.open_output_stream(f"{root}/{name}", compression=None)
                info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{name}>"), ("WARC-Date", DATE)]
                head = _member(_record([*info, ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                out.write(head)
                at = len(head)
            data = _member(_capture(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"], row["refers_to_url"]))
            out.write(data)
            lines.append((row["key"], row["page_id"], name, at, len(data)))
            at += len(data)
        columns = list(zip(*lines, strict=True)) or [()] * 5
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_LINE_NAMES)
    if out is not None:
        out.close()


# ---- index -----------------------------------------------------------------------------------
def _place(key: str, page: int | None) -> tuple[str, bool, int]:
    """Sort order of captures, the one Spark has: by code points, null pages first."""
    return key, page is not None, page or 0


def _write_index(batches: Iterator[pa.RecordBatch], folder: str, block_lines: int) -> Iterator[pa.RecordBatch]:
    files, root = _store_of(folder)
    name, at, out, held = f"index-{uuid.uuid4().hex}.cdx.gz", 0, None, []
    entries = []

    def flush() -> None:
        nonlocal at, out, held
        if out is None:
            out = files.open_output_stream(f"{root}/{name}", compression=None)
        data = _member("".join(json.dumps(line, ensure_ascii=False) + "\n" for line in held).encode())
        out.write(data)
        entries.append((held[0][0], held[0][1], name, at, len(data)))
        at, held = at + len(data), []

    for batch in batches:
        for line in zip(*(batch.column(c).to_pylist() for c in _LINE_NAMES), strict=True):
            held.append(line)
            if len(held) >= block_lines:
                flush()
    if held:
        flush()
    if out is not None:
        out.close()
    columns = list(zip(*entries, strict=True)) or [()] * 5
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["first_key", "first_page", "file", "offset", "length"]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def write(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: int = LEAST_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    block_lines: int = BLOCK_LINES,
) -> Archive:
    """Write ``pages`` as WARC archives with their index into ``folder`` (a new one under the
    shared checkpoint folder if none is named)."""
    spark = pages.sparkSession
    arrow_batches(spark, BATCH_ROWS)
    folder = folder or f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    files, root = _store_of(folder)
    files.create_dir(root, recursive=True)
    made = _decided(pages, id_col, url_col, html_col, least).mapInArrow(lambda it: _write_archives(it, folder, archive_bytes), _LINES)
    lines = store(made, "warc-lines")
    per_block = max(block_lines, -(-lines.count() // MAX_BLOCKS))
    order = ["key", "page_id", "archive", "offset"]  # the last two spread captures of one page
    blocks = lines.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(lambda it: _write_index(it, folder, per_block), _BLOCKS)
    directory = sorted(
        (_place(b.first_key, b.first_page), b.file, b.offset, b.length) for b in store(blocks, "warc-directory").collect()
    )  # at most MAX_BLOCKS entries and one per index file
    return Archive(folder, lines, spark.sparkContext.broadcast(directory))


# ---- reading ---------------------------------------------------------------------------------
class _Index:
    """Binary search in the directory, then in a block; keeps the block it read last."""

    def __init__(self, folder: str, directory: list[tuple]) -> None:
        self.files, self.root = _store_of(folder)
        self.directory = directory
        self.firsts = [entry[0] for entry in directory]
        self.at, self.lines, self.places = -1, [], []

    def _read(self, at: int) -> None:
        if at != self.at:
            _, file, offset, length = self.directory[at]
            with self.files.open_input_file(f"{self.root}/{file}") as source:
                data = zlib.decompress(source.read_at(length, offset), 31)
            self.lines = [json.loads(line) for line in data.split(b"\n")[:-1]]
            self.places = [_place(line[0], line[1]) for line in self.lines]
            self.at = at

    def find(self, key: str, page: int | None) -> Iterator[list]:
        """The lines of all captures of ``page`` under ``key``."""
        wanted = _place(key, page)
        at = max(0, bisect_left(self.firsts, wanted) - 1)
        while at < len(self.firsts) and self.firsts[at] <= wanted:
            self._read(at)
            i = bisect_left(self.places, wanted)
            while i < len(self.places) and self.places[i] == wanted:
                yield self.lines[i]
                i += 1
            at += 1


def _look_up(batches: Iterator[pa.RecordBatch], folder: str, directory: Broadcast) -> Iterator[pa.RecordBatch]:
    index = None
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    for batch in batches:
        index = index or _Index(folder, directory.value)
        wanted = zip(batch.column("key").to_pylist(), batch.column("page_id").to_pylist(), strict=True)
        lines = [line for key, page in wanted for line in index.find(key, page)]
        columns = list(zip(*lines, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_LINE_NAMES)


def parse(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(headers, HTTP head, payload) of one uncompressed record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return headers, http, payload


def _page_of(name: str) -> int | None:
    number = name[len("<urn:page:") : -1]
    return int(number) if number else None


def _ranges(rows: Iterator[tuple], read_bytes: int) -> Iterator[list[tuple]]:
    """Runs of (archive, offset, length) that lie next to each other."""
    run: list[tuple] = []
    for row in rows:
        if run and (row[0] != run[-1][0] or row[1] != run[-1][1] + run[-1][2] or row[1] + row[2] - run[0][1] > read_bytes):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def _read_records(batches: Iterator[pa.RecordBatch], folder: str, with_payload: bool) -> Iterator[pa.RecordBatch]:
    files, root = _store_of(folder)
    name, source = None, None
    kinds = [pa.int64(), *[pa.string()] * 2, pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 2, pa.binary()]
    names = [c.split()[0] for c in _CAPTURES.split(", ")]
    for batch in batches:
        places = zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True)
        for run in _ranges(places, READ_BYTES):
            if run[0][0] != name:
                if source is not None:
                    source.close()
                name = run[0][0]
                source = files.open_input_file(f"{root}/{name}")
            begin = run[0][1]
            data = source.read_at(run[-1][1] + run[-1][2] - begin, begin)
            rows = []
            for _, offset, length in run:
                headers, _, payload = parse(zlib.decompress(data[offset - begin : offset - begin + length], 31))
                kind = headers["WARC-Type"]
                read = kind == "response"
                rows.append((
                    _page_of(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], kind,
                    None if read else _page_of(headers["WARC-Refers-To"]), headers.get("WARC-Refers-To-Target-URI"),
                    len(payload) if read else None,
                    hashlib.sha1(payload).hexdigest() if read else None, headers["WARC-Payload-Digest"].removeprefix("sha1:"),
                    payload if read and with_payload else None,
                ))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
    if source is not None:
        source.close()


def read(archive: Archive, wanted: DataFrame, id_col: str = "page_id", url_col: str = "url", with_payload: bool = True) -> DataFrame:
    """The captures of the pages ``wanted`` (their ids and urls), found through the index:
    page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload.

    Revisits take size, digest and payload from the response that they refer to, which is
    read from the archives too; a digest that differs from the record's header is an error.
    """
    arrow_batches(wanted.sparkSession, BATCH_ROWS)
    folder, directory = archive.folder, archive.directory
    page = F.col(id_col).cast("long")
    keys = wanted.select(capture_key(F.col(url_col).cast("string"), page).alias("key"), page.alias("page_id")).distinct()

    def fetched(keys: DataFrame, whole: bool) -> DataFrame:
        near = keys.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
        places = near.mapInArrow(lambda it: _look_up(it, folder, directory), _LINES).select("archive", "offset", "length")
        places = places.repartitionByRange("archive", "offset").sortWithinPartitions("archive", "offset")
        found = places.mapInArrow(lambda it: _read_records(it, folder, whole), _CAPTURES)
        wrong = F.concat(F.lit("payload of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(" differs from its digest"))
        sound = (F.col("record_type") == "revisit") | (F.col("payload_digest") == F.col("told_digest"))
        return store(found.withColumn("told_digest", F.when(sound, F.col("told_digest")).otherwise(F.raise_error(wrong))), "warc-captures")

    found = fetched(keys, with_payload)
    revisits = found.where("record_type = 'revisit'").select("page_id", "url", "record_type", "refers_to", "refers_to_url", "told_digest")
    referred = revisits.select(
        capture_key(F.col("refers_to_url"), F.col("refers_to")).alias("key"), F.col("refers_to").alias("page_id")
    ).distinct()
    # Responses that are referred to but were not asked for are looked up as well.
    others = fetched(referred.join(keys, ["key", "page_id"], "left_anti"), with_payload)
    bodies = found.unionByName(others).where("record_type = 'response'").join(referred, "page_id", "left_semi")
    bodies = bodies.select(F.col("page_id").alias("refers_to"), "told_digest", "payload_bytes", "payload").dropDuplicates(["refers_to", "told_digest"])
    full = revisits.join(bodies, ["refers_to", "told_digest"], "left")
    columns = ["page_id", "url", "record_type", "refers_to", "payload_bytes", F.col("told_digest").alias("payload_digest"), "payload"]
    return found.where("record_type = 'response'").select(columns).unionByName(full.select(columns))
