"""WARC archives of web pages, and a two-level capture index over them.

Archives are plain WARC files in a shared folder, written and read by Spark.  A payload
of at least ``REVISIT_BYTES`` that an earlier page has as well is written as a revisit
of it.  Every task cuts its records into archives of about ``ARCHIVE_BYTES``, so an archive
can be read as one value.

The index sorts captures by URL key (host reversed), then archive and place, into blocks
of ``LINES`` compressed lines.  A sparse directory has one row per block.  Requests are a
table; tasks answer them by binary search in the shards' bounds, in the directory of the
shards they need, and in the blocks; then only the records' bytes are read.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib
from typing import Callable
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import scratch_path, stable

REVISIT_BYTES = 100
ARCHIVE_BYTES = 8 << 20
LINES = 512
READ_BYTES = 64 << 20
END = "\r\n\r\n"
CAPTURES = ("key string, url string, page_id bigint, record_type string, payload_bytes bigint, payload_digest string, "
            "refers_to bigint, archive string, offset bigint, length bigint")
_FIELDS = [c.split()[0] for c in CAPTURES.split(", ")]
_WHOLE = {"page_id", "payload_bytes", "refers_to", "offset", "length"}
_TYPES = [pa.int64() if f in _WHOLE else pa.string() for f in _FIELDS]


def clean_url(url: str) -> str:
    """``url`` with blanks, controls, backslashes and non-ASCII percent-encoded, as a header line needs."""
    return re.sub(r"[^\x21-\x5b\x5d-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


def url_key(url: str | None) -> str:
    """Host reversed, port and case aside, then path and query: ``com,example)/a?b``.  Null: empty."""
    if url is None:
        return ""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", clean_url(url))
    host, path = re.match(r"([^/?#]*)(.*)", rest, re.S).groups()
    host = host.rpartition("@")[2].partition(":")[0].lower()
    return ",".join(reversed(host.split("."))) + ")" + (path if path[:1] == "/" else "/" + path)


def _payload(html: str) -> Column:
    return F.coalesce(F.col(html), F.lit(""))


def with_types(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """key, url, html with payload_bytes, payload_digest, record_type and refers_to.

    Of equal payloads of at least 100 bytes the row with the smallest key is the response;
    rows with that same key are responses too, rows with a null key revisit it.
    """
    body = _payload(html)
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col("url"), body.alias("html"),
                        F.octet_length(body).cast("long").alias("payload_bytes"), F.sha2(body.cast("binary"), 256).alias("payload_digest"))
    narrow = pages.select(F.col(key).cast("long").alias("page_id"), body.alias("html")).filter(F.octet_length("html") >= REVISIT_BYTES)
    first = narrow.groupBy(F.sha2(F.col("html").cast("binary"), 256).alias("payload_digest")).agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # Written, so that its measured size decides whether the pages have to be shuffled.
    first = stable(first.filter("n > 1 and first is not null").select("payload_digest", "first"))
    rows = rows.join(first, "payload_digest", "left")
    again = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") != F.col("first"))) & (F.col("payload_bytes") >= REVISIT_BYTES)
    return rows.select("page_id", "url", "html", "payload_bytes", "payload_digest",
                       F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"))


def _record(page_id, url, html, size, digest, kind, refers_to, date) -> str:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http + (html if kind == "response" else "")
    head = [f"WARC/1.1\r\nWARC-Type: {kind}"]
    if url is not None:
        head.append("WARC-Target-URI: " + clean_url(url))
    head.append(f"WARC-Date: {date}")
    head.append(f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>")
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(http) + (size if kind == 'response' else 0)}")
    return "\r\n".join(head) + "\r\n\r\n" + block


def write(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as WARC archives under ``path``.

    A null html is an empty payload; a null url has no target line.  Other columns are left out.
    """
    def records(batches):
        archive = filled = 0
        for batch in batches:
            out, numbers = [], []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                record = _record(*row, date)
                out.append(record)
                numbers.append(archive)
                filled += len(record) + row[3]
                if filled >= archive_bytes:
                    archive, filled = archive + 1, 0
            for low in range(0, len(out), 256):
                yield pa.RecordBatch.from_arrays([pa.array(out[low:low + 256], pa.string()), pa.array(numbers[low:low + 256], pa.int32())], names=["value", "archive"])

    lines = with_types(pages).mapInArrow(records, "value string, archive int")
    lines.write.partitionBy("archive").option("lineSep", END).text(path)


def parse(data: bytes):
    """(offset, length, headers, block) of every record of an archive; lengths rule, whatever the payloads hold."""
    at = 0
    while at < len(data):
        cut = data.index(b"\r\n\r\n", at)
        lines = data[at:cut].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at byte {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        start = cut + 4
        stop = start + int(headers["Content-Length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it should")
        yield at, stop + 4 - at, headers, data[start:stop]
        at = stop + 4


def capture(archive: str, offset: int, length: int, headers: dict, block: bytes) -> tuple:
    """One line of the index; a response's digest and length are taken from its payload and checked."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"the payload at byte {offset} of {archive} is damaged")
    number = lambda name: int(x) if (x := re.sub(r"^<urn:page:|>$", "", headers.get(name, ""))) else None
    url = headers.get("WARC-Target-URI")
    return (url_key(url), url, number("WARC-Record-ID"), kind, size, digest, number("WARC-Refers-To"), archive, offset, length)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path`` as a capture: key, page, payload, archive, offset, length."""
    def captures(batches):
        for batch in batches:
            for archive, content in zip(*(batch.column(k) for k in (0, 1))):
                rows = [capture(archive.as_py(), *r) for r in parse(content.as_buffer().to_pybytes())]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_FIELDS)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    return files.select("path", "content").mapInArrow(captures, CAPTURES)


def build_index(captures: DataFrame, path: str, lines: int = LINES) -> None:
    """Write the index under ``path``: ``blocks`` by shard, and ``directory``.

    A shard is one range of the sorted captures; keys that very many captures share are
    split over shards by archive and offset.  Also right without any capture.
    """
    def pack(batches):
        from pyspark import TaskContext

        shard, block, rows = TaskContext.get().partitionId(), 0, []

        def flush(part):
            text = "\n".join("\t".join("\\N" if v is None else str(v).replace("\t", "%09").replace("\n", "%0A") for v in r) for r in part)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([part[0][0]]), pa.array([part[-1][0]]),
                 pa.array([len(part)], pa.int64()), pa.array([zlib.compress(text.encode(), 6)], pa.binary())],
                names=["shard", "block", "first_key", "last_key", "lines", "data"])

        for batch in batches:
            rows += zip(*(c.to_pylist() for c in batch.columns))
            while len(rows) >= lines:
                yield flush(rows[:lines])
                rows, block = rows[lines:], block + 1
        if rows:
            yield flush(rows)

    ordered = captures.repartitionByRange("key", "archive", "offset").sortWithinPartitions("key", "archive", "offset")
    blocks = ordered.mapInArrow(pack, "shard int, block int, first_key string, last_key string, lines bigint, data binary")
    blocks.write.partitionBy("shard").parquet(f"{path}/blocks")
    made = captures.sparkSession.read.schema(blocks.schema).parquet(f"{path}/blocks")
    made.select("shard", "block", "first_key", "last_key", "lines").write.partitionBy("shard").parquet(f"{path}/directory")


def _lines(data: bytes) -> list[tuple]:
    rows = [line.split("\t") for line in zlib.decompress(data).decode().split("\n")]
    return [tuple(None if v == "\\N" else int(v) if f in _WHOLE else v for f, v in zip(_FIELDS, r)) for r in rows]


def _tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    base = "shard int, block int, first_key string, last_key string, lines bigint"
    return spark.read.schema(base + ", data binary").parquet(f"{path}/blocks"), spark.read.schema(base).parquet(f"{path}/directory")


def all_captures(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the index."""
    def unpack(batches):
        for batch in batches:
            for data in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*_lines(data.as_py())), _TYPES)], names=_FIELDS)

    return _tables(spark, path)[0].select("data").mapInArrow(unpack, CAPTURES)


def _covering(firsts: list, ranges: list, key: str) -> list:
    """The sorted (first, last, ...) ranges that hold ``key``; ranges follow each other and share only their edges."""
    at, held = bisect.bisect_right(firsts, key) - 1, []
    while at >= 0 and ranges[at][1] >= key:
        held.append(ranges[at])
        at -= 1
    return held


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The store that holds ``uri`` and the path in it, for reads inside tasks: local, hdfs, s3, gs and abfs addresses."""
    scheme, colon, rest = uri.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else uri).lstrip("/")
    return fs.FileSystem.from_uri(scheme.replace("s3a", "s3") + ":" + quote(rest, safe="/:@"))


def find(requests: DataFrame, path: str, url: str = "url", store: Callable = open_store) -> DataFrame:
    """The index's captures of the URLs in ``requests``, each capture once however often its URL is asked for.

    Tasks search the shards' bounds (one pair a shard, sent along), then the directory of the
    shards their keys fall in, then the blocks, which meet their keys in a join; so only keys and
    hit blocks are shuffled.  A URL that very many captures share lies in many blocks, and these
    are spread over tasks.  Unknown URLs have no rows.  A null URL asks for captures without one.
    """
    spark = requests.sparkSession
    blocks, directory = _tables(spark, path)
    bounds = sorted((r["low"], r["high"], r["shard"]) for r in
                    directory.groupBy("shard").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high")).collect())
    bounds.sort(key=lambda r: (r[0], r[2]))
    lows, folder = [r[0] for r in bounds], f"{path}/directory"

    def to_shards(batches):
        for batch in batches:
            rows = [(r[2], key) for key in {url_key(u) for u in batch.column(0).to_pylist()} for r in _covering(lows, bounds, key)]
            if rows:
                shards, keys = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(keys, pa.string())], names=["shard", "key"])

    def to_blocks(batches):
        held, firsts, ranges = None, [], []
        for batch in batches:
            asked: dict[tuple, list] = {}
            for shard, key in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != held:
                    place, at = store(f"{folder}/shard={shard}")
                    files = [f.path for f in place.get_file_info(fs.FileSelector(at)) if f.path.endswith(".parquet")]
                    columns = [pq.ParquetFile(place.open_input_file(f)).read(["first_key", "last_key", "block"]) for f in files]
                    ranges = sorted((r for t in columns for r in zip(*(c.to_pylist() for c in t.columns))), key=lambda r: (r[0], r[2]))
                    held, firsts = shard, [r[0] for r in ranges]
                for r in _covering(firsts, ranges, key):
                    asked.setdefault((shard, r[2]), []).append(key)
            if asked:
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in asked], pa.int32()), pa.array([b for _, b in asked], pa.int32()),
                                                  pa.array(list(asked.values()), pa.list_(pa.string()))], names=["shard", "block", "keys"])

    def to_captures(batches):
        for batch in batches:
            for asked, data in zip(*(batch.column(k) for k in (0, 1))):
                lines, rows = _lines(data.as_py()), []
                names = [x[0] for x in lines]
                for key in asked.as_py():
                    low = bisect.bisect_left(names, key)
                    rows += lines[low:bisect.bisect_right(names, key, low)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_FIELDS)

    # Distinct before the sort, so a URL asked for very often is one row; sorted, so a task meets few shards.
    asked = requests.select(url).distinct().mapInArrow(to_shards, "shard int, key string").distinct()
    asked = asked.repartitionByRange("shard", "key").sortWithinPartitions("shard", "key").mapInArrow(to_blocks, "shard int, block int, keys array<string>")
    hit = asked.join(blocks.select("shard", "block", "data"), ["shard", "block"])
    return hit.select("keys", "data").mapInArrow(to_captures, CAPTURES)


def search(requests: DataFrame, path: str, url: str = "url", payload: bool = True, store: Callable = open_store) -> DataFrame:
    """``find``, and then each capture's record by a range read of its archive, checked against its line of the index.

    ``payload`` adds the stored bytes (null for a revisit, whose response holds them).  Reads are dealt
    by archive and offset into tasks of about ``READ_BYTES``, whatever the archives' sizes.
    """
    found = stable(find(requests, path, url, store))
    total = found.agg(F.sum("length")).first()[0] or 0

    def records(batches):
        place, source, opened = None, None, None
        for batch in batches:
            rows, filled = [], 0
            for line in zip(*(c.to_pylist() for c in batch.columns)):
                archive, offset, length = line[-3:]
                if archive != opened:
                    if source is not None:
                        source.close()
                    place, at = store(archive)
                    source, opened = place.open_input_file(at), archive
                _, size, headers, block = next(parse(source.read_at(length, offset)))
                got = capture(archive, offset, size, headers, block)
                if got != line:
                    raise ValueError(f"the record at byte {offset} of {archive} is not the one indexed")
                rows.append((*got, block.partition(END.encode())[2] if payload and got[3] == "response" else None))
                filled += length
                if filled >= READ_BYTES // 8:
                    yield made(rows)
                    rows, filled = [], 0
            if rows:
                yield made(rows)
        if source is not None:
            source.close()

    def made(rows):
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), [*_TYPES, pa.binary()])]
        return pa.RecordBatch.from_arrays(columns, names=[*_FIELDS, "payload"])

    dealt = found.repartitionByRange(1 + total // READ_BYTES, "archive", "offset").sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(records, CAPTURES + ", payload binary")


def lookup(spark: SparkSession, path: str, urls: list[str]) -> list[tuple]:
    """``find`` for a few URLs at hand: their captures by request, archive and offset, as a list."""
    held: dict[str, list] = {}
    for row in find(spark.createDataFrame([(u,) for u in urls], "url string"), path).collect():
        held.setdefault(row["key"], []).append(tuple(row))
    return [c for u in urls for c in sorted(held.get(url_key(u), []), key=lambda c: c[-3:-1])]


def fetch(spark: SparkSession, found: tuple) -> bytes:
    """The block of one capture, by a range read of its archive in whatever store holds it."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(found[-3])
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        stream.seek(found[-2])
        data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, found[-1]))
    finally:
        stream.close()
    return next(parse(data))[3]


def round_trip(pages: DataFrame, label: str = "warc") -> DataFrame:
    """Archive ``pages``, index the archives, and search the index for the URLs of all pages.

    Every row is a record that was found through the directory and read from its archive by range.
    """
    spark = pages.sparkSession
    base = scratch_path(spark, label)
    write(pages, f"{base}/archives")
    build_index(read(spark, f"{base}/archives"), f"{base}/index")
    return search(pages, f"{base}/index", payload=False)
