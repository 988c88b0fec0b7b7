"""WARC archives of pages, with a two-level capture index.

Writing: one record per page, ``response`` or ``revisit`` (a payload seen at a smaller page_id),
made by DataFrame expressions and written by Spark's text writer with the record separator as the
line separator, so the part files are plain WARC files on any store that Spark writes.

Index: the archives are scanned for record offsets; captures sorted by reversed-host URL key are
packed into compressed blocks, and a sparse directory keeps the first key of each block.  A look-up
binary-searches the directory, then the block, and reads the records by (file, offset, length).
The directory has a bounded number of entries: blocks get longer as the archive grows.

Reading: files are opened by pyarrow's file systems (local and shared folders, S3, HDFS where its client
is installed), so only ranges travel.  The scan for offsets reads headers and skips over what follows them.
To fetch records, the offsets of one file are gathered (a file has at most ``records_per_file`` records),
neighbouring ranges are read together up to ``READ_BYTES``, and each record's digest is taken from the
payload that was read.

Defined cases: a null html is an empty payload; a null url is written as an empty target; a null
page_id has no id header and never counts as the smallest; equal rows are written as often as they
come, and if their page_id is the smallest of their payload, each is a response; empty tables give
an archive without records; other columns are ignored.  Line breaks and ``%`` in urls are
percent-encoded in the header and decoded when read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import checked_broadcast, staged
from ledgerline.session import scratch_path

SEPARATOR = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 2000
BLOCK_LINES = 3000
MAX_DIRECTORY = 500_000
READ_BYTES = 4 << 20  # most bytes of neighbouring records that are read together
HEADER_BYTES = 1 << 12

CAPTURE_SCHEMA = "key string, file string, offset long, length long, record_type string"
RECORD_SCHEMA = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of a 160-bit hex digest: every five hex digits are four base32 digits."""
    out = []
    for part in range(8):
        value = F.conv(F.substring(digest, 5 * part + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            digit = F.shiftright(value, shift).bitwiseAND(31)
            out.append(F.substring(F.lit(BASE32), digit + 1, F.lit(1)))
    return F.concat(*out)


def capture_key(url: Column) -> Column:
    """Reversed-host key: ``http://a.example.org/x?y`` -> ``org,example,a)/x?y``; fragments go."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)^.*?://|#.*$", "")
    host = F.lower(F.regexp_extract(rest, r"^[^/?]*", 0))
    path = F.regexp_extract(rest, r"(?s)^[^/?]*(.*)$", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)


def record_text(pages: DataFrame) -> Column:
    """A whole WARC record without its closing separator; ``pages`` has page_id, url, html, digest,
    payload_bytes and refers_to (null: a response)."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    page_id = F.col("page_id").cast("string")
    refers = F.col("refers_to").cast("string")
    url = F.coalesce(F.col("url"), F.lit(""))
    for plain, code in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A")):
        url = F.replace(url, F.lit(plain), F.lit(code))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(SEPARATOR),
    )
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    return F.concat(
        F.lit("WARC/1.0\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.when(page_id.isNotNull(), F.concat(line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page_id, F.lit(">"))))).otherwise(F.lit("")),
        F.when(revisit, line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), refers, F.lit(">")))).otherwise(F.lit("")),
        line("WARC-Target-URI", url),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def write_archive(pages: DataFrame, path: str, min_revisit_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """One record per page; of equal payloads of at least ``min_revisit_bytes`` bytes, the one with
    the smallest page_id is the response and the others revisit it."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    digests = rows.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn("sha1", F.sha1("html"))
    firsts = (
        digests.where(F.col("payload_bytes") >= min_revisit_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first_id is not null")
        .select("sha1", "first_id")
    )
    firsts = checked_broadcast(staged(firsts, "warc_firsts"))
    other = ~F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull()
    records = (
        digests.join(firsts, "sha1", "left")
        .withColumn("refers_to", F.when(other, F.col("first_id")))
        .withColumn("digest", base32_of_hex(F.col("sha1")))
    )
    records.select(record_text(records).alias("value")).write.option("lineSep", SEPARATOR).option(
        "maxRecordsPerFile", records_per_file
    ).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """file: the archive's part files (their contents are not read)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.col("path").alias("file"))


def _open(file: str) -> pa.NativeFile:
    store, path = pa.fs.FileSystem.from_uri(file)
    return store.open_input_file(path)


def _header(data: bytes, start: int) -> tuple[dict[str, str], int]:
    """Fields of the record that starts at ``start``, and where its block starts."""
    end = data.index(b"\r\n\r\n", start)
    lines = data[start:end].decode("utf-8").split("\r\n")
    return dict(x.split(": ", 1) for x in lines[1:]), end + 4


def _headers(source: pa.NativeFile) -> Iterator[tuple[dict[str, str], int, int]]:
    """Fields, offset and length of every record; of what follows a header, no more is read than came with it."""
    size, at, held, begin = source.size(), 0, b"", 0
    while at < size:
        want = HEADER_BYTES
        while at < begin or held.find(b"\r\n\r\n", at - begin) < 0:
            if begin <= at and at - begin + want <= len(held):
                want *= 2  # a header that long
            source.seek(at)
            held, begin = source.read(want), at
            if len(held) < want and held.find(b"\r\n\r\n") < 0:
                raise ValueError(f"no record at {at} of {size} bytes")
        fields, block = _header(held, at - begin)
        end = begin + block + int(fields["Content-Length"])
        yield fields, at, end - at
        at = end + len(SEPARATOR)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file in batch["file"].to_pylist():
            with _open(file) as source:
                out = [(fields["WARC-Target-URI"], file, at, length, fields["WARC-Type"]) for fields, at, length in _headers(source)]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["url", "file", "offset", "length", "record_type"]
            )


def _decoded_url(url: Column) -> Column:
    for code, plain in (("%0A", "\n"), ("%0D", "\r"), ("%25", "%")):
        url = F.replace(url, F.lit(code), F.lit(plain))
    return url


class CaptureIndex:
    """Sorted capture blocks (``blocks``: block, first, last, n, data) and their sparse directory."""

    def __init__(self, blocks: DataFrame):
        self.blocks = blocks
        rows = blocks.select("first", "last", "block").collect()  # at most MAX_DIRECTORY and one per range
        self.directory = sorted((r["first"], r["last"], r["block"]) for r in rows)

    def captures(self) -> DataFrame:
        """Every capture, in key order within its block."""
        return self.blocks.select("data").mapInArrow(_unpack, CAPTURE_SCHEMA)

    def lookup(self, urls: DataFrame) -> DataFrame:
        """Captures of the urls (column ``url``): directory, then block, both by binary search."""
        directory = self.blocks.sparkSession.sparkContext.broadcast(self.directory)

        def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lasts = [x[1] for x in directory.value]
            for batch in batches:
                out = []
                for key in batch["key"].to_pylist():
                    i = bisect.bisect_left(lasts, key)
                    while i < len(lasts) and directory.value[i][0] <= key:
                        out.append((key, directory.value[i][2]))
                        i += 1
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64())], ["key", "block"])

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for keys, data in zip(batch["keys"].to_pylist(), batch["data"], strict=True):
                    lines = _lines(data.as_py())
                    names, out = [x[0] for x in lines], []
                    for key in keys:
                        out += lines[bisect.bisect_left(names, key) : bisect.bisect_right(names, key)]
                    yield _capture_batch(out)

        wanted = urls.select(capture_key(F.col("url")).alias("key")).distinct().mapInArrow(seek, "key string, block long")
        asked = wanted.groupBy("block").agg(F.collect_set("key").alias("keys"))  # bounded by the keys of a block
        return asked.join(self.blocks, "block").select("keys", "data").mapInArrow(find, CAPTURE_SCHEMA)


def _lines(data: bytes) -> list[tuple]:
    rows = [x.split("\t") for x in zlib.decompress(data).decode("utf-8").split("\n")]
    return [(_plain(k), f, int(o), int(n), t) for k, f, o, n, t in rows]


def _escaped(key: str) -> str:
    return key.replace("\\", "\\\\").replace("\t", "\\t").replace("\n", "\\n")


def _plain(key: str) -> str:
    return key.replace("\\\\", "\0").replace("\\t", "\t").replace("\\n", "\n").replace("\0", "\\") if "\\" in key else key


def _capture_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["key", "file", "offset", "length", "record_type"])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch["data"].to_pylist():
            yield _capture_batch(_lines(data))


def build_index(spark: SparkSession, path: str, block_lines: int = BLOCK_LINES) -> CaptureIndex:
    """Scan the archives of ``path`` and index every record."""
    scanned = _files(spark, path).mapInArrow(_scan, "url string, file string, offset long, length long, record_type string")
    found = staged(scanned.select(capture_key(_decoded_url(F.col("url"))).alias("key"), "file", "offset", "length", "record_type"), "warc_captures")
    lines = max(block_lines, -(-found.count() // MAX_DIRECTORY))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        part, made = 0, 0

        def block() -> pa.RecordBatch:
            text = "\n".join("\t".join((_escaped(x[0]), x[1], str(x[2]), str(x[3]), x[4])) for x in held[:lines])
            row = [[(part << 32) + made], [held[0][0]], [held[: lines][-1][0]], [len(held[:lines])], [zlib.compress(text.encode("utf-8"))]]
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, kinds, strict=True)], ["block", "first", "last", "n", "data"])

        for batch in batches:
            if batch.num_rows:
                part = batch["part"][0].as_py()
            held += zip(*(batch[c].to_pylist() for c in ("key", "file", "offset", "length", "record_type")), strict=True)
            while len(held) >= lines:
                yield block()
                held, made = held[lines:], made + 1
        if held:
            yield block()

    ordered = found.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    blocks = ordered.withColumn("part", F.spark_partition_id()).mapInArrow(pack, "block long, first string, last string, n long, data binary")
    return CaptureIndex(staged(blocks, "warc_blocks"))


def fetch(captures: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of ``captures`` (file, offset, length), each read from its file by its range and parsed.
    Digests and sizes of responses come from the payload as read; of revisits, whose payload is not
    in the record, from its headers."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, ranges in zip(batch["file"].to_pylist(), batch["ranges"].to_pylist(), strict=True):
                with _open(file) as source:
                    for records in _ranges(source, sorted((r["offset"], r["length"]) for r in ranges)):
                        cols = list(zip(*(_record(r, with_payload) for r in records), strict=True))
                        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    ranges = captures.groupBy("file").agg(F.collect_list(F.struct("offset", "length")).alias("ranges"))  # one file's records
    return ranges.mapInArrow(cut, RECORD_SCHEMA)


def _ranges(source: pa.NativeFile, ranges: list[tuple[int, int]]) -> Iterator[list[bytes]]:
    """The bytes of the ranges, in order; neighbours are one read of at most ``READ_BYTES`` (or one record)."""
    at = 0
    while at < len(ranges):
        begin, stop = ranges[at][0], at + 1
        while stop < len(ranges) and sum(ranges[stop]) - begin <= READ_BYTES and ranges[stop][0] - sum(ranges[stop - 1]) <= HEADER_BYTES:
            stop += 1
        source.seek(begin)
        data = source.read(sum(ranges[stop - 1]) - begin)
        yield [data[offset - begin : offset - begin + length] for offset, length in ranges[at:stop]]
        at = stop


def _record(record: bytes, with_payload: bool) -> tuple:
    fields, block = _header(record, 0)
    http_end = record.index(b"\r\n\r\n", block) + 4
    http = dict(x.split(": ", 1) for x in record[block : http_end - 4].decode("utf-8").split("\r\n")[1:])
    urn = lambda name: int(fields[name][len("<urn:page:") : -1]) if name in fields else None
    url = fields["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    if fields["WARC-Type"] == "revisit":
        return urn("WARC-Record-ID"), url, "revisit", urn("WARC-Refers-To"), int(http["Content-Length"]), fields["WARC-Payload-Digest"][5:], None
    payload = record[http_end:]
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")
    return urn("WARC-Record-ID"), url, "response", None, len(payload), digest, payload if with_payload else None


def archive_round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives in the shared scratch folder, index them, and read the records of every
    page's url back, as the index finds them."""
    spark = pages.sparkSession
    path = scratch_path(spark, "llm", "warc")
    write_archive(pages, path, min_revisit_bytes)
    return fetch(build_index(spark, path).lookup(pages), with_payload=False).drop("payload")
