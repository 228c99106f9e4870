"""Operator 2, a normaliser of monolithic gzip WARC archives.

``write_archives`` lets Spark write pages as WARC records, each file one gzip
stream from end to end (the text sink with the record terminator as its line
separator). Such a file can only be read from its start. ``normalise`` reads
each file as a stream, whatever its size, inflates it once, in bounded steps, writes every record again as a gzip
member of its own, and beside each archive a sidecar index of the members'
offsets. ``read_records`` then opens members by their offsets.

Archives are written under temporary names and moved when complete, so a task
that runs twice leaves one archive of the same content. The folder must be
one that all executors reach; tasks open it with ``pyarrow.fs``.

Defined results: null html is the empty payload; payloads under 100 bytes are
always responses; a null page id is kept as null and refers to the response of
its payload if there is one with an id; rows of one payload that repeat the
smallest id are all responses. Line breaks in urls are dropped from the header;
page ids stand there percent-encoded and come back as they were.
No rows give an index without rows. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import read, scratch, staged

LEAST_PAYLOAD = 100
DATE = "2000-01-01T00:00:00Z"
END = "\r\n\r\n"
LEVEL = 6
STEP = 1 << 20
MOST_RECORDS = 20_000

INDEX = "archive string, number long, record_id string, record_type string, offset long, length long"


# ------------------------------------------------------------ which records are revisits

def record_types(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """``page_id, url, html`` with ``digest, bytes, refers_to``: of equal
    payloads of ``least`` bytes or more, the smallest page id is the one that
    the others refer to. Only digests are grouped; where no or few payloads
    repeat, no page moves."""
    pages = pages.withColumn("html", F.coalesce("html", F.lit("")))
    pages = pages.withColumns({"digest": F.sha2(F.col("html").cast("binary"), 256), "bytes": F.octet_length("html").cast("long")})
    groups = pages.where(F.col("bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = staged(groups.where("n > 1 AND first IS NOT NULL").select("digest", "first"), "digests")
    joined = pages.join(groups, "digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.withColumn("refers_to", refers).drop("first")


def _uuid(page_id: Column, digest: Column) -> Column:
    h = F.sha2(F.concat_ws("|", page_id.cast("string"), digest), 256)
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.substring(h, 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def records(typed: DataFrame) -> Column:
    """The WARC record of a row, without its terminator."""
    revisit = F.col("refers_to").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
    optional = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("bytes")), F.lit("\r\n"))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", _uuid(F.col("page_id"), F.col("digest"))),
        line("WARC-Date", F.lit(DATE)), optional("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", "")), optional("X-Page-ID", F.url_encode(F.col("page_id").cast("string"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", _uuid(F.col("refers_to"), F.col("digest"))), line("X-Refers-To-Page-ID", F.url_encode(F.col("refers_to").cast("string"))),
                                 F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"), line("Content-Length", length), F.lit("\r\n"), http,
        F.when(revisit, "").otherwise(F.col("html")))


def write_archives(pages: DataFrame, path: str) -> None:
    """A folder of WARC files, each one gzip stream."""
    typed = record_types(pages.select("page_id", "url", "html"))
    typed.select(records(typed).alias("value")).write.option("compression", "gzip").option("lineSep", END).option("maxRecordsPerFile", MOST_RECORDS).text(path)


# ------------------------------------------------------------ streams and members

def inflate(file) -> Iterator[bytes]:
    """The bytes of a gzip stream, of one member or several, read in steps
    from an open file."""
    d = zlib.decompressobj(31)
    while chunk := file.read(STEP):
        while chunk:
            yield d.decompress(chunk, 4 * STEP)
            while d.unconsumed_tail:
                yield d.decompress(d.unconsumed_tail, 4 * STEP)
            chunk = d.unused_data
            if d.eof:
                d = zlib.decompressobj(31)
            elif not chunk:
                break


def split_records(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and whole bytes (with terminator) of each record, holding
    no more than one record and one step."""
    buffer = bytearray()

    def fill(n: int) -> bool:
        for part in stream:
            buffer.extend(part)
            if len(buffer) >= n:
                return True
        return len(buffer) >= n

    end = END.encode()
    while fill(len(buffer) + 1) or buffer:
        while buffer:
            seen = 0
            while (head := buffer.find(end, max(0, seen - 3))) < 0:
                seen = len(buffer)
                if not fill(seen + 1):
                    raise ValueError("a record's header is cut off")
            fields = header(bytes(buffer[:head]))
            size = head + len(end) + int(fields["content-length"]) + len(end)
            if len(buffer) < size and not fill(size):
                raise ValueError("a record is cut off")
            yield fields, bytes(buffer[:size])
            del buffer[:size]


def header(raw: bytes) -> dict[str, str]:
    first, *lines = raw.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _open(path: str):
    """File system and plain path of a folder or file that executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))


def normalise(spark, source: str, target: str, level: int = LEVEL) -> DataFrame:
    """Every archive of folder ``source`` again under ``target``, one gzip
    member for each record, with a sidecar ``.cdxj`` (a JSON line for each).
    Returns the index: ``archive, number, record_id, record_type, offset,
    length``."""
    # Spark lists the files and deals them over tasks; their content isn't read here
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")

    def run(batches):
        store, folder = _open(target)
        store.create_dir(folder, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for path in batch.column(0).to_pylist():
                name = re.sub(r"(\.warc|\.txt)?\.gz$", ".warc.gz", path.rsplit("/", 1)[-1])
                rows, at = [], 0
                part = f"{folder}/_{attempt}-{name}"
                there, plain = _open(path)
                with there.open_input_stream(plain, compression=None) as archive, store.open_output_stream(part, compression=None) as out:
                    for number, (fields, raw) in enumerate(split_records(inflate(archive))):
                        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = packer.compress(raw) + packer.flush()
                        out.write(member)
                        rows.append((name, number, fields["warc-record-id"], fields["warc-type"], at, len(member)))
                        at += len(member)
                with store.open_output_stream(f"{part}.cdxj", compression=None) as out:
                    for _, number, record, kind, offset, length in rows:
                        out.write((json.dumps({"number": number, "id": record, "type": kind, "offset": offset, "length": length}) + "\n").encode())
                store.move(f"{part}.cdxj", f"{folder}/{name}.cdxj")
                store.move(part, f"{folder}/{name}")
                for k in range(0, len(rows), 10_000):
                    yield _batch(rows[k:k + 10_000], ["archive", "number", "record_id", "record_type", "offset", "length"])

    return staged(files.mapInArrow(run, INDEX), "warc-index")


def _batch(rows: list[tuple], names: list[str], types: dict | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, (types or {}).get(n)) for n, c in zip(names, zip(*rows))], names=names)


RECORDS = "archive string, number long, page_id string, url string, record_type string, payload_digest string, payload_bytes long, refers_to string, payload binary"


def read_records(index: DataFrame, target: str, with_payload: bool = True) -> DataFrame:
    """The records that ``index`` lists, each opened by its offset. A payload
    that isn't that of its digest raises."""
    import hashlib

    types = {"page_id": pa.string(), "url": pa.string(), "refers_to": pa.string(), "payload": pa.binary()}
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def run(batches):
        store, folder = _open(target)
        name, file = None, None
        for batch in batches:
            rows, held = [], 0
            for at in batch.to_pylist():
                if at["archive"] != name:
                    name, file = at["archive"], store.open_input_file(f"{folder}/{at['archive']}")
                file.seek(at["offset"])
                raw = zlib.decompress(file.read(at["length"]), 31)
                head, _, block = raw.partition(END.encode())
                fields = header(head)
                http, _, payload = block[:int(fields["content-length"])].partition(END.encode())
                digest = fields["warc-payload-digest"].removeprefix("sha256:")
                size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)[1])
                kind = fields["warc-type"]
                if kind != "revisit" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                    raise ValueError(f"{name} at {at['offset']}: the payload isn't that of its digest")
                page, refers = (x if x is None else unquote_plus(x) for x in (fields.get("x-page-id"), fields.get("x-refers-to-page-id")))
                rows.append((name, at["number"], page, fields.get("warc-target-uri"), kind, digest, size, refers,
                             payload if with_payload and kind != "revisit" else None))
                held += len(payload) if with_payload else 0
                if held > 4 << 20:
                    yield _batch(rows, names, types)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, names, types)

    return index.mapInArrow(run, RECORDS)


def op2(spark, sf_dir: str) -> DataFrame:
    """Pages to monolithic archives, these normalised, and every record read
    back by its offset."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    archives, normal = scratch(spark, "warc"), scratch(spark, "warc-members")
    write_archives(pages, archives)
    found = read_records(normalise(spark, archives, normal), normal, with_payload=False)
    kind = pages.schema["page_id"].dataType
    return found.select(F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind))


OP2_SQL = """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM r"""
