"""WARC archives: one gzip stream per file in, one gzip member per record out.

``write_monolithic`` writes records as Spark's text writer does, with the
record terminator as line separator and gzip around the whole file: the layout
in which no record can be read without inflating all before it.
``normalise`` inflates each such file once, as a stream, and writes every
record as a member of its own. ``build_index`` reads the new archives and
writes the sidecar: file, offset and length of every member, so that
``read_member`` needs one range of one file.

Bytes reach and leave the shared folder through Spark's own readers and
writers, so any store that Spark knows will do. The text writer ends each row
with its separator; a member is written without its last byte, which the
separator (NUL) puts back: the top byte of a member's length field is zero
below 16 MB, and a longer record is followed by an empty member, which ends
in one. A file holds at most about ``FILE_BYTES`` of records (or one longer one), the
memory bound of a task; a record is whole in memory, a file is only in its compressed form.

Equal payloads meet by digest, ids and addresses alone. Their table goes to the
pages by broadcast while it is known to be small; otherwise the few digests of
many pages do, and pages are joined with the others by digest.

Revisit records have the profile of identical payloads and name the response by
its record id, address and date; ``X-`` fields hold the page ids. A record id
comes from page id, address and payload, so that a repeated task writes it again.

Defined results: null html is an empty payload; a null url or id leaves the
header out; line breaks in a header become blanks; repeated rows are separate
records (of one record id); of equal payloads of at least ``MIN_REVISIT`` bytes, rows with the
largest page_id (a null one counts as smallest) are responses; very long payloads
get files of their own; extra columns are left out; an empty table gives empty
archives and an empty index.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import cut_lineage, scratch_path
from .arrow import bound_batches, quoted, schema_of, ship

MIN_REVISIT = 1000
FILE_BYTES, LEAST_CLASS = 64 << 20, 14
#: Repeated payloads that a broadcast may hold (about 200 bytes each), and the
#: share of all of them that makes a payload frequent.
BROADCAST_PAYLOADS, FREQUENT_PARTS = 200_000, 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STEP = 1 << 18
END = b"\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
INDEX = ("archive string, offset long, length long, record_type string, page_id string, url string, "
         "refers_to string, payload_bytes long, payload_digest string, record_id string, refers_to_record string")


def _line(name: str, value: Column) -> Column:
    clean = F.regexp_replace(value.cast("string"), "[\r\n]", " ")
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")))


def _record_id(page_id: Column, url: Column, digest: Column) -> Column:
    """A name-based UUID of what makes the record."""
    h = F.md5(F.concat_ws("\u0001", *[F.coalesce(x.cast("string"), F.lit("\u0002")) for x in (page_id, url, digest)]))
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("3"), F.substring(h, 14, 3)),
             F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def with_responses(p: DataFrame, least: int, broadcast_payloads: int = BROADCAST_PAYLOADS) -> DataFrame:
    """Pages (id, url, bytes, digest, ...) with ``first``: id and address of the
    response of a payload that occurs twice or more, else null."""
    first = cut_lineage(p.where(F.col("bytes") >= least).groupBy("digest")
                        .agg(F.max(F.struct("id", "url")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    n, pages = first.agg(F.count(F.lit(1)), F.sum("n")).first()
    if n <= broadcast_payloads:
        return p.join(F.broadcast(first.drop("n")), "digest", "left")
    often = first.where(F.col("n") * FREQUENT_PARTS >= pages).drop("n")
    rare = first.where(F.col("n") * FREQUENT_PARTS < pages).select("digest", F.col("first").alias("other"))
    p = p.join(F.broadcast(often), "digest", "left")
    alone = F.col("first").isNotNull() | (F.col("bytes") < least)
    joined = p.where(~alone).join(rare, "digest", "left").withColumn("first", F.coalesce("first", "other")).drop("other")
    return p.where(alone).unionByName(joined)


def to_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
               least: int = MIN_REVISIT, date: Column | None = None, **options) -> DataFrame:
    """One WARC record per row, as text (``value``) without the final blank lines, and its ``bytes``."""
    p = pages.select(F.col(quoted(page_id)).alias("id"), F.col(quoted(url)).cast("string").alias("url"),
                     F.coalesce(F.col(quoted(html)).cast("string"), F.lit("")).alias("payload"))
    p = p.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    p = with_responses(p, least, **options)
    again = (F.col("bytes") >= least) & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first.id"))
    when = F.date_format(F.current_timestamp() if date is None else date, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    body = F.when(again, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), "payload"))
    original = _record_id(F.col("first.id"), F.col("first.url"), F.col("digest"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, "revisit").otherwise("response"), F.lit("\r\n"),
        _line("WARC-Record-ID", _record_id(F.col("id"), F.col("url"), F.col("digest"))), _line("WARC-Date", when),
        _line("WARC-Target-URI", F.col("url")), _line("X-Page-Id", F.col("id")),
        _line("WARC-Profile", F.when(again, F.lit(PROFILE))), _line("WARC-Refers-To", F.when(again, original)),
        _line("WARC-Refers-To-Target-URI", F.when(again, F.col("first.url"))),
        _line("WARC-Refers-To-Date", F.when(again, when)), _line("X-Refers-To-Page-Id", F.when(again, F.col("first.id"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("X-Payload-Length", F.col("bytes")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    value = F.concat(head, body)
    return p.select(value.alias("value"), F.octet_length(value).alias("bytes"))


def write_monolithic(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> str:
    """Whole-file gzip streams of records. Records of up to 2 ** c bytes share files of
    at most ``file_bytes`` / 2 ** c of them: each so many rows of a task are one file."""
    size = F.greatest(F.lit(LEAST_CLASS), F.ceil(F.log2(F.greatest(F.col("bytes"), F.lit(1)))))
    each = F.greatest(F.lit(1), F.floor(F.lit(float(file_bytes)) / F.pow(F.lit(2.0), size)))
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # its place in the task
    records.select("value", F.concat_ws("-", size.cast("int"), F.floor(nth / each)).alias("file")) \
        .write.partitionBy("file").option("lineSep", END.decode()).option("compression", "gzip") \
        .option("zlib.compress.level", "BEST_SPEED").text(path)
    return path


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Records (with their final blank lines) of an inflated stream."""
    kept = bytearray()
    for piece in pieces:
        kept += piece
        while (head := kept.find(END)) >= 0:
            size = head + len(END) + _length(bytes(kept[:head])) + len(END)
            if len(kept) < size:
                break
            yield bytes(kept[:size])
            del kept[:size]
    if kept.strip():
        raise ValueError("an archive ends inside a record")


def _length(head: bytes) -> int:
    for line in head.split(b"\r\n"):
        if line.lower().startswith(b"content-length:"):
            return int(line.split(b":", 1)[1])
    raise ValueError("a record has no Content-Length")


def inflate(data: bytes, step: int = STEP) -> Iterator[bytes]:
    """The content of a gzip file (of one member or several), piece by piece."""
    at = 0
    while at < len(data):
        engine = zlib.decompressobj(31)
        while not engine.eof:
            if at >= len(data):
                raise ValueError("a gzip stream is cut off")
            chunk = data[at:at + step]
            at += len(chunk)
            yield engine.decompress(chunk)
        at -= len(engine.unused_data)


def member(record: bytes, level: int = 1) -> bytes:
    """A record as a gzip member that ends in a zero byte (see the module)."""
    def pack(x: bytes) -> bytes:
        engine = zlib.compressobj(level, zlib.DEFLATED, 31)
        return engine.compress(x) + engine.flush()
    out = pack(record)
    return out if out[-1] == 0 else out + pack(b"")


def normalise(spark: SparkSession, source: str, target: str) -> str:
    """Rewrite every record of the files below ``source`` as its own member."""
    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                out, size = [], 0
                for record in split_records(inflate(data.as_buffer().to_pybytes())):
                    out.append(member(record)[:-1])
                    size += len(out[-1])
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    ship(spark)
    bound_batches(spark)
    files = spark.read.format("binaryFile").load(source).select("content")
    files.mapInArrow(run, "value binary").select(F.col("value").cast("string")) \
        .write.option("lineSep", "\u0000").text(target)
    return target


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of every member; an empty member belongs to the
    record before it."""
    at, held = 0, None
    while at < len(data):
        engine = zlib.decompressobj(31)
        begin, out = at, []
        while not engine.eof:
            if at >= len(data):
                raise ValueError("a gzip member is cut off")
            chunk = data[at:at + STEP]
            at += len(chunk)
            out.append(engine.decompress(chunk))
        at -= len(engine.unused_data)
        record = b"".join(out)
        if not record and held is not None:
            held = (held[0], at - held[0], held[2])
            continue
        if held is not None:
            yield held
        held = (begin, at - begin, record)
    if held is not None:
        yield held


def read_member(data: bytes, offset: int, length: int) -> bytes:
    """One record, from its range of an archive."""
    return b"".join(inflate(data[offset:offset + length]))


def describe(record: bytes) -> dict:
    """Header fields and payload facts of a record."""
    head, rest = record.split(END, 1)
    fields = {k.strip().lower(): v.strip() for k, _, v in
              (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    body = rest[:int(fields["content-length"])]
    if fields["warc-type"] == "revisit":  # the payload is elsewhere
        size, digest = int(fields["x-payload-length"]), fields["warc-payload-digest"].partition(":")[2]
    else:
        payload = body.split(END, 1)[1]
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    return {"record_type": fields["warc-type"], "page_id": fields.get("x-page-id"),
            "url": fields.get("warc-target-uri"), "refers_to": fields.get("x-refers-to-page-id"),
            "record_id": fields.get("warc-record-id"), "refers_to_record": fields.get("warc-refers-to"),
            "payload_bytes": size, "payload_digest": digest}


def build_index(spark: SparkSession, archives: str, target: str) -> DataFrame:
    """Write the sidecar of all archives below ``archives`` and return it."""
    schema = schema_of(INDEX)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for path, data in zip(batch.column(0), batch.column(1)):
                name, rows = path.as_py().rsplit("/", 1)[-1], []
                for offset, length, record in members(data.as_buffer().to_pybytes()):
                    rows.append({"archive": name, "offset": offset, "length": length, **describe(record)})
                    if len(rows) >= 2000:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    ship(spark)
    bound_batches(spark)
    spark.read.format("binaryFile").load(archives).select("path", "content") \
        .mapInArrow(run, schema).write.parquet(target)
    return spark.read.parquet(target)


def archive_pages(pages: DataFrame, folder: str, **columns) -> DataFrame:
    """Write the pages to ``folder`` (``monolithic``, ``archives``, ``index``)
    and return the index."""
    spark = pages.sparkSession
    raw = write_monolithic(to_records(pages, **columns), f"{folder}/monolithic")
    return build_index(spark, normalise(spark, raw, f"{folder}/archives"), f"{folder}/index")


def warc_report(pages: DataFrame) -> DataFrame:
    """The columns of ``op7_warc``, read back from the archives."""
    kind = pages.schema["page_id"].dataType
    index = archive_pages(pages, scratch_path(pages.sparkSession, "warc"))
    return index.select(F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast(kind))


REPORT_SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, max(page_id) AS first, count(*) AS n FROM d WHERE payload_bytes >= 1000
      GROUP BY payload_digest)
SELECT d.*, CASE WHEN f.n > 1 AND f.first IS NOT NULL AND d.page_id IS DISTINCT FROM f.first
                 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.n > 1 AND d.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest AND d.payload_bytes >= 1000"""
