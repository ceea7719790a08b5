"""WARC archives: pages written as records, long ones in segments, and read back whole.

Writing. Every page is one record of a gzip-compressed WARC 1.1 file. A response's block is an
HTTP answer whose body, the page in UTF-8, is framed in chunks. A block longer than
``segment_bytes`` is dealt over several records: the first has segment number 1, the others are
continuations that name it as their origin, and the last states the total length. As records are
bounded, so are files (``records_per_file``), and segments may lie in different files. Of pages
with equal payloads of at least ``least`` bytes only the one of the largest id is stored; the
others are revisit records without a body that refer to it. Only digests are shuffled to find
them; pages are shuffled once, by id and digest, where the list of revisits is too large to
broadcast. Files are written by Spark's text writer, as a record ends with the same two line
ends everywhere, so a repeated task leaves no double files.

Reading. Records whose block is whole are decoded where they are read. Segments are shuffled by
series and origin, ordered by number, and put together: numbers must run from 1 without gaps, the
last must state a total length and the blocks must add up to it. Then the HTTP head and the
chunk framing are decoded. Whatever does not hold is named in the column ``problem``; a file
whose records cannot be told apart stops the job. A revisit's payload length is that of the
response it refers to.

Memory: a task holds one file (``segment_bytes`` x ``records_per_file`` at most, unless written
elsewhere) and one page.

Defined results: a null or empty page has an empty payload and is a response. A null id is
smaller than any id; if all ids of a payload are null, all its records are responses. Rows that
repeat id and payload of a response are responses as well. Equal ids with other payloads are
records of their own. Columns other than ``page_id``, ``url`` and ``html`` are not stored. A null
url is written as a name made of the record's id. Control characters, spaces and bytes outside
ASCII in a url are percent-encoded.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import materialise, own_names, tune, work_dir

SEGMENT_BYTES = 16 << 10
RECORDS_PER_FILE = 4096
CHUNK_BYTES = 4 << 10
# Payloads from this size on are stored once.
LEAST = 1000
DATE = "2000-01-01T00:00:00Z"
# Parts into which the rows of one payload are dealt, where rows meet the record they refer to.
SALTS = 32
END = "\r\n\r\n"
BATCH_BYTES = 2 << 20

RECORDS = (
    "series string, record_id string, record_type string, page_id bigint, url string, digest string, "
    "refers_to string, origin string, number int, total bigint, block binary"
)


# Writing


def chunked(body: bytes, size: int) -> bytes:
    """Body in chunks of ``size`` bytes, each behind its length in hexadecimal digits."""
    parts = [body[i : i + size] for i in range(0, len(body), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def record(fields: dict[str, object], block: bytes) -> bytes:
    """A record without the two line ends that close it; fields without a value are left out."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def segments(fields: dict[str, object], block: bytes, size: int) -> Iterator[bytes]:
    """The record, or its segments where the block is longer than ``size``."""
    if len(block) <= size:
        yield record(fields, block)
        return
    own = str(fields["WARC-Record-ID"])
    common = {k: fields[k] for k in ("WARC-Warcinfo-ID", "WARC-Date", "WARC-Target-URI")}
    last = -(-len(block) // size)
    for k in range(1, last + 1):
        part = block[(k - 1) * size : k * size]
        if k == 1:
            yield record(fields | {"WARC-Segment-Number": 1}, part)
            continue
        name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{own}#{k}')}>"
        yield record(
            {"WARC-Type": "continuation", "WARC-Record-ID": name}
            | common
            | {"WARC-Segment-Origin-ID": own, "WARC-Segment-Number": k}
            | {"WARC-Segment-Total-Length": len(block) if k == last else None},
            part,
        )


def _urn(key: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hex=hashlib.md5(key.encode()).hexdigest())}>"


def _key(page_id: int | None, digest: str, copy: int = 0) -> str:
    return f"{'' if page_id is None else page_id}:{digest}" + (f":{copy}" if copy else "")


_PLAIN = re.compile(rb"[^\x21-\x7E]")


def _uri(url: str) -> str:
    return _PLAIN.sub(lambda m: b"%%%02X" % m[0][0], url.encode()).decode()


def _write(archive: str, segment_bytes: int, chunk_bytes: int, date: str):
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # All files of a task are one series, named by the record at its head.
        series = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}/{TaskContext.get().partitionId()}')}>"
        note = b"format: WARC File Format 1.1\r\n"
        info = {"WARC-Type": "warcinfo", "WARC-Record-ID": series, "WARC-Date": date}
        out, size, met = [], 0, Counter()
        for batch in batches:
            if batch.num_rows and not met:
                out.append(record(info | {"Content-Type": "application/warc-fields"}, note))
            for page_id, url, digest, response, html in zip(*[c.to_pylist() for c in batch.columns]):
                key = _key(page_id, digest)
                # Rows that repeat id and payload must not share the name of their segments.
                name = _urn(_key(page_id, digest, met[key]))
                met[key] += 1
                fields = {
                    "WARC-Type": "response" if response is None else "revisit",
                    "WARC-Record-ID": name,
                    "WARC-Warcinfo-ID": series,
                    "WARC-Date": date,
                    "WARC-Target-URI": name[1:-1] if url is None else _uri(url),
                    "WARC-Payload-Digest": f"sha1:{digest}",
                    "Page-ID": page_id,
                    "Content-Type": "application/http; msgtype=response",
                }
                if response is None:
                    block = head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(html or b"", chunk_bytes)
                else:
                    fields["WARC-Refers-To"] = _urn(_key(response, digest))
                    fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                    block = head + b"\r\n"
                out += segments(fields, block, segment_bytes)
                size += len(block)
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    return run


def revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Pages stored elsewhere: (``page_id``, ``url``, ``digest``, ``response``).

    ``response`` is the largest id of an equal payload. Payloads are told apart by SHA-1 and
    length. Counting is an aggregation, so copies collapse where they are read, and the rows of
    one payload are salted when they meet its response.
    """
    rows = pages.select("page_id", "url", "digest", F.octet_length("html").alias("size")).where(F.col("size") >= least)
    best = rows.groupBy("digest", "size").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    best = best.where("n > 1 and response is not null").withColumn("salt", salts)
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    met = rows.join(best, ["digest", "size", "salt"]).where(~F.col("page_id").eqNullSafe(F.col("response")))
    return met.select("page_id", "url", "digest", "response")


def write_archives(
    pages: DataFrame,
    folder: str,
    segment_bytes: int = SEGMENT_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
    chunk_bytes: int = CHUNK_BYTES,
    least: int = LEAST,
    date: str = DATE,
) -> None:
    """Write one record per row of ``pages`` (``page_id``, ``url``, ``html``) below ``folder``."""
    tune(pages.sparkSession)
    plain = own_names(pages, "page_id", "url", "html", page_id="bigint", url="string", html="string")
    plain = plain.withColumn("html", F.coalesce("html", F.lit("")).cast("binary"))
    plain = plain.withColumn("digest", F.sha1("html"))
    again = materialise(revisits(plain, least), "revisits")
    gone = again.select(F.col("page_id").alias("gone_id"), F.col("digest").alias("gone_digest")).distinct()
    same = F.col("page_id").eqNullSafe(F.col("gone_id")) & (F.col("digest") == F.col("gone_digest"))
    # Payloads below the limit have digests of their own, so the list cannot name them.
    stored = plain.join(gone, same, "left_anti")
    columns = ["page_id", "url", "digest", "response", "html"]
    rows = stored.withColumn("response", F.lit(None).cast("bigint")).select(columns).union(
        again.withColumn("html", F.lit(None).cast("binary")).select(columns)
    )
    records = rows.mapInArrow(_write(folder, segment_bytes, chunk_bytes, date), "record binary")
    (
        records.select(F.col("record").cast("string"))
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(folder)
    )


# Reading


class Record(NamedTuple):
    fields: dict[str, str]
    block: bytes


def parse(data: bytes) -> Iterator[Record]:
    """The records of an unpacked file. Names of fields are in lower case."""
    at = 0
    while at < len(data):
        body = data.find(b"\r\n\r\n", at) + 4
        lines = data[at : max(body - 4, at)].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = fields.get("content-length", "")
        end = body + int(size) if size.isdigit() else -1
        if body < at + 4 or not lines[0].startswith("WARC/") or end < 0 or data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"no record at byte {at}")
        yield Record(fields, data[body:end])
        at = end + 4


def dechunked(body: bytes) -> bytes:
    """The body without chunk framing; an error where the framing is broken or ends early."""
    parts, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        digits = body[at:line].partition(b";")[0].strip() if line >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", digits):
            raise ValueError("chunk length")
        size, at = int(digits, 16), line + 2
        if not size:
            break
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk end")
        parts.append(body[at : at + size])
        at += size + 2
    # Fields may follow the last chunk; an empty line closes them.
    closed = body.endswith(b"\r\n\r\n") if body[at : at + 2] != b"\r\n" else len(body) == at + 2
    if not closed:
        raise ValueError("chunk trailer")
    return b"".join(parts)


def payload(kind: str, block: bytes) -> bytes | None:
    """What a record's block carries: an HTTP answer's body, a resource itself; None for a revisit."""
    if kind == "revisit":
        return None
    if kind != "response":
        return block
    head, found, body = block.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"HTTP/"):
        raise ValueError("HTTP head")
    if re.search(rb"(?im)^transfer-encoding:.*\bchunked\b", head):
        return dechunked(body)
    return body


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and re.fullmatch(r"-?[0-9]+", text) else None


def _split(segmented: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    data = gzip.decompress(content.as_buffer())
                    for f, block in parse(data):
                        kind, digest = f.get("warc-type"), f.get("warc-payload-digest")
                        number = _number(f.get("warc-segment-number"))
                        if kind not in ("response", "resource", "revisit", "continuation"):
                            continue
                        if (number is not None) != segmented:
                            continue
                        name = f.get("warc-record-id")
                        rows.append((
                            f.get("warc-warcinfo-id"), name, kind, _number(f.get("page-id")),
                            f.get("warc-target-uri"), digest and digest.removeprefix("sha1:"),
                            f.get("warc-refers-to"), f.get("warc-segment-origin-id", name), number,
                            _number(f.get("warc-segment-total-length")), block,
                        ))
                        size += len(block)
                        if size > BATCH_BYTES:
                            yield _rows(rows)
                            rows, size = [], 0
                except (ValueError, EOFError, OSError) as problem:
                    raise ValueError(f"{path}: {problem}") from problem
        if rows:
            yield _rows(rows)

    return run


_KINDS = [pa.string()] * 3 + [pa.int64()] + [pa.string()] * 4 + [pa.int32(), pa.int64(), pa.binary()]
_NAMES = [part.split()[0] for part in RECORDS.split(", ")]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], _NAMES)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies, problems = [], []
        at = batch.schema.names.index("parts")
        for kind, problem, parts in zip(
            batch.column("record_type").to_pylist(), batch.column("problem").to_pylist(), batch.column(at)
        ):
            body = None
            if problem is None:
                try:
                    body = payload(kind, b"".join(parts.as_py()))
                except ValueError as found:
                    problem = str(found)
            bodies.append(body)
            problems.append(problem)
        kept = [n for n in batch.schema.names if n not in ("parts", "problem")]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in kept], pa.array(bodies, pa.binary()), pa.array(problems, pa.string())],
            [*kept, "payload", "problem"],
        )


def reassembled(pieces: DataFrame) -> DataFrame:
    """Segments put together: one row per origin, with its blocks in order and any problem."""
    ordered = pieces.groupBy("series", "origin").agg(
        *[F.max(c).alias(c) for c in ("page_id", "url", "digest", "refers_to")],
        F.max(F.when(F.col("number") == 1, F.col("record_type"))).alias("record_type"),
        F.sort_array(F.collect_list(F.struct("number", "total", "block"))).alias("s"),
    )
    sizes = F.aggregate("s", F.lit(0).cast("long"), lambda n, x: n + F.octet_length(x["block"]))
    numbers = F.transform("s", lambda x: x["number"])
    total = F.element_at("s", -1)["total"]
    problem: Column = (
        F.when(numbers != F.sequence(F.lit(1), F.size("s")), "segments missing or repeated")
        .when(total.isNull(), "last segment missing")
        .when(total != sizes, "segments do not add up to the total length")
    )
    return ordered.select(
        F.col("origin").alias("record_id"), "record_type", "page_id", "url", "digest", "refers_to",
        problem.alias("problem"), F.transform("s", lambda x: x["block"]).alias("parts"),
    )


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """All records below ``folder``, segments put together and payloads decoded.

    Columns ``record_id``, ``record_type``, ``page_id``, ``url``, ``digest``, ``refers_to`` (a
    record id), ``payload`` (null for revisits and where there is a problem) and ``problem``.
    """
    tune(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path", "content")
    whole = files.mapInArrow(_split(False), RECORDS).select(
        "record_id", "record_type", "page_id", "url", "digest", "refers_to",
        F.lit(None).cast("string").alias("problem"), F.array("block").alias("parts"),
    )
    joined = reassembled(files.mapInArrow(_split(True), RECORDS))
    kinds = "record_id string, record_type string, page_id bigint, url string, digest string, refers_to string, "
    found = whole.union(joined).mapInArrow(_decode, kinds + "payload binary, problem string")
    differs = F.col("digest").isNotNull() & (F.sha1("payload") != F.col("digest"))
    return found.withColumn("problem", F.when(differs, "digest differs").otherwise(F.col("problem")))


def page_records(records: DataFrame) -> DataFrame:
    """Per record the page, length and digest of the full payload, its type, and the page it repeats.

    A problem of any record, or a revisit whose response is not there, is an error.
    """
    sized = records.select(
        "record_id", "record_type", "page_id", "refers_to", "problem",
        F.octet_length("payload").cast("bigint").alias("size"),
        F.coalesce(F.sha1("payload"), "digest").alias("digest"),
    )
    stored = materialise(sized, "records")
    again = stored.where("record_type = 'revisit'")
    wanted = again.select(F.col("refers_to").alias("record_id")).distinct()
    targets = (
        stored.where("record_type != 'revisit'").join(wanted, "record_id", "left_semi")
        .groupBy(F.col("record_id").alias("refers_to"), F.col("digest"))
        .agg(F.max("page_id").alias("response"), F.max("size").alias("full"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salted = again.withColumn("salt", F.pmod(F.xxhash64("page_id", "record_id"), F.lit(SALTS)).cast("int"))
    met = salted.join(targets, ["refers_to", "digest", "salt"], "left").select(
        "page_id", F.col("full").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
        F.col("response").alias("refers_to"),
        F.coalesce("problem", F.when(F.col("full").isNull(), F.lit("no response to refer to"))).alias("problem"),
    )
    own = stored.where("record_type != 'revisit'").select(
        "page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type",
        F.lit(None).cast("bigint").alias("refers_to"), "problem",
    )
    checked = F.when(F.col("problem").isNull(), F.col("record_type")).otherwise(
        F.raise_error(F.concat(F.lit("record of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("?")),
                               F.lit(": "), F.col("problem")))
    )
    return own.union(met).withColumn("record_type", checked).drop("problem")


def written_and_read(pages: DataFrame, **sizes: int) -> DataFrame:
    """Write all pages as archives below the shared folder, read them back and report each page."""
    folder = work_dir(pages.sparkSession, "archives")
    write_archives(pages, folder, **sizes)
    return page_records(read_archives(pages.sparkSession, folder))
