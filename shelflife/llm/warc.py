"""WARC archives: writing captures, reading records, assembling transactions.

Every page becomes three records: a request, a response (or a revisit, when an equal
payload of ``MIN_REVISIT`` bytes or more is already stored with a smaller page id) and
a metadata record.  Request and metadata name the response in WARC-Concurrent-To.
Archives are gzip files of whole records, written by Spark's text writer, so they land
in any store that Spark writes to and a failed task leaves nothing behind.

Reading takes archives as binary files and walks their records by Content-Length, so
payloads may hold anything; memory is one compressed file and one record.  The
assembly joins response, request and metadata records by record id into one nested
row per capture, and a revisit with the response that its WARC-Refers-To names.  Payloads need not take part in it: ``with_payload=False`` keeps
their digest and length, taken over the bytes that were read back.

The pages are written once with a number each, which is part of their record ids.  The
stored page of each payload is found by a minimum per digest, summed before the shuffle and
written out, so the rows of a common payload can be split at the join.

Defined cases: a null html is an empty payload and a null url an empty target; control
characters of a url are percent-encoded; rows that repeat a page id are captures of
their own, told apart by a number in the record id, and equal payloads of one page are
all responses (revisits name one of them); a revisit whose response is not in the archives
has no original; a null page id never is the stored page if there is another; a revisit
has no payload of its own and keeps digest and length; of several requests or metadata
records of one capture the one with the smallest id stays; an empty table gives an
empty archive and no captures; other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelflife.llm.shared import run_folder, ship, stage

MIN_REVISIT = 100
FILE_BYTES = 32 * 1024 * 1024  # of payload per archive, on average
DATE = "2024-01-01T00:00:00Z"
_BREAK = "\r\n"

RECORD = (
    "record_id string, type string, concurrent_to string, refers_to string, target string, "
    "digest string, headers map<string,string>, payload_bytes bigint, payload binary"
)


def _clean(text: Column) -> Column:
    """Header values hold no control characters; they are percent-encoded."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for c in (13, 10, 0):
        out = F.replace(out, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    return out


def _record(kind: str | Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    """One record's text; the writer ends the line that this leaves open."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind)]
    # A null field is left out: concat of null is null, and array_join skips it.
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    head = F.array_join(F.array(*lines), _BREAK)
    return F.concat(head, F.lit(2 * _BREAK), block, F.lit(_BREAK))


def stored_pages(rows: DataFrame, folder: str, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``digest`` and ``first`` (``page``, ``n``): the row that is stored for each repeated payload."""
    sized = rows.where(F.octet_length("html") >= min_bytes)
    # Of rows that repeat the smallest page id any serves; a null id comes last.
    order = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("page"), "n")
    first = sized.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("m"))
    return stage(first.where("m > 1").drop("m"), f"{folder}/stored")


def _pages(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", _clean(F.col("url")).alias("url"), html.alias("html"))
    return rows.withColumn("digest", F.sha2("html", 256)).withColumn("n", F.monotonically_increasing_id())


def write_archives(
    pages: DataFrame, path: str, folder: str, min_bytes: int = MIN_REVISIT
) -> None:
    """Three records per row of ``page_id``, ``url``, ``html``, as gzip files below path."""
    # Written first: the numbers of the rows are part of record ids that other records name.
    rows = stage(_pages(pages), f"{folder}/pages")
    firsts = stored_pages(rows, folder, min_bytes)
    size = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("html")).alias("b")).first()
    per_file = max(1, int(size["n"] * FILE_BYTES / max(size["b"] or 0, 1)))
    rows = rows.join(firsts, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page"))

    def page(number: str) -> Column:
        return F.coalesce(F.col(number).cast("string"), F.lit("none"))

    def urn(kind: str, number: str = "page_id", n: str = "n") -> Column:
        return F.concat(F.lit(f"<urn:capture:{kind}:"), page(number), F.lit(":"), F.col(n), F.lit(">"))

    common = [("WARC-Date", F.lit(DATE)), ("WARC-Target-URI", F.col("url"))]
    beside = [("WARC-Concurrent-To", urn("response")), *common]
    request = _record(
        "request",
        [("WARC-Record-ID", urn("request")), *beside],
        F.concat(F.lit("GET "), F.col("url"), F.lit(f" HTTP/1.1{2 * _BREAK}")),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    stored = urn("response", "first.page", "first.n")
    response = _record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        [
            ("WARC-Record-ID", urn("response")),
            *common,
            ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            ("WARC-Refers-To", F.when(revisit, stored)),
            ("X-Payload-Length", F.octet_length("html").cast("string")),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.concat(F.lit(f"HTTP/1.1 200 OK{_BREAK}Content-Type: text/html{2 * _BREAK}"), body),
    )
    metadata = _record(
        "metadata",
        [("WARC-Record-ID", urn("metadata")), *beside],
        F.concat(F.lit("page-id: "), page("page_id"), F.lit(_BREAK)),
    )
    records = rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
    writer = records.write.mode("errorifexists").option("lineSep", _BREAK)
    writer.option("maxRecordsPerFile", 3 * per_file).option("compression", "gzip").text(path)


def records_of(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (the record type under ``WARC-Type``) and block of each record of an archive."""
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            headers[name] = value.strip()
        length = int(headers["Content-Length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError("an archive ends within a record")
        yield headers, block


def _parse(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    names = ["record_id", "type", "concurrent_to", "refers_to", "target", "digest", "headers"]
    names += ["payload_bytes", "payload"]
    text = pa.string()
    kinds = [text] * 6 + [pa.map_(text, text), pa.int64(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    for files in batches:
        for content in files.column(0):
            rows, held = [], 0
            # Spark writes one gzip member; archives of many members read as well.
            for headers, block in records_of(gzip.open(io.BytesIO(content.as_buffer()))):
                kind = headers.get("WARC-Type")
                digest = size = payload = None
                if kind == "response":
                    payload = block.partition(b"\r\n\r\n")[2]
                    digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
                elif kind == "revisit":
                    digest = headers.get("WARC-Payload-Digest", "").rpartition(":")[2]
                    size = int(headers["X-Payload-Length"]) if "X-Payload-Length" in headers else None
                elif kind == "metadata":
                    payload = block
                keep = payload if payloads or kind == "metadata" else None
                rows.append(
                    (headers.get("WARC-Record-ID"), kind, headers.get("WARC-Concurrent-To"),
                     headers.get("WARC-Refers-To"), headers.get("WARC-Target-URI"), digest,
                     list(headers.items()), size, keep)
                )
                held += len(keep or b"")
                if len(rows) >= 1000 or held > 1 << 23:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Every record of the archives below ``path``; digests are of the bytes that were read."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(lambda batches: _parse(batches, with_payload), RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit, with its request and metadata records.

    ``original`` is the response that a revisit refers to (``record_id``, ``target``,
    ``digest``, and ``metadata``, its metadata block), null if the archives hold none.
    The records are used several times, so they should come from a written table.
    """
    stored = records.where(F.col("type").isin("response", "revisit"))
    rows = stored.select("record_id", F.struct("*").alias("response"))
    beside = {}
    for kind in ("request", "metadata"):
        found = records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
        beside[kind] = found.groupBy(F.col("concurrent_to").alias("record_id")).agg(
            F.min_by(F.struct("record_id", "target", "headers", "payload"), "record_id").alias(kind)
        )
        rows = rows.join(beside[kind], "record_id", "left")
    responses = records.where((F.col("type") == "response") & F.col("record_id").isNotNull())
    responses = responses.groupBy("record_id").agg(F.min(F.struct("target", "digest")).alias("r"))
    originals = responses.join(beside["metadata"], "record_id", "left").select(
        F.col("record_id").alias("named"),
        F.struct("record_id", "r.target", "r.digest", F.col("metadata.payload").alias("metadata")).alias("original"),
    )
    # Those that are no revisits name themselves, so they do not meet under one null.
    refers = F.when(F.col("response.type") == "revisit", F.col("response.refers_to"))
    rows = rows.withColumn("named", F.coalesce(refers, "record_id")).join(originals, "named", "left")
    return rows.drop("named").withColumn("original", F.when(refers.isNotNull(), F.col("original")))


def round_trip(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """The captures of a table of pages, written as archives and read back."""
    spark = pages.sparkSession
    folder = run_folder(spark)
    write_archives(pages, f"{folder}/archives", folder)
    records = read_records(spark, f"{folder}/archives", with_payload)
    return captures(stage(records, f"{folder}/records"))


def digest(found: DataFrame) -> DataFrame:
    """One summary row per capture."""

    def page(block: str) -> Column:
        number = F.regexp_extract(F.col(block).cast("string"), r"^page-id: (-?\d+)", 1)
        return F.nullif(number, F.lit("")).cast("bigint")

    return found.select(
        page("metadata.payload").alias("page_id"),
        "response.payload_bytes",
        F.col("response.digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        page("original.metadata").alias("refers_to"),
    )
