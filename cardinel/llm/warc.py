"""Web archives: pages written as WARC records, and records assembled to captures.

Writing is DataFrame code: a record is a text whose end is the line separator of Spark's
text writer, so that files are committed as any other output is. Equal payloads are
stored once; the later ones revisit the first.

Reading gives one row per record. Captures (responses, revisits, resources) are joined
with the requests and metadata of their transaction by concurrent-to identifiers, in
either direction and over any number of steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardinel.llm.common import saved
from cardinel.llm.warc_records import payload_of, records, sha1_base32
from cardinel.session import settings, work_folder

# Names of the format.
WARC = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = ("response", "revisit", "resource", "conversion")

CRLF = "\r\n"
# Bytes of payload that a file gets on average; a file is read as a whole.
FILE_BYTES = 32 << 20
BATCH_BYTES = 4_000_000

RECORD = (
    "file string, offset long, whole boolean, warc_type string, record_id string, "
    "concurrent_to array<string>, refers_to string, target_uri string, date string, "
    "declared_digest string, headers array<struct<name:string,value:string>>, head binary, "
    "payload binary, payload_bytes long, payload_digest string"
)
SLIM = [
    "file", "offset", "whole", "warc_type", "record_id", "concurrent_to", "refers_to",
    "target_uri", "date", "declared_digest", "headers", "head", "payload_bytes", "payload_digest",
]


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32, without a prefix."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(
        F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def _identity(*parts: Column) -> Column:
    """A record id: a name-based UUID over the parts."""
    digest = F.md5(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])))
    cuts = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _record(kind: str, headers: list[Column], content_type: str, block: Column) -> Column:
    """A record without the two line ends after its block. Null headers are left out."""
    lines = [
        F.lit(WARC),
        F.lit(f"WARC-Type: {kind}"),
        *headers,
        F.lit(f"Content-Type: {content_type}"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def decided(pages: DataFrame, least_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """Captures without payloads, and the payloads that are stored.

    Captures have `page` (the row as JSON, without its html), `copy` (1, 2, ... of equal
    rows), `digest`, `payload_bytes`, `record_type`, and `first_page` and `first_copy` of the
    response they revisit. Payloads have `page`, `copy` and `html`.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rest = [c for c in pages.columns if c.lower() != "html"]
    rows = pages.select(
        F.col("page_id").alias("_id"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest]), {"ignoreNullFields": "false"}).alias("page"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha2(html.cast("binary"), 256).alias("content"),
        base32_sha1(html.cast("binary")).alias("digest"),
    )
    # Equal rows are one row with a number of copies, so that no group of copies is large.
    slim = rows.groupBy("_id", "page", "url", "payload_bytes", "content", "digest").agg(F.count(F.lit(1)).alias("n"))
    slim = saved(slim, "warc-captures")
    order = F.struct(F.col("_id").isNull(), F.col("_id"), F.col("page"))
    firsts = slim.filter(F.col("payload_bytes") >= least_bytes).groupBy("content").agg(
        F.min(order).alias("_first"), F.sum("n").alias("_n")
    )
    # Only payloads that occur more than once need a look at the others.
    firsts = firsts.filter("_n > 1").select("content", F.col("_first.page").alias("first_page"))
    each = slim.join(firsts, "content", "left").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    is_first = F.col("first_page").isNull() | ((F.col("first_page") == F.col("page")) & (F.col("copy") == 1))
    captures = each.select(
        "page", "url", "copy", "payload_bytes", "digest", "content",
        F.when(is_first, "response").otherwise("revisit").alias("record_type"),
        F.when(~is_first, F.col("first_page")).alias("first_page"),
    )
    # One html for each stored payload: copies of a row are one before they are dealt out.
    texts = rows.groupBy(F.col("page").alias("page"), "content").agg(F.first("html").alias("html"))
    return captures, texts


def write(pages: DataFrame, folder: str, date: str, least_bytes: int = 0, compression: str = "gzip") -> None:
    """Archive a request, a response (or revisit) and a metadata record for each page.

    Pages have page_id, url and html (null: empty); their other columns go into the
    metadata as JSON, under whatever names. Of pages with equal html of at least
    `least_bytes` bytes the one with the smallest page_id (nulls last, then by the rest of
    the row) is a response, the others revisit it; of wholly equal rows one is. Equal html
    is told by SHA-256. `date` is the capture time, in the format's form.
    """
    captures, texts = decided(pages, least_bytes)
    spark = pages.sparkSession
    total = captures.agg(F.coalesce(F.sum("payload_bytes"), F.lit(0))).first()[0]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    many = {"spark.sql.shuffle.partitions": str(max(parts, -(-total // FILE_BYTES)))}
    with settings(spark, many):
        stored = captures.filter("record_type = 'response'").join(texts, ["page", "content"])
        again = captures.filter("record_type = 'revisit'")
        lines = _transaction(stored, F.col("html"), date).union(_transaction(again, None, date))
        lines.write.option("lineSep", CRLF + CRLF).option("compression", compression).text(folder)


def _transaction(rows: DataFrame, html: Column | None, date: str) -> DataFrame:
    """Three records as one text: of the capture, its request and its metadata."""
    # Characters that end a header or a request line are percent-encoded there.
    bad = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7F]", "%20")
    uri = F.when(F.length(bad) > 0, bad)
    own = [_identity(F.col("page"), F.col("copy"), F.lit(kind)) for kind in ("response", "request", "metadata")]
    first = _identity(F.col("first_page") if html is None else F.lit(""), F.lit(1).cast("long"), F.lit("response"))
    common = [_header("WARC-Date", F.lit(date)), _header("WARC-Target-URI", uri)]
    together = _header("WARC-Concurrent-To", own[0])
    answer = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(CRLF + CRLF),
    )
    parts = F.regexp_extract(F.col("url"), r"^[a-zA-Z]+://([^/?#]*)([^#]*)", 1)
    path = F.regexp_extract(bad, r"^[a-zA-Z]+://[^/?#]*([^#]*)", 1)
    path = F.when(path == "", "/").otherwise(path)
    host = F.regexp_replace(parts, r"[\x00-\x20\x7F]", "")
    asked = F.concat(F.lit("GET "), path, F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF + CRLF))
    digest = _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    capture = [_header("WARC-Record-ID", own[0]), *common, digest]
    if html is None:
        capture += [_header("WARC-Refers-To", first), F.lit(f"WARC-Profile: {PROFILE}")]
        answered = _record("revisit", capture, "application/http;msgtype=response", answer)
    else:
        answered = _record("response", capture, "application/http;msgtype=response", F.concat(answer, html))
    request = [_header("WARC-Record-ID", own[1]), *common, together]
    about = [_header("WARC-Record-ID", own[2]), *common, together]
    return rows.select(
        F.concat_ws(
            CRLF + CRLF,
            _record("request", request, "application/http;msgtype=request", asked),
            answered,
            _record("metadata", about, "application/json", F.col("page")),
        ).alias("value")
    )


def _parse(payloads: bool):
    schema = pa.schema([
        ("file", pa.string()), ("offset", pa.int64()), ("whole", pa.bool_()), ("warc_type", pa.string()),
        ("record_id", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()),
        ("target_uri", pa.string()), ("date", pa.string()), ("declared_digest", pa.string()),
        ("headers", pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))),
        ("head", pa.binary()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ])

    def row(file: str, offset: int, own: list[tuple[str, str]], block: bytes, whole: bool) -> dict:
        def one(name: str) -> str | None:
            return next((v for k, v in own if k == name), None)

        kind = (one("warc-type") or "").lower() or None
        head, payload = payload_of(block, one("content-type") or "")
        keep = payloads if kind in CAPTURES else True
        return {
            "file": file, "offset": offset, "whole": whole, "warc_type": kind,
            "record_id": one("warc-record-id") or f"<{file}#{offset}>",
            "concurrent_to": [v for k, v in own if k == "warc-concurrent-to"],
            "refers_to": one("warc-refers-to"), "target_uri": one("warc-target-uri"),
            "date": one("warc-date"), "declared_digest": one("warc-payload-digest"),
            "headers": [{"name": k, "value": v} for k, v in own],
            "head": head, "payload": payload if keep else None,
            "payload_bytes": len(payload), "payload_digest": sha1_base32(payload),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, data = batch.column(0)[i].as_py(), memoryview(batch.column(1)[i].as_buffer())
                rows, size = [], 0
                for found in records(bytes(data)):
                    rows.append(row(file, *found))
                    size += len(found[2])
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of all files of a folder, plain or gzip, in one member or one per record.

    A file is read by one task as a whole. Records without an id get one from their place.
    A record that is cut off is not `whole`; bytes between records are passed over.
    Without `payloads` those of captures are left out, while their size and digest stay.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(_parse(payloads), RECORD)


def assemble(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per capture with all records of its transaction.

    `capture` is the response, revisit or resource with its payload (null if not asked
    for: then files are read once instead of twice); `requests` and
    `metadata` are arrays of records, in order of file and offset, and `others` has
    records of other types that name it. `original` has record id, target, size and
    digest of what a revisit refers to, if that is in the folder too. Records that lead
    to no capture are rows of their own, with a null capture. Of records with one id the
    first by file and offset counts; warcinfo records belong to no transaction and are
    left out.
    """
    slim = saved(read(spark, folder, payloads=False).select(*SLIM, "payload"), "warc-records")
    slim = slim.filter("warc_type is null or warc_type <> 'warcinfo'")
    place = F.struct("file", "offset")
    unique = slim.groupBy("record_id").agg(
        F.min(place).alias("_at"),
        F.min_by("warc_type", place).alias("warc_type"),
        F.min_by("concurrent_to", place).alias("concurrent_to"),
        F.min_by("refers_to", place).alias("refers_to"),
    )
    unique = saved(unique, "warc-ids")
    is_capture = F.coalesce(F.col("warc_type").isin(*CAPTURES), F.lit(False))
    owners = saved(_owners(unique, is_capture), "warc-owners")

    firsts = unique.select("record_id", "_at")
    own = slim.join(firsts, "record_id").filter(place == F.col("_at")).drop("_at")
    members = own.filter(~is_capture).join(owners, "record_id", "left")
    members = members.withColumn("capture_id", F.coalesce("capture_id", "record_id"))
    fields = F.struct(*[F.col(c) for c in [*SLIM, "payload"]])

    def of_type(condition: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(condition, fields)))

    kind = F.coalesce(F.col("warc_type"), F.lit(""))
    members = members.groupBy("capture_id").agg(
        of_type(kind == "request").alias("requests"),
        of_type(kind == "metadata").alias("metadata"),
        of_type(~kind.isin("request", "metadata")).alias("others"),
    )
    full = own
    if payloads:
        full = read(spark, folder).join(firsts, "record_id").filter(place == F.col("_at"))
    captures = full.filter(is_capture).select(
        F.col("record_id").alias("capture_id"), "refers_to", fields.alias("capture")
    )
    named = unique.filter(is_capture & F.col("refers_to").isNotNull()).select(F.col("refers_to").alias("record_id")).distinct()
    original = own.join(named, "record_id", "left_semi").select(
        F.col("record_id").alias("refers_to"),
        F.struct("record_id", "target_uri", "payload_bytes", "payload_digest").alias("original"),
    )
    rows = captures.join(members, "capture_id", "full").join(original, "refers_to", "left")
    none = F.array().cast(members.schema["requests"].dataType)
    return rows.select(
        "capture_id",
        "capture",
        *[F.coalesce(c, none).alias(c) for c in ("requests", "metadata", "others")],
        "original",
    )


def _owners(unique: DataFrame, is_capture: Column) -> DataFrame:
    """`record_id` and `capture_id` of records that lead to a capture.

    Records next to a capture are found first, then those next to them, and so on; of
    several captures the least id is taken.
    """
    links = unique.select("record_id", F.explode("concurrent_to").alias("other"))
    links = links.union(links.select(F.col("other").alias("record_id"), F.col("record_id").alias("other")))
    reached = unique.filter(is_capture).select("record_id", F.col("record_id").alias("capture_id"))
    left = unique.filter(~is_capture).select("record_id")
    all_found = None
    while True:
        near = left.join(links, "record_id").join(
            reached.select(F.col("record_id").alias("other"), "capture_id"), "other"
        )
        found = saved(near.groupBy("record_id").agg(F.min("capture_id").alias("capture_id")), "warc-reached")
        all_found = found if all_found is None else all_found.union(found)
        left = saved(left.join(found, "record_id", "left_anti"), "warc-left")
        if found.isEmpty() or left.isEmpty():
            return all_found
        reached = found


def archived(pages: DataFrame, least_bytes: int = 0, payloads: bool = True) -> DataFrame:
    """Pages written to an archive in the work folder, and its captures read back."""
    folder = work_folder(pages.sparkSession, "warc")
    write(pages, folder, "2024-01-01T00:00:00Z", least_bytes)
    return assemble(pages.sparkSession, folder, payloads)


def digests(captures: DataFrame, page_type: str = "long") -> DataFrame:
    """What the archive has of each page: size, digest, and what a revisit refers to.

    Both are taken from payloads as they were read, not from what headers say. Sizes and digests of revisits are those of the record they refer to.
    """
    page = F.get_json_object(F.decode(F.get("metadata", F.lit(0))["payload"], "UTF-8"), "$.page_id").cast(page_type)
    revisit = F.col("capture.warc_type") == "revisit"
    own = captures.filter("capture.record_id is not null").select(
        page.alias("page_id"),
        F.col("capture.record_id").alias("_own"),
        F.when(revisit, F.col("capture.refers_to")).alias("_refers"),
        F.when(revisit, F.col("original.payload_bytes")).otherwise(F.col("capture.payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("original.payload_digest")).otherwise(F.col("capture.payload_digest")).alias("payload_digest"),
        F.col("capture.warc_type").alias("record_type"),
    )
    own = saved(own, "warc-digests")
    named = own.filter("record_type = 'response'").select(F.col("_own").alias("_refers"), F.col("page_id").alias("refers_to"))
    used = own.filter("_refers is not null").select("_refers").distinct()
    named = named.join(used, "_refers", "left_semi")
    return own.join(named, "_refers", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
