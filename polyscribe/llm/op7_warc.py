"""Content-addressed WARC archive: payload bytes once, exact record headers apart, original records through joins.

``decide`` says for every page whether its record is the *response* that holds the payload or a *revisit* of it, and
``write_warc`` writes gzip-compressed WARC/1.1 files. ``ingest`` reads archives back into two tables: *payloads* has each
distinct payload once under its SHA-256, *headers* has every record's header as it was, byte for byte, with the digest of
the whole record. ``rebuild`` joins the two into the original records, and says of each whether the payload found has the
digest under which it is stored and the one that the record names, and whether the record is the one that was read.

Files are written by Spark's text writer, which knows every file system that Spark does; a file is one gzip stream, and holds
about ``FILE_BYTES`` of records, as readers take a file as one value. A file is read as a stream, a record at a time.

Defined cases. Null html: an empty payload. Payloads under ``least`` bytes are always stored in the archive, and once in the
payload table. Of equal payloads the response is the row with the largest page_id; repeated rows with that page_id are all
responses. A null page_id has no record id to refer to, so such a row is always a response, written with an
empty id. A null url has no URI header; a url with line breaks is written percent-encoded, under a header that says so, and comes
back as it was. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyscribe.llm.common import discard, forget_shuffles, materialise, scratch_dir, table

LEAST = 1000
#: About so many bytes of records a file.
FILE_BYTES = 128_000_000
_CRLF = "\r\n"
_END = b"\r\n\r\n"


def decide(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, payload_bytes, payload_digest (SHA-1), strong (SHA-256), record_type, refers_to; one row a page.

    Equality of payloads is equality of length and SHA-256. Winners are a max with map-side combine; rows meet them by records
    of digests only, never with their payloads, and payloads too small to be shared, of which many may be equal, meet nothing.
    """
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    facts = materialise(
        pages.select(F.col("page_id").cast("long").alias("page_id"), body.alias("body"))
        .select("page_id", F.octet_length("body").cast("long").alias("payload_bytes"), F.sha1("body").alias("payload_digest"), F.sha2("body", 256).alias("strong")),
        "warc-facts",
    )
    shared = (F.col("payload_bytes") >= least) & F.col("page_id").isNotNull()
    best = facts.filter(shared).groupBy("strong").agg(F.max("page_id").alias("best"), F.count("*").alias("n"))
    large = facts.filter(shared).join(best.filter("n > 1").select("strong", "best"), "strong", "left")
    out = large.unionByName(facts.filter(~shared).withColumn("best", F.lit(None).cast("long")))
    revisit = F.col("best").isNotNull() & (F.col("page_id") < F.col("best"))
    return out.select(
        "page_id", "payload_bytes", "payload_digest", "strong",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("best")).alias("refers_to"),
    )


def write_warc(pages: DataFrame, decisions: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> None:
    """Records as ``path/*.txt.gz``: WARC/1.1, one per page; the text writer's line separator is the record end."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), F.coalesce(value.cast("string"), F.lit("")), F.lit(_CRLF))
    html = F.coalesce(F.col("html"), F.lit(""))
    is_revisit = F.col("record_type") == "revisit"
    block = F.when(is_revisit, "").otherwise(html)
    url = F.col("url").cast("string")
    broken = url.rlike(r"[\r\n]") | (url != F.trim(url))
    encoded = url
    for plain, code in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A"), (" ", "%20")):
        encoded = F.replace(encoded, F.lit(plain), F.lit(code))
    target = F.when(url.isNull(), "").when(broken, F.concat(line("WARC-Target-URI", encoded), F.lit(f"X-Target-URI-Encoded: percent{_CRLF}"))).otherwise(line("WARC-Target-URI", url))
    record = F.concat(
        F.lit(f"WARC/1.1{_CRLF}"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        F.lit(f"WARC-Date: {date}{_CRLF}"), target,
        F.lit(f"Content-Type: text/html; charset=utf-8{_CRLF}"), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.upper("payload_digest"))),
        F.when(is_revisit, F.concat(line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))), F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{_CRLF}"))).otherwise(""),
        line("Content-Length", F.octet_length(F.encode(block, "utf-8"))), F.lit(_CRLF), block,
    )
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha2(F.encode(html, "utf-8"), 256).alias("strong"))
    # unique keys on both sides but for repeated rows, which are made one here and are all written
    keyed = rows.join(decisions.dropDuplicates(["page_id", "strong"]).withColumnRenamed("page_id", "p").withColumnRenamed("strong", "s"), F.col("page_id").eqNullSafe(F.col("p")) & (F.col("strong") == F.col("s")))
    mean = decisions.agg(F.avg("payload_bytes")).first()[0] or 0
    each = max(1, int(file_bytes // (mean + 500)))
    keyed.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", each).text(path)


FIELDS = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("said_sha1", pa.string()), ("header", pa.binary()), ("stored_bytes", pa.int64()), ("stored_sha1", pa.string()), ("strong", pa.string()), ("record_digest", pa.string()), ("payload", pa.binary())]
_SQL = {"int64": "long", "string": "string", "binary": "binary"}
SCHEMA = ", ".join(f"{n} {_SQL[str(t)]}" for n, t in FIELDS)


def records(chunks):
    """(header, payload) of the records of a gzip-compressed archive given as pieces of bytes; a payload is held once, a file never."""
    import zlib

    chunks = iter(chunks)
    unzip, held, at, done = zlib.decompressobj(31), bytearray(), 0, False

    def more():
        nonlocal unzip, held, at, done
        if at > 1_000_000:
            del held[:at]
            at = 0
        piece = next(chunks, None)
        if piece is None:
            done = True
            return
        while piece:
            held += unzip.decompress(piece)
            piece = unzip.unused_data
            if unzip.eof:  # the next member
                unzip = zlib.decompressobj(31)

    while True:
        while (end := held.find(_END, at)) < 0 and not done:
            more()
        if end < 0:
            if bytes(held[at:]).strip():
                raise ValueError("truncated WARC header")
            return
        header = bytes(held[at : end + 4])
        size = next(int(x[15:]) for x in header.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        at = end + 4
        while len(held) < at + size and not done:
            more()
        if len(held) < at + size:
            raise ValueError("truncated WARC record")
        payload = bytes(held[at : at + size])
        at += size
        while len(held) < at + 4 and not done:
            more()
        at += 4
        yield header, payload


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """A row for each record: its fields, exact header, and length, SHA-1 and SHA-256 of the bytes found, which come along if asked for."""

    def parse(batches):
        import hashlib
        from urllib.parse import unquote

        number = lambda x: int(x.removeprefix("<urn:page:").rstrip(">") or -1) if x and x != "<urn:page:>" else None

        def row(header, payload):
            head = dict(x.split(": ", 1) for x in header.decode().split("\r\n")[1:] if ": " in x)
            url = head.get("WARC-Target-URI")
            whole = hashlib.sha256(header)
            whole.update(payload)
            return (
                number(head["WARC-Record-ID"]), unquote(url) if "X-Target-URI-Encoded" in head else url, head["WARC-Type"], number(head.get("WARC-Refers-To")), head["WARC-Payload-Digest"].removeprefix("sha1:").lower(),
                header, len(payload), hashlib.sha1(payload).hexdigest(), hashlib.sha256(payload).hexdigest(), whole.hexdigest(), payload if with_payload else None,
            )

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), FIELDS, strict=True)], schema=pa.schema(FIELDS))

        for batch in batches:
            for packed in batch.column(0):
                view = memoryview(packed.as_buffer())
                rows, size = [], 0
                for header, payload in records(bytes(view[i : i + 262_144]) for i in range(0, len(view), 262_144)):
                    rows.append(row(header, payload))
                    size += len(header) + (len(payload) if with_payload else 0)
                    if size > 4_000_000:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parse, SCHEMA)


def ingest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(payloads: strong, payload; headers: a row for each record, with the strong digest of its payload), both written.

    A payload stands once in ``payloads``, whatever the number of its records. A revisit takes the digest of the response that it names,
    by record and payload digest.
    """
    found = read_warc(spark, path).filter("record_type = 'response'").select("strong", "payload")
    # the first of equal bytes is any of them, so partial aggregation keeps one a task
    payloads = materialise(found.groupBy("strong").agg(F.first("payload").alias("payload")), "warc-payloads")
    forget_shuffles(spark)
    every = materialise(read_warc(spark, path, with_payload=False).drop("payload"), "warc-records")
    held = every.filter("record_type = 'response' AND page_id IS NOT NULL").groupBy(F.col("page_id").alias("_r"), F.col("stored_sha1").alias("_d")).agg(F.max("strong").alias("_strong"))
    revisits = every.filter("record_type = 'revisit'").join(held, (F.col("refers_to") == F.col("_r")) & (F.col("said_sha1") == F.col("_d")), "left").withColumn("strong", F.col("_strong"))
    headers = materialise(every.filter("record_type != 'revisit'").unionByName(revisits.select(*every.columns)), "warc-headers")
    discard(every)
    return payloads, headers


def rebuild(payloads: DataFrame, headers: DataFrame) -> DataFrame:
    """headers' page_id, url, record_type and refers_to with payload_bytes, payload_digest, record (the original's bytes; of revisits the header alone) and verified.

    Lengths and digests are taken from the stored bytes. Responses meet their payloads; revisits, of which a payload may have any
    number, only its length and digests.
    """
    facts = payloads.select("strong", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), (F.sha2("payload", 256) == F.col("strong")).alias("_sound"), "payload")
    columns = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    named = F.coalesce(F.col("_sound") & (F.col("payload_digest") == F.col("said_sha1")), F.lit(False))
    # payloads grow with the pages: never broadcast
    full = headers.filter("record_type != 'revisit'").join(facts.hint("merge"), "strong", "left").withColumn("record", F.concat("header", "payload"))
    light = headers.filter("record_type = 'revisit'").join(facts.drop("payload").hint("merge"), "strong", "left").withColumn("record", F.col("header"))
    same = F.coalesce(F.sha2("record", 256) == F.col("record_digest"), F.lit(False))
    return full.select(*columns, "record", (named & same).alias("verified")).unionAll(light.select(*columns, "record", (named & same).alias("verified")))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives written and read back, and every original record rebuilt from the payload and header tables."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    decisions = materialise(decide(pages), "warc-decisions")
    path = f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(pages, decisions, path)
    discard(decisions)
    forget_shuffles(spark)
    payloads, headers = ingest(spark, path)
    return rebuild(payloads, headers).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages
), b AS (
  SELECT body, max(page_id) AS best FROM p WHERE n >= 1000 GROUP BY body
)
SELECT page_id, n AS payload_bytes, sha1(p.body) AS payload_digest,
       CASE WHEN page_id < best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < best THEN best END AS refers_to, TRUE AS verified
FROM p LEFT JOIN b ON p.body = b.body
"""
