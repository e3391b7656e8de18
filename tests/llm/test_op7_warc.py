import hashlib
import uuid
import gzip

from polyscribe.llm.common import scratch_dir
from polyscribe.llm.op7_warc import SQL, decide, ingest, op7_warc, read_warc, rebuild, records, write_warc
from tests.llm.helpers import prose
from tests.oracle import compare


def pages(spark, rows):
    return spark.createDataFrame([(p, u, h, "x", 1) for p, u, h in rows], "page_id long, url string, html string, strong string, best int").repartition(3)


def brute(rows):
    best = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and p is not None:
            best[b] = max(best.get(b, p), p)
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        revisit = b in best and p is not None and p < best[b]
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", best[b] if revisit else None))
    return sorted(out, key=repr)


ROWS = [(i, f"http://h/{i % 9}", ("é" * 700 + str(i % 4)) if i % 2 else f"short {i % 3}") for i in range(50)] + [(60, None, None), (61, "u\r\nX: y", ""), (62, "u", "a\r\n\r\nWARC/1.1\r\n\r\nb" * 200), (63, "u", "a\r\n\r\nWARC/1.1\r\n\r\nb" * 200)]


def archived(spark, rows, **options):
    frame = pages(spark, rows)
    path = f"{scratch_dir(spark)}/warc-test-{uuid.uuid4().hex}"
    write_warc(frame, decide(frame), path, **options)
    return path, *ingest(spark, path)


def outcome(payloads, headers):
    got = rebuild(payloads, headers)
    assert got.filter("NOT verified").count() == 0
    return sorted((tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def test_round_trip(spark):
    _, payloads, headers = archived(spark, ROWS)
    assert outcome(payloads, headers) == brute(ROWS)


def test_payloads_are_stored_once_and_give_every_page_back(spark):
    _, payloads, headers = archived(spark, ROWS)
    assert payloads.count() == len({h or "" for _, _, h in ROWS})
    assert all(hashlib.sha256(bytes(r["payload"])).hexdigest() == r["strong"] for r in payloads.collect())
    back = headers.join(payloads, "strong").select("page_id", "url", "payload").collect()
    assert sorted(((r[0], r[1], bytes(r[2]).decode()) for r in back), key=repr) == sorted(((p, u, h or "") for p, u, h in ROWS), key=repr)


def test_records_are_rebuilt_byte_for_byte(spark):
    path, payloads, headers = archived(spark, ROWS)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()
    originals = sorted(h + b for f in files for h, b in records([bytes(f["content"])]))
    assert sorted(bytes(r["record"]) for r in rebuild(payloads, headers).collect()) == originals and len(originals) == len(ROWS)
    assert all(x.startswith(b"WARC/1.1\r\n") for x in originals)


def test_a_payload_that_does_not_fit_its_digest_is_reported(spark):
    _, payloads, headers = archived(spark, ROWS)
    spoilt = payloads.withColumn("payload", payloads["payload"].substr(1, 900))
    bad = rebuild(spoilt, headers).filter("NOT verified")
    assert bad.count() == sum(len((h or "").encode()) > 900 for _, _, h in ROWS)


def test_many_records_a_file_and_long_payloads(spark):
    rows = [(i, f"http://h/{i}", prose(i, 40)) for i in range(300)] + [(400, "u", prose(1, 400_000)), (401, "u", prose(1, 400_000)), (402, "v", prose(2, 300_000))]
    path, payloads, headers = archived(spark, rows, file_bytes=1_000_000)
    assert outcome(payloads, headers) == brute(rows)
    assert len(spark.read.format("binaryFile").load(path).select("path").collect()) >= 3


def test_members_and_pieces():
    one = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nab\r\nc\r\n\r\n"
    packed = gzip.compress(one) + gzip.compress(one)  # a member a record, as other writers make them
    for size in (1, 7, 1000):
        assert list(records(packed[i : i + size] for i in range(0, len(packed), size))) == [(one[:31], b"ab\r\nc")] * 2


def test_edges(spark):
    for rows in ([], [(None, None, None)], [(None, "u", "z" * 2000), (3, "u", "z" * 2000), (3, "u", "z" * 2000)]):
        _, payloads, headers = archived(spark, rows)
        assert outcome(payloads, headers) == brute(rows)


def test_sql(spark, data):
    compare(op7_warc(spark, data), SQL, data)
