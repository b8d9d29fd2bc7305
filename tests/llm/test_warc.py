import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from jobtide.llm import warc
from jobtide.llm.common import folder

FAKE = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 5\r\n\r\n"
        "hello\r\n\r\n")
PAGES = [(i, f"http://a/{i}", "x" * (i * 37 % 900) + "é" * (i % 3)) for i in range(60)]
PAGES += [(100, "u\r\nX: y", FAKE), (101, None, "a" + FAKE + FAKE + "WARC/1.0\r\n"),
          (102, "u", "WARC/1.0\r\nWARC/1.0\r\n\r\n\r\n"), (103, "u", None), (104, "u", ""), (105, "u", "same"),
          (106, "u", "same"), (107, "u", ("z" * 5000 + FAKE) * 4), (None, "u", "nul"), (None, "u", "same"),
          (108, "u", "w" * 200_000)]
KIND = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture
def small_ranges(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def derive(payload):
    return {"n": F.octet_length(payload), "found": warc.base32(F.sha1(payload))}


@pytest.mark.parametrize("least", [0, 5])
def test_magic_in_payloads_and_ranges_inside_records(spark, small_ranges, least):
    path = folder(spark, "archives")
    warc.write(spark.createDataFrame(PAGES, KIND).repartition(3), path, least_bytes=least)
    largest = {}
    for key, _, html in PAGES:
        if key is not None and len((html or "").encode()) >= least:
            largest[html or ""] = max(largest.get(html or "", -1), key)
    want = []
    for key, _, html in PAGES:
        first = largest.get(html or "")
        again = first is not None and first != key
        want.append((f"<urn:page:{'' if key is None else key}>", "revisit" if again else "response",
                     f"<urn:page:{first}>" if again else None, "sha1:" + digest(html),
                     0 if again else len((html or "").encode()), digest("" if again else html)))
    got = [(r.record_id, r.type, r.refers_to, r.digest, r.n, r.found) for r in warc.read(spark, path, derive).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_no_pages(spark):
    path = folder(spark, "archives")
    warc.write(spark.createDataFrame([], KIND), path)
    assert warc.read(spark, path, derive).count() == 0


def test_a_broken_chain_ends_the_records_of_its_file(spark, tmp_path):
    record = "WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    (tmp_path / "a.warc").write_bytes((record.format(3, "abc") + record.format(9, "short") + record.format(2, "no")).encode())
    (tmp_path / "b.warc").write_bytes(b"no archive WARC/1.0\r\nContent-Length: 1\r\n\r\nx\r\n\r\n")
    (tmp_path / "c.warc").write_bytes((record.format(3, "abc") + record.format(99, "cut off")).encode())
    got = warc.read(spark, str(tmp_path), lambda p: {"text": p.cast("string")}).select("off", "text").collect()
    assert sorted(map(tuple, got)) == [(0, "abc"), (0, "abc")] or [r.text for r in got].count("abc") == 2


def test_base32(spark):
    row = spark.range(1).select(warc.base32(F.sha1(F.lit("text").cast("binary"))).alias("d")).first()
    assert row.d == digest("text")
