"""Archives: written, read back, filtered by headers, payloads skipped."""

import base64
import gzip
import hashlib
import re

import pytest

from cropledger.llm import warc
from cropledger.session import fresh_folder

PAGES = "page_id long, url string, html string"


def archive(spark, rows, parts=3):
    path = f"{fresh_folder(spark)}/archive"
    warc.write(spark.createDataFrame(rows, PAGES).repartition(parts), path)
    return path


def brute(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "")]
        top = max((p for p in same if p is not None), default=None)
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if page == top else "revisit", None if page == top else top))
    return sorted(out, key=str)


def test_round_trip_with_copies_nulls_and_odd_bytes(spark):
    rows = [
        (1, "http://a/1", "<p>é\r\n\r\nWARC/1.1\r\n\r\n"), (2, "http://a/2", "<p>é\r\n\r\nWARC/1.1\r\n\r\n"), (3, None, None), (4, "http://b\r\nX: y", ""),
        (5, "u", "x" * 500_000), (6, "u", "\u0000\U0001f600"), (None, "u", "alone"), (None, "u", ""), (7, "u", "twice"), (7, "u", "twice"),
    ]
    got = warc.round_trip(spark.createDataFrame(rows, PAGES)).collect()
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(found, key=str) == brute(rows)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_extra_columns_that_clash(spark):
    df = spark.createDataFrame([(1, "u", "a", "d", 9), (2, "u", "a", "d", 9)], f"{PAGES}, digest string, leader int")
    assert {(r.page_id, r.refers_to) for r in warc.round_trip(df).collect()} == {(1, 2), (2, None)}


def test_filters_reach_the_reader(spark):
    rows = [(k, f"http://host{k % 3}/{k}", f"text {k // 2}") for k in range(40)]
    path = archive(spark, rows)
    df = warc.read(spark, path)
    assert df.where("record_type = 'revisit'").count() == 20
    assert df.where("target_uri LIKE 'http://host1/%' AND record_type != 'revisit'").count() == len([k for k, _, _ in rows if k % 3 == 1 and k % 2])
    assert df.where("payload_bytes > 6").count() == 20
    assert df.where("refers_to IS NULL").count() == 20
    assert df.where("record_id IN ('<urn:page:3>', '<urn:page:4>')").count() == 2
    plan = df.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"\bFilter\b", plan)  # nothing left for Spark to filter


def test_unwanted_payloads_are_neither_read_nor_decoded(tmp_path):
    """A payload that is cut off is an error only for those who want it."""
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    broken = b"WARC/1.1\r\nWARC-Type: request\r\nWARC-Record-ID: <b>\r\nContent-Length: 900\r\n\r\nshort"
    (tmp_path / "a.warc").write_bytes(record + broken)
    reader = warc.WarcReader(str(tmp_path), 1 << 20, True)
    (part,) = reader.partitions()
    with pytest.raises(ValueError, match="cut off"):
        list(reader.read(part))
    assert list(reader.pushFilters([warc.EqualTo(("record_type",), "response")])) == []
    assert [r[9] for r in reader.read(part)] == [b"abcd"]


def test_gzip_members_folded_headers_and_groups_of_files(spark, tmp_path):
    one = b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <%d>\r\nX-Long: a\r\n  b\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(one % k) for k in range(3)))
    (tmp_path / "b.warc").write_bytes(one % 3)
    (tmp_path / "_SUCCESS").write_bytes(b"")
    rows = warc.read(spark, str(tmp_path)).collect()
    assert sorted(r.record_id for r in rows) == ["<0>", "<1>", "<2>", "<3>"]
    assert all(r.payload == b"xyz" and r.headers["x-long"] == "a b" for r in rows)
    assert len(warc.WarcReader(str(tmp_path), 1, True).partitions()) == 2
    assert warc.read(spark, str(tmp_path), payload="false").where("payload IS NULL").count() == 4


def test_a_missing_archive_is_an_error_and_an_empty_folder_is_not(spark, tmp_path):
    with pytest.raises(Exception, match="no archive at"):
        warc.read(spark, str(tmp_path / "nothing")).count()
    (tmp_path / "empty").mkdir()
    assert warc.read(spark, str(tmp_path / "empty")).count() == 0


def test_paths_are_those_of_the_default_store(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "a b")], "page_id long, url string, html string")
    for path in (str(tmp_path / "odd %20 +name"), f"file://{tmp_path}/plain"):
        warc.write(pages, path)
        assert warc.inventory(spark, path).count() == 1
    assert warc.qualified(spark, "/x/y").startswith("file:/")
