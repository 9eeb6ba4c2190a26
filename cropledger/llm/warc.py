"""WARC archives: a writer on Spark's text sink and a Python data source that reads them.

Writing: one record is one row of text, and the end of a record is the line separator, so Spark's own writer makes the
files, on any store and with its commit protocol. Payloads are text. Equal payloads are stored once: the record with the
largest id is the response, the others revisit it.

Reading: ``spark.read.format("warc")`` plans one partition per group of files up to ``partition_bytes``. Predicates on
record_type, on the other header columns and on payload_bytes are pushed down: a record's header block is parsed first,
and the payload of a record that fails is skipped by a seek, neither read nor decoded. With the option ``payload`` set to
false no payload is read at all. Files ending in .gz are read as a stream, skipping without decoding. The reader opens
files through pyarrow's file systems (local, HDFS, S3, GCS by the scheme of the path).

Defined results: a null payload is an empty one; an empty payload is a payload like others. Rows with the largest id of
their payload are all responses, so rows repeated whole are never revisits of themselves. A null id ranks below all others.
An empty table writes no record and reads back as no row. Records without a Content-Length end the file with an error.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith,
)

from cropledger.session import WorkFolder

VERSION = "WARC/1.1"
END = "\r\n\r\n"
#: The hexadecimal-like digits of base 32 as Spark's conv() writes them, and the alphabet of RFC 4648.
DIGITS, ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PARTITION_BYTES = 64 << 20
#: Header columns and the header each is read from.
HEADERS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
    "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "content_type": "content-type",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + (
    ", payload_bytes long, headers map<string,string>, payload binary, file string, position long"
)
#: Length of the payload that a revisit stands for; WARC has no header of its own for it.
FULL_LENGTH = "X-Payload-Length"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a text in UTF-8: eight groups of five hex digits are four base32 digits each."""
    hexed = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), DIGITS, ALPHABET)


def record_uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def with_leaders(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, leader: the largest page_id that has the same payload."""
    work = WorkFolder(pages.sparkSession)
    keyed = pages.withColumn("key", F.sha2(F.col("payload"), 256))
    leaders = keyed.groupBy("key").agg(F.max("page_id").alias("leader"), F.count(F.lit(1)).alias("n"))
    # Payloads that occur once need no lookup; the others are joined from a written table, so that Spark can split hot keys.
    shared = work.keep("leaders", leaders.where("n > 1").select("key", "leader", F.lit(True).alias("several")))
    joined = keyed.join(shared, "key", "left")
    return joined.withColumn("leader", F.when(F.col("several"), F.col("leader")).otherwise(F.col("page_id"))).drop("several", "key")


def write(pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "2000-01-01T00:00:00Z") -> None:
    """One record per row below ``path``; equal payloads become revisits of the one with the largest id."""
    slim = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("payload"),
    )
    rows = with_leaders(slim).withColumn("digest", base32_sha1(F.col("payload")))
    first = F.col("page_id").eqNullSafe(F.col("leader"))
    size = F.octet_length("payload").cast("string")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    # A line break inside a URL would end the header.
    uri = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]+", " ")
    record = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(first, F.lit("response")).otherwise(F.lit("revisit"))),
        line("WARC-Record-ID", record_uri(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(first, F.lit("")).otherwise(
            F.concat(
                line("WARC-Refers-To", record_uri(F.col("leader"))),
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            )
        ),
        line(FULL_LENGTH, size),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(first, size).otherwise(F.lit("0"))),
        F.lit("\r\n"),
        F.when(first, F.col("payload")).otherwise(F.lit("")),
    )
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if ":/" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its store, as Spark's own readers and writers take it: without a scheme it is of the default store."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


class Files(InputPartition):
    def __init__(self, names: tuple[str, ...]):
        self.names = names


def _holds(one: Filter, row: dict) -> bool:
    """Does a row of header columns pass a predicate? SQL's three values: unknown is no."""
    if isinstance(one, Not):
        inside = one.child
        if isinstance(inside, (EqualTo, In)) and row[inside.attribute[0]] is None:
            return False
        return not _holds(inside, row)
    value = row[one.attribute[0]]
    if isinstance(one, IsNull):
        return value is None
    if isinstance(one, IsNotNull):
        return value is not None
    if isinstance(one, EqualNullSafe):
        return value == one.value
    if value is None:
        return False
    if isinstance(one, EqualTo):
        return value == one.value
    if isinstance(one, In):
        return value in one.value
    if isinstance(one, StringStartsWith):
        return value.startswith(one.value)
    if isinstance(one, StringEndsWith):
        return value.endswith(one.value)
    if isinstance(one, StringContains):
        return one.value in value
    if isinstance(one, GreaterThan):
        return value > one.value
    if isinstance(one, GreaterThanOrEqual):
        return value >= one.value
    if isinstance(one, LessThan):
        return value < one.value
    return value <= one.value


COMPARISONS = (
    EqualTo, EqualNullSafe, In, IsNull, IsNotNull, StringStartsWith, StringEndsWith, StringContains, GreaterThan,
    GreaterThanOrEqual, LessThan, LessThanOrEqual,
)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, partition_bytes: int, with_payload: bool):
        self.path, self.partition_bytes, self.with_payload = path, partition_bytes, with_payload
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keep what the header block decides; the rest goes back to Spark."""
        for one in filters:
            inside = one.child if isinstance(one, Not) else one
            known = isinstance(inside, COMPARISONS) and len(inside.attribute) == 1
            text = known and inside.attribute[0] in HEADERS
            # Lengths are compared as numbers, header columns as texts.
            if text and not isinstance(inside, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) or (
                known and inside.attribute[0] == "payload_bytes"
            ):
                self.filters.append(one)
            else:
                yield one

    def partitions(self) -> Sequence[Files]:
        store, root = _store(self.path)
        info = store.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(f"no archive at {self.path}")
        if info.type == fs.FileType.Directory:
            found = store.get_file_info(fs.FileSelector(root, recursive=True))
        else:
            found = [info]
        files = [
            f for f in found
            if f.type == fs.FileType.File and f.size and not f.base_name.startswith(("_", "."))
        ]
        groups: list[Files] = []
        names: list[str] = []
        held = 0
        for file in sorted(files, key=lambda f: f.path):
            if names and held + file.size > self.partition_bytes:
                groups.append(Files(tuple(names)))
                names, held = [], 0
            names.append(file.path)
            held += file.size
        return [*groups, Files(tuple(names))] if names else groups or [Files(())]

    def read(self, partition: Files) -> Iterator[tuple]:
        store, _ = _store(self.path)
        for name in partition.names:
            with store.open_input_file(name) if not name.endswith(".gz") else store.open_input_stream(name, compression=None) as raw:
                stream = gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else io.BufferedReader(raw, 1 << 20)
                yield from self._records(stream, name)

    def _records(self, stream, name: str) -> Iterator[tuple]:
        while True:
            position = stream.tell()
            line = stream.readline()
            while line in (b"\r\n", b"\n"):  # what ends the record before
                position = stream.tell()
                line = stream.readline()
            if not line:
                return
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no WARC record at byte {position} of {name}")
            headers: dict[str, str] = {}
            last = ""
            for line in iter(stream.readline, b""):
                text = line.decode("utf-8", "replace").rstrip("\r\n")
                if not text:
                    break
                if text[0] in " \t" and last:  # a folded header goes on
                    headers[last] += " " + text.strip()
                    continue
                key, _, value = text.partition(":")
                last = key.strip().lower()
                headers[last] = value.strip()
            if "content-length" not in headers:
                raise ValueError(f"no Content-Length in the record at byte {position} of {name}")
            length = int(headers["content-length"])
            row = {c: headers.get(h) for c, h in HEADERS.items()}
            row["payload_bytes"] = int(headers.get(FULL_LENGTH.lower(), length))
            if not all(_holds(one, row) for one in self.filters):
                stream.seek(length, 1)
                continue
            if self.with_payload:
                payload = stream.read(length)
                if len(payload) < length:
                    raise ValueError(f"the record at byte {position} of {name} is cut off")
            else:
                stream.seek(length, 1)
                payload = None
            yield (*(row[c] for c in HEADERS), row["payload_bytes"], headers, payload, name, position)


class WarcSource(DataSource):
    """Options: path; payload (true or false); partition_bytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        options = self.options
        return WarcReader(
            options["path"], int(options.get("partition_bytes", PARTITION_BYTES)),
            str(options.get("payload", "true")).lower() != "false",
        )


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    """Records below ``path``; filters on header columns reach the reader. A path that is not there is an error."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").options(**options).load(qualified(spark, path))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length and digest of payloads as read, held against what the archive says of them."""
    for batch in batches:
        payloads = batch.column("payload").to_pylist()
        found = [base64.b32encode(hashlib.sha1(p).digest()).decode() for p in payloads]
        for said, digest in zip(batch.column("payload_digest").to_pylist(), found, strict=True):
            if said is not None and said != f"sha1:{digest}":
                raise ValueError(f"a payload of digest {digest} is filed under {said}")
        columns = [batch.column("record_id"), pa.array([len(p) for p in payloads], pa.int64()), pa.array(found, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["record_id", "payload_bytes", "payload_digest"])


def _id(column: Column) -> Column:
    """Number in a record's URI; null for a page without one."""
    return F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of an archive that write() made: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Responses are read whole and digested; of revisits only the headers are read.
    """
    responses = read(spark, path).where(F.col("record_type") == "response").select("record_id", "payload", "payload_digest")
    digested = responses.mapInArrow(_digests, "record_id string, payload_bytes long, payload_digest string")
    whole = digested.select(
        _id(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"),
    )
    pointers = read(spark, path, payload="false").where(F.col("record_type") == "revisit").select(
        _id(F.col("record_id")).alias("page_id"), "payload_bytes",
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), "record_type",
        _id(F.col("refers_to")).alias("refers_to"),
    )
    return whole.unionByName(pointers)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives below the shared folder and read them back."""
    work = WorkFolder(pages.sparkSession)
    write(pages, f"{work.path}/archive")
    return inventory(pages.sparkSession, f"{work.path}/archive")
