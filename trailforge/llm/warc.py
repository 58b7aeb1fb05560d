"""WARC archives: a deterministic sharded writer, and a reader.

1. Payload digests are taken in the JVM; the smallest id of each digest comes from a partial aggregation, and only the
   repeats' decisions (id, digest, first id) are kept: thin rows, none of which carries a payload.
2. Records and decisions are range-sorted by id together, so every decision stands beside its record and payloads move
   once. Ids spread evenly, whatever a payload's or a host's share.
3. Each task writes its range to files that roll when their compressed size passes ``ROLL_BYTES``. Headers and digests
   are made anew; each record is a gzip member of its own; dates come from a parameter. So a record's bytes depend on
   its row and its payload's first page alone, and the archives, read in order, on the rows alone; where a file ends
   also depends on the number of partitions. A file is written under a temporary name and renamed when it is whole; a manifest of each task's files is
   committed by Spark's own writer. A task that runs again replaces its files by the same bytes.

Defined results: null html is an empty payload, null url an empty target; blanks, control and non-ASCII characters of a
url are percent-encoded in the target; payloads shorter than ``least`` bytes are
always responses; rows that repeat an id and a payload give one response and revisits of the same id; rows with a null
id are responses; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailforge.llm.common import Batches, files_at, new_path, small_batches, written
from trailforge.operators.skew import hot_keys, salted_join

ROLL_BYTES = 64_000_000
DATE = "2024-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: High half of our record ids (its lower 48 bits count the rows of an id); the low half is the page's id.
_SPACE = 0x7A1F0C5E000080000000000000000000


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page: int | None, copy: int = 0) -> str:
    """A UUID that holds the page's id; copy tells rows that repeat it apart. Null ids use a range of their own."""
    low = ((page or 0) & 0xFFFFFFFFFFFFFFFF) | (_SPACE & ~0xFFFFFFFFFFFFFFFF)
    return f"<urn:uuid:{uuid.UUID(int=low ^ ((copy & 0xFFFFFFFFFFFF) << 64) ^ ((page is None) << 112))}>"


def page_of(record: str) -> int:
    low = uuid.UUID(record.strip("<>").removeprefix("urn:uuid:")).int & 0xFFFFFFFFFFFFFFFF
    return low - (1 << 64) if low >> 63 else low


#: Printable ASCII characters; all others of a target are percent-encoded, as are its UTF-8 bytes.
_PLAIN = "".join(map(chr, range(0x21, 0x7F)))


def target(url: str) -> str:
    """The url without blanks, line ends or other characters that a header can't hold; what it is encoded to stays readable."""
    return quote(url.encode("utf-8", "surrogatepass"), safe=_PLAIN)


def record(page: int | None, url: str, payload: bytes, first: int | None, copy: int, date: str = DATE) -> bytes:
    """One record, uncompressed. first: the page that has the same payload, for a revisit."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if first is not None else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if first is not None else 'response'}",
        f"WARC-Record-ID: {record_id(page, copy)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target(url)}",
        f"WARC-Payload-Digest: sha1:{digest32(payload)}",
        f"WARC-Block-Digest: sha1:{digest32(block)}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if page is None:
        lines.append("WARC-Page: none")
    if first is not None:
        lines += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {record_id(first)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without a time or a name."""
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class Roller:
    """Writes members to files of a task, each under a temporary name until it is whole."""

    def __init__(self, folder: str, task: int, attempt: int, most: int):
        self.fs, self.dir = files_at(folder)
        self.task, self.attempt, self.most = task, attempt, most
        self.n, self.out, self.done = 0, None, []

    def add(self, data: bytes) -> None:
        if self.out is not None and self.size + len(data) > self.most and self.count:
            self.close()
        if self.out is None:
            self.name = f"part-{self.task:05d}-{self.n:05d}.warc.gz"
            self.temp = f"{self.dir}/_tmp-{self.attempt}-{self.name}"
            self.out, self.size, self.count, self.sum = self.fs.open_output_stream(self.temp, compression=None), 0, 0, hashlib.sha256()
        self.out.write(data)
        self.sum.update(data)
        self.size += len(data)
        self.count += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temp, f"{self.dir}/{self.name}")
            self.done.append((self.name, self.count, self.size, self.sum.hexdigest()))
            self.out, self.n = None, self.n + 1


def write_archives(pages: DataFrame, folder: str, least: int = 0, roll_bytes: int = ROLL_BYTES, date: str = DATE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the archives and gives their manifest: file, records, bytes, sha256."""
    spark = pages.sparkSession
    small_batches(spark)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(url_col, F.lit("")).alias("url"), F.coalesce(html_col, F.lit("")).cast("binary").alias("payload"))
    thin = rows.where("id is not null").where(F.length("payload") >= least).select("id", F.sha1("payload").alias("sha"))
    # The first of a digest and, where it has more rows than one, the repeats. Equal payloads are one group before the shuffle.
    counted = thin.groupBy("sha", "id").count()
    first = counted.groupBy("sha").agg(F.min("id").alias("first"), F.sum("count").alias("n")).where("n > 1")
    # A payload that very many pages have is dealt to several parts. What is joined are thin rows, written once.
    first = written(first, "repeats")
    hot = hot_keys(first, ("sha",), "n", first.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    repeats = salted_join(counted, first.select("sha", "first"), ("sha",), hot, F.col("id")).where("id <> first or count > 1").select("id", "sha", "first")
    both = rows.select("id", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("long").alias("first"), F.sha1("payload").alias("sha")).unionByName(
        repeats.select("id", F.lit(0).alias("kind"), F.lit("").alias("url"), F.lit(b"").alias("payload"), "first", "sha")
    )
    sorted_ = both.repartitionByRange("id").sortWithinPartitions("id", "sha", "kind", "url")
    fs, at = files_at(folder)
    fs.create_dir(at, recursive=True)

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        task = TaskContext.get()
        out = Roller(folder, task.partitionId(), task.taskAttemptId(), roll_bytes)
        now, copy, seen, first, answered = object(), 0, None, None, False
        for b in batches:
            for page, kind, url, payload, to, sha in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if kind == 0:
                    first, seen, answered = to, (page, sha), False
                    continue
                repeat = (page, sha) == seen
                copy = copy + 1 if page == now else 0
                # Where the first page itself repeats, its first row is the response and the others revisit it.
                refers = first if repeat and (first != page or answered) else None
                answered = repeat
                now = page
                out.add(member(record(page, url, payload, refers, copy, date)))
        out.close()
        if out.done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out.done, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["file", "records", "bytes", "sha256"])

    manifest = f"{folder}/manifest"
    schema = "file string, records long, bytes long, sha256 string"
    sorted_.mapInArrow(run, schema).write.parquet(manifest)
    return spark.read.schema(schema).parquet(manifest)


def records(stream) -> "list[tuple[dict[str, str], bytes]]":
    """Headers and block of each record of a stream of gzip members, one after the other."""
    with gzip.GzipFile(fileobj=io.BufferedReader(stream, 1 << 20)) as f:
        while line := f.readline():
            if line == b"\r\n":
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not a record: {line[:40]!r}")
            head: dict[str, str] = {}
            while (line := f.readline()) not in (b"\r\n", b""):
                k, _, v = line.decode().partition(":")
                head[k.lower()] = v.strip()
            block = f.read(int(head["content-length"]))
            if f.read(4) != b"\r\n\r\n":
                raise ValueError("a record's end is missing")
            yield head, block


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url of every record; digests are checked."""
    small_batches(spark)

    def run(batches: Batches) -> Batches:
        fs, at = files_at(folder)
        for b in batches:
            for name, n in zip(*(b.column(i).to_pylist() for i in (0, 1)), strict=True):
                rows: list[tuple] = []
                total = 0
                with fs.open_input_stream(f"{at}/{name}", compression=None) as f:
                    for head, block in records(f):
                        if f"sha1:{digest32(block)}" != head["warc-block-digest"]:
                            raise ValueError(f"{name}: a block's digest is wrong")
                        digest = head["warc-payload-digest"].removeprefix("sha1:")
                        if head["warc-type"] == "response":
                            payload = block[block.index(b"\r\n\r\n") + 4 :]
                            if digest32(payload) != digest or str(len(payload)) != head["warc-payload-length"]:
                                raise ValueError(f"{name}: a payload's digest is wrong")
                        to = head.get("warc-refers-to")
                        page = None if "warc-page" in head else page_of(head["warc-record-id"])
                        rows.append((page, int(head["warc-payload-length"]), digest, head["warc-type"], page_of(to) if to else None, head["warc-target-uri"]))
                        total += 1
                        if len(rows) == 4096:
                            yield _rows(rows)
                            rows = []
                if total != n:
                    raise ValueError(f"{name}: {total} records, {n} in the manifest")
                if rows:
                    yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return manifest.select("file", "records").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def round_trip(pages: DataFrame, least: int = 0, **names) -> DataFrame:
    """Writes pages to archives in the shared folder and reads them back."""
    folder = new_path(pages.sparkSession, "warc")
    manifest = write_archives(pages, folder, least, **names)
    files = manifest.repartition(max(1, min(10_000, manifest.count())), F.xxhash64("file"))
    return read_archives(pages.sparkSession, folder, files)
