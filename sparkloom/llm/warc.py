"""WARC: a deterministic sharded writer, and a reader.

Records are range-sorted by page_id into shards whose borders depend on the data alone, written
to temporary names, rolled to a new file when the compressed size passes the target, and
committed by the driver: files are renamed, then the manifest is renamed into place.  Record
ids, dates, headers and digests are made anew from page and payload, so two runs give the same
bytes.  A reader trusts only what the manifest lists.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.shared import delete_path, even_ranges, in_ranges, new_folder

DATE = "2000-01-01T00:00:00Z"
LEAST_REVISIT = 100
ROLL_BYTES = 64_000_000
#: Payload in a shard: a part of all payloads, so that many tasks write, between two limits.
SHARD_BYTES, SHARD_MOST, SHARDS = 16_000_000, 1_000_000_000, 4000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 3


def record_id(page: int | None, url: str, digest: str, number: int) -> str:
    """Tells page, text and repetition apart; the page id can be read from it."""
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page}|{url}|{digest}|{number}")
    return f"<urn:x-page:{'' if page is None else page}:{name}>"


def page_of(id: str) -> int | None:
    page = id.strip("<>").split(":")[2]
    return int(page) if page else None


def one_line(value: str) -> str:
    """A header's value: line breaks and other controls would end it, so they are percent-encoded."""
    return "".join(c if c >= " " and c not in "\x7f\x85  " else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page: int | None, url: str, payload: bytes, digest: str, refers: tuple[int | None, str, str] | None, number: int, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers else http + payload
    head = [
        ("WARC-Type", "revisit" if refers else "response"),
        ("WARC-Record-ID", record_id(page, url, digest, number)),
        ("WARC-Date", date),
        ("WARC-Target-URI", one_line(url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
    ]
    if refers:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(*refers, 0)), ("WARC-Refers-To-Target-URI", one_line(refers[1]))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


#: Hadoop's names of file systems that Arrow knows by others.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss", "webhdfs": "hdfs", "swebhdfs": "hdfs"}


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The workers' way to a folder, as they have no Hadoop streams: local and mounted folders,
    HDFS, S3, GCS and Azure.  Others, such as viewfs, raise: give the folder behind them."""
    scheme, sign, rest = path.partition("://")
    return pa.fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}{sign}{rest}")


class Writer:
    """Files of one shard."""

    def __init__(self, folder: str, shard: int, roll: int):
        self.fs, self.folder = file_system(folder)
        self.shard, self.roll, self.number, self.stream, self.done = shard, roll, 0, None, []

    def add(self, data: bytes) -> None:
        if self.stream is None:
            self.temporary = f"{self.folder}/tmp-{self.shard:06d}-{self.number:05d}-{uuid.uuid4().hex}"
            self.stream, self.size, self.rows, self.sha = self.fs.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
        packed = member(data)
        self.stream.write(packed)
        self.sha.update(packed)
        self.size += len(packed)
        self.rows += 1
        if self.size >= self.roll:
            self.close()

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            final = f"part-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.done.append((self.temporary.rsplit("/", 1)[1], final, self.rows, self.size, self.sha.hexdigest()))
            self.stream, self.number = None, self.number + 1


def write_archive(pages: DataFrame, folder: str, date: str = DATE, roll_bytes: int = ROLL_BYTES, shard_bytes: int | None = None) -> list[dict]:
    """Write every row of ``pages`` (page_id, url, html) and return the manifest's entries.

    Null html is an empty payload, a null url an empty one; null page_ids sort last.  Of records
    with equal payloads of at least LEAST_REVISIT bytes the one of smallest page_id, then url, is
    the response and the others revisit it.  Repeated rows get a record each.  An empty table
    gives a manifest without files."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    slim = rows.select("page_id", "url", "digest", F.octet_length("html").alias("bytes"))
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")
    first = slim.where(F.col("bytes") >= LEAST_REVISIT).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.col("digest").alias("d"), F.col("first.page_id").alias("to_page"), F.col("first.url").alias("to_url"))
    # what is known of a repeated payload travels as a row of its own, just before its page
    notes = slim.join(first, F.col("digest") == F.col("d")).select("page_id", "url", "digest", F.lit(None).cast("string").alias("html"), F.lit(True).alias("note"), "to_page", "to_url")
    pages_ = rows.select("page_id", "url", "digest", "html", F.lit(False).alias("note"), F.lit(None).cast("long").alias("to_page"), F.lit(None).cast("string").alias("to_url"))
    if shard_bytes is None:
        total = slim.agg(F.sum("bytes")).first()[0] or 0
        shard_bytes = min(SHARD_MOST, max(SHARD_BYTES, total // SHARDS))
    ranges = even_ranges(slim, F.col("page_id"), F.col("bytes") + 200, shard_bytes)
    both = pages_.unionByName(notes).withColumn("shard", ranges.column)
    dealt = in_ranges(both, "shard", ranges).sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), "url", "digest", F.col("note").desc())
    spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, last, number, refers, done = None, None, 0, None, []
        for batch in source:
            columns = [batch.column(c).to_pylist() for c in ("shard", "page_id", "url", "digest", "html", "note", "to_page", "to_url")]
            for shard, page, url, digest, html, note, to_page, to_url in zip(*columns):
                if writer is None or writer.shard != shard:
                    if writer:
                        writer.close()
                        done += writer.done
                    writer = Writer(folder, shard, roll_bytes)
                if (page, url, digest) != last:
                    last, number, refers = (page, url, digest), 0, None
                if note:
                    refers = (to_page, to_url, digest)
                    continue
                own = refers is not None and number == 0 and refers[:2] == (page, url)
                writer.add(record(page, url, html.encode(), digest, None if own else refers, number, date))
                number += 1
        if writer:
            writer.close()
            done += writer.done
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(kinds)], names=["temporary", "file", "records", "bytes", "sha256"])

    # one row for each file
    files = dealt.mapInArrow(run, "temporary string, file string, records long, bytes long, sha256 string").collect()
    return commit(spark, folder, [f.asDict() for f in files])


def commit(spark: SparkSession, folder: str, files: list[dict]) -> list[dict]:
    """Put the finished files under their own names, then the manifest, which alone makes them count.

    What an earlier commit that died half-way has renamed is replaced: it was never listed, or is
    the same by content.  A folder holds one archive: writing again takes the manifest away first,
    and readers see none until the new one is there."""
    jvm = spark._jvm
    path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    fs = path("x").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    entries = sorted(files, key=lambda f: f["file"])
    fs.delete(path("manifest.json"), False)
    for f in entries:
        fs.delete(path(f["file"]), False)
        if not fs.rename(path(f["temporary"]), path(f["file"])):
            raise OSError(f"cannot commit {f['file']}")
    names = {f["file"] for f in entries}
    for status in fs.globStatus(path("part-*")):
        if status.getPath().getName() not in names:
            fs.delete(status.getPath(), False)
    for status in fs.globStatus(path("tmp-*")):  # left by attempts that died
        fs.delete(status.getPath(), False)
    entries = [{k: f[k] for k in ("file", "records", "bytes", "sha256")} for f in entries]
    stream = fs.create(path(".manifest"), True)
    stream.write(bytearray((json.dumps({"files": entries}, indent=1, sort_keys=True) + "\n").encode()))
    stream.close()
    if not fs.rename(path(".manifest"), path("manifest.json")):
        raise OSError("cannot commit the manifest")
    return entries


def records(stream, chunk: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzip stream, one member in memory at a time."""
    z, data, out = zlib.decompressobj(31), b"", bytearray()
    while True:
        if not data:
            data = stream.read(chunk)
            if not data:
                if out:
                    raise ValueError("an archive ends within a record")
                return
        out += z.decompress(data)
        data = z.unused_data
        if z.eof:
            head, _, rest = bytes(out).partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            if lines[0] != "WARC/1.1":
                raise ValueError("not a WARC record")
            headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
            block = rest[: int(headers["Content-Length"])]
            if hashlib.sha256(block).hexdigest() != headers["WARC-Block-Digest"].removeprefix("sha256:"):
                raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
            yield headers, block
            z, out = zlib.decompressobj(31), bytearray()


def read_archive(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type and refers_to of every record of
    the files in the manifest, and the payload if asked for; block digests are checked."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest.json")
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    entries = json.loads(bytes(stream.readAllBytes()).decode())["files"]
    stream.close()
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload
    if not entries:
        return spark.createDataFrame([], schema)
    names = spark.createDataFrame([(f"{folder}/{e['file']}",) for e in entries], "file string").repartition(len(entries), "file")

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for name in batch.column(0).to_pylist():
                fs, path = file_system(name)
                rows, size = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for head, block in records(stream):
                        http, _, body = block.partition(b"\r\n\r\n")
                        length = int(http.rsplit(b"Content-Length: ", 1)[1])
                        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                        kind = head["WARC-Type"]
                        if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
                            raise ValueError(f"damaged payload {head['WARC-Record-ID']}")
                        to = page_of(head["WARC-Refers-To"]) if kind == "revisit" else None
                        rows.append((page_of(head["WARC-Record-ID"]), head["WARC-Target-URI"], length, digest, kind, to, *([body] * with_payload)))
                        size += len(body) * with_payload
                        if len(rows) >= 5000 or size > 4_000_000:
                            yield pack(rows)
                            rows, size = [], 0
                if rows:
                    yield pack(rows)

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    fields = [x.split()[0] for x in schema.split(", ")]

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(fields))], names=fields)

    return names.mapInArrow(run, schema)


def round_trip(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the archives, read them back, and give what the records say: a row for each row of
    ``pages``, with the rules of ``write_archive`` for nulls, ties and repeated rows."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    write_archive(pages, folder, **options)
    return read_archive(pages.sparkSession, folder)


def remove_archive(spark: SparkSession, folder: str) -> None:
    delete_path(spark, folder)
