"""WARC archives: writing, normalising a monolithic gzip, and reading back.

* ``write_monolithic``: Spark's text writer turns rows into archives that are one
  gzip stream from start to end, with the record terminator as line separator.
* ``normalise``: each such archive is inflated once, as a stream; every record is
  rewritten as a gzip member of its own, and a sidecar index lists the members'
  offsets. Memory holds one record and one chunk, whatever the archive's size.
* ``read_archives``: records by index, dealt out by archive and offset range, so
  an archive is read by as many tasks as its size asks for.

Archives go to the shared folder under names of their own for each task attempt;
only the index rows of attempts that Spark accepted name an archive, so a lost or
repeated attempt leaves a file that nobody reads. Tasks reach that folder through
``pyarrow.fs`` (local and network mounts, HDFS, S3 and GCS addresses).
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from base64 import b32encode

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import scratch_path

from .common import checkpointed, quoted

END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CHUNK = 1 << 20


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: four times 40 bits, ten hex digits each."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def with_types(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type, refers_to.

    Of equal payloads of ``least`` bytes or more, the row with the smallest page_id
    is the response and the others revisit it. Digests are grouped without the
    payloads, and the decision is joined back by page_id and digest together, so a
    payload that very many pages share is not dealt to one task. A null page_id
    sorts last; of rows alike in page_id and payload, one is the response."""
    h = F.coalesce(quoted(html), F.lit(""))
    rows = pages.select(quoted(key).cast("long").alias("page_id"), quoted(url).cast("string").alias("url"), h.alias("html"))
    rows = rows.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn("payload_digest", base32_sha1(F.col("html").cast("binary")))
    known = (F.coalesce("page_id", F.lit(0).cast("long")), F.col("page_id").isNull())
    rows = rows.withColumns({"k1": known[0], "k2": known[1]})
    light = rows.select("page_id", "k1", "k2", "payload_digest", "payload_bytes")
    first = light.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    marks = (
        light.where(F.col("payload_bytes") >= least).join(first, "payload_digest")
        .select("k1", "k2", "payload_digest", F.col("page_id").eqNullSafe(F.col("first")).alias("own"), "first").distinct()
    )
    same = Window.partitionBy("k1", "k2", "payload_digest").orderBy("k1")
    revisit = F.col("own").isNotNull() & ~(F.col("own") & (F.col("nth") == 1))
    return (
        rows.join(marks, ["k1", "k2", "payload_digest"], "left")
        .withColumn("nth", F.row_number().over(same))
        .select(
            "page_id", "url", "html", "payload_bytes", "payload_digest",
            F.when(revisit, "revisit").otherwise("response").alias("record_type"),
            F.when(revisit, F.col("first")).alias("refers_to"),
        )
    )


def write_monolithic(records: DataFrame, path: str) -> str:
    """One WARC record per row of ``with_types``; a gzip stream per part file."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    address = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    block = F.concat(F.lit(HTTP), F.when(revisit, "").otherwise(F.col("html")))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", address("page_id")),
        F.when(F.col("url").isNull(), "").otherwise(line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]+", "%20"))),
        F.when(revisit, F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"), line("WARC-Refers-To", address("refers_to"))
        )).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    records.select(F.concat(header, block).alias("value")).write.text(path, compression="gzip", lineSep=END)
    return path


def _filesystem(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _inflated(stream):
    """Chunks of the inflated stream, over all its members."""
    d = zlib.decompressobj(31)
    while data := stream.read(CHUNK):
        while data:
            yield d.decompress(data, 4 * CHUNK)
            data = d.unconsumed_tail
            if d.eof:
                data, d = d.unused_data, zlib.decompressobj(31)


def _records(chunks):
    """(header, block) of each record of an inflated stream."""
    held = bytearray()
    chunks = iter(chunks)

    def fill(n: int | None = None) -> bool:
        for c in chunks:
            held.extend(c)
            if c and (n is None or len(held) >= n):
                return True
        return n is not None and len(held) >= n

    while held or fill():
        seen = 0
        while (end := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not fill():
                if bytes(held).strip():
                    raise ValueError("a record's header does not end")
                return
        header = bytes(held[: end + 4])
        length = int(fields(header)["content-length"])
        if len(held) < end + 4 + length + 4 and not fill(end + 4 + length + 4):
            raise ValueError("a record's block does not end")
        yield header, bytes(held[end + 4 : end + 4 + length])
        del held[: end + 4 + length + 4]


def fields(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines if ":" in x)}


INDEX = "archive string, offset long, length long, record_id string, record_type string, payload_digest string"


def normalise(archives: DataFrame, target: str) -> DataFrame:
    """Rewrite the archives named in column ``path`` with a gzip member per record
    under ``target``; returns the index, which also lies beside each archive as
    ``.idx`` (a JSON line per member). A broken archive fails its task."""

    def run(batches):
        for batch in batches:
            for source in batch.column("path").to_pylist():
                fs, name = _filesystem(source)
                out_fs, folder = _filesystem(target)
                out_fs.create_dir(folder, recursive=True)
                place = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                rows, offset = [], 0
                with fs.open_input_stream(name, compression=None) as stream, out_fs.open_output_stream(place, compression=None) as out:
                    for header, block in _records(_inflated(stream)):
                        z = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = z.compress(header + block + b"\r\n\r\n") + z.flush()
                        out.write(member)
                        f = fields(header)
                        rows.append((place, offset, len(member), f.get("warc-record-id"), f.get("warc-type"), f.get("warc-payload-digest")))
                        offset += len(member)
                with out_fs.open_output_stream(place + ".idx", compression=None) as out:
                    for r in rows:
                        out.write((json.dumps(dict(zip(("offset", "length", "record_id", "record_type", "payload_digest"), r[1:]))) + "\n").encode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], pa.int64() if i in (1, 2) else pa.string()) for i in range(6)],
                    names=["archive", "offset", "length", "record_id", "record_type", "payload_digest"],
                )

    return checkpointed(archives.select("path").mapInArrow(run, INDEX))


def read_archives(index: DataFrame, target: str, span: int = 32 << 20, payloads: bool = False) -> DataFrame:
    """Records read back by their offsets: page_id, url, record_type, refers_to,
    payload_bytes, payload_digest (a response's from the payload itself, a
    revisit's from its header), archive, offset, length and, if asked, payload."""
    extra = ["payload"] if payloads else []
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "archive", "offset", "length", *extra]

    def run(batches):
        fs, _ = _filesystem(target)
        opened, file = None, None
        number = lambda address: int(address[10:-1]) if address and address[10:-1] else None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if archive != opened:
                    if file:
                        file.close()
                    opened, file = archive, fs.open_input_file(archive)
                header, block = next(_records([zlib.decompress(file.read_at(length, offset), 31)]))
                f = fields(header)
                payload = block.split(b"\r\n\r\n", 1)[1] if f["warc-type"] == "response" else None
                said = f["warc-payload-digest"].removeprefix("sha1:")
                if payload is not None and b32encode(hashlib.sha1(payload).digest()).decode() != said:
                    raise ValueError(f"payload digest differs in {archive} at {offset}")
                size = int(f["x-payload-length"]) if payload is None else len(payload)
                rows.append((
                    number(f["warc-record-id"]), f.get("warc-target-uri"), f["warc-type"], number(f.get("warc-refers-to")), size, said,
                    archive, offset, length, *([payload] if payloads else []),
                ))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names=names)
        if file:
            file.close()

    dealt = index.withColumn("part", F.floor(F.col("offset") / span)).repartition("archive", "part").sortWithinPartitions("archive", "offset")
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, archive string, offset long, length long"
    return dealt.select("archive", "offset", "length").mapInArrow(run, schema + (", payload binary" if payloads else ""))


def archive_pages(pages: DataFrame, path: str | None = None, **columns) -> DataFrame:
    """Write ``pages`` as monolithic archives, normalise them and read them back.

    One record and one result row per page. Null html is an empty payload, null
    url leaves the address out, null page_id is an empty record number. Spaces and
    control characters in a url are written as %20. Other columns are ignored; an
    empty table gives no rows. Archives lie under ``path`` (a new folder in the
    shared checkpoint folder unless given): ``monolithic`` and ``records``."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_monolithic(with_types(pages, **columns), f"{path}/monolithic")
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(f"{path}/monolithic").select("path")
    return read_archives(normalise(archives, f"{path}/records"), f"{path}/records")
