"""WARC archives: writing, normalising monolithic gzip, reading by offset.

``write_archives`` lays records out with Spark's text writer, so each part
file is one gzip stream over many records: compact, but no record can be
reached without inflating all before it. ``normalise`` inflates each such file
once, as a stream, and rewrites every record as its own gzip member, with a
sidecar file of ``offset, length, record id`` lines beside the archive.
``read_records`` seeks by that index and inflates single members.

Memory stays at one chunk per task, whatever a record's or a file's size.
Archives and sidecars are written under a private name and renamed when they
are complete, so a lost or repeated task leaves no half file. The folder must
be reachable from every executor and of a kind that pyarrow opens (file, hdfs,
s3, gs); ``spark.checkpoint.dir`` names it in the registered query.

Records with equal payloads of at least ``REVISIT_MIN`` bytes are stored once:
the smallest page_id is the response, the others are revisits without payload
that name it. Smaller payloads are always responses.

Edge cases: null html is an empty payload; a null url gives an empty target;
control characters and blanks in a url are written as ``%20``; a null page_id
is written as ``null``, read back as null, and is a revisit only of an id;
rows that repeat the smallest id are all responses; an empty table gives
archives without records and no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import cut

REVISIT_MIN = 100
CHUNK = 1 << 20
READ_BYTES = 16 << 20  # compressed bytes that one task reads back
GZIP = 31  # zlib's window setting for a gzip wrapper
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
MEMBER_SCHEMA = "archive string, offset long, length long, record_id string"
RECORD_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
                 "refers_to long, url string, payload binary")


def deduplicate(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, size, refers_to); refers_to is null for responses."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("payload"))
    rows = (rows.withColumn("size", F.octet_length("payload").cast("long"))
            .withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256)))
    first = (rows.where(F.col("size") >= REVISIT_MIN).groupBy("digest")
             .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n"))
    # written first, so that the join is planned on the table's real size
    joined = rows.join(cut(first, "warc-first"), "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return joined.withColumn("refers_to", refers).drop("first_id")


def _urn(col: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(col.cast("string"), F.lit("null")), F.lit(">"))


def record_text(date: str) -> Column:
    """One record without its trailer, from the columns of ``deduplicate``."""
    revisit = F.col("refers_to").isNotNull()
    block = F.concat(F.lit(HTTP), F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\x00-\x20\x7F]", "%20")
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), _urn(F.col("page_id")), F.lit(f"\r\nWARC-Date: {date}"),
        F.lit("\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.lit("\r\nX-Payload-Length: "), F.col("size").cast("string"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), _urn(F.col("refers_to")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)


def write_archives(records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write the rows of ``deduplicate`` as monolithic ``part-*.txt.gz`` files."""
    (records.select(record_text(date).alias("value")).write
     .option("compression", "gzip").option("lineSep", "\r\n\r\n").text(path))


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri) if ":" in uri else f"file://{uri}")


class Stretch:
    """The next ``length`` bytes of an open file, as a file of their own."""

    def __init__(self, handle, length: int):
        self.handle, self.left = handle, length

    def read(self, size: int) -> bytes:
        piece = self.handle.read(min(size, self.left))
        self.left -= len(piece)
        return piece


class InflatedStream:
    """Bytes of a gzip file of one or many members, inflated chunk by chunk."""

    def __init__(self, source):
        self.source, self.inflate, self.buffer, self.fed = source, zlib.decompressobj(GZIP), b"", False

    def _more(self) -> bool:
        """Append inflated bytes to the buffer; False at the end."""
        while True:
            if self.inflate.eof:
                rest = self.inflate.unused_data
                self.inflate, self.fed = zlib.decompressobj(GZIP), False
            else:
                rest = self.inflate.unconsumed_tail
            rest = rest or self.source.read(CHUNK)
            if not rest:
                if self.fed:
                    raise EOFError("a gzip stream ends early")
                return False
            self.fed = True
            if out := self.inflate.decompress(rest, CHUNK):
                self.buffer += out
                return True

    def head(self) -> bytes | None:
        """The next record's header block with its empty line; None at the end."""
        while (at := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self._more():
                if self.buffer:
                    raise EOFError("a record's header ends early")
                return None
        head, self.buffer = self.buffer[:at + 4], self.buffer[at + 4:]
        return head

    def body(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.buffer and not self._more():
                raise EOFError("a record's block ends early")
            piece, self.buffer = self.buffer[:size], self.buffer[size:]
            size -= len(piece)
            yield piece


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def _rewrite(source_uri: str, target: str) -> None:
    """One archive into members, with its sidecar."""
    fs, source = _open(source_uri)
    out_fs, folder = _open(target)
    name = re.sub(r"(\.txt)?\.gz$", "", source.rsplit("/", 1)[-1])
    private = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with fs.open_input_stream(source, compression=None) as raw, \
            out_fs.open_output_stream(f"{private}.gz", compression=None) as out, \
            out_fs.open_output_stream(f"{private}.idx", compression=None) as index:
        stream, offset = InflatedStream(raw), 0
        while (head := stream.head()) is not None:
            fields, pack = headers(head), zlib.compressobj(wbits=GZIP)
            length = out.write(pack.compress(head))
            for piece in stream.body(int(fields["content-length"])):
                length += out.write(pack.compress(piece))
            if b"".join(stream.body(4)) != b"\r\n\r\n":
                raise ValueError(f"a record of {source_uri} has no trailer")
            length += out.write(pack.compress(b"\r\n\r\n") + pack.flush())
            index.write(f"{name}.warc.gz\t{offset}\t{length}\t{fields['warc-record-id']}\n".encode())
            offset += length
    for end in ("gz", "idx"):
        out_fs.move(f"{private}.{end}", f"{folder}/{name}.warc.{end}")


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every ``*.gz`` file of ``source`` member by member into the folder
    ``target`` and return the index (archive, offset, length, record_id)."""
    fs, folder = _open(target)
    fs.create_dir(folder, recursive=True)
    # the listing only: binaryFile does not open what is not selected
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                _rewrite(uri, target)
            yield batch

    files.mapInArrow(run, files.schema).agg(F.sum("length")).collect()
    return read_index(spark, target)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecars of a folder of normalised archives."""
    return spark.read.option("sep", "\t").option("pathGlobFilter", "*.idx").schema(MEMBER_SCHEMA).csv(folder)


def _page(urn: str | None) -> int | None:
    number = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(number[1]) if number else None


def read_records(index: DataFrame, folder: str, with_payload: bool = False,
                 read_bytes: int = READ_BYTES) -> DataFrame:
    """The records that ``index`` names, each inflated on its own; a response
    whose payload does not have the digest of its header raises."""
    total = index.agg(F.sum("length")).first()[0] or 0
    near = F.floor(F.col("offset") / read_bytes)
    dealt = index.repartition(int(total // read_bytes) + 1, "archive", near).sortWithinPartitions("archive", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        opened, handle = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if archive != opened:
                    if handle:
                        handle.close()
                    opened, handle = archive, fs.open_input_file(f"{base}/{archive}")
                handle.seek(offset)
                stream = InflatedStream(Stretch(handle, length))
                fields = headers(stream.head())
                left, digest, size, kept = int(fields["content-length"]) - len(HTTP), hashlib.sha256(), 0, []
                b"".join(stream.body(len(HTTP)))
                for piece in stream.body(left):
                    digest.update(piece)
                    size += len(piece)
                    kept += [piece] if with_payload else []
                claimed = fields["warc-payload-digest"].removeprefix("sha256:")
                if fields["warc-type"] == "revisit":
                    size = int(fields["x-payload-length"])
                elif digest.hexdigest() != claimed:
                    raise ValueError(f"{archive} at {offset}: the payload does not have its digest")
                rows.append((_page(fields["warc-record-id"]), size, claimed, fields["warc-type"],
                             _page(fields.get("warc-refers-to")), fields["warc-target-uri"],
                             b"".join(kept) if with_payload else None))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
            columns = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             [x.split()[0] for x in RECORD_SCHEMA.split(", ")])
        if handle:
            handle.close()

    return dealt.mapInArrow(run, RECORD_SCHEMA)
