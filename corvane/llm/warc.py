"""WARC archives as a table of chunks.

Writing turns each payload into rows of (record, chunk number, bytes) of bounded
size; a payload of several chunks becomes a segmented record (a first segment
and `continuation` records, as the WARC standard has it), so no row of the
archive is larger than a chunk and its header. Spark's own text writer stores
the rows, and with them comes its commit protocol: a lost executor costs a
repeated task. A payload that an earlier record holds already is written as a
`revisit` without a block.

Reading streams each archive file with a buffer of one chunk. It gives the same
kind of rows, each with the digest of the payload *so far*, carried from chunk
to chunk and across the segments of a record, so that the last row of a record
has its length and digest and no record is ever held whole.

Defined results: a null payload counts as empty; equal payloads below
`min_revisit` bytes are all responses; a record with a null id is never the
one that others revisit, and neither is any record whose payload has only such
ids; rows with the id of the first record of their payload are all responses.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.tables import narrow

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 1 << 20
CHUNKS = "record_id string, record_type string, uri string, refers_to string, chunk_no int, data binary, bytes_so_far bigint, sha256_so_far string, last boolean"


def mark_revisits(pages: DataFrame, id_col: str, uri_col: str, payload_col: str, min_revisit: int = 100) -> DataFrame:
    """record_id, uri, payload (binary), sha256, refers_to: the smallest id of an equal payload, if that is another."""
    records = narrow(pages, record_id=id_col, uri=uri_col, payload=payload_col).withColumn(
        "payload", F.coalesce(F.col("payload").cast("binary"), F.lit(b""))
    )
    records = records.withColumn("sha256", F.sha2("payload", 256))
    firsts = (
        records.where((F.length("payload") >= min_revisit) & F.col("record_id").isNotNull())
        .groupBy("sha256")
        .agg(F.min("record_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("sha256", "first_id")
    )
    joined = records.join(firsts, "sha256", "left")
    return joined.withColumn("refers_to", F.when(~F.col("first_id").eqNullSafe(F.col("record_id")), F.col("first_id"))).drop("first_id")


def _line(name: str, value) -> F.Column:
    """A header line, left out where its value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_archive(records: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write the records of `mark_revisits` below `path`, as gzipped WARC files."""
    size = F.length("payload")
    revisit = F.col("refers_to").isNotNull()
    chunks = F.when(revisit, F.lit(1)).otherwise(F.greatest(F.lit(1), F.ceil(size / chunk_bytes).cast("int")))
    rows = records.withColumn("n_chunks", chunks).withColumn("chunk_no", F.explode(F.sequence(F.lit(1), "n_chunks")))
    block = F.when(revisit, F.lit(b"")).otherwise(
        F.substring(F.col("payload"), (F.col("chunk_no") - 1) * chunk_bytes + 1, F.lit(chunk_bytes))
    )
    name = F.concat(F.lit("<urn:record:"), F.coalesce(F.col("record_id").cast("string"), F.lit("")))
    urn = F.concat(name, F.lit(">"))
    part_urn = F.when(F.col("chunk_no") == 1, urn).otherwise(F.concat(name, F.lit("#"), F.col("chunk_no").cast("string"), F.lit(">")))
    segmented = F.col("n_chunks") > 1
    kind = F.when(revisit, "revisit").when(F.col("chunk_no") == 1, "response").otherwise("continuation")
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", part_urn),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.regexp_replace("uri", r"[\r\n]", " ")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("sha256"))),
        _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:record:"), F.col("refers_to").cast("string"), F.lit(">")))),
        _line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        # A revisit has no block; this says how long the payload is that it stands for.
        _line("X-Payload-Length", F.when(revisit, size.cast("string"))),
        _line("WARC-Segment-Number", F.when(segmented, F.col("chunk_no").cast("string"))),
        _line("WARC-Segment-Origin-ID", F.when(F.col("chunk_no") > 1, urn)),
        _line("WARC-Segment-Total-Length", F.when(segmented & (F.col("chunk_no") == F.col("n_chunks")), size.cast("string"))),
        _line("Content-Length", F.length(block).cast("string")),
        F.lit("\r\n"),
    )
    # The writer ends each row with the second line break that a record needs.
    value = F.concat(header.cast("binary"), block, F.lit(b"\r\n")).cast("string")
    rows.select(value.alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


class Stream:
    """Bytes of a gzipped or plain file, by lines and by counts, with a small buffer."""

    def __init__(self, file, block: int = 1 << 16):
        self.file, self.block, self.buffer, self.zip = file, block, b"", None
        start = file.read(block)
        if start[:2] == b"\x1f\x8b":
            self.zip = zlib.decompressobj(31)
        self.buffer = self._plain(start)

    def _plain(self, raw: bytes) -> bytes:
        if self.zip is None:
            return raw
        plain = b""
        while raw:
            plain += self.zip.decompress(raw)
            raw = self.zip.unused_data
            if self.zip.eof:  # the next member of the file
                self.zip = zlib.decompressobj(31)
        return plain

    def _fill(self) -> bool:
        raw = self.file.read(self.block)
        self.buffer += self._plain(raw)
        return bool(raw)

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        while (end := self.buffer.find(b"\r\n")) < 0:
            if not self._fill():
                if self.buffer:
                    raise ValueError("the archive ends within a record's header")
                return None
        line, self.buffer = self.buffer[:end], self.buffer[end + 2 :]
        return line

    def take(self, n: int) -> bytes:
        parts, missing = [], n
        while missing:
            if not self.buffer and not self._fill() and not self.buffer:
                raise ValueError("the archive ends within a record's block")
            part, self.buffer = self.buffer[:missing], self.buffer[missing:]
            parts.append(part)
            missing -= len(part)
        return b"".join(parts)


def records_of(stream: Stream, chunk_bytes: int) -> Iterator[dict]:
    """The chunk rows of one archive file, in its order."""
    import hashlib

    digest, total, number, open_id = hashlib.sha256(), 0, 0, None
    while (version := stream.line()) is not None:
        if not version:
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        fields = {}
        while line := stream.line():
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        origin = fields.get("warc-segment-origin-id")
        if origin is None:
            digest, total, number, open_id = hashlib.sha256(), 0, 0, fields.get("warc-record-id")
        elif origin != open_id:
            raise ValueError("a continuation does not follow its record")
        segmented = "warc-segment-number" in fields
        ended = not segmented or "warc-segment-total-length" in fields
        left = int(fields.get("content-length", 0))
        revisit = fields.get("warc-type") == "revisit"
        while True:
            data = stream.take(min(left, chunk_bytes))
            left -= len(data)
            digest.update(data)
            total, number = total + len(data), number + 1
            yield {
                "record_id": open_id[len("<urn:record:") : -1] or None,
                "record_type": "response" if fields["warc-type"] == "continuation" else fields["warc-type"],
                "uri": fields.get("warc-target-uri"),
                "refers_to": fields["warc-refers-to"][len("<urn:record:") : -1] if "warc-refers-to" in fields else None,
                "chunk_no": number,
                "data": data,
                "bytes_so_far": int(fields["x-payload-length"]) if revisit else total,
                "sha256_so_far": fields["warc-payload-digest"].partition(":")[2] if revisit else digest.hexdigest(),
                "last": ended and left == 0,
            }
            if left == 0:
                break
        if ended and not revisit and digest.hexdigest() != fields.get("warc-payload-digest", "").partition(":")[2]:
            raise ValueError(f"a payload differs from its digest: {open_id}")


def read_archive(spark: SparkSession, path: str, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunk rows of all archive files below `path`; see `CHUNKS` for the columns.

    Without data, the chunks are streamed and digested, and their bytes left out.
    """
    files = spark.read.format("binaryFile").load(path).select("path")
    if files.isEmpty():
        return spark.createDataFrame([], CHUNKS)
    # File names only; each file is one task's stream.
    files = files.repartition(max(1, files.count()))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        schema = pa.schema(
            [(n, pa.string()) for n in ("record_id", "record_type", "uri", "refers_to")]
            + [("chunk_no", pa.int32()), ("data", pa.binary()), ("bytes_so_far", pa.int64()), ("sha256_so_far", pa.string()), ("last", pa.bool_())]
        )
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, place = fs.FileSystem.from_uri(uri)
                # The reader follows the bytes itself: no guess by the name's ending.
                with system.open_input_stream(place, compression=None) as file:
                    rows, held = [], 0
                    for row in records_of(Stream(file), chunk_bytes):
                        if not with_data:
                            row["data"] = None
                        rows.append(row)
                        held += len(row["data"] or b"")
                        if held >= 4 * chunk_bytes or len(rows) >= 1000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return files.mapInArrow(chunks, CHUNKS)
