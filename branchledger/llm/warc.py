"""Zstandard-compressed web archives: writer and reader.

An archive starts with a skippable frame (magic ``0x184D2A5D``) that holds a dictionary, itself
compressed or not; then every record is one Zstandard frame. Each task writes its own archives
to the shared folder under names no other attempt uses; the table of archives that the job
commits names those that count, so a repeated or lost task leaves nothing behind that is read.
The reader streams: it holds one record and a small buffer.

Records: ``response`` with an HTTP head and the payload, ``revisit`` with the head alone, whose
``Content-Length`` still gives the payload's length.

Defined cases: a null payload is empty; a null id gives the record name ``null`` and comes back
null; a null address is left out; of equal payloads the row with the smallest id is the response,
rows that repeat that very id are responses too, and rows without any id to refer to are
responses; an empty table gives no archive and no record; further columns are not written. Archives
of other writers are read as well: no dictionary, folded header lines, skippable frames between
records, HTTP heads without a length and digests by other algorithms, which are checked where
known; ``payload_digest`` is always the SHA-256 of a payload that is there, and for a revisit what
the record declares.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchledger.llm.common import new_folder, written

#: Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = 0x184D2A50
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
DIGESTS = ("md5", "sha1", "sha256", "sha512")
REQUIRED = ("warc-record-id", "warc-type", "warc-date", "content-length")


class ArchiveError(ValueError):
    """An archive breaks the format; the message names the archive and the place."""


@dataclass(frozen=True)
class Writing:
    level: int = 3
    #: An archive is closed when it has this many bytes.
    archive_bytes: int = 64 << 20
    #: The dictionary is trained on an archive's first records: so many, of so many bytes at most,
    #: in samples of so many bytes. It has an eighth of their bytes, this many at most.
    sample_records: int = 512
    sample_bytes: int = 4 << 20
    sample_piece: int = 512
    dictionary_bytes: int = 64 << 10
    #: Smaller payloads are always written in full.
    least_revisit: int = 100
    date: str = "1970-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One archive record. ``refers_to``: the response that holds the payload, if not this one."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'null' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:?#[]@!$&'()*+,;=~"))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:x-page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def trained_on(records: list[bytes], w: Writing) -> zstandard.ZstdCompressionDict:
    """A dictionary of an archive's first records, of a size that suits them.

    Training wants many samples: records are cut into pieces, and heads of records without a
    payload stand beside them, so that the smallest archive has a dictionary as well.
    """
    heads = [record(i, f"https://{i}.invalid/", b"", hashlib.sha256(b"%d" % i).hexdigest(), (None, i)[i % 2], w.date) for i in range(64)]
    samples = [data[a : a + w.sample_piece] for data in records for a in range(0, len(data), w.sample_piece)] + heads
    return zstandard.train_dictionary(max(256, min(w.dictionary_bytes, sum(map(len, samples)) // 8)), samples)


class _Archive:
    """An open archive: a dictionary from its first records, then a frame for each record."""

    def __init__(self, folder: str, w: Writing):
        self.fs, base = pafs.FileSystem.from_uri(folder)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.uri = f"{folder}/{self.name}"
        self.fs.create_dir(base, recursive=True)
        self.out = self.fs.open_output_stream(f"{base}/{self.name}", compression=None)  # the name would ask for one
        self.w, self.first, self.held, self.packer = w, [], 0, None
        self.records = self.size = 0

    def add(self, data: bytes) -> None:
        self.records += 1
        if self.packer:
            self._put(self.packer.compress(data))
            return
        self.first.append(data)
        self.held += len(data)
        if len(self.first) >= self.w.sample_records or self.held >= self.w.sample_bytes:
            self._start()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def _start(self) -> None:
        trained = trained_on(self.first, self.w)
        packed = zstandard.ZstdCompressor(level=self.w.level).compress(trained.as_bytes())
        self._put(struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed)
        self.packer = zstandard.ZstdCompressor(level=self.w.level, dict_data=trained, write_checksum=True)
        for data in self.first:
            self._put(self.packer.compress(data))
        self.first = []

    def close(self) -> pa.RecordBatch:
        if not self.packer:
            self._start()
        self.out.close()
        return pa.RecordBatch.from_pydict({"path": [self.uri], "records": [self.records], "bytes": [self.size]})


def write_archives(pages: DataFrame, folder: str, w: Writing = Writing(), id_col="page_id", url_col="url", payload_col="html") -> DataFrame:
    """Write a record per row into archives in ``folder``; the committed table (path, records, bytes)."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(payload_col, F.lit("")), "utf-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    repeated = written(
        rows.where(F.octet_length("payload") >= w.least_revisit)
        .groupBy("digest").agg(F.min("page_id").alias("of"), F.count("*").alias("copies"))
        .where("copies > 1 and of is not null").select("digest", "of"),
        "warc-repeated",
    )
    rows = rows.join(repeated, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("of")), F.col("of")).alias("refers_to")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                archive = archive or _Archive(folder, w)
                archive.add(record(*row, w.date))
                if archive.size >= w.archive_bytes:
                    yield archive.close()
                    archive = None
        if archive:
            yield archive.close()

    return written(rows.mapInArrow(run, "path string, records long, bytes long"), "warc-archives")


def _dictionary(data: bytes, where: str) -> zstandard.ZstdCompressionDict:
    if data[:4] == ZSTD_MAGIC:
        data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
    if data[:4] != DICTIONARY_MAGIC:
        raise ArchiveError(f"{where}: the leading skippable frame holds no dictionary")
    return zstandard.ZstdCompressionDict(data)


#: A record larger than this, decoded, is refused: nothing else bounds what a frame unpacks to.
MOST_RECORD = 1 << 30


def frames(stream, where: str, buffer: int = 32 << 10, most: int = MOST_RECORD) -> Iterator[tuple[int, bytes]]:
    """Offset and content of every frame, decoded with the archive's dictionary; skippable frames are skipped."""
    unpacker, held, offset = zstandard.ZstdDecompressor(), b"", 0
    while True:
        while len(held) < 8 and (more := stream.read(buffer)):
            held += more
        if not held:
            return
        magic = struct.unpack("<I", held[:4])[0] if len(held) >= 8 else 0
        if magic & ~0xF == SKIPPABLE:
            size = struct.unpack("<I", held[4:8])[0]
            first, kept = offset == 0 and magic == DICTIONARY_FRAME, []
            left, held, offset = size, held[8:], offset + 8 + size
            while left:
                held = held or stream.read(buffer)
                if not held:
                    raise ArchiveError(f"{where}: {'the dictionary' if first else 'a skippable'} frame is cut short")
                if first:
                    kept.append(held[:left])
                left, held = left - min(left, len(held)), held[left:]
            if first:
                unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(b"".join(kept), where))
            continue
        frame, parts, used, unpacked = unpacker.decompressobj(), [], 0, 0
        while True:
            try:
                parts.append(frame.decompress(held))
            except zstandard.ZstdError as e:
                raise ArchiveError(f"{where}: frame at {offset}: {e}") from e
            unpacked += len(parts[-1])
            if unpacked > most:
                raise ArchiveError(f"{where}: frame at {offset} unpacks to more than {most} bytes")
            used += len(held)
            if frame.eof:
                held = frame.unused_data
                break
            if not (held := stream.read(buffer)):
                raise ArchiveError(f"{where}: frame at {offset} is cut short")
        yield offset, b"".join(parts)
        offset += used - len(held)


def _headers(lines: list[bytes], where: str) -> dict[str, str]:
    """Names in lower case; a line that starts with white space continues the one before."""
    out: dict[str, str] = {}
    last = None
    for line in lines:
        if line[:1] in (b" ", b"\t") and last is not None:
            out[last] += " " + line.decode("utf-8", "replace").strip()
            continue
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ArchiveError(f"{where}: header line without a name: {line[:60]!r}")
        last = name.decode("latin-1").strip().lower()
        out[last] = value.decode("utf-8", "replace").strip()
    return out


def agrees(declared: str, payload: bytes) -> bool:
    """Whether a payload has the declared digest, in base 16 or 32; an unknown algorithm tells nothing."""
    name, _, value = declared.partition(":")
    if name.lower().replace("-", "") not in DIGESTS:
        return True
    own = hashlib.new(name.lower().replace("-", ""), payload)
    return value.lower() == own.hexdigest() or value.upper().rstrip("=") == base64.b32encode(own.digest()).decode().rstrip("=")


def parse(data: bytes, where: str) -> dict:
    """The record in a frame, its headers and lengths checked."""
    head, blank, body = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not blank or version not in VERSIONS:
        raise ArchiveError(f"{where}: no record head")
    headers = _headers(lines, where)
    if missing := [h for h in REQUIRED if h not in headers]:
        raise ArchiveError(f"{where}: headers missing: {', '.join(missing)}")
    if not headers["content-length"].isdigit() or int(headers["content-length"]) + 4 != len(body) or body[-4:] != b"\r\n\r\n":
        raise ArchiveError(f"{where}: Content-Length {headers['content-length']} of {len(body) - 4} bytes")
    block = body[:-4]
    out = {"type": headers["warc-type"], "id": headers["warc-record-id"], "uri": headers.get("warc-target-uri"), "date": headers["warc-date"], "refers_to": headers.get("warc-refers-to"), "payload": None, "size": None, "digest": None}
    if out["type"] not in ("response", "revisit"):
        return out | {"payload": block, "size": len(block), "digest": hashlib.sha256(block).hexdigest()}
    http, blank, payload = block.partition(b"\r\n\r\n")
    if not blank or not http.startswith(b"HTTP/"):
        raise ArchiveError(f"{where}: no HTTP head")
    fields = _headers(http.split(b"\r\n")[1:], where)
    # A transfer coding makes the declared length one of another form of the payload.
    length = None if "transfer-encoding" in fields else fields.get("content-length")
    if length is not None and not length.isdigit():
        raise ArchiveError(f"{where}: HTTP length {length}")
    declared = headers.get("warc-payload-digest", "")
    if out["type"] == "revisit":
        if payload or not (out["refers_to"] or "warc-refers-to-target-uri" in headers):
            raise ArchiveError(f"{where}: a revisit needs a reference and no payload")
        return out | {"size": None if length is None else int(length), "digest": declared.removeprefix("sha256:") or None}
    if length is not None and int(length) != len(payload):
        raise ArchiveError(f"{where}: HTTP length {length}, payload of {len(payload)}")
    if not agrees(declared, payload):
        raise ArchiveError(f"{where}: the payload's digest differs")
    return out | {"payload": payload, "size": len(payload), "digest": hashlib.sha256(payload).hexdigest()}


READ = "archive string, offset long, record_type string, record_id string, target_uri string, date string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def read_archives(spark: SparkSession, archives: DataFrame, payload: bool = True, path_col: str = "path") -> DataFrame:
    """Every record of the archives that ``archives`` names; ``payload``: return payloads too.

    Archives are dealt over the shuffle partitions; one is read by one task, as a stream.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, inner = pafs.FileSystem.from_uri(path)
                with fs.open_input_stream(inner, compression=None) as stream:
                    rows, held = [], 0
                    for offset, data in frames(stream, path):
                        r = parse(data, f"{path}, {offset}")
                        rows.append((path, offset, r["type"], r["id"], r["uri"], r["date"], r["refers_to"], r["size"], r["digest"], r["payload"] if payload else None))
                        held += len(data) if payload else 500
                        if held > 8 << 20:
                            yield _records(rows)
                            rows, held = [], 0
                    yield _records(rows)

    return archives.select(F.col(path_col).alias("path")).repartition(parts, "path").mapInArrow(run, READ)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    names = ["archive", "offset", "record_type", "record_id", "target_uri", "date", "refers_to", "payload_bytes", "payload_digest", "payload"]
    types = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary()]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def page_of(column: str):
    """The id in a record's name; null if there is none."""
    return F.expr(f"try_cast(regexp_extract({column}, '^<urn:x-page:(-?[0-9]+)>$', 1) as bigint)")


def round_trip(pages: DataFrame, w: Writing = Writing()) -> DataFrame:
    """Write archives of ``pages`` to the shared folder and read their records back."""
    spark = pages.sparkSession
    archives = write_archives(pages, new_folder(spark, "warc"), w)
    return read_archives(spark, archives, payload=False)
