"""WARC archives, compressed record by record with a dictionary of their own.

Each task writes its rows into archives of bounded size. An archive starts with a skippable Zstandard frame
that holds a dictionary built from records all over the archive; every record after it is one frame, so any
record can be read alone. Of records with equal payloads one is a response, the others only refer to it, by
its address and date. A response's block is a whole HTTP message. Record ids are made of the archive's place
and the record's place in it, so no two are equal, also where rows repeat; the page's own id is a field.

Archives go to a folder that all machines share, under names that a repeated task writes anew.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitrec.storage import Scratch

#: Fixed value: the magic number of the skippable frame that holds a dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES, SAMPLE_BYTES = 64 << 10, 4 << 20
#: The dictionary is trained on pieces of this size, as long records come in several; fewer than ``TRAINED`` pieces
#: are the dictionary themselves.
PIECE_BYTES, TRAINED = 128 << 10, 8
ARCHIVE_BYTES = 32 << 20
LEVEL = 3
ROWS_A_TABLE = 2000

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _number(text: str) -> int | None:
    return int(text) if text else None


def record(
    identity: str,
    date: str,
    page_id: int | None,
    url: str | None,
    payload: bytes,
    refers_to: tuple[int | None, str | None] | None = None,
) -> bytes:
    """One WARC record. ``refers_to`` is the page id and the address of a revisit's response.

    The block is an HTTP response; that of a revisit is its head alone, as length and digest tell the payload.
    """
    revisit = refers_to is not None
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{identity}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_uri(url)}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head += [
            f"WARC-Profile: {_PROFILE}",
            f"WARC-Refers-To-Target-URI: {_uri(refers_to[1])}",
            f"WARC-Refers-To-Date: {date}",
            f"X-Refers-To-Page-ID: {'' if refers_to[0] is None else refers_to[0]}",
        ]
    message = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = message.encode() + (b"" if revisit else payload)
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _uri(url: str | None) -> str:
    return "".join(c for c in url or "" if c.isprintable())


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """The fields of a record and the body of its HTTP message."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on every k-th record, k such that these come to ``SAMPLE_BYTES`` or little more.

    Where there is too little to train on, the beginnings of the records serve as they are.
    """
    every = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    chosen = records[::every]
    pieces = [r[at : at + PIECE_BYTES] for r in chosen for at in range(0, min(len(r), SAMPLE_BYTES), PIECE_BYTES)]
    held = sum(map(len, pieces))
    if len(pieces) >= TRAINED:
        try:
            return zstandard.train_dictionary(min(DICTIONARY_BYTES, held // 8), pieces)
        except zstandard.ZstdError:  # the records are too short, or too much alike
            pass
    size = min(DICTIONARY_BYTES, -(-held // 8))
    raw = b"".join(r[: -(-size // len(chosen))] for r in chosen)[:size]
    return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def compressed(records: list[bytes]) -> bytes:
    """An archive of one record or more: the dictionary in a skippable frame, then each record as a frame."""
    dictionary = _dictionary(records)
    raw = dictionary.as_bytes()
    writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    return b"".join(
        [struct.pack("<II", DICTIONARY_MAGIC, len(raw)), raw, *(writer.compress(r) for r in records)]
    )


def frames(archive: bytes) -> Iterator[bytes]:
    """The records of an archive."""
    magic, size = struct.unpack("<II", archive[:8])
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive doesn't start with a dictionary frame")
    raw = archive[8 : 8 + size]
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    rest = memoryview(archive)[8 + size :]
    while len(rest):
        one = reader.decompressobj()
        data = one.decompress(rest)
        if not one.eof:
            raise ValueError("the archive ends within a record")
        yield data
        rest = rest[len(rest) - len(one.unused_data) :]


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return pafs.FileSystem.from_uri(uri)


def _writer(folder: str, archive_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        held: list[bytes] = []
        size = number = 0

        def name() -> str:
            return f"part-{task.partitionId():05d}-{number:05d}.warc.zst"

        def flush() -> pa.RecordBatch:
            draft = f"{root}/_{name()}.{task.taskAttemptId()}"
            with system.open_output_stream(draft, compression=None) as out:
                out.write(compressed(held))
            system.move(draft, f"{root}/{name()}")  # a repeated task replaces what the first one wrote
            return pa.RecordBatch.from_arrays([pa.array([name()]), pa.array([len(held)], pa.int64())], names=["archive", "records"])

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "response_id", "response_url", "revisit")]
            for i in range(len(batch)):
                page_id, url, html, response_id, response_url, revisit = (c[i].as_py() for c in columns)
                identity = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{root}/{name()}#{len(held)}"))
                refers_to = (response_id, response_url) if revisit else None
                held.append(record(identity, date, page_id, url, (html or "").encode(), refers_to))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
                    held, size, number = [], 0, number + 1
        if held:
            yield flush()

    return write


def write_archives(
    pages: DataFrame,
    folder: str,
    least_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
    date: dt.datetime | None = None,
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) into archives in ``folder``; returns archive and records.

    ``date``, in UTC, is the capture date of all records; by default it is the time of the call.

    Of pages with equal payloads of at least ``least_bytes`` bytes, that with the largest page_id is the
    response and the others revisit it; smaller payloads are all responses. A null html is an empty payload.
    Rows that repeat the largest page_id are responses all; a row without an id revisits if the payload has a
    row with one. Other columns are ignored.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    digests = pages.select("page_id", "url", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size"))
    responses = scratch.keep(
        digests.filter(F.col("size") >= least_bytes)
        .groupBy("digest")
        .agg(
            F.max("page_id").alias("response_id"),
            F.max_by("url", F.struct("page_id", "url")).alias("response_url"),
            F.count(F.lit(1)).alias("copies"),
        )
        .filter("copies > 1")
        .select("digest", "response_id", "response_url"),
        "responses",
    )
    rows = pages.select("page_id", "url", "html", F.sha1(payload).alias("digest")).join(responses, "digest", "left")
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    rows = rows.select("page_id", "url", "html", "response_id", "response_url", revisit.alias("revisit"))
    day = (date or dt.datetime.now(dt.UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return scratch.keep(
        rows.mapInArrow(_writer(folder, archive_bytes, day), "archive string, records long"), "archives"
    )


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Read the named archives: page_id, payload_bytes, payload_digest, record_type, refers_to and payload.

    A revisit has no payload of its own. The payload of a response must have the length and the digest that its
    record states, or the job stops.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("page_id", pa.int64()),
                ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()),
                ("record_type", pa.string()),
                ("refers_to", pa.int64()),
                ("payload", pa.binary()),
            ]
        )
        system, root = _open(folder)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                with system.open_input_stream(f"{root}/{name}", compression=None) as source:
                    archive = source.read()
                out: list[tuple] = []
                for data in frames(archive):
                    out.append(_row(*parsed(data)))
                    if len(out) == ROWS_A_TABLE:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    spread = archives.select("archive").repartition(_tasks(archives))
    return spread.mapInArrow(read, T.StructType.fromDDL(f"{_RECORD}, payload binary"))


def _tasks(archives: DataFrame) -> int:
    return int(np.clip(archives.count(), 1, 10_000))


def _row(fields: dict[str, str], body: bytes) -> tuple:
    revisit = fields["WARC-Type"] == "revisit"
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
    if not revisit and (len(body) != size or payload_digest(body) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} doesn't hold the payload that it states")
    refers_to = _number(fields["X-Refers-To-Page-ID"]) if revisit else None
    return (
        _number(fields["X-Page-ID"]),
        size,
        digest,
        fields["WARC-Type"],
        refers_to,
        None if revisit else body,
    )
