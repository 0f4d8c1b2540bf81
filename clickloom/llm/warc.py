"""WARC archives: written as one gzip stream, normalised to a member per record, read back.

Some archives are one gzip stream over the whole file, in which no record can be reached without
inflating all before it. The normaliser inflates such a stream once, piece by piece, writes each
record as a gzip member of its own and beside the archive an index of offsets, a JSON line for
each record. Reading back opens the index and inflates members one at a time.

Each task makes archives of its own rows, under a name that holds the attempt's random part, and
passes the paths on in its rows; a task that runs again leaves only files nobody reads. Files go
through the file system of the shared folder's address, whichever that is.

Payloads are UTF-8; a null payload is empty. Of records with equal payloads of at least
``LEAST`` bytes, the one with the smallest ``page_id`` is a response and the others revisit it;
rows that repeat that ``page_id`` are responses too. A null ``page_id`` sorts after all others. Null addresses are left out of the record's head.
Extra columns are ignored; without pages there are no archives.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.storage import shared_folder, stored

LEAST = 100
#: Bytes of payload after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 18
_GZIP = 31  # zlib's window bits for a gzip stream


#: Fixed value: the standard's name for a revisit whose payload has the digest of an earlier one.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_head(
    kind: str, page: object, url: str | None, digest: str, refers: object, length: int, revisit_of: object, date: str = "1970-01-01T00:00:00Z"
) -> bytes:
    """The head of a record, up to and with the empty line."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {json.dumps(url)[1:-1]}"] if url is not None else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <urn:page:{revisit_of}>"] if kind == "revisit" else []),
        f"X-Payload-Bytes: {refers}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {length}",
    ]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def parse_head(raw: bytes) -> dict[str, str]:
    version, *lines = raw.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    return dict(line.split(": ", 1) for line in lines if line)


class RecordReader:
    """Records of an uncompressed stream that comes in pieces; holds one record at most."""

    def __init__(self) -> None:
        self.buffer = bytearray()
        self.need = 0

    def feed(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
        """(head, payload, whole record) of each record that has become complete."""
        self.buffer += piece
        while len(self.buffer) >= self.need:
            end = self.buffer.find(b"\r\n\r\n")
            if end < 0:
                self.need = len(self.buffer) + 1
                return
            head = parse_head(bytes(self.buffer[:end]))
            size = end + 4 + int(head["Content-Length"]) + 4
            if len(self.buffer) < size:
                self.need = size
                return
            record = bytes(self.buffer[:size])
            del self.buffer[:size]
            self.need = 1
            yield head, record[end + 4 : -4], record

    def close(self) -> None:
        if self.buffer:
            raise ValueError("the archive ends inside a record")


def normalise(source: BinaryIO, target: BinaryIO, index: BinaryIO, level: int = 6) -> int:
    """Rewrite one whole-file gzip stream as a member per record, with an index; the number of records.

    Streams that follow one another are read through, so that an archive which is already normal stays so.
    """
    reader, offset, count = RecordReader(), 0, 0
    inflate = zlib.decompressobj(_GZIP)
    raw = source.read(CHUNK)
    while raw:
        piece = inflate.decompress(raw, 4 * CHUNK)
        raw = inflate.unconsumed_tail
        if inflate.eof:
            raw = inflate.unused_data
            inflate = zlib.decompressobj(_GZIP)
        raw = raw or source.read(CHUNK)
        for head, _, record in reader.feed(piece):
            press = zlib.compressobj(level, zlib.DEFLATED, _GZIP)
            member = press.compress(record) + press.flush()
            target.write(member)
            index.write((json.dumps({"id": head["WARC-Record-ID"], "offset": offset, "length": len(member)}) + "\n").encode())
            offset += len(member)
            count += 1
    reader.close()
    return count


def read_records(archive: BinaryIO, index: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Head and payload of each record, by the offsets of the index."""
    rest, at = b"", -1
    while piece := index.read(CHUNK):
        *lines, rest = (rest + piece).split(b"\n")
        for line in lines:
            entry = json.loads(line)
            if entry["offset"] != at:
                archive.seek(entry["offset"])
            at = entry["offset"] + entry["length"]
            reader = RecordReader()
            for head, payload, _ in reader.feed(zlib.decompress(archive.read(entry["length"]), _GZIP)):
                yield head, payload
            reader.close()


def _system(folder: str):  # type: ignore[no-untyped-def]
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if ":/" in folder else f"file://{folder}")


def _packed(pages: DataFrame, content: Column) -> DataFrame:
    """``page, url, payload_digest`` and the compressed ``payload``, which is what is shuffled."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                raw = part.column("payload").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page"),
                        part.column("url"),
                        pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
                        pa.array([press.compress(r) for r in raw], pa.binary()),
                    ],
                    names=["page", "url", "payload_digest", "payload"],
                )

    rows = pages.select(
        F.col("page_id").cast("long").alias("page"), F.col("url").cast("string").alias("url"), content.alias("payload")
    )
    return rows.mapInArrow(pack, "page long, url string, payload_digest string, payload binary")


def with_revisits(pages: DataFrame, payload: str = "html") -> DataFrame:
    """``page, url, payload`` (compressed), ``payload_digest, revisit, response`` (the response's id) of each row."""
    content = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = _packed(pages, content)
    order = F.struct(F.col("page").isNull().alias("none"), F.col("page").alias("page"))
    first = stored(
        pages.where(F.octet_length(content) >= LEAST)
        .select(F.col("page_id").cast("long").alias("page"), F.sha2(content, 256).alias("payload_digest"))
        .groupBy("payload_digest")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("payload_digest", "first")
    )
    # a payload of very many pages is a skewed join key, whose rows the adaptive plan splits
    return rows.join(first, "payload_digest", "left").select(
        "page",
        "url",
        "payload",
        "payload_digest",
        (F.col("first").isNotNull() & ~F.col("first.page").eqNullSafe(F.col("page"))).alias("revisit"),
        F.col("first.page").alias("response"),
    )


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write each row of ``with_revisits`` as a record; ``archive`` and ``records`` of each whole-file gzip stream.

    The table has no time of capture, so all records are dated by the call.
    """
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        system, root = _system(folder)
        system.create_dir(root, recursive=True)
        inflate, out = zstandard.ZstdDecompressor(), None

        def closed() -> pa.RecordBatch:
            nonlocal out
            file, press, name, records = out[:4]
            file.write(press.flush())
            file.close()
            out = None
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64())], names=["archive", "records"])

        for batch in batches:
            columns = [batch.column(c) for c in ("page", "url", "payload", "payload_digest", "revisit", "response")]
            for row in range(batch.num_rows):
                page, url, packed, digest, revisit, response = (c[row].as_py() for c in columns)
                content = inflate.decompress(packed)
                body = b"" if revisit else content
                record = record_head("revisit" if revisit else "response", page, url, digest, len(content), len(body), response, date) + body + b"\r\n\r\n"
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out = [system.open_output_stream(f"{root}/{name}", compression=None), zlib.compressobj(4, zlib.DEFLATED, _GZIP), name, 0, 0]
                out[0].write(out[1].compress(record))
                out[3] += 1
                out[4] += len(record)
                if out[4] >= ARCHIVE_BYTES:
                    yield closed()
        if out is not None:
            yield closed()

    return rows.mapInArrow(write, "archive string, records long")


def normalise_archives(archives: DataFrame, folder: str, level: int = 4) -> DataFrame:
    """Rewrite each archive as a member per record with a sidecar index; ``archive, index, records``."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _system(folder)
        for batch in batches:
            for name, expected in zip(batch.column("archive").to_pylist(), batch.column("records").to_pylist(), strict=True):
                stem = f"{name.removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}"
                with (
                    system.open_input_stream(f"{root}/{name}", compression=None, buffer_size=CHUNK) as source,
                    system.open_output_stream(f"{root}/{stem}.members.warc.gz", compression=None) as target,
                    system.open_output_stream(f"{root}/{stem}.index.jsonl", compression=None) as index,
                ):
                    count = normalise(source, target, index, level)
                if count != expected:
                    raise ValueError(f"{name}: {count} records, {expected} were written")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{stem}.members.warc.gz"]), pa.array([f"{stem}.index.jsonl"]), pa.array([count], pa.int64())],
                    names=["archive", "index", "records"],
                )

    return archives.mapInArrow(rewrite, "archive string, index string, records long")


RECORDS = "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, url string, payload binary"


def read_archives(archives: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of normalised archives; each response's payload must have the digest of its head."""
    from pyspark.sql.types import _parse_datatype_string

    wanted = _parse_datatype_string(RECORDS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(wanted)
        system, root = _system(folder)

        def number(urn: str) -> int | None:
            value = urn.removeprefix("<urn:page:").removesuffix(">")
            return None if value == "None" else int(value)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

        for batch in batches:
            for archive, index in zip(batch.column("archive").to_pylist(), batch.column("index").to_pylist(), strict=True):
                rows, size = [], 0
                with system.open_input_file(f"{root}/{archive}") as members, system.open_input_stream(f"{root}/{index}", compression=None) as lines:
                    for head, payload in read_records(members, lines):
                        kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha256:")
                        if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(head["X-Payload-Bytes"])):
                            raise ValueError(f"{archive}: {head['WARC-Record-ID']} has another payload than its head says")
                        url = head.get("WARC-Target-URI")
                        rows.append(
                            (
                                number(head["WARC-Record-ID"]),
                                kind,
                                number(head["WARC-Refers-To"]) if kind == "revisit" else None,
                                int(head["X-Payload-Bytes"]),
                                digest,
                                None if url is None else json.loads(f'"{url}"'),
                                payload if with_payload else None,
                            )
                        )
                        size += len(payload) + 200
                        if size > 4 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return archives.mapInArrow(read, wanted)


def remove_archives(archives: DataFrame, folder: str) -> int:
    """Delete the listed archives, in tasks; how many there were."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _system(folder)
        for batch in batches:
            names = batch.column("archive").to_pylist()
            for info in system.get_file_info([f"{root}/{n}" for n in names]):
                if info.is_file:
                    system.delete_file(info.path)
            yield pa.RecordBatch.from_arrays([pa.array([len(names)], pa.int64())], names=["n"])

    return archives.mapInArrow(remove, "n long").agg(F.sum("n")).first()[0] or 0


def archive_pages(pages: DataFrame, folder: str | None = None, payload: str = "html") -> tuple[DataFrame, str]:
    """Write, normalise: the list of normalised archives (``archive, index, records``) and their folder."""
    folder = folder or f"{shared_folder(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    streams = stored(write_archives(with_revisits(pages, payload), folder))
    normal = stored(normalise_archives(streams.repartition(max(1, streams.count())), folder))
    remove_archives(streams, folder)
    return normal, folder


def page_records(pages: DataFrame) -> DataFrame:
    """Per page, as read back from the archives: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    archives, folder = archive_pages(pages)
    return read_archives(archives, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, CAST(octet_length(CAST(encode(t) AS BLOB)) AS BIGINT) AS n, sha256(encode(t)) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= {LEAST} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {LEAST} AND page_id <> first THEN first END AS refers_to
FROM f"""
