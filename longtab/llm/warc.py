"""WARC archives: writing, normalising monolithic gzip files, reading back by offset (operator 9).

``write`` puts one record per page into archives that are one gzip stream each (the form that cannot be
read from the middle).  ``normalise`` inflates each such stream once, front to back in bounded memory,
rewrites every record as a gzip member of its own and writes a sidecar offset index beside it.
``read`` opens that index, not the archive, to find the members: it cuts it into ranges of at most a
number of bytes (or one record), and tasks seek to their ranges and inflate them in bounded memory.

Payloads that are equal and at least ``least`` bytes long are stored once: the smallest page_id's record
is the response, the others are revisits that refer to it.  Equality is by SHA-1; copies are found by
a pre-aggregated minimum per digest.

Archives are files in the shared folder (any file system that pyarrow opens by its URI: file, hdfs, s3,
...).  A task writes under a fresh name and reports it in its output row, so a lost or repeated task
leaves an orphan file at worst and never a torn one in the manifest.

Null html is an empty payload.  Null page ids have the id ``-``; they refer to the smallest id that is
there, and are responses if there is none.  Rows that repeat id and payload of a response are responses too.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longtab.session import cut_lineage, ensure_checkpoint_dir

LEAST_BYTES = 0
BLOCK_BYTES = 8 << 20    # compressed bytes that one unit of reading covers; a longer record is a unit of its own
READ = 1 << 20
ROWS = 4096              # rows that a task hands over at once
STAMP = "2024-01-01T00:00:00Z"


def with_roles(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, html, first_id): first_id is the smallest page_id of the equal payloads, null if it has none
    or the payload is smaller than ``least`` bytes."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), F.sha1(body).alias("digest"),
                        F.octet_length(body).alias("bytes"))
    first = rows.where(F.col("bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("first_id"))
    return rows.join(first, "digest", "left").select("page_id", "url", "html", "first_id")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, first_id: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has the headers of its payload but not the payload."""
    revisit = first_id is not None and first_id != page_id
    name = "-" if page_id is None else str(page_id)
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", STAMP),
            ("WARC-Target-URI", " ".join((url or "").split())), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
            ("X-Payload-Length", str(len(payload))), ("Content-Type", "text/html; charset=utf-8")]
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<urn:page:{first_id}>")]
    body = b"" if revisit else payload
    head.append(("Content-Length", str(len(body))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body + b"\r\n\r\n"


class Splitter:
    """Cuts an inflated stream into records; keeps one unfinished record at most."""

    def __init__(self) -> None:
        self.held, self.need = bytearray(), 0

    def feed(self, data: bytes) -> Iterator[bytes]:
        self.held += data
        while True:
            if not self.need:
                end = self.held.find(b"\r\n\r\n")
                if end < 0:
                    return
                head = bytes(self.held[:end])
                if not head.startswith(b"WARC/"):
                    raise ValueError("not a WARC record")
                self.need = end + 8 + int(dict(_headers(head))["content-length"])
            if len(self.held) < self.need:
                return
            yield bytes(self.held[:self.need])
            del self.held[:self.need]
            self.need = 0


def _headers(head: bytes) -> Iterator[tuple[str, str]]:
    for line in head.decode().split("\r\n")[1:]:
        k, _, v = line.partition(":")
        yield k.strip().lower(), v.strip()


def parse(raw: bytes) -> tuple[dict, bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(_headers(head))
    return fields, rest[:int(fields["content-length"])]


def inflate(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The content of a gzip file of one or many members that comes in ``pieces``, in bounded memory."""
    z = zlib.decompressobj(31)
    for data in pieces:
        if z.eof:
            z = zlib.decompressobj(31)
        while data:
            yield z.decompress(data, READ)
            while z.unconsumed_tail and not z.eof:
                yield z.decompress(z.unconsumed_tail, READ)
            data = z.unused_data
            if z.eof and data:
                z = zlib.decompressobj(31)
    if not z.eof:
        raise ValueError("the gzip stream is cut off")


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write(rows: DataFrame, folder: str) -> DataFrame:
    """``with_roles`` rows -> one monolithic archive per task; returns (archive, records)."""
    def run(batches):
        out, n, name, z = None, 0, f"{folder}/mono-{uuid.uuid4().hex}.warc.gz", zlib.compressobj(6, zlib.DEFLATED, 31)
        for b in batches:
            for page_id, url, html, first_id in zip(*[b.column(c).to_pylist() for c in ("page_id", "url", "html", "first_id")], strict=True):
                if out is None:
                    where, path = _open(name)
                    where.create_dir(path.rpartition("/")[0])
                    out = where.open_output_stream(path, compression=None)
                out.write(z.compress(record(page_id, url, html.encode("utf-8", "surrogatepass"), first_id)))
                n += 1
        if out is not None:
            out.write(z.flush())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n])], names=["archive", "records"])
    return cut_lineage(rows.select("page_id", "url", "html", "first_id").mapInArrow(run, "archive string, records long"), "archives")


def normalise(archives: DataFrame) -> DataFrame:
    """``archives(archive)`` of any gzip layout -> (archive, records): the rewritten files, one member per record.
    Beside each stands its index ``<archive>.idx``: a JSON line per record (id, offset, length)."""
    def run(batches):
        for b in batches:
            for source in b.column("archive").to_pylist():
                where, path = _open(source)
                name = f"{source.rpartition('/')[0]}/norm-{uuid.uuid4().hex}.warc.gz"
                at, n, split = 0, 0, Splitter()
                to, target = _open(name)
                with where.open_input_stream(path, compression=None) as stream, \
                        to.open_output_stream(target, compression=None) as out, \
                        to.open_output_stream(f"{target}.idx", compression=None) as index:
                    for piece in inflate(iter(lambda: stream.read(READ), b"")):
                        for raw in split.feed(piece):
                            z = zlib.compressobj(6, zlib.DEFLATED, 31)
                            member = z.compress(raw) + z.flush()
                            out.write(member)
                            fields, _ = parse(raw)
                            index.write(json.dumps({"id": fields["warc-record-id"], "offset": at, "length": len(member)}).encode() + b"\n")
                            at, n = at + len(member), n + 1
                if split.held:
                    raise ValueError(f"{source} ends inside a record")
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["archive", "records"])
    # one archive a task: a row is a whole file's work
    n = max(1, archives.count())
    spread = archives.select("archive").repartitionByRange(n, "archive")
    return cut_lineage(spread.mapInArrow(run, "archive string, records long"), "normalised")


def entries(archive: str) -> Iterator[tuple[str, int, int]]:
    """(record id, offset, length) of every line of an archive's index, streamed."""
    where, path = _open(f"{archive}.idx")
    held = b""
    with where.open_input_stream(path, compression=None) as f:
        while data := f.read(READ):
            *lines, held = (held + data).split(b"\n")
            for line in lines:
                e = json.loads(line)
                yield e["id"], e["offset"], e["length"]
    if held:
        raise ValueError(f"the index of {archive} is cut off")


def fetch(archive: str, offset: int, length: int) -> tuple[dict, bytes]:
    """The header fields and payload of the one record that an index entry names."""
    where, path = _open(archive)
    with where.open_input_file(path) as f:
        return parse(zlib.decompress(f.read_at(length, offset), 31))


def ranges(archives: DataFrame, block: int = BLOCK_BYTES) -> DataFrame:
    """(archive, start, stop, records): the members of every archive's index in ranges of at most ``block`` bytes."""
    def cut(name):
        start = stop = records = 0
        for _, offset, length in entries(name):
            if offset != stop:
                raise ValueError(f"the index of {name} leaves out bytes {stop} to {offset}")
            if records and stop + length - start > block:
                yield name, start, stop, records
                start, records = stop, 0
            stop, records = stop + length, records + 1
        if records:
            yield name, start, stop, records

    def run(batches):
        for b in batches:
            for name in b.column("archive").to_pylist():
                rows = list(cut(name))
                for i in range(0, len(rows), ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[i:i + ROWS]], pa.string() if not k else pa.int64())
                                                      for k in range(4)], names=["archive", "start", "stop", "records"])
    return archives.select("archive").mapInArrow(run, "archive string, start long, stop long, records long")


def _window(f, start: int, stop: int) -> Iterator[bytes]:
    while start < stop:
        data = f.read_at(min(READ, stop - start), start)
        if not data:
            raise ValueError("the archive is shorter than its index")
        yield data
        start += len(data)


def read(archives: DataFrame, block: int = BLOCK_BYTES) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record of normalised ``archives(archive)``,
    found by their indexes.  A response's payload is hashed again and must agree with its header, and a range
    must hold as many records as its index says."""
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    number = lambda s: None if s == "<urn:page:->" else int(s[10:-1])

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=list(names))

    def run(batches):
        for b in batches:
            for name, start, stop, records in zip(*[b.column(c).to_pylist() for c in ("archive", "start", "stop", "records")], strict=True):
                where, path = _open(name)
                rows, seen, split = [], 0, Splitter()
                with where.open_input_file(path) as f:
                    for piece in inflate(_window(f, start, stop)):
                        for raw in split.feed(piece):
                            fields, payload = parse(raw)
                            kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                            if kind == "response" and (digest != base32_sha1(payload) or int(fields["x-payload-length"]) != len(payload)):
                                raise ValueError(f"{name}: payload of {fields['warc-record-id']} does not match its digest")
                            refers = fields.get("warc-refers-to")
                            rows.append((number(fields["warc-record-id"]), int(fields["x-payload-length"]), digest, kind,
                                         number(refers) if refers else None))
                            if len(rows) == ROWS:
                                yield batch(rows)
                                seen, rows = seen + len(rows), []
                if split.held or seen + len(rows) != records:
                    raise ValueError(f"{name}: bytes {start} to {stop} do not hold the {records} records of the index")
                yield batch(rows)
    # ranges of one archive are dealt to many tasks
    n = max(archives.sparkSession.sparkContext.defaultParallelism, archives.count())
    dealt = ranges(archives, block).repartition(n, "archive", "start")
    return dealt.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Write, normalise and read back ``pages(page_id, url, html)``."""
    folder = f"{ensure_checkpoint_dir(pages.sparkSession).rstrip('/')}/longtab-warc/{uuid.uuid4().hex}"
    return read(normalise(write(with_roles(pages, least), folder)))
