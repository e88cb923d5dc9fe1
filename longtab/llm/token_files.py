"""Token ids in binary files of patched frame-of-reference blocks, and back (operator 13).

Documents are dealt to files in ascending order of id (null first; rows of one id by a hash of their text).  A task
encodes its documents one after the other and writes their ids as one sequence in blocks of ``BLOCK`` ids:

* a block's smallest id is subtracted from all of them,
* the rest is packed in as many bits as the ``SHARE`` percentile of them needs,
* the few that need more keep their low bits there, and their high bits go to the block's exception list
  (positions and values).

Behind the blocks stand the document table (id, ids in it) and the index of block starts, then a footer with their
places.  Any range of ids is read by seeking to its blocks (``ids_between``); ``read`` goes through a file once, a
window of blocks at a time, so a document of any length takes bounded memory.

Files lie in the shared folder (any file system that pyarrow opens by its URI).  A task writes under a fresh name
and reports it in its output row: a lost or repeated task leaves an orphan at worst, never a torn file in the
manifest.  The manifest has a file's first position in the sequence of all ids; only counts per file are summed up.

Null text is an empty text and has the closing id only.  Repeated rows are documents of their own.  Null ids stay
null.  Other columns don't matter, whatever they are called.  No documents: no files, an empty table.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from longtab.llm.common import by_chars, texts_of
from longtab.llm.warc import _open
from longtab.llm.wordids import STRETCH, encoder
from longtab.session import cut_lineage, ensure_checkpoint_dir

BLOCK, SHARE, END = 1024, 0.95, 2
FILE_BYTES = 16_000_000          # bytes of text that one file is meant for
WINDOW = 64                      # blocks that are decoded at once
MAGIC = b"PFORIDS1"
_HEAD = struct.Struct("<IBHH")   # smallest id, width, ids, exceptions
_FOOT = struct.Struct("<QQQQQ8s")  # place of documents, of index; documents, ids, blocks; magic


def _packed(rest: np.ndarray, width: int) -> np.ndarray:
    """[blocks, n] values of ``width`` bits -> [blocks, width, lanes] words; 32 rows of lanes become ``width`` rows of words."""
    lanes = -(-rest.shape[1] // 32)
    rows = np.zeros((len(rest), 32 * lanes), "<u4")
    rows[:, :rest.shape[1]] = rest
    if width < 32:
        rows &= np.uint32((1 << width) - 1)
    rows = rows.reshape(len(rest), 32, lanes)
    out = np.zeros((len(rest), width, lanes), "<u4")
    for r in range(32 if width else 0):
        word, off = divmod(r * width, 32)
        out[:, word] |= rows[:, r] << np.uint32(off)
        if off + width > 32:
            out[:, word + 1] |= rows[:, r] >> np.uint32(32 - off)
    return out


def _unpacked(words: np.ndarray, width: int, n: int) -> np.ndarray:
    """The inverse of ``_packed``."""
    out = np.zeros((len(words), 32, words.shape[2]), "<u4")
    for r in range(32 if width else 0):
        word, off = divmod(r * width, 32)
        out[:, r] = words[:, word] >> np.uint32(off)
        if off + width > 32:
            out[:, r] |= words[:, word + 1] << np.uint32(32 - off)
    if width < 32:
        out &= np.uint32((1 << width) - 1)
    return out.reshape(len(words), -1)[:, :n]


def pack_blocks(ids: np.ndarray, share: float = SHARE) -> list[bytes]:
    """Blocks [blocks, n] of ids: each a header, low bits, positions and high bits of the exceptions."""
    n = ids.shape[1]
    low = ids.min(axis=1)
    rest = (ids - low[:, None]).astype("<u4")
    at = min(n - 1, int(np.ceil(share * n)) - 1)
    width = np.array([int(x).bit_length() for x in np.partition(rest, at, axis=1)[:, at]])
    out: list[bytes] = [b""] * len(ids)
    for w in np.unique(width).tolist():
        of = np.flatnonzero(width == w)
        words = _packed(rest[of], w)
        high = rest[of] >> np.uint32(w) if w < 32 else np.zeros((len(of), n), "<u4")
        for k, i in enumerate(of.tolist()):
            far = np.flatnonzero(high[k])
            out[i] = b"".join((_HEAD.pack(int(low[i]), w, n, len(far)), words[k].tobytes(), far.astype("<u2").tobytes(), high[k][far].tobytes()))
    return out


def unpack_blocks(raw: bytes, starts: list[int]) -> np.ndarray:
    """The ids of the blocks at ``starts``, one after the other."""
    heads = [_HEAD.unpack_from(raw, at) for at in starts]
    first = np.cumsum([0, *[h[2] for h in heads]])
    out = np.empty(int(first[-1]), "<u4")
    alike: dict[tuple[int, int], list[int]] = {}
    for i, (_, width, n, _) in enumerate(heads):
        alike.setdefault((width, n), []).append(i)
    for (width, n), of in alike.items():
        lanes = -(-n // 32)
        words = [np.frombuffer(raw, "<u4", width * lanes, starts[i] + _HEAD.size) for i in of]
        ids = _unpacked(np.concatenate(words).reshape(len(of), width, lanes), width, n)
        for k, i in enumerate(of):
            low, _, _, far = heads[i]
            at = starts[i] + _HEAD.size + 4 * width * lanes
            row = ids[k]
            if far:
                row[np.frombuffer(raw, "<u2", far, at)] |= np.frombuffer(raw, "<u4", far, at + 2 * far) << np.uint32(width)
            out[first[i]:first[i + 1]] = row + np.uint32(low)
    return out


class Writer:
    """Writes one file; holds a window of blocks and the tables of documents and blocks."""

    def __init__(self, out, block: int = BLOCK, share: float = SHARE) -> None:
        self.out, self.block, self.share = out, block, share
        self.at, self.starts, self.held, self.size = len(MAGIC), [], [], 0
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.lengths.append(len(ids))
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= WINDOW * self.block:
            self._blocks()

    def _blocks(self, last: bool = False) -> None:
        """Write the whole blocks that are held, a window at a time, and the rest too if it is the last."""
        ids = np.concatenate(self.held)
        whole = len(ids) // self.block * self.block
        cuts = [ids[a:min(a + WINDOW * self.block, whole)].reshape(-1, self.block) for a in range(0, whole, WINDOW * self.block)]
        for blocks in [*cuts, *([ids[whole:].reshape(1, -1)] if last and whole < len(ids) else [])]:
            for raw in pack_blocks(blocks, self.share):
                self.starts.append(self.at)
                self.out.write(raw)
                self.at += len(raw)
        self.held, self.size = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        if self.size:
            self._blocks(last=True)
        docs, index = self.at, self.at + 17 * len(self.docs)
        self.out.write(np.array([i is None for i in self.docs], np.uint8).tobytes())
        self.out.write(np.array([i or 0 for i in self.docs], "<i8").tobytes())
        self.out.write(np.array(self.lengths, "<u8").tobytes())
        self.out.write(np.array([*self.starts, docs], "<u8").tobytes())
        self.out.write(_FOOT.pack(docs, index, len(self.docs), sum(self.lengths), len(self.starts), MAGIC))


class Reader:
    """Reads one file by its index."""

    def __init__(self, source, block: int = BLOCK) -> None:
        self.source, self.block = source, block
        end = source.size()
        docs, index, n, self.ids, blocks, magic = _FOOT.unpack(source.read_at(_FOOT.size, end - _FOOT.size))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        table = source.read_at(index - docs, docs)
        self.null = np.frombuffer(table, np.uint8, n).astype(bool)
        self.doc_ids = np.frombuffer(table, "<i8", n, n)
        self.lengths = np.frombuffer(table, "<u8", n, 9 * n).astype(np.int64)
        self.starts = np.frombuffer(source.read_at(8 * (blocks + 1), index), "<u8").astype(np.int64)

    def blocks(self, a: int, b: int) -> np.ndarray:
        """Ids of blocks [a, b)."""
        first = int(self.starts[a])
        raw = self.source.read_at(int(self.starts[b]) - first, first)
        return unpack_blocks(raw, (self.starts[a:b] - first).tolist())

    def ids_between(self, a: int, b: int) -> np.ndarray:
        """Ids at positions [a, b) of the file, reading only the blocks that hold them."""
        if a >= b:
            return np.zeros(0, "<u4")
        first = a // self.block
        ids = self.blocks(first, -(-b // self.block))
        return ids[a - first * self.block:b - first * self.block]

    def windows(self, blocks: int = WINDOW) -> Iterator[np.ndarray]:
        n = len(self.starts) - 1
        for a in range(0, n, blocks):
            yield self.blocks(a, min(n, a + blocks))

    def checksums(self) -> list[int]:
        """crc32 of every document's ids, in order."""
        out, ends, crc, doc, at = [], np.cumsum(self.lengths), 0, 0, 0
        for ids in self.windows():
            stop = at + len(ids)
            while doc < len(ends) and ends[doc] <= stop:
                part = ids[at - stop + len(ids):len(ids) - stop + int(ends[doc])]
                out.append(zlib.crc32(part.tobytes(), crc))
                crc, at, doc = 0, int(ends[doc]), doc + 1
            crc, at = zlib.crc32(ids[len(ids) - stop + at:].tobytes(), crc), stop
        return out


def write(docs: DataFrame, folder: str, tokenizer: str, end: int = END, block: int = BLOCK, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``docs(doc_id, text)`` -> manifest (file, part, documents, ids, start), one row per file."""
    held = F.octet_length(F.coalesce(F.col("text"), F.lit("")))
    total = docs.agg(F.sum(held + 8).alias("n")).first()[0] or 0
    parts = max(1, -(-int(total) // file_bytes))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"),
                       F.monotonically_increasing_id().alias("no"))
    key = [F.col("doc_id").asc_nulls_first(), "mark", "no"]
    dealt = rows.repartitionByRange(parts, *key).sortWithinPartitions(*key).select(
        "doc_id", "text", F.spark_partition_id().alias("part"))

    def run(batches):
        out = writer = name = part = None
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), texts_of(batch)
            if out is None and ids:
                name, part = f"{folder}/ids-{uuid.uuid4().hex}.pfor", batch.column("part")[0].as_py()
                where, path = _open(name)
                where.create_dir(path.rpartition("/")[0])
                out = where.open_output_stream(path, compression=None)
                writer = Writer(out, block)
            for a, b in by_chars(texts, STRETCH):
                every, stops = encoder(tokenizer).stretch(texts[a:b])
                every, stops = np.insert(every, stops, end), (stops + np.arange(1, b - a + 1)).tolist()
                for i, first, stop in zip(ids[a:b], [0, *stops[:-1]], stops, strict=True):
                    writer.add(i, every[first:stop])
        if out is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([part], pa.int32()), pa.array([len(writer.docs)]),
                                              pa.array([sum(writer.lengths)])], names=["file", "part", "documents", "ids"])
    files = cut_lineage(dealt.mapInArrow(run, "file string, part int, documents long, ids long"), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # one row a file
    return files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read(manifest: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of ``manifest(file, start)``."""
    def run(batches):
        for b in batches:
            for name, start in zip(b.column("file").to_pylist(), b.column("start").to_pylist(), strict=True):
                where, path = _open(name)
                with where.open_input_file(path) as source:
                    r = Reader(source, block)
                    crc = r.checksums()
                first = start + np.cumsum(r.lengths) - r.lengths
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r.doc_ids, pa.int64(), mask=r.null), pa.array(first), pa.array(r.lengths), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
    # a row is a whole file's work: as many tasks as files
    rows = cut_lineage(manifest.select("file", "start"), "manifest")
    n = max(1, rows.count())
    return rows.repartitionByRange(n, "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """Write the files of ``docs(doc_id, text)`` to the shared folder and read them back."""
    folder = f"{ensure_checkpoint_dir(docs.sparkSession).rstrip('/')}/longtab-tokens/{uuid.uuid4().hex}"
    return read(write(docs, folder, tokenizer, end))
