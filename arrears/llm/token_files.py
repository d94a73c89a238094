"""Token ids in binary files of patched frame-of-reference blocks, written and read in parallel.

A block holds up to 1,024 ids.  Its minimum is subtracted; the width of its packed field is
the one that a chosen percentile of the differences fits; the few larger ones keep their
low bits there, and their positions and high bits go to the block's exception list.  After
the blocks come the starts of the blocks, the documents of the file and a trailer, so that
a reader can go to any block or document.

File, all little-endian:

    "PFOR0001"
    blocks    count u16, width u8, zero u8, exceptions u16, minimum u32,
              packed bits (count * width, lowest bit first, filled up to a byte),
              positions u16 each, high bits u32 each
    index     block starts u64 each, then one u64 past the last block
    documents doc_id i64 each, known u8 each (0: the doc_id is null), first id u64 each, one more u64
    trailer   blocks u64, documents u64, ids u64, place of the index u64, ids per block u32, "PFOR"

Documents are dealt to files by ranges of doc_id and sorted within them.  A task writes its
file under a name of its own and returns a row for the table of files; what an attempt that
failed has left is not in that table and is never read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from arrears.llm.common import give_back, on_executors, pieces, texts, without_cycles, written
from arrears.llm.pretokens import Cutter, encoded_column, plain_rule
from arrears.sources.staging import fresh_path

MAGIC, END = b"PFOR0001", b"PFOR"
BLOCK = 1024
#: share of a block's differences that its width fits
PERCENTILE = 0.9
#: blocks that are packed or unpacked at once
CHUNK = 256
#: bytes of text whose distinct words are encoded once
PIECE = 4 << 20
END_ID = 1

_HEAD = struct.Struct("<HBBHI")
_TRAILER = struct.Struct("<QQQQI4s")


# --- blocks


def widths_of(rest: np.ndarray, share: float = PERCENTILE) -> np.ndarray:
    """Bits per value of each row of differences: the percentile's, as an exact rank."""
    at = max(0, int(np.ceil(share * rest.shape[1])) - 1)
    chosen = np.partition(rest, at, axis=1)[:, at]
    return np.ceil(np.log2(chosen.astype(np.float64) + 1)).astype(np.int64)


def packed(low: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below ``2 ** width`` as rows of bytes, lowest bit first."""
    if width == 0:
        return np.empty((len(low), 0), dtype=np.uint8)
    bits = np.unpackbits(low.astype("<u4")[:, :, None].view(np.uint8), axis=2, bitorder="little", count=width)
    return np.packbits(bits.reshape(len(low), -1), axis=1, bitorder="little")


def unpacked(data: np.ndarray, count: int, width: int) -> np.ndarray:
    """``count`` values from the bytes that ``packed`` made, row by row."""
    if width == 0:
        return np.zeros((len(data), count), dtype=np.uint32)
    bits = np.unpackbits(data, axis=1, bitorder="little", count=count * width).reshape(len(data), count, width)
    whole = np.zeros((len(data), count, 32), dtype=np.uint8)
    whole[:, :, :width] = bits
    return np.packbits(whole, axis=2, bitorder="little").view("<u4")[:, :, 0]


def encode_blocks(ids: np.ndarray, share: float = PERCENTILE) -> list[bytes]:
    """The blocks of whole rows ``ids[block, position]`` of one length."""
    if not ids.size:
        return []
    low = ids.min(axis=1)
    rest = ids - low[:, None]
    width = widths_of(rest, share)
    count = ids.shape[1]
    out: list[bytes] = [b""] * len(ids)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        some = rest[rows]
        high = (some >> np.uint32(w)).astype("<u4") if w < 32 else np.zeros_like(some)
        body = packed(some & np.uint32((1 << int(w)) - 1), int(w))
        for k, row in enumerate(rows):
            at = np.flatnonzero(high[k])
            head = _HEAD.pack(count, int(w), 0, len(at), int(low[row]))
            out[row] = b"".join((head, body[k].tobytes(), at.astype("<u2").tobytes(), high[k][at].tobytes()))
    return out


def decode_blocks(blocks: list[memoryview]) -> list[np.ndarray]:
    """The ids of each block."""
    out: list[np.ndarray] = [None] * len(blocks)
    alike: dict[tuple[int, int], list[int]] = {}
    heads = [_HEAD.unpack_from(b) for b in blocks]
    for k, (count, width, _, _, _) in enumerate(heads):
        alike.setdefault((count, width), []).append(k)
    for (count, width), rows in alike.items():
        size = (count * width + 7) // 8
        body = np.stack([np.frombuffer(blocks[k], np.uint8, size, _HEAD.size) for k in rows])
        values = unpacked(body, count, width)
        for own, k in zip(values, rows):
            n, low = heads[k][3], heads[k][4]
            if n:
                at = np.frombuffer(blocks[k], "<u2", n, _HEAD.size + size)
                high = np.frombuffer(blocks[k], "<u4", n, _HEAD.size + size + 2 * n)
                own[at] |= high << np.uint32(width)
            out[k] = own + np.uint32(low)
    return out


# --- files


def write_file(out, documents: Iterable[tuple[int | None, bytes]], share: float = PERCENTILE) -> tuple[int, int]:
    """Write ``(doc_id, ids as u32 bytes)`` to a stream; returns the number of documents and of ids.

    Memory: one document, ``CHUNK`` blocks, and 17 bytes a document.
    """
    out.write(MAGIC)
    place, starts = len(MAGIC), []
    names, known, firsts = [], bytearray(), []
    held, size, total = [], 0, 0

    def flush(every: bool) -> None:
        nonlocal place, held, size
        ids = np.frombuffer(b"".join(held), dtype="<u4")
        whole = len(ids) // BLOCK
        blocks = []
        for at in range(0, whole, CHUNK):
            to = min(whole, at + CHUNK)
            blocks += encode_blocks(ids[at * BLOCK : to * BLOCK].reshape(-1, BLOCK), share)
        rest = ids[whole * BLOCK :]
        if every and len(rest):
            blocks += encode_blocks(rest.reshape(1, -1), share)
            rest = rest[:0]
        for b in blocks:
            starts.append(place)
            place += len(b)
        out.write(b"".join(blocks))
        held, size = [rest.tobytes()], 4 * len(rest)

    for doc_id, ids in documents:
        names.append(doc_id or 0)
        known.append(doc_id is not None)
        firsts.append(total)
        held.append(ids)
        size += len(ids)
        total += len(ids) // 4
        if size >= 4 * BLOCK * CHUNK:
            flush(False)
    flush(True)
    out.write(np.array([*starts, place], dtype="<u8").tobytes())
    out.write(np.array(names, dtype="<i8").tobytes() + bytes(known))
    out.write(np.array([*firsts, total], dtype="<u8").tobytes())
    out.write(_TRAILER.pack(len(starts), len(names), total, place, BLOCK, END))
    return len(names), total


class TokenFile:
    """A written file, open for reading whole or by document."""

    def __init__(self, stream, size: int):
        self.stream = stream
        blocks, documents, self.n_ids, place, self.block, end = _TRAILER.unpack(self._at(size - _TRAILER.size, _TRAILER.size))
        if end != END or self._at(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a token file")
        index = 8 * (blocks + 1)
        data = self._at(place, index + 17 * documents + 8)
        self.starts = np.frombuffer(data, "<u8", blocks + 1).astype(np.int64)
        self.doc_ids = np.frombuffer(data, "<i8", documents, index)
        self.known = np.frombuffer(data, np.uint8, documents, index + 8 * documents).astype(bool)
        self.firsts = np.frombuffer(data, "<u8", documents + 1, index + 9 * documents).astype(np.int64)

    def _at(self, place: int, size: int) -> bytes:
        self.stream.seek(place)
        return self.stream.read(size)

    def _blocks(self, first: int, to: int) -> np.ndarray:
        data = memoryview(self._at(int(self.starts[first]), int(self.starts[to] - self.starts[first])))
        at = self.starts[first : to + 1] - self.starts[first]
        return np.concatenate(decode_blocks([data[a:b] for a, b in zip(at[:-1], at[1:])]))

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document; only the blocks that hold it are read."""
        a, b = int(self.firsts[k]), int(self.firsts[k + 1])
        if a == b:
            return np.empty(0, dtype="<u4")
        first = a // self.block
        return self._blocks(first, (b - 1) // self.block + 1)[a - first * self.block : b - first * self.block]

    def chunks(self) -> Iterator[tuple[int, np.ndarray]]:
        """``(place, ids)`` of the whole file in order, a few blocks at once."""
        for first in range(0, len(self.starts) - 1, CHUNK):
            yield first * self.block, self._blocks(first, min(len(self.starts) - 1, first + CHUNK))

    def checksums(self) -> np.ndarray:
        """CRC-32 of the ids of each document; a document may span chunks."""
        out = np.zeros(len(self.doc_ids), dtype=np.int64)
        k = 0
        for place, ids in self.chunks():
            data = memoryview(ids.astype("<u4").tobytes())
            to = place + len(ids)
            while k < len(out):
                a, b = max(int(self.firsts[k]), place), min(int(self.firsts[k + 1]), to)
                if a < b:
                    out[k] = zlib.crc32(data[4 * (a - place) : 4 * (b - place)], int(out[k]))
                if self.firsts[k + 1] > to:
                    break
                k += 1
        return out


# --- encoding


class LibraryEncoder:
    """Ids of whole texts by the tokenizers library: cut by the file's rules, its model once per new word.

    Files whose rules are not of the plain form (``pretokens.plain_rule``) get whole texts.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        rules = json.loads(spec) | {"truncation": None, "padding": None}
        self.library = Tokenizer.from_str(json.dumps(rules))
        self.plain = plain_rule(rules) is not None
        if self.plain:
            self.model, self.cut = self.library.model, Cutter(rules)

    def _words(self, words: list[str]) -> list[list[int]]:
        tokenize = self.model.tokenize
        return [[t.id for t in tokenize(w)] for w in words]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a column, and where each text's ids start."""
        if self.plain:
            with without_cycles():
                return encoded_column(column, self.cut, self._words)
        # one by one: the library's own threads would compete with Spark's tasks
        every = [self.library.encode(t, add_special_tokens=False).ids for t in texts(column)]
        starts = np.cumsum([0, *map(len, every)])
        return np.array([i for ids in every for i in ids], dtype="<u4"), starts


# --- Spark


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int | None = END_ID, share: float = PERCENTILE) -> DataFrame:
    """Encode ``docs(doc_id, text)`` into token files in ``folder``; returns the table of files.

    ``(part, path, bytes, documents, ids)``: files in the order of ``part`` hold the documents
    by ascending doc_id, null ones first; equal doc_ids by a hash of the text.  A row number
    ends the sort key, so that even rows which repeat one doc_id are dealt to several files.
    The texts are shuffled once; Spark samples the keys for the ranges, the encoding runs
    after the shuffle.  ``folder`` is one that all executors reach.
    """
    spark = docs.sparkSession
    on_executors(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = LibraryEncoder(spec.value)
        part = TaskContext.get().partitionId()

        def documents() -> Iterator[tuple[int | None, bytes]]:
            for batch in pieces(batches, limit=PIECE):
                ids, starts = encoder.encode(batch.column(1))
                for doc_id, a, b in zip(batch.column(0).to_pylist(), starts[:-1].tolist(), starts[1:].tolist()):
                    yield doc_id, ids[a:b].tobytes() + end

        system, base = _opened(folder)
        system.create_dir(base, recursive=True)
        path = f"{base}/{part:06d}-{uuid.uuid4().hex}.pfor"
        with system.open_output_stream(path) as out:
            n, total = write_file(out, documents(), share)
            size = out.tell()
        if n:
            columns = [pa.array([part], pa.int32()), [path.rsplit("/", 1)[1]], [size], [n], [total]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["part", "path", "bytes", "documents", "ids"])
        else:
            system.delete_file(path)
        give_back()

    rows = docs.select(
        "doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("__hash"), F.monotonically_increasing_id().alias("__row")
    )
    keys = ["doc_id", "__hash", "__row"]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    made = dealt.mapInArrow(work, "part int, path string, bytes long, documents long, ids long")
    return written(made, "token-files")


def _reads(files: DataFrame, folder: str, schema: str, body: Callable[[TokenFile, int], pa.RecordBatch]) -> DataFrame:
    """``body(file, ids before it)`` of every file of the table, each file by one task."""
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = files.withColumn("before", F.coalesce(F.sum("ids").over(order), F.lit(0).cast("long")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _opened(folder)
        for batch in batches:
            for path, size, before in zip(*(batch.column(k).to_pylist() for k in range(3))):
                with system.open_input_file(f"{base}/{path}") as stream:
                    yield body(TokenFile(stream, size), before)
        give_back()

    tasks = max(2 * files.sparkSession.sparkContext.defaultParallelism, -(-files.count() // 16))
    return placed.select("path", "bytes", "before", "part").repartition(tasks, "part").drop("part").mapInArrow(work, schema)


def read_checksums(files: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files, from their blocks."""

    def body(file: TokenFile, before: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(file.doc_ids, pa.int64(), mask=~file.known),
                pa.array(file.firsts[:-1] + before),
                pa.array(np.diff(file.firsts)),
                pa.array(file.checksums()),
            ],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )

    return _reads(files, folder, "doc_id long, start long, n_tokens long, ids_crc32 long", body)


def token_positions(docs: DataFrame, tokenizer_path: str, folder: str | None = None) -> DataFrame:
    """Write the token files of ``docs`` and return ``read_checksums`` of them.

    A null or empty text is a document of the end id alone.  Repeated rows are documents of
    their own; rows without doc_id come first.  An empty table writes no file and gives an
    empty result; other columns are not read.  A very long text is held whole by one task.
    """
    where = folder or fresh_path(docs.sparkSession, "tokens")
    return read_checksums(write_tokens(docs, tokenizer_path, where), where)
