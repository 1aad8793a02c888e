"""Token-ID output as patched frame-of-reference files.

``encode_documents`` turns whole texts into ids, ``write_ids`` stores them with
``format("pfor")`` and ``read_ids`` reads them back. A folder holds one
``.pfor`` file per task plus ``_manifest.json``, which only lists files of
committed task attempts: a lost executor's half-written file is never read.

File layout (little endian)::

    b"PFOR" u32 version | blocks | footer | u64 footer start | b"PFOR"

    block   u32 minimum | u16 values | u8 width | u8 exceptions
            | values packed at ``width`` bits, low bit first
            | u8 position of each exception | u32 value of each exception
    footer  u32 documents | u32 blocks | i64 doc ids | u32 ids of each document
            | u64 start of each block

A block covers ``BLOCK`` ids of the file's stream (the last one fewer). Its
width is the bit length of the ``PERCENTILE`` of value minus minimum; values
that need more bits become exceptions. The block starts let a reader seek to
any id, which is how long files are split into read partitions.

Edge cases: a null text is empty; an empty text still stores the end id; rows
with a null id are stored first, under the smallest long; repeated rows are all
kept; an empty table gives a folder with an empty manifest; extra columns are
ignored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from weft.llm.common import frugal, open_folder, texts
from weft.llm.encoding import END_ID, broadcast_tokenizer, encoder
from weft.session import ship_package

MAGIC, VERSION = b"PFOR", 1
BLOCK = 128
PERCENTILE = 90
#: Ids packed in one go by a writer, and read by one partition of a reader.
WRITE_IDS, READ_IDS = 1 << 18, 1 << 23
NULL_ID = -(1 << 63)
MANIFEST = "_manifest.json"


# ---------------------------------------------------------------------------
# blocks
# ---------------------------------------------------------------------------


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below 2**width as rows of bytes."""
    bits = (rows[:, :, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")


def _unpack(rows: np.ndarray, width: int, n: int) -> np.ndarray:
    bits = np.unpackbits(rows, axis=1, count=n * width, bitorder="little").reshape(len(rows), n, width)
    return (bits.astype(np.uint32) << np.arange(width, dtype=np.uint32)).sum(axis=2, dtype=np.uint32)


def encode_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> list[bytes]:
    """One byte string per block of ``BLOCK`` ids; the last may be shorter."""
    whole = len(ids) // BLOCK
    out = _encode_rows(ids[: whole * BLOCK].reshape(whole, BLOCK), percentile) if whole else []
    if tail := len(ids) - whole * BLOCK:
        out += _encode_rows(ids[-tail:].reshape(1, tail), percentile)
    return out


def _encode_rows(rows: np.ndarray, percentile: int) -> list[bytes]:
    minimum = rows.min(axis=1)
    above = rows - minimum[:, None]
    at = min(rows.shape[1] - 1, rows.shape[1] * percentile // 100)
    width = _bit_lengths(np.partition(above, at, axis=1)[:, at])
    over = _bit_lengths(above) > width[:, None]
    kept = np.where(over, np.uint32(0), above).astype(np.uint32)
    out: list[bytes] = [b""] * len(rows)
    for w in np.unique(width):
        of = np.nonzero(width == w)[0]
        packed = _pack(kept[of], int(w)) if w else np.zeros((len(of), 0), np.uint8)
        for i, body in zip(of.tolist(), packed):
            places = np.nonzero(over[i])[0]
            head = np.array([minimum[i]], "<u4").tobytes() + np.array([rows.shape[1]], "<u2").tobytes() + bytes((int(w), len(places)))
            out[i] = head + body.tobytes() + places.astype(np.uint8).tobytes() + above[i, places].astype("<u4").tobytes()
    return out


def decode_blocks(data: bytes) -> np.ndarray:
    """All ids of consecutive blocks."""
    raw, at, found, by_width = np.frombuffer(data, np.uint8), 0, [], {}
    while at < len(raw):
        minimum, n, width, patches = int.from_bytes(data[at : at + 4], "little"), int.from_bytes(data[at + 4 : at + 6], "little"), data[at + 6], data[at + 7]
        body = at + 8
        places = body + (n * width + 7) // 8
        values = places + patches
        by_width.setdefault((width, n), []).append(len(found))
        found.append((minimum, raw[body:places], raw[places:values], np.frombuffer(data, "<u4", patches, values)))
        at = values + 4 * patches
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(found)
    for (width, n), of in by_width.items():
        rows = _unpack(np.stack([found[i][1] for i in of]), width, n) if width else np.zeros((len(of), n), np.uint32)
        for i, row in zip(of, rows):
            row[found[i][2]] = found[i][3]
            out[i] = row + np.uint32(found[i][0])
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


# ---------------------------------------------------------------------------
# files
# ---------------------------------------------------------------------------


class FileWriter:
    """Streams documents to one file with bounded memory (beside 12 bytes a
    document and 8 a block for the footer)."""

    def __init__(self, stream, percentile: int = PERCENTILE):
        self.stream, self.percentile = stream, percentile
        self.docs: list[int] = []
        self.counts: list[int] = []
        self.starts: list[int] = []
        self.buffer: list[bytes] = []
        self.held = self.total = 0
        self.at = len(MAGIC) + 4
        stream.write(MAGIC + VERSION.to_bytes(4, "little"))

    def add(self, doc_id: int, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.total += len(ids) // 4
        self.buffer.append(ids)
        self.held += len(ids) // 4
        if self.held >= WRITE_IDS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.buffer), "<u4")
        cut = len(ids) if last else len(ids) // BLOCK * BLOCK
        for lo in range(0, cut, WRITE_IDS):
            blocks = encode_blocks(ids[lo : min(cut, lo + WRITE_IDS)], self.percentile)
            for block in blocks:
                self.starts.append(self.at)
                self.at += len(block)
            self.stream.write(b"".join(blocks))
        self.buffer, self.held = [ids[cut:].tobytes()], len(ids) - cut

    def close(self) -> None:
        self._flush(True)
        self.stream.write(
            np.array([len(self.docs), len(self.starts)], "<u4").tobytes() + np.array(self.docs, "<i8").tobytes()
            + np.array(self.counts, "<u4").tobytes() + np.array(self.starts, "<u8").tobytes() + self.at.to_bytes(8, "little") + MAGIC
        )


class FileReader:
    def __init__(self, file):
        self.file = file
        size = file.size()
        end = file.read_at(12, size - 12)
        if end[8:] != MAGIC:
            raise ValueError("not a whole pfor file")
        self.blocks_end = int.from_bytes(end[:8], "little")
        footer = file.read_at(size - 12 - self.blocks_end, self.blocks_end)
        n, blocks = np.frombuffer(footer, "<u4", 2).tolist()
        self.docs = np.frombuffer(footer, "<i8", n, 8)
        self.counts = np.frombuffer(footer, "<u4", n, 8 + 8 * n).astype(np.int64)
        self.starts = np.append(np.frombuffer(footer, "<u8", blocks, 8 + 12 * n).astype(np.int64), self.blocks_end)
        self.first = np.cumsum(self.counts) - self.counts

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids ``lo`` to ``hi`` of the file's stream; reads only their blocks."""
        if hi <= lo:
            return np.zeros(0, np.uint32)
        a, b = lo // BLOCK, -(-hi // BLOCK)
        at = int(self.starts[a])
        found = decode_blocks(self.file.read_at(int(self.starts[b]) - at, at))
        return found[lo - a * BLOCK : hi - a * BLOCK]


# ---------------------------------------------------------------------------
# the data source
# ---------------------------------------------------------------------------

READ_SCHEMA = "doc_id long, start long, ids binary"


@dataclass
class _Written(WriterCommitMessage):
    partition: int
    name: str
    docs: int
    ids: int


@dataclass
class _Range(InputPartition):
    name: str
    lo: int
    hi: int
    base: int


class PforDataSource(DataSource):
    """``format("pfor")``: rows (doc_id long, ids binary of uint32) in the order
    of the partitions and of the rows in them."""

    @classmethod
    def name(cls) -> str:
        return "pfor"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema):
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"], int(self.options.get("percentile", PERCENTILE)))


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, percentile: int):
        self.path, self.percentile = path, percentile

    def write(self, iterator) -> _Written:
        from pyspark import TaskContext

        system, folder = open_folder(self.path)
        system.create_dir(folder, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.pfor"
        with system.open_output_stream(f"{folder}/{name}") as stream:
            file = FileWriter(stream, self.percentile)
            for batch in iterator:
                for doc, ids in zip(batch.column("doc_id"), batch.column("ids")):
                    doc = doc.as_py()
                    file.add(NULL_ID if doc is None else doc, ids.as_py() or b"")
            file.close()
        return _Written(part, name, len(file.docs), file.total)

    def commit(self, messages) -> None:
        system, folder = open_folder(self.path)
        system.create_dir(folder, recursive=True)
        done = sorted((m for m in messages if m is not None and m.docs), key=lambda m: m.partition)
        base, files = 0, []
        for m in done:
            files.append({"name": m.name, "docs": m.docs, "ids": m.ids, "start": base})
            base += m.ids
        with system.open_output_stream(f"{folder}/{MANIFEST}") as stream:
            stream.write(json.dumps({"version": VERSION, "block": BLOCK, "files": files}).encode())

    def abort(self, messages) -> None:
        """Nothing to undo: files without a manifest are never read."""


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        system, folder = open_folder(self.path)
        with system.open_input_file(f"{folder}/{MANIFEST}") as f:
            files = json.loads(f.read())["files"]
        # a range of ids of a file; a document belongs to the range it starts in
        return [_Range(x["name"], lo, lo + READ_IDS, x["start"]) for x in files for lo in range(0, x["ids"], READ_IDS)] or [_Range("", 0, 0, 0)]

    def read(self, partition):
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
        if not partition.name:
            return
        system, folder = open_folder(self.path)
        with system.open_input_file(f"{folder}/{partition.name}") as f:
            file = FileReader(f)
            a, b = np.searchsorted(file.first, [partition.lo, partition.hi])
            while a < b:  # documents of about WRITE_IDS ids at a time
                c = min(b, max(a + 1, int(np.searchsorted(file.first, file.first[a] + WRITE_IDS))))
                base = int(file.first[a])
                raw = file.ids(base, int(file.first[c - 1] + file.counts[c - 1])).astype("<u4").tobytes()
                spans = zip(file.first[a:c].tolist(), file.counts[a:c].tolist())
                docs = pa.array(file.docs[a:c], pa.int64(), mask=file.docs[a:c] == NULL_ID)
                yield pa.RecordBatch.from_arrays([docs, pa.array(file.first[a:c] + partition.base), pa.array([raw[4 * (s - base) : 4 * (s - base + n)] for s, n in spans], pa.binary())], schema=schema)
                a = c


# ---------------------------------------------------------------------------
# operators
# ---------------------------------------------------------------------------


def encode_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int | None = END_ID) -> DataFrame:
    """(doc_id, ids binary): the ids of each whole text as little-endian uint32
    and ``end_id`` after them. Narrow: keeps partitions and row order."""
    ship_package(docs.sparkSession)
    spec = broadcast_tokenizer(docs.sparkSession, tokenizer)
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def encode(batches: Iterator[pa.RecordBatch]):
        enc = encoder(spec.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([enc.ids(t) + tail for t in texts(part.column("text"))], pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(frugal(encode), "doc_id long, ids binary")


def in_id_order(docs: DataFrame) -> DataFrame:
    """Range-partitioned and sorted by doc_id (nulls first); only the id and
    the text move. The session's shuffle partitions are kept as they are:
    encoding is heavy for its bytes, so few large partitions would not pay."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.select("doc_id", "text").repartitionByRange(n, F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"))


def write_ids(ids: DataFrame, path: str, percentile: int = PERCENTILE) -> None:
    """Write (doc_id, ids) rows, in the order they stand, to the folder ``path``."""
    ship_package(ids.sparkSession)
    ids.sparkSession.dataSource.register(PforDataSource)
    ids.select("doc_id", "ids").write.format("pfor").mode("append").option("path", path).option("percentile", str(percentile)).save()


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): ``start`` counts the ids of all documents before."""
    ship_package(spark)
    spark.dataSource.register(PforDataSource)
    return spark.read.format("pfor").option("path", path).load()
