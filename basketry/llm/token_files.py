"""Token ids in fixed-width bit-packed files.

A file holds consecutive documents. Every id takes the least number of bits that tells all ids
of the vocabulary apart, lowest bit first, one id after the other. The layout, all numbers
little-endian:

    bytes 0-7      b"TOKBITS1"
    bytes 8-31     width in bits, documents, ids per block, ids in the file (uint32, uint32,
                   uint64, uint64; the first two share eight bytes)
    then           uint64 per document: ids up to its end (the document index)
    then           uint64 per block: byte offset of the block, from the start of the data
    then           the data: each block's ids packed, padded to whole bytes

Blocks hold the same number of ids but for the last, so id ``i`` lies in block ``i // size``;
the block offset and the width give its bits, and a block unpacks with a few numpy calls.
Encoded texts are sorted by id over the cluster, so files follow each other in ascending
``doc_id`` order; a manifest row names each file, with the numbers of ids and documents. Files are written
under a name of the attempt and renamed when complete, so that a repeated task does no harm.

A null or empty text has only the end id. Rows with a null ``doc_id`` come first; rows of equal
ids follow the order of a hash of their texts.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from basketry.llm.bpe import load_vocabulary, packed_ids, piece_table
from basketry.llm.common import materialise, own_names, tune, work_dir

MAGIC = b"TOKBITS1"
BLOCK = 1 << 16
END = 1
# Bytes of text behind one file, about. A task sorts and packs a whole file, so this bounds its memory.
FILE_BYTES = 32 << 20
# Keys looked at per file to place its border.
SAMPLED = 100
# Array and numpy names of the numbers that carry ids of up to 16 bits, and of more.
NUMBER = (("H", "<u2"), ("I", "<u4"))
MANIFEST = "part int, file string, n_docs bigint, n_ids bigint"


def width_for(vocabulary_size: int) -> int:
    """Bits that tell ``vocabulary_size`` ids apart."""
    return max(1, (vocabulary_size - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """Ids as ``width`` bits each, lowest bit first, padded to whole bytes."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    if not len(ids):
        return b""
    # Each id is added into the 64-bit word its first bit lies in, and what sticks out into
    # the next one.
    at = np.arange(len(ids), dtype=np.uint64) * np.uint64(width)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    out = np.zeros(int(word[-1]) + 2, np.uint64)
    values = ids.astype(np.uint64)
    np.bitwise_or.at(out, word, values << shift)
    over = shift + np.uint64(width) > 64
    np.bitwise_or.at(out, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return out.astype("<u8").tobytes()[: -(-len(ids) * width // 8)]


def unpack_bits(data: bytes, width: int, count: int, first: int = 0) -> np.ndarray:
    """``count`` ids from the ``first`` on."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count, first * width // 8).astype(np.uint32)
    at = np.arange(first, first + count, dtype=np.uint64) * np.uint64(width)
    byte, shift = (at >> np.uint64(3)).astype(np.int64), at & np.uint64(7)
    raw = np.frombuffer(data + bytes(8), np.uint8)
    value = np.zeros(count, np.uint64)
    for k in range(-(-(width + 7) // 8)):
        value |= raw[byte + k].astype(np.uint64) << np.uint64(8 * k)
    return ((value >> shift) & np.uint64((1 << width) - 1)).astype(np.uint32)


def write_file(out, ids: np.ndarray, ends: np.ndarray, width: int, block: int = BLOCK) -> None:
    """Write one file; ``ends`` has for each document the ids up to its end."""
    # All blocks but the last have the same size, so the offsets are known before any is packed.
    offsets = np.arange(-(-len(ids) // block), dtype=np.int64) * -(-block * width // 8)
    out.write(MAGIC + struct.pack("<IIQQ", width, len(ends), block, len(ids)))
    out.write(ends.astype("<u8").tobytes())
    out.write(offsets.astype("<u8").tobytes())
    for i in range(0, len(ids), block):
        out.write(pack_bits(ids[i : i + block], width))


class TokenFile:
    """Random access to a file: ``ids(start, stop)`` and ``document(k)``."""

    HEAD = 32

    def __init__(self, source):
        self.source = source
        head = source.read_at(self.HEAD, 0)
        if head[:8] != MAGIC:
            raise ValueError("not a token file")
        self.width, self.docs, self.block, self.n_ids = struct.unpack("<IIQQ", head[8:])
        blocks = -(-self.n_ids // self.block)
        index = source.read_at(8 * (self.docs + blocks), self.HEAD) if self.docs + blocks else b""
        numbers = np.frombuffer(index, "<u8").astype(np.int64)
        self.ends, self.offsets = numbers[: self.docs], numbers[self.docs :]
        self.data = self.HEAD + 8 * (self.docs + blocks)

    def _block(self, k: int) -> np.ndarray:
        count = min(self.block, self.n_ids - k * self.block)
        size = -(-count * self.width // 8)
        return unpack_bits(self.source.read_at(size, self.data + int(self.offsets[k])), self.width, count)

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, np.uint32)
        first = start // self.block
        parts = [self._block(k) for k in range(first, (stop - 1) // self.block + 1)]
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))

    def documents(self) -> Iterator[np.ndarray]:
        """All documents in order, a block at a time."""
        at, held, loaded = 0, np.zeros(0, np.uint32), 0
        for end in self.ends:
            parts, need = [held], int(end) - at - len(held)
            while need > 0:
                parts.append(self._block(loaded))
                need -= len(parts[-1])
                loaded += 1
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield held[: int(end) - at]
            held, at = held[int(end) - at :], int(end)


def _write(folder: str, width: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, attempt = context.partitionId(), context.taskAttemptId()
        kind, ids, ends, total = NUMBER[width > 16][1], bytearray(), [], 0
        close = np.array([end], kind).tobytes()
        doc_ids: list = []
        for batch in batches:
            for own in batch.column(1).to_pylist():
                ids += own
                ids += close
                total = len(ids) // len(close)
                ends.append(total)
            doc_ids += batch.column(0).to_pylist()
        if not ends:
            return
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        name, draft = f"tokens-{part:06d}.bin", f".{part:06d}-{attempt}-{uuid.uuid4().hex}"
        with store.open_output_stream(f"{path}/{draft}") as out:
            write_file(out, np.frombuffer(ids, kind), np.array(ends, np.int64), width)
        store.move(f"{path}/{draft}", f"{path}/{name}")
        rows = [[part], [name], [len(ends)], [total]]
        kinds = pa.int32(), pa.string(), pa.int64(), pa.int64()
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(r, k) for r, k in zip(rows, kinds)], pa.array([doc_ids], pa.list_(pa.int64()))],
            ["part", "file", "n_docs", "n_ids", "doc_ids"],
        )

    return run


def _borders(keys: DataFrame, rows: int, files: int) -> tuple[np.ndarray, np.ndarray]:
    """First (id, tie) of every file but the first, from a sample of the keys.

    The sample has about ``SAMPLED`` rows per file and not more than a million, by a hash of the
    keys; only how even the files are depends on it.
    """
    wanted = min(SAMPLED * files, 1_000_000)
    chosen = F.pmod(F.xxhash64("id", "tie"), F.lit(max(1, rows // wanted))) == 0
    found = sorted((r["id"], r["tie"]) for r in keys.where(chosen).collect())
    at = [found[len(found) * k // files] for k in range(1, files)] if found else []
    ids, ties = zip(*sorted(set(at))) if at else ([], [])
    return np.array(ids, np.int64), np.array(ties, np.int64)


def _to_files(borders: tuple[np.ndarray, np.ndarray]):
    """The file of each row: the number of borders not above its (id, tie)."""
    ids, ties = borders

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, tie = (batch.column(batch.schema.names.index(c)).to_numpy() for c in ("id", "tie"))
            low, part = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
            # An id that is a border itself: its rows are told apart by their ties.
            for i in np.flatnonzero(low < part):
                part[i] = low[i] + np.searchsorted(ties[low[i] : part[i]], tie[i], "right")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(part, pa.int32())], [*batch.schema.names, "part"]
            )

    return run


def write_tokens(docs: DataFrame, vocabulary_path: str, folder: str, end: int = END, stored: bool = False) -> DataFrame:
    """Encode texts and write them in ascending ``doc_id`` order; gives the manifest.

    Texts are encoded where they are read, each distinct word once; only ids are sorted. The
    manifest is a stored table of one row per file: ``part`` (files in order), ``file``,
    ``n_docs``, ``n_ids`` and the ids of its documents. ``stored`` says that ``docs`` is a plain
    scan of a stored table; any other frame is written first. The driver holds one border, of
    16 bytes, per file.
    """
    spark = tune(docs.sparkSession)
    vocabulary = load_vocabulary(spark, vocabulary_path)
    width = width_for(max([end, *[i for i, _ in piece_table(vocabulary.value)]]) + 1)
    plain = own_names(docs, "doc_id", "text")
    if not stored:
        plain = materialise(plain, "texts")
    # Rows without an id come first.
    keys = [F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.xxhash64("text").alias("tie")]
    size, rows = plain.select(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    size = size or 0
    files = max(1, -(-size // FILE_BYTES), min(spark.sparkContext.defaultParallelism, size >> 20))
    borders = _borders(plain.select(*keys), rows, files)
    part = T.StructField("part", T.IntegerType())
    read = plain.select("text", "doc_id", *keys)
    dealt = packed_ids(read, vocabulary, NUMBER[width > 16][0], size, _to_files(borders), [part])
    ordered = dealt.repartitionById(files, "part").sortWithinPartitions("id", "tie").select("doc_id", "ids")
    return materialise(
        ordered.mapInArrow(_write(folder, width, end), MANIFEST + ", doc_ids array<bigint>"), "manifest"
    )


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start, doc_ids in zip(*[c.to_pylist() for c in batch.columns]):
                with store.open_input_file(f"{path}/{name}") as source:
                    file = TokenFile(source)
                    counts = np.diff(np.concatenate(([0], file.ends)))
                    starts = start + file.ends - counts
                    sums = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in file.documents()]
                columns = doc_ids, starts, counts, sums
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    return run


def read_tokens(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Rows (``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``) from the files of a manifest."""
    # One row per file: a handful of numbers even for very large outputs.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))
    rows = manifest.select("part", "file", "doc_ids").join(starts, "part").select("file", "start", "doc_ids")
    dealt = rows.repartition("file")
    return dealt.mapInArrow(_read(folder), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def written_and_read(docs: DataFrame, vocabulary_path: str, end: int = END, stored: bool = False) -> DataFrame:
    """Write token files below the shared folder and read them back."""
    folder = work_dir(docs.sparkSession, "tokens")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    manifest = write_tokens(docs, vocabulary_path, folder, end, stored)
    return read_tokens(docs.sparkSession, folder, manifest)
