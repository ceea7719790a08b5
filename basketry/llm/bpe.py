"""BPE encoding over a table of distinct words, and decoding.

A vocabulary of this kind never joins text across white space, so a text is split at ASCII
white space, each distinct word is encoded once, and a text's ids are its words' ids in order.

1. Every block of the stored documents (a file split of the scan) hands on its distinct words,
   dealt by hash into buckets and packed: one row holds all words of one block and bucket.
2. A bucket's rows meet in one task, which encodes each distinct word once and gives every
   block the ids of its words. A bucket holds a bounded share of the vocabulary: the number of
   buckets follows the size of the input.
3. The answers are stored by block. The second scan opens the table of its own block, looks
   up its words by position, and joins their ids; ids become pieces by a join with the
   vocabulary (id to piece), made once for each word of the block.

Texts are never shuffled, only packed words and ids. A block whose table is missing or lacks a
word (its borders moved because the cluster changed between the scans) encodes such words on
the spot, with the same result.

Texts that hold a special token's string keep it whole: it contains no white space. A null or
empty text has no ids and decodes to an empty text.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.blocks import block_of_scan, pack, read_block, store_by_block, unpack
from basketry.llm.common import materialise, own_names, tune

# Words a task holds before it hands them on, and distinct words looked for in one bucket.
HELD = 1_000_000
# Bytes of text whose words are looked up at once, about: so many at least, and for each word of
# the block's table, which a lookup hashes anew. A longer text is looked up alone.
PIECE, PER_WORD = 4 << 20, 12
RESULT = (
    "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
)


class WordBpe:
    """Encodes single words with the vocabulary's own library, and names the pieces."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.library.no_truncation()
        self.library.no_padding()

    def ids(self, words: list[bytes]) -> list[list[int]]:
        # One by one: the library's own threads cost more than they save beside other tasks.
        encode = self.library.encode
        return [encode(w.decode(), add_special_tokens=False).ids for w in words]


def piece_table(vocabulary: str) -> list[tuple[int, str]]:
    """Rows (id, piece) of a vocabulary file, special tokens included."""
    data = json.loads(vocabulary)
    pieces = {i: p for p, i in data["model"]["vocab"].items()}
    pieces |= {t["id"]: t["content"] for t in data["added_tokens"]}
    return sorted(pieces.items())


_WORKER: dict[int, WordBpe] = {}


def encoder(vocabulary: Broadcast) -> WordBpe:
    """The encoder of a worker process, made once."""
    key = zlib.crc32(vocabulary.value.encode())
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = WordBpe(vocabulary.value)
    return _WORKER[key]


def load_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary file, sent to the executors; it does not grow with the corpus."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def _pack(parts: list[bytes]) -> bytes:
    return pack(b" ".join(parts))


def _unpack(blob: bytes) -> list[bytes]:
    return unpack(blob).split(b" ")


def _block_words(buckets: int):
    """Distinct words by block and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, set()

        def packed() -> pa.RecordBatch:
            dealt: list[list[bytes]] = [[] for _ in range(buckets)]
            for word in held:
                dealt[zlib.crc32(word) % buckets].append(word)
            rows = [(b, block, _pack(sorted(words))) for b, words in enumerate(dealt) if words]
            columns = list(zip(*rows)) if rows else [[], [], []]
            kinds = pa.int32(), pa.int64(), pa.binary()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "block", "words"]
            )

        for batch in batches:
            for text, own in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist()):
                if own != block or len(held) > HELD:
                    if held:
                        yield packed()
                    block, held = own, set()
                if text:
                    held.update(text.split())
        if held:
            yield packed()

    return run


def _pack_numbers(parts: list[bytes], width: int) -> bytes:
    """Numbers of ``width`` bytes of several words: how many each word has, then the numbers."""
    counts = np.array([len(p) // width for p in parts], "<u4")
    return pack(counts.tobytes() + b"".join(parts))


def _unpack_numbers(blob: bytes, words: int, width: int) -> pa.Array:
    """The numbers of each word, as a binary array."""
    data = unpack(blob)
    ends = np.cumsum(np.frombuffer(data, "<u4", words), dtype=np.int64) * width
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), words, [None, pa.py_buffer(offsets), pa.py_buffer(data[4 * words :])])


def _encode_buckets(vocabulary: Broadcast, kind: str | None = None):
    """Ids of each row's words; each distinct word of a bucket is encoded once.

    Ids are decimal texts, or numbers of the array ``kind``.
    """
    if kind is None:
        shown, packed = (lambda ids: ",".join(map(str, ids)).encode()), _pack
    else:
        width = array(kind).itemsize
        shown, packed = (lambda ids: array(kind, ids).tobytes()), (lambda parts: _pack_numbers(parts, width))

    class Known(dict):
        """Ids of the words of a bucket; a new word is encoded."""

        def __init__(self, bpe: WordBpe):
            super().__init__()
            self.bpe = bpe

        def __missing__(self, word: bytes) -> bytes:
            found = self[word] = shown(self.bpe.ids([word])[0])
            return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, bucket, known = encoder(vocabulary), None, None
        for batch in batches:
            for own, block, blob in zip(*[c.to_pylist() for c in batch.columns]):
                if own != bucket or known is None:
                    bucket, known = own, Known(bpe)
                row = [[block], [blob], [packed([known[w] for w in _unpack(blob)])]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(row, (pa.int64(), pa.binary(), pa.binary()))],
                    ["block", "words", "ids"],
                )

    return run


def word_table(stored: DataFrame, vocabulary: Broadcast, size: int | None = None, kind: str | None = None) -> str:
    """Write the words and ids of every block of ``stored``; gives the folder.

    ``size`` is the number of bytes of all texts, if it is known already.
    """
    spark = stored.sparkSession
    if size is None:
        size = stored.select(F.sum(F.octet_length("text"))).first()[0] or 0
    # Distinct words grow about as the root of the text: 100 TB give 10,000 buckets.
    buckets = max(spark.sparkContext.defaultParallelism, int(size**0.5 / 1000))
    rows = stored.select("text", block_of_scan().alias("block")).mapInArrow(
        _block_words(buckets), "bucket int, block bigint, words binary"
    )
    dealt = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    encoded = dealt.mapInArrow(_encode_buckets(vocabulary, kind), "block bigint, words binary, ids binary")
    return store_by_block(encoded, "words")


def _encode_texts(vocabulary: Broadcast, folder: str, pieces: Broadcast):
    def table_of(block: int, bpe: WordBpe) -> dict[bytes, tuple[bytes, bytes]]:
        words, ids = [], []
        try:
            table = read_block(folder, block, ["words", "ids"])
        except (OSError, ValueError):  # a store that only Spark can read
            table = None
        if table is not None:
            for w, i in zip(table["words"].to_pylist(), table["ids"].to_pylist()):
                words += _unpack(w)
                ids += _unpack(i)
        return entries(words, ids)

    def entries(words: list[bytes], ids: list[bytes]) -> dict[bytes, tuple[bytes, bytes]]:
        """Per word its ids and its pieces, both as text; the join of ids with the pieces."""
        names = pieces.value
        return {
            w: (i.replace(b",", b" "), b" ".join([names[int(x)] for x in i.split(b",")]) if i else b"")
            for w, i in zip(words, ids)
        }

    class Lookup(dict):
        """Words of the block; one that is missing is encoded on the spot."""

        def __init__(self, block, bpe):
            super().__init__(table_of(block, bpe))
            self.bpe = bpe

        def __missing__(self, word: bytes):
            own = ",".join(map(str, self.bpe.ids([word])[0])).encode()
            found = entries([word], [own])[word]
            if len(self) < 2 * HELD:
                self[word] = found
            return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, block, table = encoder(vocabulary), None, {}
        for batch in batches:
            counts, ids_sha, decoded_sha = [], [], []
            for text, own in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                if own != block or not isinstance(table, Lookup):
                    block, table = own, Lookup(own, bpe)
                found = [table[w] for w in (text or b"").split()]
                ids = b" ".join([f[0] for f in found if f[0]])
                decoded = b" ".join([f[1] for f in found if f[0]])
                counts.append(ids.count(b" ") + 1 if ids else 0)
                ids_sha.append(sha256(ids).hexdigest())
                decoded_sha.append(sha256(decoded).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def encode_and_decode(docs: DataFrame, vocabulary_path: str, stored: bool = False) -> DataFrame:
    """Rows (``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``), one per input row.

    ``stored`` says that ``docs`` is a plain scan of a stored table; any other frame is
    written first, since the blocks of both scans must be the same.
    """
    spark = tune(docs.sparkSession)
    plain = own_names(docs, "doc_id", "text")
    if not stored:
        plain = materialise(plain, "texts")
    vocabulary = load_vocabulary(spark, vocabulary_path)
    names = dict(piece_table(vocabulary.value))
    pieces = spark.sparkContext.broadcast([names.get(i, "").encode() for i in range(max(names, default=-1) + 1)])
    folder = word_table(plain, vocabulary)
    return plain.select("doc_id", "text", block_of_scan().alias("block")).mapInArrow(
        _encode_texts(vocabulary, folder, pieces), RESULT
    )


class _StoredIds:
    """Ids of the words of one block as packed numbers, words and ids as two Arrow arrays side by side.

    A word that is missing is encoded on the spot.
    """

    def __init__(self, folder: str, block: int, bpe: WordBpe, kind: str):
        self.bpe, self.kind = bpe, kind
        try:
            table = read_block(folder, block, ["words", "ids"])
        except (OSError, ValueError):  # a store that only Spark can read
            table = None
        # The split of a text gives an empty word for white space at its ends.
        words, ids = [pa.array([b""], pa.binary())], [pa.array([b""], pa.binary())]
        if table is not None:
            for blob, numbers in zip(table["words"].to_pylist(), table["ids"].to_pylist()):
                words.append(pa.array(_unpack(blob), pa.binary()))
                ids.append(_unpack_numbers(numbers, len(words[-1]), array(kind).itemsize))
        self.words, self.ids = pa.concat_arrays(words), pa.concat_arrays(ids)

    def of_words(self, words: pa.Array) -> pa.Array:
        """The packed ids of each word."""
        at = pc.index_in(words, value_set=self.words)
        if not at.null_count:
            return self.ids.take(at)
        new = pc.unique(words.filter(at.is_null()))
        own = [array(self.kind, ids).tobytes() for ids in self.bpe.ids(new.to_pylist())]
        known, ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, pa.array(own, pa.binary())])
        if len(known) < 2 * HELD:
            self.words, self.ids = known, ids
        return ids.take(pc.index_in(words, value_set=known))

    def of_texts(self, texts: pa.Array) -> pa.Array:
        """The packed ids of each text, one word after the other; null is empty."""
        split = pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))
        found = self.of_words(split.flatten().cast(pa.binary()))
        # The ids of all words lie one after the other, so those of a text are a range of them.
        ends = np.cumsum(np.concatenate(([0], pc.list_value_length(split).to_numpy())))
        word_ends = np.cumsum(np.concatenate(([0], pc.binary_length(found).to_numpy())))
        at, data = pa.py_buffer(word_ends[ends].astype(np.int32)), found.buffers()[2] or pa.py_buffer(b"")
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, at, data])


def _pieces(batches: Iterator[pa.RecordBatch], table_of: Callable[[int], _StoredIds]):
    """Rows (text, block, others) in order, in runs of one block and bounded size, each with its block's table."""
    held, size, block, table = [], 0, None, None
    for batch in batches:
        first, lengths = 0, pc.binary_length(batch.column(0)).fill_null(0).to_pylist()
        for i, (own, length) in enumerate(zip(batch.column(1).to_pylist(), lengths)):
            if table is None or own != block or size + length > max(PIECE, PER_WORD * len(table.words)):
                if i > first:
                    held.append(batch.slice(first, i - first))
                if held:
                    yield table, pa.concat_batches(held)
                held, size, first = [], 0, i
                if table is None or own != block:
                    block, table = own, table_of(own)
            size += length + 100
        if batch.num_rows:
            held.append(batch.slice(first))
    if held:
        yield table, pa.concat_batches(held)


def packed_ids(
    plain: DataFrame, vocabulary: Broadcast, kind: str, size: int, after=iter, fields: Sequence[T.StructField] = ()
) -> DataFrame:
    """``plain`` with ``ids``, numbers of the array ``kind`` as one binary, in place of ``text``.

    ``plain`` is a plain scan of a stored table. Each distinct word is encoded once, by
    :func:`word_table`; ``size`` is the number of bytes of all texts. ``after`` goes over the
    batches in the same task and adds ``fields``.
    """
    folder = word_table(plain, vocabulary, size, kind)
    others = [f for f in plain.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for table, rows in _pieces(batches, lambda block: _StoredIds(folder, block, bpe, kind)):
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[2:], table.of_texts(rows.column(0))], [*rows.schema.names[2:], "ids"]
            )

    rows = plain.select("text", block_of_scan().alias("_block"), *[f.name for f in others])
    kinds = T.StructType([*others, T.StructField("ids", T.BinaryType()), *fields])
    return rows.mapInArrow(lambda batches: after(run(batches)), kinds)


def encode(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Rows (``doc_id``, ``ids``): token ids of each text as an array, by distinct words.

    The plain form for tables whose ids shall stay a column: words by position, the distinct
    words encoded once, and both joined.
    """
    spark = tune(docs.sparkSession)
    vocabulary = load_vocabulary(spark, vocabulary_path)
    rows = materialise(
        own_names(docs, "doc_id", "text").withColumn("_row", F.monotonically_increasing_id()), "texts"
    )
    split = rows.select("_row", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"[ \t\n\x0B\f\r]+")).alias("at", "word"))
    split = split.where("word != ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for batch in batches:
            ids = bpe.ids([w.encode() for w in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["word", "ids"])

    table = split.select("word").distinct().mapInArrow(run, "word string, ids array<int>")
    parts = split.join(table, "word").groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("x"))
    joined = rows.select("_row", "doc_id").join(parts, "_row", "left")
    empty = F.array().cast("array<int>")
    return joined.select("doc_id", F.coalesce(F.flatten(F.col("x.ids")), empty).alias("ids"))


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """Rows (``doc_id``, ``decoded``): pieces of the ids, one blank apart.

    Ids are exploded by position and joined with the table of pieces, whose size is that of
    the vocabulary; ids outside the vocabulary give no piece.
    """
    spark = tune(encoded.sparkSession)
    vocabulary = load_vocabulary(spark, vocabulary_path)
    pieces = spark.createDataFrame(piece_table(vocabulary.value), "id int, piece string")
    rows = materialise(
        encoded.select("doc_id", "ids").withColumn("_row", F.monotonically_increasing_id()), "ids"
    )
    tokens = rows.select("_row", F.posexplode("ids").alias("at", "id")).join(F.broadcast(pieces), "id")
    texts = tokens.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("x"))
    joined = rows.select("_row", "doc_id").join(texts, "_row", "left")
    return joined.select("doc_id", F.coalesce(F.array_join("x.piece", " "), F.lit("")).alias("decoded"))
