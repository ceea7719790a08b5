"""Benchmark decontamination with an Aho-Corasick automaton.

Texts are normalised to words: A-Z in lower case, a word is a longest run of letters a-z,
digits and bytes of characters beyond ASCII. Every window of 10 consecutive words of a
benchmark item is a pattern; an item of fewer words is one pattern, an item without words is
none. All patterns form one automaton over the normalised bytes, with a blank before, between
and after the words, so that a match always covers whole words. A text is scanned once; match
ends are mapped back to words and to offsets of the original text.

The benchmark is a query set and small next to the corpus, but its size is checked: patterns
are dealt into parts of at most ``PATTERNS`` each, a part's automaton is what a task holds,
and more parts mean more scans, never fewer patterns.

A null, empty or blank text has no words and no hits; repeated rows get equal results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import wordarrays as wa
from basketry.llm.common import free_name, materialise, own_names, tune, with_fields

WINDOW = 10
PATTERNS = 50_000

GAP = np.ones(256, bool)
GAP[ord("0") : ord("9") + 1] = False
GAP[ord("A") : ord("Z") + 1] = False
GAP[ord("a") : ord("z") + 1] = False
GAP[128:] = False
# Byte of the normalised text for each byte of the original: lower case, or a blank.
PLAIN = bytes(32 if GAP[b] else int(wa.LOWER[b]) for b in range(256))

HIT = T.StructType(
    [
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("pattern", T.StringType()),
    ]
)
FOUND = (("n_words", T.LongType()), ("n_hit", T.LongType()), ("hits", T.ArrayType(HIT)))


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(PLAIN).split()


def _patterns(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(*[c.to_pylist() for c in batch.columns]):
                words = normal_words(text)
                for i in range(max(0, len(words) - window) + 1 if words else 0):
                    rows.append((item, b" ".join(words[i : i + window]).decode("latin-1")))
            items, texts = zip(*rows) if rows else ([], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int64()), pa.array(texts, pa.string())], ["item_id", "pattern"]
            )

    return run


def patterns(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (``item_id``, ``pattern``): the word windows of each item, one byte a character."""
    tune(benchmark.sparkSession)
    items = own_names(benchmark, "item_id", "text", item_id="bigint")
    return items.mapInArrow(_patterns(window), "item_id bigint, pattern string").distinct()


_AUTOMATA: dict[str, ahocorasick.Automaton] = {}


def _automaton(shared) -> ahocorasick.Automaton:
    """The automaton of a part; built once in each worker process."""
    key = zlib.crc32("\n".join(shared.value).encode())
    name = f"{len(shared.value)}:{key}"
    if name not in _AUTOMATA:
        _AUTOMATA.clear()
        built = ahocorasick.Automaton()
        for pattern in shared.value:
            built.add_word(f" {pattern} ", (pattern, pattern.count(" ") + 1, len(pattern) + 2))
        built.make_automaton()
        _AUTOMATA[name] = built
    return _AUTOMATA[name]


def _scan(shared, text_at: int):
    def hits_of(data: bytes, normal: bytes, automaton) -> list[dict]:
        starts, ends, _ = wa.words(*_single(data), GAP)
        # Where each word ends in the normalised text: a blank leads, one follows each word.
        after = np.cumsum(ends - starts + 1)
        # Code points up to each byte: all bytes but the later ones of a character.
        points = None if data.isascii() else np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        found = []
        for at, (pattern, count, _) in automaton.iter(normal.decode("latin-1")):
            last = int(np.searchsorted(after, at))
            first = last - count + 1
            begin, end = int(starts[first]), int(ends[last])
            if points is not None:
                begin, end = int(points[begin]) - 1, int(points[end - 1])
            found.append({"first_word": first, "last_word": last, "start": begin, "end": end, "pattern": pattern})
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared) if shared.value else None
        kind = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("start", pa.int64()),
                                   ("end", pa.int64()), ("pattern", pa.string())]))
        for batch in batches:
            counts, hit, hits = [], [], []
            for text in batch.column(text_at).cast(pa.string()).cast(pa.binary()).to_pylist():
                words = (text or b"").translate(PLAIN).split()
                normal = b" " + b" ".join(words) + b" "
                own = []
                if automaton is not None and next(automaton.iter(normal.decode("latin-1")), None):
                    own = hits_of(text, normal, automaton)
                counts.append(len(words))
                hit.append(len({w for h in own for w in range(h["first_word"], h["last_word"] + 1)}))
                hits.append(own)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64()), pa.array(hit, pa.int64()), pa.array(hits, kind)],
                [*batch.schema.names, "n_words", "n_hit", "hits"],
            )

    return run


def _single(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(data, np.uint8), np.array([0, len(data)], np.int64)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, per_part: int = PATTERNS) -> DataFrame:
    """Rows (``doc_id``, ``text``, ``n_words``, ``n_hit``, ``hits``), one per input row.

    ``hits`` has for each occurrence of a pattern the words it covers, its place in the
    original text (code points, end exclusive) and the pattern.
    """
    tune(docs.sparkSession)
    distinct = patterns(benchmark, window).select("pattern").distinct().persist()
    parts = -(-distinct.count() // per_part) or 1
    plain = own_names(docs, "doc_id", "text")
    kind = with_fields(plain, FOUND)
    scans = []
    for shared in _shared_parts(distinct, parts):
        scans.append(plain.mapInArrow(_scan(shared, 1), kind))
    if parts == 1:
        return scans[0]
    # One row per scan: the rows of a document are the same in each but for their hits.
    every = reduce(DataFrame.union, scans).withColumn("_text", F.xxhash64("text"))
    total = every.groupBy("doc_id", "_text").agg(
        F.first("text").alias("text"), F.first("n_words").alias("n_words"),
        (F.count(F.lit(1)) / parts).cast("int").alias("copies"),
        F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
    )
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["first_word"], h["last_word"]))))
    return total.withColumn("n_hit", F.size(covered).cast("bigint")).select(
        *kind.names, F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("_copy")
    ).drop("_copy")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``).

    Patterns become items by a join on the pattern, so an item costs a row and not a copy
    of the automaton's payload. ``items_sha256`` digests the ids of the items, sorted as
    strings and joined by commas.
    """
    spark = docs.sparkSession
    scanned = scan(docs, benchmark, window).select("doc_id", "n_words", "n_hit", "hits")
    owners = patterns(benchmark, window).groupBy("pattern").agg(F.collect_set("item_id").alias("items"))
    shared = spark.sparkContext.broadcast({r[0]: r[1] for r in owners.collect()})

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, digests = [], []
            for hits in batch.column(3).to_pylist():
                items = sorted({str(i) for h in hits or [] for i in shared.value[h["pattern"]]})
                numbers.append(len(items))
                digests.append(sha256(",".join(items).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(numbers, pa.int64()), pa.array(digests)],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256"],
            )

    kind = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string"
    return scanned.mapInArrow(digest, kind).withColumn("contaminated", F.col("n_hit") > 0)


def _shared_parts(distinct: DataFrame, parts: int) -> Iterator:
    """The patterns of each part, sent to the executors."""
    for part in range(parts):
        own = distinct.where(F.pmod(F.xxhash64("pattern"), F.lit(parts)) == part)
        yield distinct.sparkSession.sparkContext.broadcast(sorted(r[0] for r in own.collect()))


def _is_hit(text: bytes | None, automaton) -> bool:
    normal = b" " + b" ".join((text or b"").translate(PLAIN).split()) + b" "
    return automaton is not None and next(automaton.iter(normal.decode("latin-1")), None) is not None


def _filter(shared, text_at: int, keep_hits: bool):
    """The rows whose text holds a pattern of the part, or the other ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared) if shared.value else None
        for batch in batches:
            texts = batch.column(text_at).cast(pa.string()).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([_is_hit(t, automaton) == keep_hits for t in texts], pa.bool_()))

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of a benchmark item.

    Each row is judged by its own text, whatever its ``doc_id``. With more than one part the rows
    get a number in a written table and each part is a scan of its own, so that a task holds the
    automaton of one part; filters in a row would hold all of them at once.
    """
    tune(docs.sparkSession)
    distinct = patterns(benchmark, window).select("pattern").distinct().persist()
    parts = -(-distinct.count() // PATTERNS) or 1
    if parts == 1:
        shared = next(_shared_parts(distinct, 1))
        return docs.mapInArrow(_filter(shared, docs.columns.index("text"), False), docs.schema)
    row = free_name(docs, "row_number")
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    texts = rows.select(row, "text")
    hit = [texts.mapInArrow(_filter(s, 1, True), texts.schema).select(row) for s in _shared_parts(distinct, parts)]
    return rows.join(reduce(DataFrame.union, hit).distinct(), row, "left_anti").select(*[f"`{c}`" for c in docs.columns])
