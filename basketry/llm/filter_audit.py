"""Audit of five document filters in every order, by a stream that takes back what it counted.

The filters fail a document with: A under 200 words; B fewer than half of its words distinct; C
more than two capitals in a hundred characters; D a character of ``#$%&*|``; E a text equal to
that of a document with a smaller id, anywhere in the table. A to D depend on the text alone, E on
all other documents, so files are processed as a stream:

1. All files of the table are taken in micro-batches (trigger "available now"). Each task turns its
   texts into masks of failed filters and 128-bit text keys; texts go no further.
2. Labels are joined by id. Within a task only the rows of the smallest id of a text go on; the
   others fail E whatever comes later and are counted at once.
3. A keyed state holds for each text the smallest id met and the masks counted for it. When a
   smaller id arrives, the masks counted before are retracted from the counters of their parts,
   counted again as failing E, and the state moves to the new id. Texts lie in the state by
   buckets of their keys, as handing one group to Python costs more than a thousand texts in it;
   the number of buckets follows from the rows of the table when a stream first starts.
4. Each batch writes its sum of signed changes per part, mask and labels to a folder of its own,
   overwriting it if the batch is repeated. The counters are the sums over all batches.

From the counters (at most 32 masks a part) follow all 120 orders: what a filter removes depends
only on the set of filters before it, so 80 pairs of filter and set make all 600 rows of a part.

State lives in RocksDB with its changes in the checkpoint folder, so neither heap nor driver grow
with the number of texts, and a lost executor's state is read again. A task holds one bucket. A very frequent text reaches
the state once per task and batch; rows without an id are spread over the join.

Defined results: a null text is an empty one, a null source the part ``""``. A row without an id
neither fails E nor makes others fail it. Rows that repeat the smallest id of a text do not fail
E. A document is labelled good (toxic) if any of its rows in ``labels`` says so. An empty table has
no parts and so no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from hashlib import blake2b
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window

from basketry.llm.common import own_names, tune, work_dir
from basketry.llm.wordarrays import raw
from basketry.sources.readers import or_none

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
MIN_WORDS = 200
# Micro-batches into which the files of a table are dealt. A repeated batch costs its share of
# the table; each batch reads the labels once.
BATCHES = 4
# Rows of the table per bucket of texts.
BUCKET_ROWS = 1000
# Rows that a task gathers before it hands them on.
HELD_ROWS = 100_000
CHANGES = "part string, mask int, good boolean, toxic boolean, n bigint"
ROWS = f"key binary, doc_id bigint, {CHANGES}"
STATE = (
    "key array<binary>, doc_id array<bigint>, part array<string>, mask array<int>, good array<boolean>, "
    "toxic array<boolean>, n array<bigint>"
)
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # Otherwise each of many small stores reserves megabytes of disk.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

_CAPITAL = np.zeros(256, bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"#$%&*|")] = True


def masks(texts: pa.Array) -> np.ndarray:
    """Bits of the filters A to D that each text fails."""
    data, offsets = raw(texts)

    def count(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))[offsets]
        return total[1:] - total[:-1]

    body = data.tobytes()
    n_words, n_kinds = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        words = body[a:b].split()
        n_words[i], n_kinds[i] = len(words), len(set(words))
    characters = count((data & 0xC0) != 0x80)
    fails = (
        n_words < MIN_WORDS,
        100 * n_kinds < 50 * n_words,
        100 * count(_CAPITAL[data]) > 2 * characters,
        count(_MARK[data]) > 0,
    )
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to keys and masks; rows that repeat id, text and part become one with a count."""
    rows: Counter = Counter()

    def packed() -> pa.RecordBatch:
        columns = [*zip(*rows), tuple(rows.values())]
        kinds = pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.int64()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "doc_id", "part", "mask", "n"]
        )

    for batch in batches:
        ids, texts, parts = batch.columns
        keys = [blake2b(t or b"", digest_size=16).digest() for t in texts.cast(pa.binary()).to_pylist()]
        rows.update(zip(keys, ids.to_pylist(), parts.to_pylist(), masks(texts).tolist()))
        if len(rows) > HELD_ROWS:
            yield packed()
            rows.clear()
    if rows:
        yield packed()


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Only the smallest id of each text goes on as it is; other rows are final and come counted.

    Final rows have no id, and a key of the task's own so that they spread over the buckets.
    """
    own = b"task%d" % TaskContext.get().partitionId()
    least: dict[bytes, tuple[int, Counter]] = {}
    final: Counter = Counter()

    def packed() -> pa.RecordBatch:
        rows = [(key, i, *row, n) for key, (i, counts) in least.items() for row, n in counts.items()]
        rows += [(own, None, *row, n) for row, n in final.items()]
        kinds = pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64()
        names = "key", "doc_id", "part", "mask", "good", "toxic", "n"
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], list(names))

    for batch in batches:
        for key, i, part, mask, good, toxic, n in zip(*[c.to_pylist() for c in batch.columns]):
            if i is None:
                final[part, mask, good, toxic] += n
                continue
            held = least.get(key)
            if held is None or i < held[0]:
                for (p, m, g, t), k in held[1].items() if held else ():
                    final[p, m | DUPLICATE, g, t] += k
                least[key] = i, Counter({(part, mask, good, toxic): n})
            elif i == held[0]:
                held[1][part, mask, good, toxic] += n
            else:
                final[part, mask | DUPLICATE, good, toxic] += n
        if len(least) + len(final) > HELD_ROWS:
            yield packed()
            least.clear()
            final.clear()
    if least or final:
        yield packed()


def _retract(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Signed changes of the counters by new rows of one bucket, and its texts after them."""
    held: dict[bytes, tuple[int, Counter]] = {}
    if state.exists:
        for text, i, *row, n in zip(*state.get):
            held.setdefault(bytes(text), (i, Counter()))[1][tuple(row)] = n
    changes: Counter = Counter()
    for frame in frames:
        columns = [frame[c].tolist() for c in ("key", "doc_id", "part", "mask", "good", "toxic", "n")]
        for text, i, part, mask, good, toxic, n in zip(*columns):
            if i is None or i != i:
                changes[part, mask, good, toxic] += n
                continue
            known = held.get(text)
            if known is not None and i > known[0]:
                changes[part, mask | DUPLICATE, good, toxic] += n
                continue
            if known is None or i < known[0]:
                for (p, m, g, t), k in known[1].items() if known else ():
                    changes[p, m, g, t] -= k
                    changes[p, m | DUPLICATE, g, t] += k
                known = held[text] = int(i), Counter()
            known[1][part, mask, good, toxic] += n
            changes[part, mask, good, toxic] += n
    if held:
        rows = [(text, i, *row, n) for text, (i, counts) in held.items() for row, n in counts.items()]
        state.update(tuple(map(list, zip(*rows))))
    rows = [(*row, n) for row, n in changes.items() if n]
    if rows:
        yield pd.DataFrame(rows, columns=["part", "mask", "good", "toxic", "n"])


def _pattern(path: str) -> str:
    """A pattern for one file or folder: the stream source takes a lone file only by pattern."""
    path = path.rstrip("/")
    return path if re.search(r"[*?\[{]", path) else f"{path[:-1]}[{path[-1]}]"


@contextmanager
def _settings(spark: SparkSession):
    """The stream's settings, for the time it is set up; a started stream keeps its own copy."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _buckets(spark: SparkSession, folder: str, table: DataFrame) -> int:
    """The number of buckets of this folder's state, chosen once."""
    chosen = or_none(spark.read.parquet, f"{folder}/buckets")
    if chosen is not None:
        return chosen.first()[0]
    buckets = max(1, table.count() // BUCKET_ROWS)
    spark.createDataFrame([(buckets,)], "buckets bigint").write.parquet(f"{folder}/buckets")
    return buckets


def start_audit(
    spark: SparkSession, path: str, labels: DataFrame, folder: str, files_per_batch: int
) -> StreamingQuery:
    """Count all files of the table at ``path`` that ``folder`` has not seen, then stop.

    Started again with the same folder, it goes on where it ended, and takes files that came since.
    """
    tune(spark)
    table = spark.read.parquet(path)
    schema = table.schema
    buckets = _buckets(spark, folder, table)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(_pattern(path))
    docs = own_names(source, "doc_id", "text", "source", source="string")
    docs = docs.withColumn("source", F.coalesce("source", F.lit("")))
    measured = docs.mapInArrow(_measure, "key binary, doc_id bigint, part string, mask int, n bigint")
    known = (
        own_names(labels, "doc_id", "quality", "toxic").where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(n) for c, n in (("quality", "good"), ("toxic", "bad"))])
        .withColumn("spread", F.lit(0))
    )
    # Rows without an id match nothing; they are spread so that they do not meet in one task.
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("key", "part"), F.lit(1 << 20)).cast("int"))
    labelled = measured.withColumn("spread", F.coalesce(spread, F.lit(0))).join(known, ["doc_id", "spread"], "left")
    flagged = labelled.select(
        "key", "doc_id", "part", "mask",
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("bad", F.lit(False)).alias("toxic"), "n",
    )
    changes = (
        flagged.mapInArrow(_settle, ROWS)
        .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandasWithState(_retract, CHANGES, STATE, "append", GroupStateTimeout.NoTimeout)
    )

    def add(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        sums.write.mode("overwrite").parquet(f"{folder}/counters/batch={number}")

    # A table, if only an empty one, for streams that never have a batch.
    spark.createDataFrame([], CHANGES).write.mode("overwrite").parquet(f"{folder}/counters/batch=-1")
    with _settings(spark):
        return (
            changes.writeStream.trigger(availableNow=True)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .foreachBatch(add)
            .start()
        )


def counters(spark: SparkSession, folder: str) -> DataFrame:
    """Documents per part, mask of failed filters, and labels, all batches so far."""
    changes = spark.read.schema(CHANGES).parquet(f"{folder}/counters/batch=*")
    return changes.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n != 0")


def interactions(counted: DataFrame) -> DataFrame:
    """What each filter removes at each step of every order, per part."""
    spark = counted.sparkSession
    bits = [1 << k for k in range(len(FILTERS))]
    everything = sum(bits)
    pairs = [(b, s) for b in bits for s in range(everything + 1) if not s & b]
    last = len(FILTERS) - 1
    cells = F.explode(F.array(*[
        F.struct(
            F.lit(b).alias("bit"), F.lit(s).alias("prior"),
            # Orders in which exactly this set comes before the filter.
            F.lit(math.factorial(s.bit_count()) * math.factorial(last - s.bit_count())).cast("long").alias("orders"),
        )
        for b, s in pairs
    ]))
    sums = counted.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    rows = sums.withColumn("cell", cells).select("*", "cell.*")
    mask, bit, prior = F.col("mask"), F.col("bit"), F.col("prior")
    fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(prior) != 0

    def total(column: str, when, name: str):
        return F.sum(F.when(when, F.col(column)).otherwise(0)).alias(name)

    by_cell = rows.groupBy("part", "bit", "prior", "orders").agg(
        total("n", ~fails & ~gone, "kept"),
        total("n", fails & ~gone, "removed"),
        total("n", fails & gone, "redundant"),
        total("n", mask == bit, "unique_fails"),
        total("good", fails & ~gone, "good_lost"),
        total("toxic", fails & ~gone, "toxic_lost"),
    )
    # 16 rows of one part and filter.
    shapley = F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "bit"))
    orders = []
    for order in permutations(range(len(FILTERS))):
        prior_set = 0
        for step, k in enumerate(order, 1):
            orders.append(("".join(FILTERS[x] for x in order), step, 1 << k, prior_set))
            prior_set |= 1 << k
    steps = spark.createDataFrame(orders, "filter_order string, step int, bit int, prior int")
    # 600 rows whatever the input.
    return by_cell.withColumn("shapley", shapley).join(F.broadcast(steps), ["bit", "prior"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        "shapley",
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Stream the whole table at ``path`` through the audit and report all orders."""
    folder = work_dir(spark, "audit")
    n_files = len(spark.read.parquet(path).inputFiles())
    query = start_audit(spark, path, labels, folder, max(1, -(-n_files // batches)))
    query.awaitTermination()
    return interactions(counters(spark, folder))
