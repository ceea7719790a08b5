"""Near-duplicate documents by b-bit MinHash.

Words are runs of bytes other than ASCII white space, A-Z in lower case. A document's set
holds its distinct five-word shingles; one of fewer words holds its whole sequence as one
shingle; one without words (null, empty or blank text) has an empty set and no links. Two
documents are linked if the shared shingles make 75 % of the union or more, checked on the
full sets. ``component_id`` is the smallest ``doc_id`` reachable over links.

How it goes:

1. One pass over the texts gives each document the 128-bit key of its word sequence, the
   number of shingles, keys of 32 bands of 4 minima each, and of all 128 minima the low
   4 bits, packed into 64 bytes. Equal word sequences form a class; from here on a class is
   one node, however many copies it has.
2. Band buckets of two or more nodes give candidates. Each node is first tried against the
   smallest node of its buckets (a star, never all pairs). The share of equal 4-bit minima,
   corrected for the 1/16 of chance matches, estimates the similarity; pairs that are five
   standard errors below the threshold are given up, the rest are checked on full sets.
3. Components form from the confirmed links. In buckets that still touch several components,
   every node outside the bucket's largest component is held against every node of another
   component in it. This exact tail runs in blocks of bounded size: signatures first, then the
   full sets, and a pair that the block has connected already is not tried again, so a block
   gives out fewer links than it has rows.

No bucket is cut off, so a pair is missed only if none of 32 bands collides: 5 in a million
at a similarity of 0.75, less above it.

Rows with a null ``doc_id`` take part; a component of such rows alone has a null id. Repeated
rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import wordarrays as wa
from basketry.llm.common import connected, free_name, materialise, own_names, tune

HASHES = 128
BANDS = 32
ROWS = HASHES // BANDS
BITS = 4
PERCENT = 75
WORDS = 5
# Five standard errors of an estimate from 128 minima at a similarity of 0.75.
MARGIN = 5 * (0.75 * 0.25 / HASHES) ** 0.5
BLOCK = 1000

_rng = np.random.default_rng(5)
TIMES = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLUS = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
BAND_SALT = wa.mix(np.arange(1, BANDS + 1, dtype=np.uint64) * wa.SEED)

SKETCH = "doc_id bigint, k1 bigint, k2 bigint, n_shingles bigint, bands array<bigint>, sig array<bigint>"


def minima(shingles: np.ndarray) -> np.ndarray:
    """Smallest value of each of the hash functions over a set of shingle hashes."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        np.minimum(least, (shingles[i : i + 512, None] * TIMES + PLUS).min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = wa.mix(least.reshape(BANDS, ROWS) + np.arange(ROWS, dtype=np.uint64) * wa.SEED)
    return wa.mix(rows.sum(axis=1, dtype=np.uint64) ^ BAND_SALT).view(np.int64)


def packed(least: np.ndarray) -> np.ndarray:
    """The low ``BITS`` bits of each (mixed) minimum, sixteen to a 64-bit word."""
    low = wa.mix(least) & np.uint64(2**BITS - 1)
    shift = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)
    return (low.reshape(-1, 64 // BITS) << shift).sum(axis=1, dtype=np.uint64).view(np.int64)


def similarity(share: float) -> float:
    """Resemblance from the share of equal ``BITS``-bit minima, less the chance matches."""
    chance = 2.0**-BITS
    return (share - chance) / (1 - chance)


def least_matches() -> int:
    """Fewest equal minima of a pair that is still checked on full sets."""
    chance = 2.0**-BITS
    return int(HASHES * ((PERCENT / 100 - MARGIN) * (1 - chance) + chance))


def _rows(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """The two halves of the class key and the shingle set of each text."""
    data, offsets = wa.raw(texts)
    data = wa.LOWER[data]
    starts, ends, first = wa.words(data, offsets)
    sets = wa.shingles(wa.hashes(data, starts, ends), first, WORDS)
    text = data.tobytes()
    for i, own in enumerate(sets):
        # Words one blank apart: the sequence itself, whatever white space it had.
        sequence = b" ".join(text[offsets[i] : offsets[i + 1]].split())
        k1, k2 = np.frombuffer(blake2b(sequence, digest_size=16).digest(), np.int64).tolist()
        yield k1, k2, own


def _longs(rows: list) -> pa.Array:
    return pa.array(rows, pa.list_(pa.int64()))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, known = [], {}
        for k1, k2, own in _rows(batch.column(1)):
            if (k1, k2) not in known:
                least = minima(own)
                known[k1, k2] = (band_keys(least), packed(least)) if len(own) else (None, None)
            rows.append((k1, k2, len(own), *known[k1, k2]))
        k1, k2, n, bands, sig = zip(*rows) if rows else [[]] * 5
        longs = [pa.array(c, pa.int64()) for c in (k1, k2, n)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *longs, _longs(bands), _longs(sig)],
            ["doc_id", "k1", "k2", "n_shingles", "bands", "sig"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = list(_rows(batch.column(0)))
        longs = [pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], *longs, _longs([np.sort(r[2].view(np.int64)) for r in rows])],
            ["node", "c1", "c2", "k1", "k2", "shingles"],
        )


def sketches(docs: DataFrame) -> DataFrame:
    """Class key, set size, band keys and packed signature of each document."""
    tune(docs.sparkSession)
    return own_names(docs, "doc_id", "text").mapInArrow(_sketches, SKETCH)


def matches(a: str, b: str):
    """Number of equal 4-bit minima of two packed signatures, as a column."""
    total = F.lit(0)
    for i in range(HASHES * BITS // 64):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        total = total + F.lit(64 // BITS) - F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return total


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """Rows of a list column as numpy arrays, without a Python object per element."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    at = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))))
    return [values[a:b] for a, b in zip(at[:-1], at[1:])]


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Number of values that two sorted arrays of distinct values share."""
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def _tail(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between different components found in one block.

    Input rows are sorted by block; a block holds at most about twice ``BLOCK`` rows. A pair
    is tried in the first of the buckets it shares, if the estimate passes and the block has
    not connected it yet, and always on the full sets.
    """
    need, held, key = least_matches(), [], None

    def links(bucket: int, rows) -> pa.RecordBatch:
        node, root, own, sig, bands, sets = zip(*rows)
        node, root, own = np.array(node), np.array(root), np.array(own)
        sig, bands = np.array(sig).view(np.uint64), np.array(bands)
        parent = {int(r): int(r) for r in root}

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        right, found = np.flatnonzero(own), []
        for i in np.flatnonzero(~own):
            x = sig[right] ^ sig[i]
            x |= x >> np.uint64(1)
            x |= x >> np.uint64(2)
            same = HASHES - np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1)
            maybe = right[(same >= need) & (root[right] != root[i])]
            first = (bands[maybe] == bands[i]).argmax(axis=1)
            for j in maybe[bands[i][first] == bucket]:
                u, v = top(int(root[i])), top(int(root[j]))
                if u == v:
                    continue
                common = _shared(sets[i], sets[j])
                if 100 * common >= PERCENT * (len(sets[i]) + len(sets[j]) - common):
                    parent[max(u, v)] = min(u, v)
                    found.append((int(node[i]), int(node[j])))
        columns = list(zip(*found)) if found else [[], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    for batch in batches:
        plain = [c.to_pylist() for c in batch.columns[:6]]
        lists = [_lists(c) for c in batch.columns[6:]]
        for row in zip(*plain, *lists):
            if row[:3] != key:
                if held:
                    yield links(key[0], held)
                key, held = row[:3], []
            held.append(row[3:])
    if held:
        yield links(key[0], held)


def link_components(docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """Rows (``k1``, ``k2``, ``component_id``, ``component_nodes``), one per class.

    ``sketched`` is the stored table of :func:`sketches` of ``docs``.
    """
    full = sketched.where("n_shingles > 0")
    classes = materialise(
        full.groupBy("k1", "k2").agg(F.min("doc_id").alias("first_id"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    # One sketch per class: copies agree, so any row will do.
    one = full.groupBy("k1", "k2").agg(F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    nodes = classes.join(one, ["k1", "k2"])
    members = nodes.select("node", F.explode("bands").alias("bucket")).repartition("bucket")
    shared = (
        members.groupBy("bucket")
        .agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("size"))
        .where("size > 1")
    )
    buckets = materialise(members.join(shared, "bucket"), "buckets")
    involved = materialise(
        nodes.select("node", "k1", "k2", "sig", "bands", "first_id").join(buckets.select("node").distinct(), "node", "left_semi"),
        "involved",
    )
    sets = materialise(_class_sets(docs, sketched, involved), "sets")
    star = buckets.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    links = materialise(_confirmed(star, involved, sets), "links")
    roots = materialise(connected(links), "roots")
    rooted = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = rooted.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 != r1")
    unsettled = materialise(rooted.join(split.select("bucket"), "bucket", "left_semi"), "unsettled")
    more = materialise(_tail_links(unsettled, involved.select("node", "sig", "bands").join(sets, "node")), "links")
    if not more.isEmpty():
        # What is connected already needs one link to its root, however many it had.
        roots = connected(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).union(more))
    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return named.join(lowest, "root").select("k1", "k2", "component_id")


def _class_sets(docs: DataFrame, sketched: DataFrame, involved: DataFrame) -> DataFrame:
    """Full shingle sets of the classes in shared buckets.

    A class's text is found by its smallest ``doc_id``; the key computed from the text says
    whether it is the right one, should an id be used twice. Rows without an id are found by
    the key itself.
    """
    kind = "node bigint, c1 bigint, c2 bigint, k1 bigint, k2 bigint, shingles array<bigint>"
    plain = own_names(docs, "doc_id", "text")
    wanted = involved.select(F.col("first_id").alias("doc_id"), "node", F.col("k1").alias("c1"), F.col("k2").alias("c2"))
    found = plain.join(wanted, "doc_id").select("text", "node", "c1", "c2").mapInArrow(_sets, kind)
    found = found.where("k1 = c1 AND k2 = c2").select("node", "shingles")
    if sketched.where("doc_id IS NULL").limit(1).count():
        none = F.lit(None).cast("bigint")
        texts = plain.where("doc_id IS NULL").select("text", none.alias("node"), none.alias("c1"), none.alias("c2"))
        keyed = texts.mapInArrow(_sets, kind).select("k1", "k2", "shingles").dropDuplicates(["k1", "k2"])
        nameless = involved.where("first_id IS NULL").select("node", "k1", "k2")
        found = found.union(keyed.join(nameless, ["k1", "k2"]).select("node", "shingles"))
    return found


def _confirmed(pairs: DataFrame, involved: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that pass the estimate and whose full sets reach the threshold."""
    sig = involved.select("node", "sig")
    near = (
        pairs.distinct()
        .join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
        .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")
        .where(matches("sa", "sb") >= least_matches())
        .select("a", "b")
    )
    both = near.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"
    )
    return (
        both.withColumn("common", F.size(F.array_intersect("x", "y")))
        .where(100 * F.col("common") >= PERCENT * (F.size("x") + F.size("y") - F.col("common")))
        .select("a", "b")
    )


def _tail_links(unsettled: DataFrame, payload: DataFrame) -> DataFrame:
    """Links across components within the unsettled buckets, block by block.

    A bucket's nodes are dealt into strips; those outside its largest component, also into
    lanes. A block is one strip against one lane, so every such pair meets in one block, and
    no block outgrows ``BLOCK`` rows a side, but for chance.
    """
    per_root = unsettled.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    main = per_root.groupBy("bucket").agg(
        F.max(F.struct("n", F.negate("root").alias("r"))).alias("m"), F.sum("n").alias("total")
    ).select(
        "bucket",
        F.negate(F.col("m.r")).alias("main"),
        F.ceil(F.col("total") / BLOCK).cast("int").alias("strips"),
        F.ceil((F.col("total") - F.col("m.n")) / BLOCK).cast("int").alias("lanes"),
    )
    rows = unsettled.select("bucket", "node", "root").join(main, "bucket").join(payload, "node")
    strip = F.pmod(F.xxhash64("node"), F.col("strips")).cast("int")
    lane = F.pmod(F.xxhash64("node", F.lit(1)), F.col("lanes")).cast("int")
    last = ["node", "root", "own", "sig", "bands", "shingles"]
    held = rows.withColumn("own", F.lit(True)).select(
        "bucket", strip.alias("strip"), F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"), *last
    )
    tried = rows.where("root != main").withColumn("own", F.lit(False)).select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("strips") - 1)).alias("strip"), lane.alias("lane"), *last
    )
    blocks = held.union(tried).repartition("bucket", "strip", "lane").sortWithinPartitions("bucket", "strip", "lane")
    return blocks.mapInArrow(_tail, "a bigint, b bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Rows (``doc_id``, ``n_shingles``, ``component_id``, ``kept``), one per input row.

    A document without words is its own component. ``kept`` is true for the smallest
    ``doc_id`` of a component.
    """
    sketched = materialise(sketches(docs), "sketches")
    components = link_components(docs, sketched)
    own = sketched.select("doc_id", "n_shingles", "k1", "k2")
    joined = own.join(components, ["k1", "k2"], "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest ``doc_id``.

    Of rows that repeat a kept ``doc_id`` all stay if their texts differ, since nothing says
    which is meant; rows that repeat it with an equal text are dropped to one. Rows with a
    null ``doc_id`` stay only if they are not near copies of a row that has one.
    """
    name = free_name(docs, "doc_id_gone")
    decided = materialise(
        near_duplicates(docs).groupBy(F.col("doc_id").alias(name)).agg(F.count_if("kept").alias("n")), "decided"
    )
    # Fewer documents go than stay, so the list of those is the smaller side to send. It is a table
    # of its own, so that its size is known when the join is planned.
    gone = materialise(decided.where("n = 0").select(name), "gone")
    stays = docs.join(gone, docs["doc_id"].eqNullSafe(F.col(name)), "left_anti")
    if decided.where("n > 1").limit(1).count():
        return stays.dropDuplicates([c for c in docs.columns if c in ("doc_id", "text")])
    return stays
