"""Runs: maximal stretches of words that repeat with a period, found through Lyndon roots.

Method, per document (words are runs of bytes other than ASCII white space):

1. A word that occurs once in a stretch of the document lies in no run, as every word of a run
   stands one period before or after an equal one. The document is cut at such words until
   nothing changes; stretches shorter than the shortest wanted run go. What remains holds every
   run whole.
2. For each remaining stretch the first phase of Baier's suffix sorter runs twice, under an
   order of the words and under its reverse. Positions start in one group per word. Groups are
   taken from the highest down; each position of the group points to the nearest position
   before it that is in no group taken so far, and positions pointed to equally often leave
   their group for a new one right above it, with a context longer by so many contexts of the
   group taken. When a position is taken, its group's context is the longest Lyndon word that
   starts there: the Lyndon array, without sorting the suffixes further.
3. Every run holds a Lyndon root, under one of the two orders, of the length of its period. All
   (position, length) pairs are extended to the right and left by longest common extensions.
   These come from names of blocks of 1, 2, 4, ... words (equal blocks, equal names), so they
   are exact; all pairs of a batch are extended together in numpy.

Documents do not depend on each other, so the work is one narrow pass without a shuffle. The
grouping takes linear time; names take ``log`` of the longest stretch arrays of that stretch.

Defined results: a null, empty or blank text has no words, no runs and the collapsed text ``""``.
Repeated rows, equal ids and null ids are rows of their own. Other columns are kept untouched;
an own column named like an output (``runs``, ``collapsed``) is passed over in ``runs_report``
and refused by ``add_runs``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import let, own_names, tune, with_fields
from basketry.llm.wordarrays import hashes, mix, raw, words

MIN_LENGTH = 12
MIN_REPEATS = 2
WORD = r"[^\x20\x09-\x0D]+"
RUNS = T.ArrayType(
    T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]), False
)
# Rounds of cutting. Cutting is only a saving: what it leaves is looked at in full.
CUTS = 12


def lyndon_array(ids: Sequence[int]) -> list[int]:
    """Length of the longest Lyndon word from each position, by Baier's grouping."""
    n = len(ids)
    members: list[list[int]] = []
    for_word: dict[int, int] = {}
    group_of = [0] * n
    for i, word in enumerate(ids):
        g = for_word.setdefault(word, len(members))
        if g == len(members):
            members.append([])
        members[g].append(i)
        group_of[i] = g
    ordered = [for_word[w] for w in sorted(for_word)]
    context = [1] * len(members)
    lower, upper = [-1] * len(members), [-1] * len(members)
    for a, b in zip(ordered, ordered[1:]):
        lower[b], upper[a] = a, b
    # Neighbours among the positions not taken yet.
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    out = [0] * n
    now = ordered[-1] if ordered else -1
    while now >= 0:
        length = context[now]
        pointed: dict[int, int] = {}
        for i in members[now]:
            if group_of[i] != now:
                continue
            out[i] = length
            p, q = before[i], after[i]
            if q < n:
                before[q] = p
            if p >= 0:
                after[p] = q
                pointed[p] = pointed.get(p, 0) + 1
        fresh: dict[tuple[int, int], list[int]] = {}
        for p, times in pointed.items():
            fresh.setdefault((times, group_of[p]), []).append(p)
        for times, old in sorted(fresh, reverse=True) if len(fresh) > 1 else fresh:
            moved = fresh[times, old]
            g, above = len(members), upper[old]
            members.append(moved)
            context.append(context[old] + times * length)
            lower.append(old)
            upper.append(above)
            upper[old] = g
            if above >= 0:
                lower[above] = g
            for p in moved:
                group_of[p] = g
        members[now] = []
        now = lower[now]
    return out


def _stretches(keys: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that may lie in runs, as positions, and the first index of each stretch of them."""
    at, part = np.arange(len(keys)), doc
    for _ in range(CUTS):
        own = mix(keys[at] + part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(own)
        ranked = own[order]
        same = ranked[1:] == ranked[:-1]
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        part = part[again]
        kept = at[again]
        new = np.ones(len(kept), bool)
        new[1:] = (kept[1:] != kept[:-1] + 1) | (part[1:] != part[:-1])
        stretch = np.cumsum(new) - 1
        long = np.bincount(stretch, minlength=1)[stretch] >= least if len(kept) else np.zeros(0, bool)
        settled = len(kept) == len(at) and long.all()
        at, part = kept[long], stretch[long]
        if settled or not len(at):
            break
    firsts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(at) else np.zeros(0, np.int64)
    return at, firsts


def _names(ids: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """For each k the names of the blocks of 2**k words, -1 where a block passes its stretch."""
    here = np.arange(len(ids))
    levels, size = [ids.astype(np.int64)], 1
    while True:
        fits = np.flatnonzero(here + 2 * size <= end)
        if not len(fits):
            return levels
        low = levels[-1]
        pair = low[fits] * np.int64(len(ids) + 1) + low[fits + size]
        name = np.full(len(ids), -1, np.int64)
        name[fits] = np.unique(pair, return_inverse=True)[1]
        levels.append(name)
        size *= 2


def find_runs(ids: np.ndarray, firsts: np.ndarray, least: int, repeats: int):
    """Runs (first index, length, period) of stretches laid one after the other.

    ``ids`` numbers the words, ``firsts`` has each stretch's first index.
    """
    none = np.zeros(0, np.int64)
    if not len(ids):
        return none, none, none
    bounds = np.r_[firsts, len(ids)]
    stretch = np.repeat(np.arange(len(firsts)), np.diff(bounds))
    begin, end = bounds[stretch], bounds[stretch + 1]
    roots = []
    for sign in (1, -1):
        lengths = [lyndon_array((sign * ids[a:b]).tolist()) for a, b in zip(bounds[:-1], bounds[1:])]
        roots.append(np.concatenate([np.array(x, np.int64) for x in lengths]))
    at = np.tile(np.arange(len(ids)), 2)
    period = np.concatenate(roots)
    wanted = np.unique(np.stack([at, period], 1)[period * repeats <= (end - begin)[at]], axis=0)
    at, period = wanted[:, 0], wanted[:, 1]
    levels = _names(ids, end)
    right, left = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        name, size = levels[k], 1 << k
        a, b = at + right, at + period + right
        fits = b + size <= end[at]
        equal = fits & (name[np.where(fits, a, 0)] == name[np.where(fits, b, 0)])
        right += equal * size
        a = at - left - size
        fits = a >= begin[at]
        equal = fits & (name[np.where(fits, a, 0)] == name[np.where(fits, a + period, 0)])
        left += equal * size
    length = left + period + right
    run = length >= np.maximum(least, repeats * period)
    found = np.unique(np.stack([at - left, period, length], 1)[run], axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


def _batch(texts: pa.Array, least: int, repeats: int) -> tuple[pa.Array, pa.Array]:
    data, offsets = raw(texts)
    starts, ends, first = words(data, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    at, firsts = _stretches(hashes(data, starts, ends), doc, least) if len(starts) else (starts, starts)
    body = data.tobytes()
    # Numbers by the words themselves; the hashes only helped to cut.
    number: dict[bytes, int] = {}
    spans = zip(starts[at].tolist(), ends[at].tolist())
    ids = np.array([number.setdefault(body[a:b], len(number)) for a, b in spans], np.int64)
    start, length, period = find_runs(ids, firsts, least, repeats)
    start = at[start] if len(start) else start
    # Words behind the first period of a run, by adding up where such stretches begin and end.
    change = np.zeros(len(starts) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    dropped = np.cumsum(change[:-1]) > 0
    n_dropped = np.concatenate(([0], np.cumsum(dropped)))[first]
    collapsed = []
    for d, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        own = body[a:b].split()
        if n_dropped[d + 1] > n_dropped[d]:
            gone = dropped[first[d] : first[d + 1]].tolist()
            own = [w for w, g in zip(own, gone) if not g]
        collapsed.append(b" ".join(own))
    owner = doc[start] if len(start) else start
    lists = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(offsets) - 1))))
    columns = [start - first[owner], length, period]
    values = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(lists, pa.int32()), values)
    return runs, pa.array(collapsed, pa.binary()).cast(pa.string())


def add_runs(df: DataFrame, text: str = "text", least: int = MIN_LENGTH, repeats: int = MIN_REPEATS) -> DataFrame:
    """``df`` with ``runs`` (start word, length, period; by start, then period) and ``collapsed``.

    ``collapsed`` has the words that no run covers behind its first period, one space between.
    A run is at least ``least`` words and ``repeats`` periods long, ``repeats`` at least two.
    """
    if repeats < 2:
        raise ValueError("a run repeats its period at least twice")
    taken = {"runs", "collapsed"} & {c.lower() for c in df.columns}
    if taken:
        raise ValueError(f"columns of the result exist already: {sorted(taken)}")
    tune(df.sparkSession)
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, collapsed = _batch(batch.column(at), least, repeats)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, runs, collapsed], [*batch.schema.names, "runs", "collapsed"]
            )

    return df.mapInArrow(run, with_fields(df, [("runs", RUNS), ("collapsed", T.StringType())]))


def made_periodic(doc_id: Column, text: Column) -> Column:
    """The text, one in ten rewritten so that its end repeats with a period set by the id.

    With h the checksum of the decimal id and g = h div 10, every text with h mod 10 = 0 and
    n > 0 words goes on from word a = g mod n in copies of its next
    p = 1 + (n - a) div (3 + g mod 8) words. Rows without an id stay as they are.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))

    def rewritten(w: Column) -> Column:
        n = F.size(w).cast("long")
        g = F.floor(h / 10)
        start = g % F.greatest(n, F.lit(1))
        p = F.lit(1) + F.floor((n - start) / (F.lit(3) + g % 8))
        copies = F.ceil((n - start) / p)
        body = F.flatten(F.array_repeat(F.slice(w, (start + 1).cast("int"), p.cast("int")), copies.cast("int")))
        own = F.concat(F.slice(w, F.lit(1), start.cast("int")), F.slice(body, F.lit(1), (n - start).cast("int")))
        return F.when(n > 0, F.array_join(own, " ")).otherwise(text)

    found = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.when((h % 10 == 0) & text.isNotNull(), let(found, rewritten)).otherwise(text)


def runs_report(docs: DataFrame, least: int = MIN_LENGTH, repeats: int = MIN_REPEATS) -> DataFrame:
    """Per document the number of runs, the longest one, and digests of runs and collapsed text."""
    plain = own_names(docs, "doc_id", "text")
    dealt = plain.select("doc_id", made_periodic(F.col("doc_id"), F.col("text")).alias("text"))
    found = add_runs(dealt, "text", least, repeats).select("doc_id", "runs", "collapsed")
    # The greatest of (length, -start, -period) is the longest run, ties to the smallest start.
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest.alias("best"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("(1000 * best.length) div (-best.p)").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
