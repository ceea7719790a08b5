"""Repeated passages, by bounded interval expansion on a Burrows-Wheeler transform.

Every byte of a text that lies in a string of 50 bytes which also starts in a document of
smaller ``doc_id`` is removed. Strings never cross documents and are judged on the input.

Only strings that occur in two documents need sorting, so two exchanges of packed numbers come
first, and texts are never shuffled:

1. Each window of 50 bytes is dealt by its anchor, the 24-byte piece of least hash within it.
   Neighbouring windows share anchors; such a run of windows is one string of up to 76 bytes.
   Equal windows have equal anchors. Blocks of the scan send the distinct anchors of a chunk of
   documents with the smallest and largest id seen; the answers say which anchors occur in
   more than one document.
2. A second scan sends the strings of shared anchors, each distinct string of a chunk once.
   Where they meet, they are taken part by part, a part being some anchors with all their
   strings, so that a task's memory does not depend on the share of text that repeats. The
   distinct strings of a part are sorted into a Burrows-Wheeler transform. Intervals
   of rows are extended backward through it, breadth first from the empty string, which gives
   the common prefixes of neighbouring rows by increasing value; the search stops at 50. Rows
   not parted by then hold equal windows, and their smallest id is compared with each string's.
3. A third scan looks up the answers, marks the covered bytes and cuts them out.

An anchor of very many runs (a phrase in all kinds of surroundings) is hot: its windows are
dealt one by one, each by its own 50 bytes, so that no task gets all strings of an anchor.

A null or empty text has no bytes. A null ``doc_id`` counts as larger than all others; rows of
equal ids never remove bytes from each other, and repeated rows get equal results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import wordarrays as wa
from basketry.llm.blocks import block_of_scan, pack, read_block, store_by_block, unpack
from basketry.llm.common import materialise, own_names, tune

LENGTH = 50
ANCHOR = 24
# Bytes of text handled together; positions within a piece take 20 bits.
PIECE = 1 << 16
CHUNK = 2 << 20
# Runs that may have an anchor before its windows go one by one: strings of 3 MB at most.
HOT = 40_000
# Bytes of text behind one bucket, of anchors and of strings: about 600,000 anchors, and strings
# of four times the text at most, if all of it repeats.
BUCKET = 8 << 20
# The strings of a bucket lie in so many parts, and parts of so many bytes are sorted together;
# sorting takes about 90 times the bytes.
PARTS = 64
TOGETHER = 1 << 19
# Symbols by which suffixes are first ranked: as many as fit a 64-bit word.
WORD = 7
LAST = np.iinfo(np.int64).max
LOW20 = np.uint64((1 << 20) - 1)


def window_runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """Runs of windows with a common anchor: text index, first window, windows, anchor hash."""
    parts, i = [], 0
    ends = offsets[1:]
    starts = offsets[:-1]
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
        low, high = int(starts[i]), int(ends[j - 1])
        # A text longer than a piece is cut; its pieces overlap by a window less a byte.
        for a in range(low, max(high, low + 1), PIECE):
            b = min(high, a + PIECE + length - 1)
            if b - a >= length:
                parts.append(_piece_runs(data, a, b, starts[i:j], ends[i:j], i, length, anchor))
        i = j
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _piece_runs(data, a, b, starts, ends, first, length, anchor):
    n = b - a
    up, down = wa.powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    h = wa.mix((total[anchor:] - total[: n - anchor + 1]) * down[: n - anchor + 1])
    least = (h & ~LOW20) | np.arange(len(h), dtype=np.uint64)
    span, done = length - anchor + 1, 1
    while 2 * done <= span:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if span > done:
        least = np.minimum(least[: n - length + 1], least[span - done : span - done + n - length + 1])
    at = (least & LOW20).astype(np.int64)
    last = a + len(at)
    owner = np.repeat(np.arange(len(ends)), np.clip(ends, a, last) - np.clip(starts, a, last))
    window = np.flatnonzero(np.arange(a, last) + length <= ends[owner])
    if not len(window):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = at[window]
    new = np.ones(len(window), bool)
    new[1:] = (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)
    begin = np.flatnonzero(new)
    counts = np.diff(np.append(begin, len(window)))
    return owner[window[begin]] + first, window[begin] + a, counts, h[at[begin]]


@dataclass
class Strings:
    """Distinct strings of a chunk, each with its bucket, part and smallest id, and all their places."""

    texts: list[bytes]
    bucket: np.ndarray
    part: np.ndarray
    least: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    orders: np.ndarray
    which: np.ndarray

    def by_bucket(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each bucket with the indices of its strings, part by part."""
        order = np.lexsort((self.part, self.bucket))
        values, begin = np.unique(self.bucket[order], return_index=True)
        for value, members in zip(values.tolist(), np.split(order, begin[1:])):
            yield value, members


class Chunk:
    """Some consecutive documents of one block."""

    def __init__(self, block: int, seq: int, texts: list[bytes], orders: list[int], extra: list):
        self.block, self.seq, self.extra = block, seq, extra
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.offsets = np.cumsum([0, *map(len, texts)]).astype(np.int64)
        self.orders = np.array(orders, np.int64)
        self.doc, self.start, self.windows, self.hash = window_runs(self.data, self.offsets)

    def anchors(self, buckets: int):
        """Distinct anchors by bucket and residue, as one number, their runs in that order and
        where each anchor's begin; and first and last anchor of each bucket that has some."""
        key = ((self.hash % np.uint64(buckets)) << np.uint64(32)) | (self.hash >> np.uint64(32))
        order = np.argsort(key)
        key = key[order]
        begin = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))
        key = key[begin]
        edges = np.searchsorted(key >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64)).tolist()
        return key, order, begin, [(k, a, b) for k, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]

    def strings(self, flags: np.ndarray, buckets: int) -> Strings:
        """The strings of shared anchors; those of hot anchors one window each."""
        runs = np.flatnonzero(flags)
        split = np.where(flags[runs] == 1, 1, self.windows[runs])
        each = np.repeat(runs, split)
        nth = np.arange(len(each)) - np.repeat(np.cumsum(split) - split, split)
        hot = flags[each] != 1
        start = self.start[each] + nth
        windows = np.where(hot, 1, self.windows[each])
        orders = self.orders[self.doc[each]]
        data, index = self.data.tobytes(), {}
        which = np.fromiter(
            (index.setdefault(data[a:b], len(index)) for a, b in zip(start.tolist(), (start + windows + LENGTH - 1).tolist())),
            np.int64, len(each),
        )
        least = np.full(len(index), LAST)
        np.minimum.at(least, which, orders)
        texts = list(index)
        bucket, part = np.zeros(len(index), np.int64), np.zeros(len(index), np.uint8)
        bucket[which] = (self.hash[each] % np.uint64(buckets)).astype(np.int64)
        part[which] = ((self.hash[each] >> np.uint64(24)) % np.uint64(PARTS)).astype(np.uint8)
        for k in np.unique(which[hot]).tolist():
            code = zlib.crc32(texts[k])
            bucket[k], part[k] = code % buckets, (code >> 24) % PARTS
        return Strings(texts, bucket, part, least, start, windows, orders, which)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """Chunks of the rows of a scan: columns ``doc_id``, ``text``, ``block``."""
    block, seq, size = None, 0, 0
    texts: list[bytes] = []
    orders: list[int] = []
    ids: list = []
    for batch in batches:
        columns = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()
        for doc_id, text, own in zip(*columns):
            if own != block or size > CHUNK:
                if texts:
                    yield Chunk(block, seq, texts, orders, ids)
                seq = seq + 1 if own == block else 0
                block, size, texts, orders, ids = own, 0, [], [], []
            texts.append(text or b"")
            orders.append(LAST if doc_id is None else doc_id)
            ids.append(doc_id)
            size += len(texts[-1])
    if texts:
        yield Chunk(block, seq, texts, orders, ids)


ASKED = "bucket int, block bigint, seq int, anchors binary"
ANSWER = "block bigint, bucket int, seq int, answer binary"


def _ask_anchors(buckets: int):
    def run(batches):
        for chunk in chunks(batches):
            key, order, begin, edges = chunk.anchors(buckets)
            if not edges:
                continue
            ids = chunk.orders[chunk.doc[order]]
            low = np.minimum.reduceat(ids, begin)
            # Most anchors have one run; the rest of what is sent is nearly all zeros then.
            above = np.maximum.reduceat(ids, begin) - low
            runs = np.diff(begin, append=len(ids)).astype("<u4")
            residue = key.astype(np.uint32)
            rows = []
            for bucket, a, b in edges:
                gaps = np.diff(residue[a:b], prepend=np.uint32(0)).astype("<u4")
                body = b"".join(x.tobytes() for x in (gaps, runs[a:b], low[a:b], above[a:b]))
                rows.append((bucket, chunk.block, chunk.seq, pack(body)))
            yield _batch(rows, ("i4", "i8", "i4", "b"), ["bucket", "block", "seq", "anchors"])

    return run


_KINDS = {"i4": pa.int32(), "i8": pa.int64(), "b": pa.binary()}


def _batch(rows: list[tuple], kinds: tuple[str, ...], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(columns, kinds)], names)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """All rows of one bucket after another; the rows come sorted by bucket."""
    bucket, held = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[0] != bucket:
                if held:
                    yield bucket, held
                bucket, held = row[0], []
            held.append(row[1:])
    if held:
        yield bucket, held


def _answer_anchors(hot: int):
    """Per distinct anchor of each chunk: 0 in one document only, 1 shared, 2 shared and hot."""

    def run(batches):
        for bucket, rows in _by_bucket(batches):
            values, runs, low, high = [], [], [], []
            for _, _, body in rows:
                body = unpack(body)
                n = len(body) // 24
                values.append(np.cumsum(np.frombuffer(body, "<u4", n), dtype=np.uint32))
                runs.append(np.frombuffer(body, "<u4", n, 4 * n))
                low.append(np.frombuffer(body, np.int64, n, 8 * n))
                high.append(low[-1] + np.frombuffer(body, np.int64, n, 16 * n))
            runs, low, high = (np.concatenate(x) for x in (runs, low, high))
            every = np.concatenate(values)
            order = np.argsort(every, kind="stable")
            new = np.ones(len(every), bool)
            new[1:] = every[order][1:] != every[order][:-1]
            begin = np.flatnonzero(new)
            shared = np.minimum.reduceat(low[order], begin) < np.maximum.reduceat(high[order], begin)
            counts = np.diff(np.append(begin, len(every)))
            many = np.add.reduceat(runs[order], begin, dtype=np.int64) > hot
            answer = np.empty(len(every), np.uint8)
            answer[order] = np.repeat(shared.astype(np.uint8) + (shared & many), counts)
            at = np.cumsum([0, *map(len, values)])
            replies = [
                (r[0], bucket, r[1], pack(answer[a:b].tobytes())) for r, a, b in zip(rows, at[:-1], at[1:])
            ]
            yield _batch(replies, ("i8", "i4", "i4", "b"), ["block", "bucket", "seq", "answer"])

    return run


class Answers:
    """Stored answers of the block at hand, by chunk and bucket."""

    def __init__(self, folder: str):
        self.folder, self.block, self.found = folder, None, {}

    def of(self, chunk: Chunk) -> dict[int, bytes]:
        if chunk.block != self.block:
            self.block, self.found = chunk.block, {}
            table = read_block(self.folder, chunk.block, ["bucket", "seq", "answer"])
            if table is not None:
                for bucket, seq, answer in zip(*[table[c].to_pylist() for c in ("bucket", "seq", "answer")]):
                    self.found[seq, bucket] = answer
        return {b: unpack(x) for (seq, b), x in self.found.items() if seq == chunk.seq}


def _flags(chunk: Chunk, answers: Answers, buckets: int) -> np.ndarray:
    """Answer about the anchor of each run."""
    key, order, begin, edges = chunk.anchors(buckets)
    got, own = answers.of(chunk), np.zeros(len(key), np.uint8)
    for bucket, a, b in edges:
        answer = np.frombuffer(got.get(bucket, b""), np.uint8)
        if len(answer) != b - a:
            raise RuntimeError("the blocks of the scan have changed; run the job again")
        own[a:b] = answer
    flags = np.empty(len(order), np.uint8)
    flags[order] = np.repeat(own, np.diff(begin, append=len(order)))
    return flags


STRINGS = "bucket int, block bigint, seq int, strings binary"


def _ask_strings(folder: str, buckets: int, string_buckets: int):
    def run(batches):
        answers = Answers(folder)
        for chunk in chunks(batches):
            rows = []
            found = chunk.strings(_flags(chunk, answers, buckets), string_buckets)
            for bucket, members in found.by_bucket() if found.texts else ():
                own = [found.texts[k] for k in members.tolist()]
                sizes = np.fromiter(map(len, own), "<u2", len(own))
                head = found.least[members].tobytes() + sizes.tobytes() + found.part[members].tobytes()
                body = b"".join([len(own).to_bytes(8, "little"), head, *own])
                rows.append((bucket, chunk.block, chunk.seq, pack(body)))
            if rows:
                yield _batch(rows, ("i4", "i8", "i4", "b"), ["bucket", "block", "seq", "strings"])

    return run


def suffix_order(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` symbols at least, and its inverse.

    Doubles the length by which suffixes are ranked, starting from words of ``WORD`` symbols.
    """
    n = len(symbols)
    one = np.concatenate([symbols.astype(np.uint64), np.zeros(WORD - 1, np.uint64)])
    two = (one[:-1] << np.uint64(9)) | one[1:]
    # Two, two, two and one symbols.
    key = (((two[:n] << np.uint64(18)) | two[2 : n + 2]) << np.uint64(27)) | (two[4 : n + 4] << np.uint64(9)) | one[6 : n + 6]
    order = np.argsort(key).astype(np.int32)
    head = np.ones(n, bool)
    ordered = key[order]
    head[1:] = ordered[1:] != ordered[:-1]
    # The rank of a suffix is the row at which those that begin alike begin.
    rank = np.empty(n, np.int32)
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    done = WORD
    while done < depth:
        tied = ~head
        tied[:-1] |= ~head[1:]
        rows = np.flatnonzero(tied)
        if not len(rows):
            break
        # Only suffixes that begin alike are sorted again, in place.
        own = order[rows]
        onward = own + done
        behind = np.where(onward < n, rank[np.minimum(onward, n - 1)] + 1, 0)
        key = (rank[own].astype(np.uint64) << np.uint64(32)) | behind.astype(np.uint64)
        by = np.argsort(key)
        key, order[rows] = key[by], own[by]
        new = np.ones(len(rows), bool)
        new[1:] = key[1:] != key[:-1]
        head[rows] = new
        rank[order[rows]] = rows[new][np.cumsum(new) - 1]
        done *= 2
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    return order, place


def common_prefixes(symbols: np.ndarray, order: np.ndarray, place: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix of each row of the transform with the row before it, -1 from ``limit`` on.

    The transform is the symbol before each sorted suffix; ``back`` has the row of the suffix that
    begins with it, and ``begins`` the symbol itself at that row. A queue holds the intervals of rows that begin with a string of
    ``level`` symbols, at first the interval of the empty string. Extending an interval backward
    by each symbol that its rows have in the transform gives the intervals of strings one symbol
    longer. Where such an interval ends and no shorter string has ended there, the rows on both
    sides share exactly ``level`` symbols, and the interval joins the next level's queue; where
    a shorter one has, its extensions end where those of the shorter one do, and it is let go.
    So values come in rising order, each row gets its own once, and the queue of level
    ``limit`` is not looked at. All intervals of a level are extended together.

    Marks (symbol 0) are never extended by: a row whose value would need a string with a mark
    keeps -1, which parts no two windows without one.
    """
    n = len(order)
    back, begins = place[order - 1], symbols[order]
    # Marks are the smallest symbol, so the suffixes that begin with one come first.
    marks = np.int32(np.count_nonzero(begins == 0))
    value = np.full(n + 1, -1, np.int16)
    open_end = np.ones(n + 1, bool)
    open_end[[0, n]] = False
    value[0] = 0
    low, high = np.array([0], np.int32), np.array([n], np.int32)
    came_from = np.zeros(n, np.int32)
    for level in range(limit):
        # The rows that one interval reaches by one symbol lie side by side, so the reached rows
        # in order, cut where interval or symbol changes, are the extended intervals.
        if not level:
            # From the interval of the empty string every row is reached.
            reached = target = np.arange(marks, n, dtype=np.int32)
            came_from[target] = 1
        else:
            sizes = high - low
            target = back[_ranges(low, sizes)]
            came_from[target] = np.repeat(np.arange(1, len(low) + 1, dtype=np.int32), sizes)
            reached = np.flatnonzero(came_from) if 16 * len(target) > n else np.sort(target)
            reached = reached[np.searchsorted(reached, marks) :]
        if not len(reached):
            break
        by, symbol = came_from[reached], begins[reached]
        cut = np.ones(len(reached) + 1, bool)
        cut[1:-1] = (by[1:] != by[:-1]) | (symbol[1:] != symbol[:-1])
        at = np.flatnonzero(cut)
        low, high = reached[at[:-1]].astype(np.int32), reached[at[1:] - 1].astype(np.int32) + 1
        came_from[target] = 0
        fresh = open_end[high]
        low, high = low[fresh], high[fresh]
        value[high] = level
        open_end[high] = False
    return value[:n]


def equal_windows(strings: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of every window of ``length`` bytes: (index of the string, offset, class).

    The strings, each closed by a mark, form one text. Windows of a class are neighbours in the
    order of suffixes, with common prefixes of ``length`` or more between them.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    begin = np.cumsum(np.concatenate(([0], sizes[:-1] + 1)))
    n = int(sizes.sum() + len(strings))
    symbols = np.zeros(n, np.uint16)
    body = np.ones(n, bool)
    body[begin + sizes] = False
    symbols[body] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
    order, place = suffix_order(symbols, length)
    group = np.cumsum(common_prefixes(symbols, order, place, length) >= 0) - 1
    string_of = np.repeat(np.arange(len(strings), dtype=np.int32), sizes + 1)
    owner = string_of[order]
    offset = order - begin[owner]
    whole = offset + length <= sizes[owner]
    return owner[whole], offset[whole], group[whole]


def _answer_strings(batches):
    """Per string of each chunk one bit for each window: it also starts at a smaller id."""
    for bucket, rows in _by_bucket(batches):
        texts, sizes, parts, low = [], [], [], []
        for _, _, body in rows:
            body = unpack(body)
            n = int.from_bytes(body[:8], "little")
            low.append(np.frombuffer(body, np.int64, n, 8))
            sizes.append(np.frombuffer(body, "<u2", n, 8 + 8 * n))
            parts.append(np.frombuffer(body, np.uint8, n, 8 + 10 * n))
            texts.append(body[8 + 11 * n :])
        ends = np.cumsum([0, *map(len, sizes)])
        data, sizes, parts, low = b"".join(texts), np.concatenate(sizes).astype(np.int64), np.concatenate(parts), np.concatenate(low)
        texts = None
        counts = sizes - (LENGTH - 1)
        base = np.concatenate(([0], np.cumsum(counts)))
        first = np.cumsum(sizes) - sizes
        bits = np.zeros(base[-1], bool)
        for members in _parts(parts, sizes):
            at = first[members]
            own = [data[a:b] for a, b in zip(at.tolist(), (at + sizes[members]).tolist())]
            bits[_ranges(base[members], counts[members])] = _repeats(own, low[members])
        replies = [
            (block, bucket, seq, pack(np.packbits(bits[base[a] : base[b]]).tobytes()))
            for (block, seq, _), a, b in zip(rows, ends[:-1], ends[1:])
        ]
        yield _batch(replies, ("i8", "i4", "i4", "b"), ["block", "bucket", "seq", "answer"])


def _parts(parts: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Strings that are sorted together: whole parts, of ``TOGETHER`` bytes or one part only."""
    order = np.argsort(parts, kind="stable")
    edges = np.searchsorted(parts[order], np.arange(PARTS + 1))
    total = np.concatenate(([0], np.cumsum(sizes[order])))[edges]
    a = 0
    while a < PARTS:
        b = max(a + 1, int(np.searchsorted(total, total[a] + TOGETHER, "right")) - 1)
        if edges[b] > edges[a]:
            yield order[edges[a] : edges[b]]
        a = b


def _repeats(texts: list[bytes], orders: np.ndarray) -> np.ndarray:
    """For every window of the strings: it also starts at an id smaller than its string's."""
    index: dict[bytes, int] = {}
    which = np.fromiter((index.setdefault(x, len(index)) for x in texts), np.int64, len(texts))
    distinct = list(index)
    low = np.full(len(distinct), LAST)
    np.minimum.at(low, which, orders)
    owner, offset, group = equal_windows(distinct)
    # Rows of a class are neighbours, so its smallest id is a reduction over a range.
    begin = np.flatnonzero(np.diff(group, prepend=-1))
    smallest = np.repeat(np.minimum.reduceat(low[owner], begin), np.diff(np.append(begin, len(group))))
    counts = np.fromiter(map(len, distinct), np.int64, len(distinct)) - (LENGTH - 1)
    base = np.cumsum(counts) - counts
    by_window = np.empty(int(counts.sum()), np.int64)
    by_window[base[owner] + offset] = smallest
    counts = counts[which]
    return by_window[_ranges(base[which], counts)] < np.repeat(orders, counts)


def _ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts[i]`` numbers from ``first[i]`` on, for each i."""
    shift = (first - (np.cumsum(counts) - counts)).astype(first.dtype)
    return np.repeat(shift, counts) + np.arange(int(counts.sum()), dtype=first.dtype)


CUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<bigint>"


def _cut(anchor_folder: str, buckets: int, string_folder: str, string_buckets: int):
    def covered(chunk: Chunk, anchors: Answers, strings: Answers) -> np.ndarray:
        got = strings.of(chunk)
        found = chunk.strings(_flags(chunk, anchors, buckets), string_buckets)
        if not found.texts:
            return np.zeros(len(chunk.data), bool)
        counts = np.fromiter(map(len, found.texts), np.int64, len(found.texts)) - (LENGTH - 1)
        base = np.cumsum(counts) - counts
        bits = np.zeros(int(counts.sum()), bool)
        for bucket, members in found.by_bucket():
            if bucket not in got:
                raise RuntimeError("the blocks of the scan have changed; run the job again")
            own = np.unpackbits(np.frombuffer(got[bucket], np.uint8)).astype(bool)
            n = counts[members]
            bits[_ranges(base[members], n)] = own[: n.sum()]
        # Every window of the chunk belongs to one place; it is hit if the answer says so, or
        # if the same string starts in a smaller document of the chunk.
        hit = bits[_ranges(base[found.which], found.windows)]
        hit |= np.repeat(found.orders > found.least[found.which], found.windows)
        starts = np.zeros(len(chunk.data) + 1, np.int64)
        starts[1 + _ranges(found.start, found.windows)[hit]] = 1
        total = np.cumsum(starts)
        recent = total[1:].copy()
        recent[LENGTH:] -= total[1:-LENGTH]
        return recent > 0

    def run(batches):
        anchors, strings = Answers(anchor_folder), Answers(string_folder)
        for chunk in chunks(batches):
            gone = covered(chunk, anchors, strings)
            data, rows = chunk.data.tobytes(), []
            for k, doc_id in enumerate(chunk.extra):
                a, b = int(chunk.offsets[k]), int(chunk.offsets[k + 1])
                own = gone[a:b]
                if not own.any():
                    rows.append((doc_id, b - a, 0, 0, sha256(data[a:b]).hexdigest(), []))
                    continue
                change = np.flatnonzero(np.diff(own, prepend=False, append=False))
                kept = chunk.data[a:b][~own].tobytes()
                rows.append((doc_id, b - a, int(own.sum()), len(change) // 2, sha256(kept).hexdigest(), change.tolist()))
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    return run


def repeated_passages(docs: DataFrame, stored: bool = False, hot: int = HOT) -> DataFrame:
    """Rows (``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``spans``).

    ``spans`` has start and end of each removed run of bytes, one after the other. ``stored``
    says that ``docs`` is a plain scan of a stored table; any other frame is written first.
    """
    tune(docs.sparkSession)
    plain = own_names(docs, "doc_id", "text")
    if not stored:
        plain = materialise(plain, "texts")
    rows = plain.select("doc_id", "text", block_of_scan().alias("block"))
    size = plain.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET))
    asked = rows.mapInArrow(_ask_anchors(buckets), ASKED).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    anchors = store_by_block(asked.mapInArrow(_answer_anchors(hot), ANSWER), "anchors")
    strings = rows.mapInArrow(_ask_strings(anchors, buckets, buckets), STRINGS)
    dealt = strings.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    answers = store_by_block(dealt.mapInArrow(_answer_strings, ANSWER), "windows")
    return rows.mapInArrow(_cut(anchors, buckets, answers, buckets), CUT)
