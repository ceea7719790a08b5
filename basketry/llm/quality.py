"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad. A line is described by a few counts of its bytes and
words, and by the same counts of the line before and the line after it; the chain adds a
weight for each pair of neighbouring states. Forward-backward gives each line the
probability of being good, and their mean, weighted by line length, is the share of good text.
A logistic curve over that share, fitted on the same sample, gives the document's quality.

Labels exist for whole documents, so in training each line carries its document's label; the
chain learns which lines tell. Training is full-batch ascent of the conditional likelihood
on at most ``sample`` labelled documents of at most ``max_lines`` lines (those of the
smallest hash of their id); this bounds what the driver gets. Scoring covers every line of
every document.

A null, empty or blank text has no lines and gets the share of good documents in the
sample, or 0.5 if there is no label at all. Repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm import wordarrays as wa
from basketry.llm.common import free_name, own_names, tune, with_fields

SAMPLE = 4000
MAX_LINES = 100
THRESHOLD = 0.3
STEPS = 120
RATE = 0.15
PENALTY = 1e-4

# Kinds of bytes.
UPPER, LOWER, DIGIT, SPACE, STOP, SIGN, BANG, BAR, HIGH = range(9)
KINDS = np.full(256, SIGN, np.uint8)
KINDS[ord("A") : ord("Z") + 1] = UPPER
KINDS[ord("a") : ord("z") + 1] = LOWER
KINDS[ord("0") : ord("9") + 1] = DIGIT
KINDS[wa.SPACE] = SPACE
KINDS[[ord(c) for c in ".,;:'\"()-?"]] = STOP
KINDS[ord("!")] = BANG
KINDS[[ord("|"), ord("<"), ord(">"), ord("{"), ord("}"), ord("="), ord("\\"), ord("_")]] = BAR
KINDS[128:] = HIGH

OWN = 15


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of a batch, lines' lengths, and each text's first line.

    A line is a run of bytes between line feeds that holds a word.
    """
    data, offsets = wa.raw(texts)
    if not len(data):
        return np.zeros((0, OWN)), np.zeros(0), np.zeros(len(offsets), np.int64)
    starts, ends, first_word = wa.words(data, offsets)
    feeds = np.concatenate(([0], np.cumsum(data == 10)))
    # A word opens a line if it opens a text or a line feed lies before it.
    opens = np.zeros(len(starts), bool)
    opens[1:] = feeds[starts[1:]] > feeds[ends[:-1]]
    opens[first_word[:-1][np.diff(first_word) > 0]] = True
    at = np.flatnonzero(opens)
    lines = len(at)
    if not lines:
        return np.zeros((0, OWN)), np.zeros(0), np.zeros(len(offsets), np.int64)
    begin, last = starts[at], ends[np.append(at[1:], len(starts)) - 1]
    words = np.diff(np.append(at, len(starts)))
    size = (last - begin).astype(float)
    kinds = KINDS[data]

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return (total[last] - total[begin]).astype(float)

    def per_line(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags.astype(float), at)

    upper, lower, digit = count(kinds == UPPER), count(kinds == LOWER), count(kinds == DIGIT)
    stop, sign, bang, bar = (count(kinds == k) for k in (STOP, SIGN, BANG, BAR))
    hashes = wa.hashes(wa.LOWER[data], starts, ends)
    same = np.zeros(len(starts), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & ~opens[1:]
    odd_end = kinds[ends - 1]
    length = ends - starts
    line_hash = np.add.reduceat(hashes * (np.arange(len(hashes), dtype=np.uint64) - np.repeat(at, words).astype(np.uint64) + wa.SEED), at)
    first_line = np.searchsorted(at, first_word)
    again = np.zeros(lines, bool)
    again[1:] = line_hash[1:] == line_hash[:-1]
    again[first_line[:-1][first_line[:-1] < lines]] = False
    features = np.column_stack(
        [
            np.log1p(size) / 5,
            np.log1p(words) / 3,
            upper / np.maximum(1, upper + lower),
            digit / size,
            stop / size * 5,
            np.minimum(1, sign / words),
            np.minimum(1, bang / words),
            np.minimum(1, bar / words),
            per_line(same) / words,
            per_line((odd_end == SIGN) | (odd_end == BAR) | (odd_end == BANG)) / words,
            np.minimum(2, size / words / 6),
            per_line(length > 20) / words,
            per_line(length < 3) / words,
            np.isin(data[last - 1], [ord("."), ord("!"), ord("?")]).astype(float),
            again.astype(float),
        ]
    )
    return features, size, first_line


def with_neighbours(features: np.ndarray, first_line: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after within a text, and a constant."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    edges = first_line[(first_line > 0) & (first_line < len(features))]
    before[edges] = 0
    after[edges - 1] = 0
    return np.hstack([features, before, after, np.ones((len(features), 1))])


@dataclass(frozen=True)
class ChainModel:
    """Weights of a good line's features and of neighbouring states; the score without lines;
    slope and offset of the quality over the logit of the share of good text."""

    weights: np.ndarray
    pairs: np.ndarray
    base: float
    curve: tuple[float, float] = (1.0, 0.0)

    def marginals(self, features: np.ndarray, first_line: np.ndarray) -> np.ndarray:
        return chain_marginals(features @ self.weights, self.pairs, first_line)[0]


def chain_marginals(gain: np.ndarray, pairs: np.ndarray, first_line: np.ndarray, gold: np.ndarray | None = None):
    """Probability of the good state per line; with ``gold`` also the gradient of ``pairs``.

    Texts run side by side, longest first, so that one step of the recursion serves every
    text that still has lines.
    """
    counts = np.diff(first_line)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    starts, counts = first_line[:-1][order], counts[order]
    out, slope = np.zeros(len(gain)), np.zeros((2, 2))
    if not len(order):
        return out, slope
    # alive[t]: how many texts have a line t.
    alive = len(counts) - np.searchsorted(counts[::-1], np.arange(counts[0]), "right")
    bump = np.exp(pairs - pairs.max())
    ahead = np.zeros((len(gain), 2))
    emit = np.empty((len(gain), 2))
    emit[:, 1] = 1 / (1 + np.exp(-np.clip(gain, -30, 30)))
    emit[:, 0] = 1 - emit[:, 1]
    emit = np.maximum(emit, 1e-12)
    for t in range(counts[0]):
        now = starts[: alive[t]] + t
        value = emit[now] * (ahead[now - 1] @ bump if t else 1.0)
        ahead[now] = value / value.sum(axis=1, keepdims=True)
    back = np.ones((len(gain), 2))
    for t in range(counts[0] - 2, -1, -1):
        now = starts[: alive[t + 1]] + t
        value = (emit[now + 1] * back[now + 1]) @ bump.T
        back[now] = value / value.sum(axis=1, keepdims=True)
    both = ahead * back
    out = both[:, 1] / both.sum(axis=1)
    if gold is not None:
        inner = np.ones(len(gain), bool)
        inner[starts] = False
        here = np.flatnonzero(inner)
        joint = ahead[here - 1][:, :, None] * bump[None] * (emit[here] * back[here])[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        for a in (0, 1):
            for b in (0, 1):
                seen = ((gold[here - 1] == a) & (gold[here] == b)).sum()
                slope[a, b] = seen - joint[:, a, b].sum()
    return out, slope


def train(features: np.ndarray, first_line: np.ndarray, labels: np.ndarray) -> ChainModel:
    """Fit the chain on texts' lines; ``labels`` has one 0 or 1 per text."""
    base = float(labels.mean()) if len(labels) else 0.5
    wide = with_neighbours(features, first_line)
    weights, pairs = np.zeros(wide.shape[1]), np.zeros((2, 2))
    if not len(wide) or labels.min() == labels.max():
        weights[-1] = np.log((base + 0.01) / (1.01 - base))
        return ChainModel(weights, pairs, base)
    gold = np.repeat(labels, np.diff(first_line)).astype(int)
    n = len(wide)
    # Features on one scale while training; the weights are put back to the raw scale after.
    centre, spread = wide.mean(axis=0), np.maximum(wide.std(axis=0), 1e-3)
    centre[-1], spread[-1] = 0, 1
    even = (wide - centre) / spread
    mean, square = np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)
    for step in range(1, STEPS + 1):
        good, slope = chain_marginals(even @ weights, pairs, first_line, gold)
        gradient = np.concatenate(
            [even.T @ (gold - good) / n - PENALTY * weights, slope.ravel() / n - PENALTY * pairs.ravel()]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        weights = weights + move[:-4]
        pairs = pairs + move[-4:].reshape(2, 2)
    weights = weights / spread
    weights[-1] -= (weights[:-1] * centre[:-1]).sum()
    return ChainModel(weights, pairs, base)


def fit_curve(share: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the logit of the share of good text.

    Newton steps with a small penalty; one pseudo-document a class keeps the curve finite
    where the classes do not overlap.
    """
    if not len(labels) or labels.min() == labels.max():
        return 1.0, 0.0
    x = np.column_stack([_logit(share), np.ones(len(share))])
    good = labels.sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (len(labels) - good + 2))
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (target - p) - 1e-3 * at
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(curve, slope)
        at = at + np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    return max(float(at[0]), 0.0), float(at[1])


def _logit(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 1e-4, 1 - 1e-4)
    return np.log(share / (1 - share))


def held_out(doc_id: Column) -> Column:
    """True for documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _train_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        features, size, first = line_features(batch.column(1))
        ranges = list(zip(first[:-1], first[1:]))
        lines = [features[a:b].astype(np.float32).ravel() for a, b in ranges]
        sizes = [size[a:b].astype(np.float32) for a, b in ranges]
        floats = pa.list_(pa.float32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lines, floats), pa.array(sizes, floats)], ["label", "lines", "sizes"]
        )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, max_lines: int = MAX_LINES) -> ChainModel:
    """Train on the labelled documents that are not held out, at most ``sample`` of them.

    Only labels 0 and 1 count; a document with both counts once for each.
    """
    tune(docs.sparkSession)
    marked = own_names(labels, "doc_id", "quality", quality="int").where("quality IN (0, 1) AND doc_id IS NOT NULL")
    chosen = (
        marked.where(~held_out(F.col("doc_id"))).distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    )
    texts = own_names(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", "text")
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1
    rows = (
        texts.where(lines <= max_lines)
        .mapInArrow(_train_rows, "label int, lines array<float>, sizes array<float>")
        .where(F.size("lines") > 0)
        .limit(2 * sample)
        .collect()
    )
    parts = [np.array(r["lines"], np.float64).reshape(-1, OWN) for r in rows]
    first = np.cumsum([0, *map(len, parts)])
    features = np.vstack(parts) if parts else np.zeros((0, OWN))
    marks = np.array([r["label"] for r in rows], float)
    model = train(features, first, marks)
    share = good_share(model, features, np.array([x for r in rows for x in r["sizes"]]), first)
    return replace(model, curve=fit_curve(share, marks))


def good_share(model: ChainModel, features: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Share of each text, by length of lines, that is good; not a number without lines."""
    good = model.marginals(with_neighbours(features, first), first)
    length, total = (np.concatenate(([0.0], np.cumsum(x))) for x in (size, size * good))
    with np.errstate(invalid="ignore"):
        return (total[first[1:]] - total[first[:-1]]) / (length[first[1:]] - length[first[:-1]])


def score_texts(model: ChainModel, texts: pa.Array) -> np.ndarray:
    """Quality of each text."""
    features, size, first = line_features(texts)
    share = good_share(model, features, size, first)
    slope, offset = model.curve
    quality = 1 / (1 + np.exp(-(slope * _logit(share) + offset)))
    return np.where(np.isnan(share), model.base, quality)


def scored(docs: DataFrame, model: ChainModel, name: str = "score") -> DataFrame:
    """``docs`` with the quality of each text in the new column ``name``."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(score_texts(model, batch.column(at)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, score], [*batch.schema.names, name])

    tune(docs.sparkSession)
    return docs.mapInArrow(run, with_fields(docs, [(name, T.DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (``doc_id``, ``held_out``, ``score``, ``predicted``), one per input row."""
    model = fit(docs, labels)
    plain = own_names(docs, "doc_id", "text")
    return scored(plain, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents whose quality is below the threshold."""
    name = free_name(docs, "quality_score")
    return scored(docs, fit(docs, labels), name).where(F.col(f"`{name}`") >= threshold).drop(name)
