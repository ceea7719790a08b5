"""Repeated passages: what a task holds at once, and which anchors are dealt window by window."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import suffix_dedup
from basketry.llm.blocks import unpack

LENGTH = suffix_dedup.LENGTH


def noise(rng: random.Random, n: int) -> str:
    return "".join(rng.choices("abcdefgh ", k=n))


def scan(rows: list[tuple]) -> pa.RecordBatch:
    ids, texts = zip(*rows)
    kinds = pa.int64(), pa.string(), pa.int64()
    columns = [pa.array(c, k) for c, k in zip((ids, texts, [0] * len(ids)), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "block"])


@pytest.fixture
def all_shared(monkeypatch):
    """Every anchor counts as shared."""
    monkeypatch.setattr(suffix_dedup, "_flags", lambda chunk, *_: np.ones(len(chunk.hash), np.uint8))


def test_a_bucket_takes_memory_by_parts(all_shared):
    """Strings of 4 MB in one bucket; sorted at once they take some 85 times as much."""
    rng = random.Random(3)
    batch = scan([(i, noise(rng, 10_000)) for i in range(100)])
    asked = list(suffix_dedup._ask_strings("", 1, 1)(iter([batch])))
    tracemalloc.start()
    try:
        answered = sum(b.num_rows for b in suffix_dedup._answer_strings(iter(asked)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert answered == 1 and peak < 110 << 20


@pytest.mark.parametrize("together", [1, 20_000, 1 << 30])
def test_answers_of_parts_are_those_of_the_whole(all_shared, monkeypatch, together):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    rng = random.Random(4)
    shared = noise(rng, 3000)
    texts = [noise(rng, rng.randint(0, 900)) + shared[(a := rng.randint(0, 2900)) : a + rng.randint(0, 400)] for _ in range(60)]
    rows = [(rng.choice([None, *range(40)]), t) for t in texts]
    order = lambda i: suffix_dedup.LAST if i is None else i
    least = {}
    for i, t in rows:
        for k in range(len(t) - LENGTH + 1):
            window = t[k : k + LENGTH].encode()
            least[window] = min(least.get(window, order(i)), order(i))
    asked = list(suffix_dedup._ask_strings("", 1, 1)(iter([scan(rows)])))
    (reply,) = pa.Table.from_batches(suffix_dedup._answer_strings(iter(asked))).to_pylist()
    (chunk,) = suffix_dedup.chunks(iter([scan(rows)]))
    found = chunk.strings(np.ones(len(chunk.hash), np.uint8), 1)
    ((_, members),) = found.by_bucket()
    want = [
        least[found.texts[k][j : j + LENGTH]] < found.least[k]
        for k in members.tolist()
        for j in range(len(found.texts[k]) - LENGTH + 1)
    ]
    got = np.unpackbits(np.frombuffer(unpack(reply["answer"]), np.uint8))[: len(want)].astype(bool).tolist()
    assert 0 < sum(want) < len(want) and got == want


def test_an_anchor_of_many_runs_in_one_chunk_is_hot():
    """All rows lie in one chunk, so the chunks that hold an anchor say nothing about its strings."""
    rng = random.Random(5)
    phrase = noise(rng, LENGTH)
    rows = [(i, noise(rng, 60) + phrase + noise(rng, 60)) for i in range(50)]
    batch = scan(rows)
    (chunk,) = suffix_dedup.chunks(iter([batch]))
    asked = list(suffix_dedup._ask_anchors(1)(iter([batch])))
    answers = {}
    for hot in (49, 50):
        (reply,) = pa.Table.from_batches(suffix_dedup._answer_anchors(hot)(iter(asked))).to_pylist()
        answers[hot] = np.bincount(np.frombuffer(unpack(reply["answer"]), np.uint8), minlength=3).tolist()
    runs = np.unique(chunk.hash >> np.uint64(32), return_counts=True)[1]
    assert answers[49][2] == (runs > 49).sum() > 0
    assert answers[50][2] == (runs > 50).sum()
