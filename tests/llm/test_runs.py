"""Runs: Lyndon arrays, runs and collapsed texts against their definitions."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from basketry.llm import common, periodic_runs, queries
from basketry.llm.periodic_runs import _batch, find_runs, lyndon_array

FOLDER = "/root/testdata/sf0.001"


def lyndon_by_definition(s):
    """From i up to the next position whose suffix is smaller."""
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[i:] < s[j:]:
            j += 1
        out.append(j - i)
    return out


def runs_by_definition(w, least=12, repeats=2):
    out = []
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, repeats * q):
                own = w[i : i + size]
                if not any(own[r:] == own[:-r] for r in range(1, q)):
                    out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


def collapsed_by_definition(w, runs):
    gone = {i for start, size, q in runs for i in range(start + q, start + size)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic(doc_id, w):
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def report(doc_id, text):
    w = [x.decode() for x in (text or "").encode().split()]
    w = periodic(doc_id, w)
    runs = runs_by_definition(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(collapsed_by_definition(w, runs).encode()).hexdigest(),
    )


def random_words(rng, most=80):
    n, kinds = rng.randrange(most), rng.choice([1, 2, 3, 5, 50])
    s = [rng.randrange(kinds) for _ in range(n)]
    if n and rng.random() < 0.6:
        a, p = rng.randrange(n), 1 + rng.randrange(8)
        s = s[:a] + [s[min(a + (i - a) % p, n - 1)] for i in range(a, n)]
    return s


def test_lyndon_array_by_both_orders():
    rng = random.Random(1)
    for _ in range(400):
        s = random_words(rng, 50)
        assert lyndon_array(s) == lyndon_by_definition(s)
        assert lyndon_array([-x for x in s]) == lyndon_by_definition([-x for x in s])


@pytest.mark.parametrize("least,repeats", [(12, 2), (1, 2), (6, 3)])
def test_runs_of_stretches_laid_together(least, repeats):
    rng = random.Random(2)
    for _ in range(60):
        parts = [p for p in (random_words(rng) for _ in range(6)) if p]
        firsts = np.cumsum([0, *map(len, parts)])[:-1]
        found = sorted(zip(*[c.tolist() for c in find_runs(np.array(sum(parts, [])), firsts, least, repeats)]))
        want = [(s + f, n, q) for p, f in zip(parts, firsts.tolist()) for s, n, q in runs_by_definition(p, least, repeats)]
        assert found == want


def test_thue_morse_and_fibonacci():
    """Words that defeat polynomial hashes, and words of very many nested runs."""
    thue = [bin(i).count("1") % 2 for i in range(2048)]
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    for s in (thue[:700], b):
        found = find_runs(np.array(s), np.array([0]), 12, 2)
        assert sorted(zip(*[c.tolist() for c in found])) == runs_by_definition(s)
    assert lyndon_array(thue) == lyndon_by_definition(thue)


def test_batches_with_blank_and_null_texts():
    rng = random.Random(3)
    for _ in range(40):
        docs = [[f"w{x}" for x in random_words(rng)] for _ in range(20)]
        texts = [" \t".join(d) for d in docs] + [None, "", " \n\x0b ", "é é " * 20, "x"]
        runs, collapsed = _batch(pa.array(texts), 12, 2)
        for text, own, short in zip(texts, runs.to_pylist(), collapsed.to_pylist()):
            w = [x.decode() for x in (text or "").encode().split()]
            want = runs_by_definition(w)
            assert [tuple(r.values()) for r in own] == want
            assert short == collapsed_by_definition(w, want)


def test_long_text_of_one_word_and_of_one_period():
    n = 30_000
    runs, collapsed = _batch(pa.array(["a " * n, " ".join(f"w{i % 1000}" for i in range(n))]), 12, 2)
    assert [[tuple(r.values()) for r in own] for own in runs.to_pylist()] == [[(0, n, 1)], [(0, n, 1000)]]
    assert collapsed.to_pylist() == ["a", " ".join(f"w{i}" for i in range(1000))]


KIND = "doc_id bigint, text string, RUNS_ string, n_runs string, words string"


def odd_rows():
    line = "one two three four. "
    rows = [(i, line * (i % 7) + f"tail {i}") for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n "), (103, "x"), (None, line * 9), (None, None)]
    rows += [(7, line * 30), (7, line * 30), (7, None), (104, "é ü " * 5000)]
    return rows


def test_report_on_odd_rows(spark):
    df = spark.createDataFrame([(i, t, "r", "n", "w") for i, t in odd_rows()], KIND).repartition(4)
    found = [tuple(r) for r in periodic_runs.runs_report(df).collect()]
    assert sorted(found, key=repr) == sorted([report(i, t) for i, t in odd_rows()], key=repr)
    assert periodic_runs.runs_report(df.limit(0)).count() == 0


def test_add_runs_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a b " * 10, "r", "n", "w")], KIND)
    row = periodic_runs.add_runs(df).first()
    assert row["RUNS_"] == "r" and [tuple(r) for r in row["runs"]] == [(0, 20, 2)] and row["collapsed"] == "a b"
    with pytest.raises(ValueError):
        periodic_runs.add_runs(df.withColumnRenamed("RUNS_", "Runs"))


def test_query_against_definition(spark):
    docs = common.read_table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    found = sorted(tuple(r) for r in queries.QUERIES["op13_runs"](spark, FOLDER).collect())
    assert found == sorted(report(i, t) for i, t in docs)
    assert sum(r[1] for r in found) > 10
