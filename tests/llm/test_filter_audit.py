"""Filter audit: masks, retraction over micro-batches in any order of ids, and all orders."""

import os
import random
from collections import Counter, defaultdict
from itertools import permutations

import pyarrow as pa
import pytest

from basketry.llm import common, filter_audit, queries
from workload.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
KIND = "doc_id bigint, text string, source string, mask string, key string, KEPT string"
LABELS = "doc_id bigint, quality int, toxic int, source string"


def mask_of(text):
    words = [w for w in (text or "").encode().split()]
    text = text or ""
    fails = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
        any(c in "#$%&*|" for c in text),
    )
    return sum(f << k for k, f in enumerate(fails))


def counters_by_definition(docs, labels):
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = Counter()
    for i, text, source in docs:
        again = i is not None and i > least[text or ""]
        out[source or "", mask_of(text) | 16 * again, i in good, i in toxic] += 1
    return out


def report_by_definition(docs, labels):
    parts = defaultdict(list)
    for (part, *key), n in counters_by_definition(docs, labels).items():
        parts[part].append((*key, n))
    out = []
    for part, rows in parts.items():
        removed_by = Counter()
        lines = []
        for order in permutations("ABCDE"):
            prior = 0
            for step, name in enumerate(order, 1):
                bit = 1 << "ABCDE".index(name)
                total = lambda f: sum(n for m, g, t, n in rows if f(m, g, t))  # noqa: E731, B023
                removed = total(lambda m, g, t: m & bit and not m & prior)
                removed_by[name] += removed
                lines.append((
                    part, "".join(order), step, name,
                    total(lambda m, g, t: not m & (bit | prior)), removed,
                    total(lambda m, g, t: m & bit and m & prior), total(lambda m, g, t: m == bit),
                    total(lambda m, g, t: g and m & bit and not m & prior),
                    total(lambda m, g, t: t and m & bit and not m & prior),
                ))
                prior |= bit
        out += [(p, o, s, *rest, removed_by[name]) for p, o, s, name, *rest in lines]
    return sorted(out)


def counted(df):
    return {(r["part"], r["mask"], r["good"], r["toxic"]): r["n"] for r in df.collect()}


def label_table(spark, labels):
    return spark.createDataFrame([(*r, "x") for r in labels], LABELS)


def odd_docs():
    rng = random.Random(8)
    long = " ".join(f"word{i}" for i in range(250))
    texts = [long, long + " #", "A B " * 150, "x y " * 200, None, "", "tiny", "é" * 10, long.upper()]
    docs = [(i, rng.choice(texts), rng.choice(["s", "t", None, ""])) for i in rng.sample(range(1000), 150)]
    docs += [(docs[0][0], docs[0][1], "s")] * 3 + [(docs[1][0], "other", "t"), (None, long, "s"), (None, None, None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 1000, 2)]
    labels += [(labels[0][0], 1, 1), (None, 1, 1), (5000, 1, 1)]
    return docs, labels


def written(spark, docs, files, name="docs"):
    """One file per list of rows, read in that order."""
    folder = common.work_dir(spark, name)
    for k, rows in enumerate(files):
        spark.createDataFrame([(*r, "m", "k", "u") for r in rows], KIND).coalesce(1).write.mode("append").parquet(folder)
    return folder


def test_masks_at_the_limits():
    texts = [
        " ".join(f"w{i}" for i in range(199)), " ".join(f"w{i}" for i in range(200)), "a b a b", "a a b",
        "A" + "x" * 49, "AB" + "x" * 49, "É" * 30, "|", "a\x1cb " * 3, None, "", "  x",
    ]
    assert filter_audit.masks(pa.array(texts)).tolist() == [mask_of(t) for t in texts]


@pytest.mark.parametrize("order", ["rising", "falling", "mixed"])
def test_smaller_ids_that_arrive_later(spark, order):
    docs, labels = odd_docs()
    rows = sorted(docs, key=lambda r: (r[0] is None, r[0]), reverse=order == "falling")
    if order == "mixed":
        random.Random(4).shuffle(rows)
    folder = written(spark, docs, [rows[i : i + 40] for i in range(0, len(rows), 40)])
    state = common.work_dir(spark, "audit")
    filter_audit.start_audit(spark, folder, label_table(spark, labels), state, 1).awaitTermination()
    batches = spark.read.parquet(f"{state}/counters")
    assert batches.where("batch >= 0").select("batch").distinct().count() == 4
    assert counted(filter_audit.counters(spark, state)) == dict(counters_by_definition(docs, labels))
    if order == "falling":
        assert batches.where("n < 0").count(), "earlier masks are retracted"


def test_goes_on_with_files_that_came_since(spark):
    docs, labels = odd_docs()
    folder, state = written(spark, docs, [docs[:70]]), common.work_dir(spark, "audit")
    known = label_table(spark, labels)
    filter_audit.start_audit(spark, folder, known, state, 5).awaitTermination()
    assert counted(filter_audit.counters(spark, state)) == dict(counters_by_definition(docs[:70], labels))
    spark.createDataFrame([(*r, "m", "k", "u") for r in docs[70:]], KIND).write.mode("append").parquet(folder)
    filter_audit.start_audit(spark, folder, known, state, 5).awaitTermination()
    assert counted(filter_audit.counters(spark, state)) == dict(counters_by_definition(docs, labels))


def test_report_of_odd_rows(spark):
    docs, labels = odd_docs()
    folder = written(spark, docs, [docs[:50], docs[50:100], docs[100:]])
    found = filter_audit.audit(spark, folder, label_table(spark, labels), batches=3)
    assert sorted(tuple(r) for r in found.collect()) == report_by_definition(docs, labels)
    assert found.count() == 600 * 3


def test_a_lone_file_and_an_empty_table(spark):
    docs, labels = odd_docs()
    known = label_table(spark, labels)
    folder = written(spark, docs, [docs])
    file = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    found = filter_audit.audit(spark, f"{folder}/{file}", known)
    assert sorted(tuple(r) for r in found.collect()) == report_by_definition(docs, labels)
    assert filter_audit.audit(spark, written(spark, [], [[]]), known).count() == 0


def test_settings_come_back(spark):
    before = {k: spark.conf.get(k, None) for k in filter_audit.SETTINGS}
    with filter_audit._settings(spark):
        pass
    assert {k: spark.conf.get(k, None) for k in filter_audit.SETTINGS} == before


def test_query_against_sql(spark):
    assert compare(spark, connect(FOLDER), "op11_filter_audit", FOLDER) is None
    assert "op11_filter_audit" in queries.ORACLES
