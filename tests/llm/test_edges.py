"""Rows every operator and stage must take: none, null, empty, repeated, long, clashing names."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import decontaminate, language_id, near_dup, pii, suffix_dedup, token_files
from basketry.session import materialise, work_dir
from tests.llm.test_operators import BASE, VOCABULARY

FOLDER = "/root/testdata/sf0.001"
KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint, TEXT_ string, score double, kept string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, "x", 0.5, "k") for i, t in rows], KIND)


def folder_with(spark, documents):
    """A data folder with these documents and the other tables of the small one."""
    base = work_dir(spark, "folder")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{base}/{name}.parquet")
    documents.write.parquet(f"{base}/documents.parquet")
    return base


def test_pipeline_without_documents(spark):
    assert corpus_pipeline.run(spark, folder_with(spark, frame(spark, []))).count() == 0


def test_pipeline_on_null_ids_and_clashing_columns(spark):
    good = spark.read.parquet(f"{FOLDER}/documents.parquet").join(
        spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1 AND toxic = 0"), "doc_id"
    ).limit(6).collect()
    rows = [(r["doc_id"], r["text"]) for r in good[:3]] + [(None, good[3]["text"]), (good[4]["doc_id"], good[4]["text"])] * 2
    rows += [(None, None), (7_000, None), (7_001, "")]
    found = corpus_pipeline.run(spark, folder_with(spark, frame(spark, rows))).collect()
    ids = [r["doc_id"] for r in found]
    assert {i for i in ids if i is not None} <= {i for i, _ in rows}
    assert ids.count(good[4]["doc_id"]) <= 1, "rows that repeat an id and a text stay once"


def test_redact_keeps_rows_and_columns(spark):
    mail = "write to jane.doe@mail.example.com now"
    rows = [(1, mail), (1, mail), (None, mail), (2, None), (3, ""), (4, "nothing here")]
    out = pii.redact(frame(spark, rows))
    assert out.columns == frame(spark, []).columns
    found = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    assert len(found) == len(rows)
    assert {t for i, t in found if i in (2, 3, 4)} == {None, "", "nothing here"}
    assert all("jane.doe" not in (t or "") for _, t in found)
    assert pii.redact(frame(spark, [])).count() == 0


def test_filters_on_an_empty_table(spark):
    bench = spark.createDataFrame([(1, BASE)], "item_id bigint, text string")
    none = frame(spark, [])
    for out in (near_dup.drop_near_duplicates(none), decontaminate.drop_contaminated(none, bench)):
        assert out.count() == 0 and out.columns == none.columns


def test_near_copies_go_whatever_their_ids(spark):
    """A kept id that another row repeats stays with its other text; null ids yield to real ones."""
    other = " ".join(f"other{i}" for i in range(60))
    rows = [(5, BASE), (6, BASE), (5, other), (None, BASE), (7, other), (8, None)]
    found = {(r["doc_id"], r["text"]) for r in near_dup.drop_near_duplicates(frame(spark, rows)).collect()}
    assert found == {(5, BASE), (5, other), (8, None)}


def test_token_file_of_a_document_longer_than_a_block(spark):
    """One document of more ids than a block holds, between two short ones."""
    words = [f"w{i % 977}" for i in range(90_000)]
    rows = [(1, "short"), (2, " ".join(words)), (3, "also short")]
    docs = materialise(frame(spark, rows), "docs")
    found = {r["doc_id"]: r for r in token_files.written_and_read(docs, VOCABULARY, stored=True).collect()}
    assert found[2]["n_tokens"] > token_files.BLOCK
    from tokenizers import Tokenizer

    library, start = Tokenizer.from_file(VOCABULARY), 0
    for i, text in rows:
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        got = found[i]
        assert (got["start"], got["n_tokens"]) == (start, len(ids))
        assert got["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


@pytest.mark.parametrize("words_per_bucket", [7, 10**6])
def test_language_ties_and_repeated_rows(spark, monkeypatch, words_per_bucket):
    """Both languages have the same words: the first by name wins, with half of the score."""
    monkeypatch.setattr(language_id, "BUCKET_WORDS", words_per_bucket)
    learned = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5][:2]
    text = "the very same words in both"
    docs = spark.createDataFrame([(learned[0], text, "bb"), (learned[1], text, "aa")], "doc_id bigint, text string, lang string")
    asked = frame(spark, [(1, "same words"), (1, "same words"), (None, "both zzz"), (2, "123"), (3, None)])
    found = language_id.predict(asked, language_id.fit(docs)).select("doc_id", "lang_pred", F.round("score", 6)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [(1, "aa", 0.5), (1, "aa", 0.5), (None, "aa", 0.5), (2, "und", 0.0), (3, "und", 0.0)], key=repr
    )


def test_common_prefixes_come_level_by_level():
    """Values against the suffixes themselves, for every limit; rows below it only where marks part them."""
    rng = np.random.default_rng(9)
    for _ in range(60):
        parts = [rng.integers(1, 4, rng.integers(1, 25)) for _ in range(rng.integers(1, 6))]
        symbols = np.concatenate([np.append(p, 0) for p in parts]).astype(np.uint16)
        n = len(symbols)
        order, place = suffix_dedup.suffix_order(symbols, n)
        rows = [symbols[i:].tolist() for i in order]
        assert rows == sorted(rows) and (place[order] == np.arange(n)).all()
        shared = [0] + [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a)) for a, b in zip(rows, rows[1:])]
        for limit in (1, 2, 3, 7, n):
            found = suffix_dedup.common_prefixes(symbols, order, place, limit)
            for i in range(1, n):
                marked = 0 in rows[i - 1][: shared[i] + 1]
                assert found[i] == (shared[i] if shared[i] < limit and not marked else -1)


def test_windows_of_long_texts_across_pieces(spark):
    """A text of several pieces that repeats passages of another one over the borders between them."""
    rng = random.Random(6)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, tail = noise(3000), noise(400)
    first = noise(65_536 - 1500) + passage + noise(65_536) + tail
    second = noise(65_536 * 2 - 1500) + passage + noise(1000) + tail[:49] + "Z" + tail[60:110]
    rows = [(1, first), (2, second), (3, tail[100:149]), (4, tail[100:150])]
    docs = materialise(frame(spark, rows), "docs")
    found = {r["doc_id"]: r for r in suffix_dedup.repeated_passages(docs, stored=True).collect()}
    met, want = set(), {}
    for i, text in rows:
        gone = {k + j for k in range(len(text) - 49) if text[k : k + 50] in met for j in range(50)}
        want[i] = len(gone), sum(k - 1 not in gone for k in gone)
        met |= {text[k : k + 50] for k in range(len(text) - 49)}
    assert want[2][0] >= 3050 and want[4] == (50, 1)
    assert {i: (r["n_removed"], r["n_spans"]) for i, r in found.items()} == want
