"""Each operator against brute force, and on the awkward rows every one must take."""

import os
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import (
    bpe,
    common,
    decontaminate,
    fingerprint,
    language_id,
    near_dup,
    pii,
    quality,
    queries,
    sharding,
    suffix_dedup,
    token_files,
)
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
VOCABULARY = queries.vocabulary_path()

BASE = " ".join(f"word{i % 37} and{i % 11} thing{i}" for i in range(60))
ROWS = [
    (1, BASE),
    (2, BASE + " a few more words at the end"),
    (3, BASE),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (7, "one"),
    (8, "One"),
    (9, "mail me: jane.doe@mail.example.com or +1 (234) 555-0199, card 4111 1111 1111 1111, 10.0.0.1"),
    (10, "é😀 Straße <|endoftext|> don't 12345 …"),
    (11, "x" * 3000 + " " + "y z " * 20000),
    (12, "la casa. " * 40),
    (13, "la casa. " * 39 + "la cosa."),
    (14, "short text of just eight words in it"),
]
KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, words string, block string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1, None, None, None) for i, t in rows], KIND).repartition(3)


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank and long texts, copies, and columns whose names clash."""
    return table(spark, ROWS)


@pytest.fixture(scope="module")
def repeated(spark):
    """Rows that repeat, and rows without an id."""
    return table(spark, ROWS[:3] + [(1, BASE), (None, BASE), (None, "alone here"), (None, None)])


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def corpus(spark):
    """The documents of the small folder."""
    return common.read_table(spark, FOLDER, "documents")


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def got(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


NEAR = ("doc_id", "n_shingles", "component_id", "kept")


@pytest.mark.parametrize("name", ["odd", "corpus"])
def test_near_duplicates(name, request):
    docs = request.getfixturevalue(name)
    assert got(near_dup.near_duplicates(docs), *NEAR) == brute.near_duplicates(texts(docs))


def test_near_duplicates_of_a_large_group(spark):
    """Variants of one text, half of them too far from the smallest id to be linked to it."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            words[rng.randrange(60)] = f"v{rng.randrange(4)}"
        rows.append((i, " ".join(words)))
    small, near_dup.BLOCK = near_dup.BLOCK, 40  # several blocks even here
    try:
        found = got(near_dup.near_duplicates(table(spark, rows)), *NEAR)
    finally:
        near_dup.BLOCK = small
    assert found == brute.near_duplicates(rows)


def test_near_duplicates_of_repeated_rows(repeated, none):
    found = near_dup.near_duplicates(repeated).collect()
    assert sorted((r.doc_id, r.component_id) for r in found if r.doc_id) == [(1, 1), (1, 1), (2, 1), (3, 1)]
    assert sorted(str((r.component_id, r.kept)) for r in found if r.doc_id is None) == [
        "(1, False)", "(None, True)", "(None, True)"
    ]
    assert near_dup.near_duplicates(none).count() == 0
    kept = near_dup.drop_near_duplicates(repeated)
    assert kept.columns == repeated.columns
    assert sorted(str(r.doc_id) for r in kept.collect() if r.doc_id) == ["1"]


def test_estimate_and_packing():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 400, dtype=np.uint64)
    b = np.concatenate([a[:320], rng.integers(0, 2**63, 80, dtype=np.uint64)])
    x, y = (near_dup.packed(near_dup.minima(s)).view(np.uint64) for s in (a, b))
    nibbles = lambda v: (v[:, None] >> np.arange(0, 64, 4, dtype=np.uint64)) & np.uint64(15)
    share = (nibbles(x) == nibbles(y)).mean()
    assert abs(near_dup.similarity(share) - 320 / 480) < 5 * (0.25 / 128) ** 0.5
    assert near_dup.similarity(1.0) == 1


CUT = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("hot", [1000, 0])
def test_repeated_passages(corpus, hot):
    rows = texts(corpus)
    assert got(suffix_dedup.repeated_passages(corpus, stored=True, hot=hot), *CUT) == brute.repeated_passages(rows)


def test_repeated_passages_of_odd_rows(odd, repeated, none):
    # The long text repeats itself within one document, which removes nothing.
    assert got(suffix_dedup.repeated_passages(odd), *CUT) == brute.repeated_passages(texts(odd))
    found = {(r.doc_id, r.n_removed) for r in suffix_dedup.repeated_passages(repeated).collect()}
    size = len(BASE.encode())
    assert found == {(1, 0), (2, size), (3, size), (None, size), (None, 0)}
    assert suffix_dedup.repeated_passages(none).count() == 0


def test_equal_windows_are_classes():
    rng = random.Random(1)
    strings = list({bytes(rng.choice(b"ab") for _ in range(rng.randint(3, 14))) for _ in range(80)})
    owner, offset, group = suffix_dedup.equal_windows(strings, 5)
    classes = {}
    for a, b, c in zip(owner, offset, group):
        classes.setdefault(strings[a][b : b + 5], set()).add(int(c))
    assert all(len(v) == 1 for v in classes.values())
    assert len(set().union(*classes.values())) == len(classes)
    assert len(owner) == sum(max(0, len(s) - 4) for s in strings)


PRINT = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@pytest.mark.parametrize("name", ["odd", "corpus"])
def test_fingerprints(name, request):
    docs = request.getfixturevalue(name)
    assert got(fingerprint.edited_likeness(docs), *PRINT) == brute.fingerprints(texts(docs))


def test_fingerprints_of_repeated_rows(spark, repeated, none):
    found = fingerprint.edited_likeness(repeated).collect()
    assert len(found) == 7
    assert len({r.fingerprint for r in found if r.n_chars == len(BASE)}) == 1
    assert fingerprint.edited_likeness(none).count() == 0
    assert fingerprint.edited_likeness(table(spark, [(1, "a b c d e f")])).first().near_next == 1.0


def test_fingerprint_estimates(spark):
    words = [f"w{i}" for i in range(3000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[1000:])), (3, " ".join(words[:1500])), (4, " ".join(words[1496:]))]
    sketches = table(spark, rows).select("doc_id", fingerprint.sketch(F.col("text")).alias("sketch"))
    s = {r.doc_id: r.sketch for r in sketches.collect()}
    both = spark.createDataFrame([(s[1], s[2])], "a array<bigint>, b array<bigint>")
    r = both.select(
        fingerprint.resemblance(F.col("a"), F.col("b")), fingerprint.containment(F.col("b"), F.col("a")),
        fingerprint.containment(F.col("a"), F.col("b")), fingerprint.distinct_count(F.col("a")),
    ).first()
    assert abs(r[0] - 2 / 3) < 0.2 and r[1] > 0.8 and abs(r[2] - 2 / 3) < 0.2 and abs(r[3] / 2996 - 1) < 0.4
    # Sketches of parts merge into the sketch of the whole.
    parts = sketches.where("doc_id >= 3").withColumn("g", F.lit(1))
    assert fingerprint.merged(parts, ["g"]).first().sketch == s[1]


def expected_tokens(rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    for (i, _), e in zip(rows, library.encode_batch([t or "" for _, t in rows], add_special_tokens=False)):
        yield i, e.ids, library.decode(e.ids, skip_special_tokens=False)


@pytest.mark.parametrize("name", ["odd", "corpus", "repeated"])
def test_bpe(name, request):
    docs = request.getfixturevalue(name)
    want = [(i, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(d)) for i, ids, d in expected_tokens(texts(docs))]
    found = bpe.encode_and_decode(docs, VOCABULARY, stored=name == "corpus").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_bpe_as_columns(odd, none):
    encoded = bpe.encode(odd, VOCABULARY)
    want = list(expected_tokens(texts(odd)))
    assert sorted((r.doc_id, r.ids) for r in encoded.collect()) == sorted((i, ids) for i, ids, _ in want)
    decoded = bpe.decode(encoded, VOCABULARY)
    assert sorted(map(tuple, decoded.collect())) == sorted((i, d) for i, _, d in want)
    assert bpe.encode_and_decode(none, VOCABULARY).count() == 0


def test_bpe_without_stored_blocks(corpus, monkeypatch):
    """Blocks whose borders moved between the scans give the same result."""
    monkeypatch.setattr(bpe, "store_by_block", lambda answers, name: "/nowhere")
    want = {i: len(ids) for i, ids, _ in expected_tokens(texts(corpus))}
    assert {r.doc_id: r.n_tokens for r in bpe.encode_and_decode(corpus, VOCABULARY, stored=True).collect()} == want


def test_packed_ids_look_up_whole_pieces(monkeypatch):
    """Words are looked up once per run of a block, whose size is bounded, and not one by one."""
    texts = [None, "", " a  b ", "\tone\x0btwo\x0cé\r\n", "\x1ca\x1d\x85b \x00", "x" * 300, "one two", "b"]
    blocks = [1, 1, 1, 1, 1, 1, 2, 2]
    rows = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(blocks), pa.array(range(8))], ["t", "b", "i"])
    with open(VOCABULARY, encoding="utf-8") as file:
        words = bpe.WordBpe(file.read())
    want = [b"".join(np.array(words.ids([w])[0], "<u2").tobytes() for w in (t or "").encode().split()) for t in texts]
    calls, of_words = [], bpe._StoredIds.of_words
    monkeypatch.setattr(bpe._StoredIds, "of_words", lambda self, w: calls.append(len(w)) or of_words(self, w))
    # Rows by lookup: all of a block; a long text alone; each alone.
    for piece, lookups in ((1 << 20, 2), (800, 3), (1, 8)):
        monkeypatch.setattr(bpe, "PIECE", piece)
        monkeypatch.setattr(bpe, "PER_WORD", 0)
        calls.clear()
        pieces = bpe._pieces(iter([rows.slice(0, 3), rows.slice(0, 0), rows.slice(3)]), lambda b: bpe._StoredIds("/nowhere", b, words, "H"))
        found = [(i, ids) for t, r in pieces for i, ids in zip(r.column(2).to_pylist(), t.of_texts(r.column(0)).to_pylist())]
        assert found == list(enumerate(want))
        assert len(calls) == lookups


@pytest.mark.parametrize("width", [1, 3, 8, 13, 16, 17, 31, 32])
def test_bit_packing(width):
    for n in (0, 1, 63, 64, 65, 1000):
        ids = np.random.default_rng(n).integers(0, 2**width, n).astype(np.uint32)
        data = token_files.pack_bits(ids, width)
        assert len(data) == -(-n * width // 8)
        assert (token_files.unpack_bits(data, width, n) == ids).all()
        if n > 10:
            assert (token_files.unpack_bits(data, width, n - 9, 9) == ids[9:]).all()


def test_token_file_random_access():
    ids = np.random.default_rng(2).integers(0, 49408, 1000).astype(np.uint32)
    ends = np.array([0, 10, 10, 500, 1000])
    for width in (16, 17):
        out = pa.BufferOutputStream()
        token_files.write_file(out, ids, ends, width, block=64)
        file = token_files.TokenFile(pa.BufferReader(out.getvalue()))
        assert [len(d) for d in file.documents()] == [0, 10, 0, 490, 500]
        assert (np.concatenate(list(file.documents())) == ids).all()
        assert (file.document(3) == ids[10:500]).all() and (file.ids(60, 130) == ids[60:130]).all()


@pytest.mark.parametrize("name", ["odd", "corpus"])
def test_token_files(name, request):
    docs = request.getfixturevalue(name)
    want, start = [], 0
    for i, ids, _ in expected_tokens(sorted(texts(docs))):
        ids = np.array([*ids, 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got(token_files.written_and_read(docs, VOCABULARY), "doc_id", "start", "n_tokens", "ids_crc32") == want


def test_token_files_of_repeated_rows(repeated, none):
    found = token_files.written_and_read(repeated, VOCABULARY).collect()
    assert len(found) == 7
    assert sum(r.n_tokens for r in found) == max(r.start + r.n_tokens for r in found)
    assert token_files.written_and_read(none, VOCABULARY).count() == 0


def check_shards(rows, shards):
    counts = [0] * shards
    for r in rows:
        counts[r.shard] += 1
    assert max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_sharding(corpus, odd, repeated, none):
    for docs in (corpus, odd, repeated):
        found = sharding.shard_documents(docs).collect()
        assert len(found) == docs.count()
        check_shards(found, 24)
    want = {i: (len((t or "").encode()) + 8, brute.crc(t)) for i, t in ROWS}
    assert {r.doc_id: (r.size, r.text_crc32) for r in sharding.shard_documents(odd).collect()} == want
    assert sharding.shard_documents(none).count() == 0


def test_sharding_keeps_groups(spark):
    """A third of all rows in one group, and many small groups that must not be split."""
    rows = [(i, "hot") for i in range(400)] + [(400 + i, f"t{i // 4}") for i in range(400)]
    rows += [(800 + i, f"single {i}") for i in range(400)]
    found = sharding.shard_documents(table(spark, rows), 6).collect()
    check_shards(found, 6)
    shard = {r.doc_id: r.shard for r in found}
    split = sum(len({shard[400 + 4 * g + j] for j in range(4)}) > 1 for g in range(100))
    assert split <= 5
    # 400 rows need two shards of 200; hash placement would use all six.
    assert len({shard[i] for i in range(400)}) <= 4


@pytest.mark.parametrize("name", ["odd", "corpus"])
def test_personal_data(name, request):
    docs = request.getfixturevalue(name)
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    for i, text in texts(docs):
        spans = brute.personal_data(text)
        listed = [f"{k}:{s}:{e}" for s, _, e, k in spans]
        assert found[i].base_sha256 == brute.sha(",".join(listed))
        assert [found[i][f"n_{k}"] for k in brute.PII] == [sum(s[3] == k for s in spans) for k in brute.PII]
        assert set(listed) <= set(found[i].spans.split(","))


def test_personal_data_edges(spark, none, repeated):
    cases = [
        "a@b.c%d@e.f é 😀 x@y.z", "1.2.3.4.5.6.7.8 300.1.1.1 000255.1.1.001", "1 2 3 4 5" * 300, "a" * 3000 + "@x.y",
        "+1 (800) 555-1234 +44 20 7946 0958 +1", "x@y.z@a.b a@b..c 5.5.5.5@6.6.6.6", "4111-1111-1111-1112",
    ]
    docs = table(spark, list(enumerate(cases)))
    for r in pii.find(docs).collect():
        listed = [f"{k}:{s}:{e}" for s, _, e, k in brute.personal_data(cases[r.doc_id])]
        assert r.base_sha256 == brute.sha(",".join(listed)), cases[r.doc_id]
    assert pii.find(none).count() == 0
    assert pii.find(repeated).count() == 7
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[0] == "[EMAIL][EMAIL] é 😀 [EMAIL]" and clean[4] == "[PHONE] [PHONE] +1"
    assert pii.redact(docs).columns == docs.columns


def test_labelers_are_weighed():
    """A labeler that agrees with the others gets a better rate than one that guesses."""
    rng = random.Random(5)
    patterns = {}
    for _ in range(4000):
        true = rng.random() < 0.5
        votes = tuple(int(true if rng.random() < p else not true) for p in (0.95, 0.9, 0.85, 0.5))
        patterns[votes] = patterns.get(votes, 0) + 1
    posterior, rates, prior = pii._em(patterns)
    assert posterior[1, 1, 1, 1] > 0.95 and posterior[0, 0, 0, 0] < 0.05 and abs(prior - 0.5) < 0.1
    assert rates[0][0] > 0.9 and abs(rates[3][0] - rates[3][1]) < 0.1


def test_contamination(spark, corpus, odd, none):
    items = [(1, " ".join(BASE.split()[10:40])), (2, "EIGHT words"), (3, None), (4, "--"), (5, BASE), (6, "straße")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for per_part in (decontaminate.PATTERNS, 7):
        found = decontaminate.scan(odd, bench, per_part=per_part)
        want = brute.contamination(texts(odd), items)
        assert got(found, "doc_id", "n_words", "n_hit") == sorted(w[:3] for w in want)
        for r in found.collect():  # places in the original text
            for h in r.hits:
                assert " ".join(w.decode() for w in decontaminate.normal_words(r.text[h.start : h.end])) == h.pattern.encode(
                    "latin-1"
                ).decode()
    assert got(decontaminate.contamination(odd, bench), "*") == sorted(want)
    clean = decontaminate.drop_contaminated(odd, bench)
    assert clean.columns == odd.columns
    assert {r.doc_id for r in clean.collect()} == {w[0] for w in want if not w[-1]}
    assert decontaminate.contamination(none, bench).count() == 0
    assert not decontaminate.contamination(odd, bench.limit(0)).where("contaminated").count()


@pytest.mark.parametrize("per_part", [decontaminate.PATTERNS, 7])
def test_contaminated_rows_go_one_by_one(spark, monkeypatch, per_part):
    """A row without an id, or with a repeated one, goes for its own text only, by any number of parts."""
    monkeypatch.setattr(decontaminate, "PATTERNS", per_part)
    bench = spark.createDataFrame([(1, BASE), (2, "eight words")], "item_id bigint, text string")
    rows = [(None, BASE), (None, "clean"), (None, None), (7, "x eight words y"), (7, "clean too"), (7, "clean too"), (8, BASE)]
    clean = decontaminate.drop_contaminated(table(spark, rows), bench)
    assert sorted(texts(clean), key=repr) == sorted([rows[1], rows[2], rows[4], rows[5]], key=repr)


def test_language(spark, corpus, odd, none):
    found = language_id.languages(corpus).join(corpus.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95
    model = language_id.fit(corpus)
    by = {r.doc_id: r for r in language_id.predict(odd, model).collect()}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (4, 5, 6))
    assert all(0 <= r.score <= 1 for r in by.values())
    assert language_id.languages(none).count() == 0
    unlabelled = corpus.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.languages(unlabelled).select("lang_pred").distinct().collect()} == {"und"}


def test_language_backs_off():
    rows = np.log(np.array([[0.9, 0.1], [0.1, 0.9]], np.float32))
    model = language_id.LanguageModel(["aa", "bb"], {"known": 0}, rows[:1], {"ab": 0, "z": 1}, rows)
    assert model.backoff("xaby") == [0] and model.backoff("z") == [1] and model.backoff("q") == []


def expected_language(model, text):
    """Sums per language, by a model in memory."""
    total = np.zeros(len(model.languages))
    for word in language_id.words_of(text):
        if word in model.words:
            total += model.word_rows[model.words[word]]
        elif rows := model.backoff(word):
            total += model.gram_rows[rows].mean(axis=0)
    return total


def test_language_joins_are_the_rule(spark, corpus, odd, monkeypatch):
    """Tables joined by blocks against the same counts in memory, also for unseen words."""
    monkeypatch.setattr(language_id, "BLOCK", 5000)
    tables = language_id.fit(corpus.where("doc_id % 9 = 0"))
    names, parts = tables.languages, []
    for counts in (tables.words, tables.grams):
        held = {}
        for r in counts.collect():
            held.setdefault(r["item"], {})[r["lang"]] = r["n"]
        size = [sum(h.get(x, 0) + language_id.SMOOTH * (x in h) for h in held.values()) for x in names]
        rows = np.log([(np.array([h.get(x, 0) for x in names]) + language_id.SMOOTH) / size for h in held.values()])
        parts += [{w: i for i, w in enumerate(held)}, rows]
    model = language_id.LanguageModel(names, *parts)
    for docs in (corpus, odd):
        got = {r.doc_id: r for r in language_id.predict(docs, tables).collect()}
        want = [(r.doc_id, expected_language(model, r.text), language_id.words_of(r.text)) for r in docs.collect()]
        assert len(got) == len(want)
        for doc, sums, words in want:
            share = np.exp(sums - sums.max())
            best = names[int(np.argmax(np.round(sums, 6)))] if words else "und"
            assert got[doc].lang_pred == best
            assert abs(got[doc].score - (1 / share.sum() if words else 0)) < 1e-6


def test_language_keeps_words_of_rare_languages(spark):
    """More words than 100,000 and more n-grams than 50,000 of one language cut nothing of another."""
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(101_000)})
    rng.shuffle(words)
    rare, common_words = words[:60], words[60:]
    learned = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    rows = [(learned[k], " ".join(common_words[k::100] * 2), "aa") for k in range(100)]
    rows.append((learned[100], " ".join(rare), "zz"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    asked = spark.createDataFrame([(1000, " ".join(rare[::-1]))], "doc_id bigint, text string")
    found = language_id.predict(asked, language_id.fit(docs)).first()
    assert found.lang_pred == "zz" and found.score > 0.99


def test_quality(spark, corpus, odd, none):
    labels = common.read_table(spark, "/root/testdata/sf0.01", "labels")
    docs = common.read_table(spark, "/root/testdata/sf0.01", "documents")
    found = quality.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in found]) > 0.95
    assert all(r.predicted == 1 for r in found if r.quality == 1)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    scores = {r.doc_id: r.score for r in quality.quality(odd, labels).collect()}
    assert len(scores) == len(ROWS) and len({scores[i] for i in (4, 5, 6)}) == 1
    assert {r.score for r in quality.quality(odd, labels.limit(0)).collect()} <= {0.5, *scores.values()}
    assert quality.quality(none, labels).count() == 0
    assert quality.drop_low_quality(odd, labels).columns == odd.columns


def test_chain_marginals_are_exact():
    """Forward-backward against the sum over all labellings."""
    rng = np.random.default_rng(4)
    gain, pairs = rng.normal(size=7), rng.normal(size=(2, 2))
    first = np.array([0, 4, 4, 7])
    found, _ = quality.chain_marginals(gain, pairs, first)
    for a, b in ((0, 4), (4, 7)):
        n = b - a
        total, good = 0.0, np.zeros(n)
        for code in range(2**n):
            y = [(code >> k) & 1 for k in range(n)]
            w = np.exp(sum(gain[a + k] * y[k] for k in range(n)) + sum(pairs[y[k], y[k + 1]] for k in range(n - 1)))
            total += w
            good += w * np.array(y)
        assert np.allclose(found[a:b], good / total)


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 160)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = {r.node: r.root for r in common.connected(df).collect()}
    assert found == {x: r for x, r in root.items() if x in found}
    assert all(root[x] == x and not any(x in e and e[0] != e[1] for e in edges) for x in root if x not in found)
    assert common.connected(df.limit(0)).count() == 0


def test_distributed_rank(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 3))
    ranked = common.distributed_rank(df, ["k"], F.xxhash64("id"), 1000, per_bucket=50).collect()
    for k in (None, 1, 2):
        own = sorted(r._rank for r in ranked if r.k == k)
        assert own == list(range(len(own)))
    assert len(ranked) == 1000


def test_pipeline_stages(spark):
    """Every stage keeps the columns, works on what the one before kept, and has effect."""
    docs = start = common.read_table(spark, FOLDER, "documents")
    bench = [(r.item_id, r.text) for r in common.read_table(spark, FOLDER, "benchmark").collect()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = docs
        docs = common.materialise(stage(spark, before, FOLDER), "stage")
        assert docs.columns == start.columns
        rows = dict(texts(before))
        left = dict(texts(docs))
        if name == "near_dup":
            assert set(left) == {r[0] for r in brute.near_duplicates(rows.items()) if r[3]}
        elif name == "decontaminate":
            assert set(left) == {r[0] for r in brute.contamination(rows.items(), bench) if not r[-1]}
        elif name == "pii":
            assert set(left) == set(rows) and not any(brute.personal_data(t) for t in left.values())
            assert sum(left[i] != rows[i] for i in rows) >= sum(bool(brute.personal_data(t)) for t in rows.values())
        else:
            assert 0 < len(left) < len(rows)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    want = {i: brute.sha(" ".join(map(str, ids))) for i, ids, _ in expected_tokens(texts(docs))}
    assert {r.doc_id: r.ids_sha256 for r in last.collect()} == want


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    from workload.compare import compare, connect

    assert compare(spark, connect(FOLDER), name, FOLDER) is None


def test_oracle_engine_reads_the_folder():
    assert os.path.isdir(FOLDER) and duckdb.connect().execute(f"SELECT count(*) FROM '{FOLDER}/documents.parquet'").fetchone()[0]


def test_blocks_of_a_token_file_are_packed_as_they_are_written(monkeypatch):
    """No block waits for the others in memory, and a file stands for 32 MB of text at most."""
    events, packing = [], token_files.pack_bits

    class Out:
        def write(self, data):
            events.append(len(data))

    monkeypatch.setattr(token_files, "pack_bits", lambda *a: events.append("pack") or packing(*a))
    token_files.write_file(Out(), np.arange(300, dtype=np.uint32), np.array([300]), 13, block=64)
    full = -(-64 * 13 // 8)
    assert events[3:] == ["pack", full] * 4 + ["pack", -(-44 * 13 // 8)]
    assert token_files.FILE_BYTES <= 32 << 20


def test_language_blocks_are_not_shuffled(spark, corpus):
    """The last step is a scan of the blocks that looks its answers up."""
    plan = language_id.languages(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan


def test_language_words_and_places_are_packed():
    """A block's words are one packed text, and a bucket's places small steps."""
    rng = np.random.default_rng(5)
    words = list(dict.fromkeys("".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(1, 9, 30_000)))
    docs = pa.table({"doc_id": [1, 2, 3], "text": [" ".join(words[:9]), None, " ".join(words)], "lang": ["en", None, None]})
    (block,) = language_id._bags(iter(docs.to_batches()))
    assert block.schema.names == ["doc_ids", "langs", "sizes", "width", "words", "bag"]
    assert block.column(3).to_pylist() == [len(words)]
    assert language_id._unpack_words(block.column(4)[0].as_py()) == words
    assert sum(c.nbytes for c in (block.column(4), block.column(5))) < 0.8 * sum(map(len, words)) + len(words)
    asked = pa.RecordBatch.from_arrays([pa.array([7], pa.int64()), block.column(4)], ["block", "words"])
    (found,) = language_id._questions(4)(iter([asked]))
    # A place as a number of its own, in the order of the words, takes two bytes and more.
    assert sum(len(at.as_py()) for at in found.column(2)) < len(words)
    got = {}
    for at, own in zip(found.column(2), found.column(3)):
        got |= zip(language_id._unpack_places(at.as_py()).tolist(), language_id._unpack_words(own.as_py()))
    assert [got[i] for i in range(len(words))] == words
    assert language_id._unpack_words(language_id._pack_words([])) == []


def test_language_bags_give_back_what_was_packed():
    sizes = [2, 0, 3, 0]
    blob = language_id._to_bag([5, 1, 7, 0, 9], [1, 2, 3, 4, 70_000], sizes)
    at, counts = language_id._from_bag(blob, np.array(sizes))
    assert at.tolist() == [1, 5, 0, 7, 9] and counts.tolist() == [2, 1, 4, 3, 70_000]
