"""Language identification: known words first, then shorter and shorter character n-grams.

A word is a longest run of letters, in lower case. The model holds, per language, the log
frequency of every word and of every character n-gram (1 to 4 characters, with a mark at both
ends of a word) of the documents that may be learned from. A known word adds its log
frequencies. For an unseen one the longest n-grams are tried first: those of 4 characters that
are known add the mean of their log frequencies; if none is, those of 3 are tried, and so on.
The language of the largest sum wins; the score is its share after a softmax over the languages.

The model is two written tables that grow with the vocabulary, and no task or driver holds one:

1. Documents are packed into blocks of about ``BLOCK`` characters: the distinct words of a block
   as one packed text, in order of appearance, and per document the places of its words in them and how often each occurs. Training counts the
   blocks too, so texts are cut into words once.
2. Words are dealt by their hash: a block sends its words to the buckets, packed, one row per
   block and bucket, and the word table is dealt the same way. A bucket's task finds the words
   that are missing in the table. Only their n-grams are joined with the n-gram table, 4
   characters first, then 3 for the words still open, and so on.
3. The buckets meet the table of all answers and send each block one packed row: for each of its
   words the number of an answer, and the few different answers (the counts of the languages that
   have a word, or its mean gains by n-grams). These rows are stored by block, and the scan of
   the blocks looks its own up and sums them per document. Neither texts nor blocks are
   shuffled, buckets grow in number and not in size, and no word is a hot key.

A text without letters, or null, is ``und`` with score 0. Ties go to the first language in
alphabetical order. Without any labelled text every document is ``und``.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.blocks import pack, read_block, store_by_block, unpack
from basketry.llm.common import materialise, own_names, tune
from basketry.llm.quality import held_out

LONGEST = 4
SMOOTH = 0.5
# Distinct words a task counts before it hands them on.
HELD = 300_000
# Characters of text in a block; a longer document is a block of its own. Blocks share few of
# their words' rows, so larger ones ask and store less.
BLOCK = 16_000_000
# Distinct words, counted per block, that meet in one task.
BUCKET_WORDS = 400_000
# First letters of an answer: from the word table, or from n-grams.
SEEN, UNSEEN = "w", "g"
# Place that counts the known n-grams of a word, beside those of the languages.
KNOWN = -1

LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").lower())


def grams_of(word: str, size: int) -> list[str]:
    marked = f"_{word}_"
    return [marked[i : i + size] for i in range(len(marked) - size + 1)] if size > 1 else list(word)


def _flushed(counts: Counter, names: list[str]) -> pa.RecordBatch:
    rows = [(*k, n) for k, n in counts.items()]
    columns = list(zip(*rows)) if rows else [[], [], []]
    counts.clear()
    kinds = pa.string(), pa.string(), pa.int64()
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words by language, from blocks: only documents with a language in ``langs`` count."""
    counts: Counter = Counter()
    for batch in batches:
        for sizes, langs, words, bag in zip(*batch.columns):
            langs, words = langs.as_py(), _unpack_words(words.as_py())
            sizes = np.array(sizes.as_py(), np.int64)
            place, n = _from_bag(bag.as_py(), sizes)
            for lang in set(langs) - {None}:
                mine = np.repeat(np.array([own == lang for own in langs]), sizes)
                found = np.bincount(place[mine], n[mine], len(words)).astype(np.int64)
                for i in np.flatnonzero(found):
                    counts[lang, words[i]] += int(found[i])
            if len(counts) > HELD:
                yield _flushed(counts, ["lang", "item", "n"])
    yield _flushed(counts, ["lang", "item", "n"])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # A table per language: its keys are plain strings, which hash faster than pairs.
    counts: dict[str, dict[str, int]] = {}

    def flushed() -> pa.RecordBatch:
        pairs = Counter({(lang, gram): n for lang, own in counts.items() for gram, n in own.items()})
        counts.clear()
        return _flushed(pairs, ["lang", "item", "n"])

    for batch in batches:
        for lang, word, n in zip(*[c.to_pylist() for c in batch.columns]):
            own = counts.setdefault(lang, {})
            get = own.get
            for size in range(1, LONGEST + 1):
                for gram in grams_of(word, size):
                    own[gram] = get(gram, 0) + n
        if sum(map(len, counts.values())) > HELD:
            yield flushed()
    yield flushed()


@dataclass(frozen=True)
class LanguageModel:
    """A model in memory: log frequencies, a row per word or n-gram, a column per language.

    States the rule for one word; tests hold the joins of tables against it.
    """

    languages: list[str]
    words: dict[str, int]
    word_rows: np.ndarray
    grams: dict[str, int]
    gram_rows: np.ndarray

    def backoff(self, word: str) -> list[int]:
        """Rows of the longest known n-grams of an unseen word; none if no character is known."""
        get = self.grams.get
        for size in range(LONGEST, 0, -1):
            known = [r for g in grams_of(word, size) if (r := get(g)) is not None]
            if known:
                return known
        return []


@dataclass(frozen=True)
class LanguageTables:
    """The whole model: written tables (``lang``, ``item``, ``n``) of words and n-grams.

    An item that a language has ``n`` times has the log frequency of an unseen one, which is the
    base of the language, plus ``log(1 + n / SMOOTH)``.
    """

    languages: list[str]
    words: DataFrame
    word_base: np.ndarray
    grams: DataFrame
    gram_base: np.ndarray


def _sums(df: DataFrame) -> DataFrame:
    return df.groupBy("lang", "item").agg(F.sum("n").alias("n"))


def _totals(counts: DataFrame) -> dict[str, tuple[int, int]]:
    """Occurrences and distinct items of each language."""
    rows = counts.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()
    return {r["lang"]: (r["n"], r["kinds"]) for r in rows}


def _base(totals: dict[str, tuple[int, int]], languages: list[str]) -> np.ndarray:
    """Log frequency of an item that a language does not have; 0 for a language without items."""
    sizes = [n + SMOOTH * kinds for n, kinds in (totals.get(lang, (0, 0)) for lang in languages)]
    return np.log([SMOOTH / size if size else 1.0 for size in sizes])


def bags_of(docs: DataFrame) -> DataFrame:
    """Stored blocks of documents as :func:`_bags` packs them, numbered by ``block``.

    ``langs`` has the language of each document that may be learned from, null for the others.
    """
    tune(docs.sparkSession)
    learn = "lang" in docs.columns
    plain = own_names(docs, "doc_id", "text", *(["lang"] if learn else []), lang="string")
    lang = F.when(~held_out(F.col("doc_id")), F.col("lang")) if learn else F.lit(None).cast("string")
    bags = plain.select("doc_id", "text", lang.alias("lang")).mapInArrow(_bags, BAG)
    return materialise(bags.withColumn("block", F.monotonically_increasing_id()), "bags")


def fit(docs: DataFrame, bags: DataFrame | None = None) -> LanguageTables:
    """Count words and n-grams of all documents that are not held out and have a language.

    ``bags`` are the documents' blocks, if :func:`bags_of` has made them already.
    """
    bags = bags_of(docs) if bags is None else bags
    kind = "lang string, item string, n bigint"
    words = materialise(_sums(bags.select("sizes", "langs", "words", "bag").mapInArrow(_count_words, kind)), "words")
    grams = materialise(_sums(words.mapInArrow(_count_grams, kind)), "grams")
    totals = _totals(words)
    languages = sorted(totals)
    return LanguageTables(languages, words, _base(totals, languages), grams, _base(_totals(grams), languages))


def _gains(counts: DataFrame, languages: list[str]) -> DataFrame:
    """Rows (``item``, ``gains``): what the languages that have an item add to their base."""
    place = F.array_position(F.array(*map(F.lit, languages)).cast("array<string>"), F.col("lang")).cast("int") - 1
    gain = F.log1p(F.col("n") / SMOOTH)
    return counts.groupBy("item").agg(F.collect_list(_gain(place, gain)).alias("gains"))


def _gain(place: Column, gain: Column) -> Column:
    return F.struct(place.alias("place"), gain.alias("gain"))


def _planes(values: Sequence[int]) -> bytes:
    """32-bit numbers, first all lowest bytes, then the next ones; most of those are zero."""
    return np.array(values, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _to_bag(at: Sequence[int], counts: Sequence[int], sizes: list[int]) -> bytes:
    """Places and counts of the words of documents; each document's places in order, as steps."""
    at, counts = np.array(at, np.int64), np.array(counts, np.int64)
    order = np.lexsort((at, np.repeat(np.arange(len(sizes)), sizes)))
    at, counts = at[order], counts[order]
    steps = np.diff(at, prepend=0)
    first = np.cumsum([0, *sizes])[:-1][np.array(sizes) > 0]
    steps[first] = at[first]
    return pack(_planes(np.concatenate([steps, counts])))


def _from_bag(blob: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = np.split(_from_planes(unpack(blob)).astype(np.int64), 2)
    upto = np.cumsum(steps)
    before = np.concatenate(([0], upto))[np.cumsum(sizes) - sizes]
    return upto - np.repeat(before, sizes), counts


def _pack_words(words: Iterable[str]) -> bytes:
    return pack(" ".join(words).encode(), 6)


def _unpack_words(blob: bytes) -> list[str]:
    text = unpack(blob).decode()
    return text.split(" ") if text else []


BAG = "doc_ids array<bigint>, langs array<string>, sizes array<int>, width int, words binary, bag binary"


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: distinct words, and per document their places and counts."""
    ids, langs, sizes, at, counts = [], [], [], array("I"), array("I")
    words: dict[str, int] = {}
    held = 0

    def packed() -> pa.RecordBatch:
        row = [[list(ids)], [list(langs)], [list(sizes)], [len(words)], [_pack_words(words)], [_to_bag(at, counts, sizes)]]
        for own in (ids, langs, sizes, words):
            own.clear()
        del at[:], counts[:]
        lists = pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32())
        kinds = *lists, pa.int32(), pa.binary(), pa.binary()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(row, kinds)], ["doc_ids", "langs", "sizes", "width", "words", "bag"]
        )

    for batch in batches:
        for doc_id, text, lang in zip(*[c.to_pylist() for c in batch.columns]):
            if ids and held + len(text or "") > BLOCK:
                yield packed()
                held = 0
            own = Counter(words_of(text))
            ids.append(doc_id)
            langs.append(lang)
            sizes.append(len(own))
            at.extend([words.setdefault(w, len(words)) for w in own])
            counts.extend(own.values())
            held += len(text or "") + 100
    if ids:
        yield packed()


def _split(size: int):
    """The n-grams of words, with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(w, g, n) for w in batch.column(0).to_pylist() for g, n in Counter(grams_of(w, size)).items()]
            columns = list(zip(*rows)) if rows else [[], [], []]
            kinds = pa.string(), pa.string(), pa.int64()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "item", "n"]
            )

    return run


def _backed_off(missing: DataFrame, grams: DataFrame, languages: list[str]) -> list[DataFrame]:
    """Rows (``item``, ``gains``) of unseen words by their longest known n-grams, as means.

    A word without any known character is in none of the tables.
    """
    found = []
    for size in range(LONGEST, 0, -1):
        if missing.isEmpty():
            break
        table = _gains(grams.where(F.length("item") == size), languages)
        asked = missing.mapInArrow(_split(size), "word string, item string, n bigint")
        one = F.array(_gain(F.lit(KNOWN), F.lit(1.0)))
        each = asked.join(table, "item").select("word", "n", F.inline(F.concat(one, "gains")))
        sums = each.groupBy("word", "place").agg(F.sum(F.col("n") * F.col("gain")).alias("gain"))
        sums = sums.groupBy("word").agg(
            F.max(F.when(F.col("place") == KNOWN, F.col("gain"))).alias("known"),
            F.collect_list(F.when(F.col("place") != KNOWN, _gain(F.col("place"), F.col("gain")))).alias("all"),
        )
        means = F.transform("all", lambda x: _gain(x["place"], x["gain"] / F.col("known")))
        found.append(materialise(sums.select(F.col("word").alias("item"), means.alias("gains")), "backed-off"))
        if size > 1:
            missing = materialise(missing.join(found[-1].select("item"), "item", "left_anti"), "missing")
    return found


def _answer(kind: str, value: str) -> Column:
    """Per item its gains as one short text: ``kind``, then place:value of each language that has it."""
    parts = F.transform(F.sort_array("gains"), lambda x: F.concat_ws(":", x["place"], x[value]))
    return F.concat(F.lit(kind), F.array_join(parts, ","))


def _word_answers(words: DataFrame, languages: list[str]) -> DataFrame:
    """Rows (``item``, ``answer``) of the word table: counts, which are shorter than their logarithms."""
    place = F.array_position(F.array(*map(F.lit, languages)).cast("array<string>"), F.col("lang")).cast("int") - 1
    own = words.groupBy("item").agg(F.collect_list(F.struct(place.alias("place"), "n")).alias("gains"))
    return own.select("item", _answer(SEEN, "n").alias("answer"))


def _pack_places(at: list[int]) -> bytes:
    """Ascending places as steps."""
    return pack(_planes(np.diff(at, prepend=0)))


def _unpack_places(blob: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(unpack(blob)), dtype=np.int64)


QUESTIONS = "bucket int, block bigint, at binary, words binary"


def _questions(buckets: int):
    """The distinct words of each block by bucket of their hash, packed, with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = _unpack_words(blob.as_py())
                dealt: dict[int, list[int]] = {}
                for i, word in enumerate(words):
                    dealt.setdefault(bucket_of(word, buckets), []).append(i)
                rows = []
                for bucket, at in dealt.items():
                    # In order of their places, whose steps are small and pack well.
                    rows.append((bucket, block, _pack_places(at), _pack_words([words[i] for i in at])))
                kinds = pa.int32(), pa.int64(), pa.binary(), pa.binary()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)],
                    ["bucket", "block", "at", "words"],
                )

    return run


def bucket_of(word: str, buckets: int) -> int:
    return zlib.crc32(word.encode()) % buckets


def _dealt(items: DataFrame, buckets: int) -> DataFrame:
    """``items`` with the bucket of its column ``item``, as :func:`bucket_of` has it."""
    return items.withColumn("bucket", (F.crc32(F.col("item").cast("binary")) % buckets).cast("int"))


def _words_in(column: pa.ChunkedArray) -> Iterator[list[str]]:
    for blob in column:
        yield _unpack_words(blob.as_py())


def _unseen(questions: pa.Table, known: pa.Table) -> pa.Table:
    words = set().union(*_words_in(questions["words"])) - set(known["item"].to_pylist())
    return pa.table([pa.array(sorted(words), pa.string())], ["item"])


ANSWERS = "block bigint, at binary, profile binary, profiles array<string>"


def _answers(questions: pa.Table, known: pa.Table) -> pa.Table:
    """Per block of a bucket: the places of its words, the number of each one's answer, the answers."""
    answer = dict(zip(known["item"].to_pylist(), known["answer"].to_pylist()))
    out = []
    for block, at, words in zip(questions["block"].to_pylist(), questions["at"].to_pylist(), _words_in(questions["words"])):
        number: dict[str, int] = {}
        found = [number.setdefault(answer.get(w, ""), len(number)) for w in words]
        out.append((block, at, pack(_planes(found)), list(number)))
    kinds = pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.string())
    columns = zip(*out) if out else [[]] * 4
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["block", "at", "profile", "profiles"])


def _sum_documents(languages: list[str], word_base: np.ndarray, gram_base: np.ndarray, folder: str):
    """Sums per document, block by block; each block's answers lie in a folder of their own."""

    def summed_block(block: int, ids: list, sizes: np.ndarray, width: int, bag: bytes) -> pa.RecordBatch:
        answers = read_block(folder, block, ["at", "profile", "profiles"]) if width else None
        if width and answers is None:
            raise FileNotFoundError(f"no answers for block {block} in {folder}")
        # A row per answer: whether it is of a word or of n-grams, and its gain per language.
        kinds, gains, places = [(False, False)], [np.zeros(len(languages))], []
        columns = [answers[c].to_pylist() for c in ("at", "profile", "profiles")] if width else [[], [], []]
        for at, profile, profiles in zip(*columns):
            places.append((_unpack_places(at), _from_planes(unpack(profile)).astype(np.int64) + len(kinds)))
            for text in profiles:
                row = np.zeros(len(languages))
                for part in text[1:].split(",") if len(text) > 1 else ():
                    place, value = part.split(":")
                    row[int(place)] = np.log1p(int(value) / SMOOTH) if text[0] == SEEN else float(value)
                kinds.append((text[:1] == SEEN, text[:1] == UNSEEN))
                gains.append(row)
        gain = np.array(gains)
        as_word, as_grams = np.array(kinds, float).T
        of_word = np.zeros(width, np.int64)
        for at, profile in places:
            of_word[at] = profile
        place, counts = _from_bag(bag, sizes)
        document = np.repeat(np.arange(len(ids)), sizes)
        of_place = of_word[place]

        def summed(per_answer: np.ndarray) -> np.ndarray:
            return np.bincount(document, per_answer[of_place] * counts, len(ids))

        totals = np.outer(summed(as_word), word_base) + np.outer(summed(as_grams), gram_base)
        for k in range(len(languages)):
            totals[:, k] += summed(gain[:, k])
        predicted, scores = ["und"] * len(ids), [0.0] * len(ids)
        for i in np.flatnonzero(sizes) if languages else ():
            best = int(np.argmax(np.round(totals[i], 6)))
            predicted[i] = languages[best]
            scores[i] = float(1 / np.exp(np.clip(totals[i] - totals[i, best], -700, 0)).sum())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(predicted, pa.string()), pa.array(scores, pa.float64())],
            ["doc_id", "lang_pred", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, sizes, width, bag in zip(*batch.columns):
                sizes = np.array(sizes.as_py(), np.int64)
                yield summed_block(block.as_py(), ids.as_py(), sizes, width.as_py(), bag.as_py())

    return run


def predict(docs: DataFrame, model: LanguageTables, bags: DataFrame | None = None) -> DataFrame:
    """Rows (``doc_id``, ``lang_pred``, ``score``), one per input row; only texts are used.

    ``bags`` are the documents' blocks, if :func:`bags_of` has made them already.
    """
    bags = bags_of(own_names(docs, "doc_id", "text")) if bags is None else bags
    asked = bags.select(F.sum("width")).first()[0] or 0
    buckets = max(1, -(-asked // BUCKET_WORDS))
    questions = materialise(bags.select("block", "words").mapInArrow(_questions(buckets), QUESTIONS), "questions")

    def met(known: DataFrame, work, kind: str) -> DataFrame:
        """Questions and known items of each bucket in one task."""
        return questions.groupBy("bucket").cogroup(_dealt(known, buckets).groupBy("bucket")).applyInArrow(work, kind)

    missing = met(model.words.select("item").distinct(), _unseen, "item string")
    backed_off = _backed_off(materialise(missing, "missing"), model.grams, model.languages)
    known = _word_answers(model.words, model.languages)
    for found in backed_off:
        known = known.unionByName(found.select("item", _answer(UNSEEN, "gain").alias("answer")))
    folder = store_by_block(met(known, _answers, ANSWERS), "answers")
    return bags.select("block", "doc_ids", "sizes", "width", "bag").mapInArrow(
        _sum_documents(model.languages, model.word_base, model.gram_base, folder),
        "doc_id bigint, lang_pred string, score double",
    )


def languages(docs: DataFrame) -> DataFrame:
    """Rows (``doc_id``, ``held_out``, ``lang_pred``, ``score``): learn from ``docs``, then predict."""
    bags = bags_of(docs)
    found = predict(docs, fit(docs, bags), bags)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
