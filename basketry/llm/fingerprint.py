"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame expressions only.

A sketch is the sorted array of the ``k`` smallest distinct 64-bit hashes of a text's five-word
shingles (words are runs outside ASCII white space, in lower case; a text of fewer words has
one shingle, its whole sequence; one without words has an empty sketch). Sketches of parts
merge into the sketch of the whole. Two sketches estimate resemblance (shared shingles over
all), containment (share of the first's shingles that the second has) and the number of
distinct shingles. A sketch of fewer than ``k`` hashes is the full set, and estimates from two
such are exact.

Null texts are treated as empty. Equal texts have equal sketches. Rows that repeat a
``doc_id`` with an equal text count once in the order of documents and get equal results;
rows that repeat it with another text follow the order of a hash of the text; a null
``doc_id`` comes after all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketry.llm.common import let, materialise, own_names, tune

K = 128
WORDS = 5
BLANKS = r"[ \t\n\x0B\f\r]+"
LARGEST = float(2**64)


def words(text: Column) -> Column:
    """Words of a text, lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BLANKS, -1), lambda w: w != "")


def shingle_hashes(parts: Column, size: int = WORDS) -> Column:
    """Hash of each run of ``size`` words; of the whole sequence if it is shorter."""
    n = F.size(parts)
    runs = F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.xxhash64(F.slice(parts, i, size)))
    none = F.array().cast("array<bigint>")
    return F.when(n >= size, runs).when(n > 0, F.array(F.xxhash64(parts))).otherwise(none)


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K) -> Column:
    """Bottom-k sketch of a text."""
    return let(words(text), lambda w: bottom(shingle_hashes(w), k))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of all shingles of two texts that both have; 1 for two empty ones."""
    both = F.array_intersect(a, b)
    return let(
        merge(a, b, k),
        lambda whole: F.when(F.size(whole) == 0, 1.0).otherwise(F.size(F.array_intersect(whole, both)) / F.size(whole)),
    )


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    span = F.element_at(a, -1).cast("double") + F.lit(LARGEST / 2)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * F.lit(LARGEST) / span)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 if ``a`` is empty."""
    shared = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_count(a, k)))


def merged(sketches: DataFrame, by: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each group of parts, by one aggregation of single hashes.

    Only hashes that are among the ``k`` smallest of their part travel; ranks within a group
    are taken by a window, which cuts to ``k`` rows before the exchange as well.
    """
    single = sketches.select(*by, F.explode(column).alias("_h")).distinct()
    rank = Window.partitionBy(*by).orderBy("_h")
    least = single.withColumn("_n", F.row_number().over(rank)).where(F.col("_n") <= k)
    return least.groupBy(*by).agg(F.sort_array(F.collect_list("_h")).alias(column))


def as_text(a: Column) -> Column:
    """A sketch as hexadecimal text, 16 digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def successors(docs: DataFrame) -> DataFrame:
    """Rows (``doc_id``, ``h``, ``n``, ``next_id``, ``next_h``): the next document of each.

    Documents go by descending id; after the last comes the first. Rows are dealt out by
    range and written, so that each range orders its own rows; where a range ends, the next
    one's first row follows, by a table of one row per range.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), F.length("text").alias("n")).distinct()
    order = [F.col("doc_id").desc_nulls_last(), F.col("h")]
    ranged = materialise(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "order")
    inside = Window.partitionBy("part").orderBy(*order)
    own = ranged.select(
        "*", F.lead(F.struct("doc_id", "h")).over(inside).alias("next"), F.row_number().over(inside).alias("at")
    )
    heads = own.where("at = 1").select("part", F.struct("doc_id", "h").alias("head"))
    # One row per range: few, however many documents there are.
    along = Window.orderBy("part")
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select(
        "part", F.coalesce(F.lead("head").over(along), F.first("head").over(every)).alias("after")
    )
    linked = own.join(after, "part").select("doc_id", "h", "n", F.coalesce("next", "after").alias("next"))
    return linked.select("doc_id", "h", "n", F.col("next.doc_id").alias("next_id"), F.col("next.h").alias("next_h"))


def edited_likeness(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of each text and of its edited form, and how alike they are.

    The edited text has the last third of the text (rounded down) replaced by as many code
    points from the start of the next document. Rows: ``doc_id``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next``, and ``n_shingles``, the estimated number of distinct shingles.
    """
    tune(docs.sparkSession)
    plain = own_names(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = plain.withColumn("h", F.xxhash64("text"))
    links = materialise(successors(plain), "successors")
    wanted = links.select(
        F.col("doc_id").alias("own_id"), F.col("h").alias("own_h"), F.floor(F.col("n") / 3).cast("int").alias("third"),
        "next_id", "next_h",
    )
    # What the next document sends: its first code points and its sketch. Its repeated rows
    # would send the same again.
    sent = (
        keyed.join(wanted, keyed["doc_id"].eqNullSafe(wanted["next_id"]) & (keyed["h"] == wanted["next_h"]))
        .select("own_id", "own_h", "third", F.substring("text", F.lit(1), F.col("third")).alias("start"),
                sketch(F.col("text"), k).alias("next_sketch"))
    )
    if keyed.groupBy("doc_id", "h").count().where("count > 1").limit(1).count():
        sent = sent.dropDuplicates(["own_id", "own_h"])
    n = F.length("text")
    both = keyed.join(sent, keyed["doc_id"].eqNullSafe(sent["own_id"]) & (keyed["h"] == sent["own_h"])).select(
        "doc_id", "text", n.cast("bigint").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), n - F.col("third")), F.col("start")).alias("edited"), "next_sketch",
    )
    sketched = both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        sketch(F.col("text"), k).alias("a"), sketch(F.col("edited"), k).alias("b"), "next_sketch",
    )
    return sketched.select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("a")).alias("fingerprint"), as_text(F.col("b")).alias("edited_fingerprint"),
        resemblance(F.col("a"), F.col("b"), k).alias("near_edited"),
        resemblance(F.col("a"), F.col("next_sketch"), k).alias("near_next"),
        distinct_count(F.col("a"), k).alias("n_shingles"),
    )
