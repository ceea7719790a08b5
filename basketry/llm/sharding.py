"""Shards of even size that keep linked documents together: balanced label propagation.

Documents with equal texts are linked. The law is ``rows``: counts of any two shards differ by
one at most.

1. Linked documents are gathered into units: a group of equal texts is one unit, or several
   of about an eighth of a shard each if it is large. Units are what moves; documents without
   links are kept back as fillers.
2. Units start at the shard of their hash. In each round one join and two aggregations give
   every unit the weight of its group in every shard; a unit applies to the heaviest shard
   that has room for it, if that beats its own. A shard accepts applicants in the order of a
   hash while they fit its quota, and a shard above its quota sends units to shards with room.
   Rounds go on until nothing moves, or ``ROUNDS`` are done.
3. Each shard numbers its documents; what lies beyond the quota joins the fillers. Fillers are
   numbered once and fill the holes of the shards in order, so every count is exact, and slots
   have no gaps.

Only counts per shard reach the driver. Ranks are taken within hash buckets, so no group and
no shard is ever handled by one task.

A null text is linked with other null texts and has size 8. Repeated rows are separate
documents, linked by their texts. Null ids are allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import distributed_rank, materialise, own_names, tune

SHARDS = 24
ROUNDS = 12
UNITS_PER_SHARD = 8
BUCKETS = 1000


def quotas(rows: int, shards: int) -> list[int]:
    """Rows of each shard; counts differ by one at most."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _at(values: list[int], index: Column) -> Column:
    """Element of a short list by a 0-based column."""
    return F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), index.cast("int") + 1)


def _place(cumulative: list[int], value: Column) -> Column:
    """Number of the range that ``value`` falls into, given the ends of the ranges."""
    return sum((F.when(value >= end, 1).otherwise(0) for end in cumulative), F.lit(0)).cast("int")


def _running(values: list[int]) -> list[int]:
    out, total = [], 0
    for v in values:
        total += v
        out.append(total)
    return out


def _loads(units: DataFrame, shards: int) -> list[int]:
    found = {r["label"]: r["load"] for r in units.groupBy("label").agg(F.sum("size").alias("load")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def propagate(units: DataFrame, memberships: DataFrame, limits: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Move units towards the shards of their groups.

    ``units`` has ``unit``, ``size`` and ``label`` (the shard it starts in), ``memberships``
    rows (``unit``, ``grp``); a unit may be in several groups, and a plain link is a group of
    two. ``limits`` are the quotas by shard. Gives ``units`` with their last labels.
    """
    shards = len(limits)
    units = materialise(units, "units")
    for turn in range(rounds):
        loads = _loads(units, shards)
        room = [max(0, q - x) for q, x in zip(limits, loads)]
        bucket = F.pmod(F.xxhash64("unit", F.lit(turn)), F.lit(BUCKETS))
        known = memberships.join(units, "unit")
        weight = known.groupBy("grp", "label").agg(F.sum("size").alias("w"))
        pull = (
            known.select("unit", "size", F.col("label").alias("own"), "grp").join(weight, "grp")
            .groupBy("unit", "size", "own", "label").agg(F.sum("w").alias("w"))
        )
        own_weight = F.max(F.when(F.col("label") == F.col("own"), F.col("w"))).alias("own_w")
        open_to = F.when(
            (F.col("label") != F.col("own")) & (_at(room, F.col("label")) >= F.col("size")),
            F.struct("w", F.negate("label").alias("minus")),
        )
        wish = pull.groupBy("unit", "size", "own").agg(own_weight, F.max(open_to).alias("best"))
        # Weights decide, then the smaller shard number, so that two units never swap for ever.
        better = (F.col("best.w") > F.col("own_w")) | (
            (F.col("best.w") == F.col("own_w")) & (-F.col("best.minus") < F.col("own"))
        )
        wish = wish.where("best IS NOT NULL").where(better).select(
            "unit", "size", (-F.col("best.minus")).alias("to"), bucket.alias("bucket")
        )
        over = [max(0, x - q) / x if x else 0.0 for q, x in zip(limits, loads)]
        if any(over) and sum(room):
            crowd = F.element_at(F.array(*[F.lit(x) for x in over]), F.col("label") + 1) * BUCKETS
            spot = F.pmod(F.xxhash64("unit", F.lit(turn), F.lit("to")), F.lit(sum(room)))
            leave = units.select(
                "unit", "size", _place(_running(room), spot).alias("to"), bucket.alias("bucket"), crowd.alias("crowd")
            )
            leave = leave.where(F.ceil("crowd") > F.col("bucket")).drop("crowd")
            wish = wish.join(leave, "unit", "left_anti").union(leave)
        wish = materialise(wish, "wishes")
        asked = sorted(
            (r["to"], r["bucket"], r["n"])
            for r in wish.groupBy("to", "bucket").agg(F.sum("size").alias("n")).collect()
        )
        if not asked:
            break
        accepted, left = [], list(room)
        for to, own_bucket, n in asked:
            if n <= left[to]:
                left[to] -= n
                accepted.append(to * BUCKETS + own_bucket)
        if not accepted:
            break
        key = (F.col("to") * BUCKETS + F.col("bucket")).cast("int")
        moves = wish.where(key.isin(accepted)).select("unit", F.col("to").cast("int").alias("to"))
        moved = units.join(moves, "unit", "left")
        units = materialise(moved.select("unit", "size", F.coalesce("to", "label").alias("label")), "units")
    return units


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Rows (``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``)."""
    tune(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    base = materialise(
        own_names(docs, "doc_id", "text").select(
            "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
            F.coalesce(F.md5("text"), F.lit("none")).alias("grp"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "documents",
    )
    rows = base.count()
    limits = quotas(rows, shards)
    most = max(1, rows // shards // UNITS_PER_SHARD)
    groups = base.groupBy("grp").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    salt = F.pmod(F.xxhash64("row"), F.ceil(F.col("copies") / most))
    linked = base.select("row", "grp").join(groups, "grp").select("row", "grp", F.xxhash64("grp", salt).alias("unit"))
    linked = materialise(linked, "linked")
    units = linked.groupBy("unit").agg(F.count(F.lit(1)).alias("size"))
    start = units.withColumn("label", F.pmod(F.xxhash64("unit", F.lit("start")), F.lit(shards)).cast("int"))
    labels = propagate(start, linked.select("unit", "grp").distinct(), limits, rounds).select("unit", "label")
    named = linked.join(labels, "unit").select("row", "label")
    labelled = materialise(base.drop("grp").join(named, "row", "left"), "labelled")
    # Documents without links wait as fillers and need no rank here.
    settled = labelled.where("label IS NOT NULL")
    ranked = materialise(distributed_rank(settled, ["label"], F.xxhash64("row"), rows), "ranked")
    fits = F.col("_rank") < _at(limits, F.col("label"))
    placed = ranked.where(fits)
    counts = {r["label"]: r["n"] for r in placed.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = [counts.get(s, 0) for s in range(shards)]
    holes = _running([q - t for q, t in zip(limits, taken)])
    beyond = ranked.where(~fits).drop("_rank")
    fillers = materialise(beyond.unionByName(labelled.where("label IS NULL")), "fillers")
    spare = distributed_rank(fillers, [], F.xxhash64("row", F.lit("spare")), rows)
    place = _place(holes, F.col("_rank"))
    spare = spare.withColumn("label", place).withColumn(
        "_rank", F.col("_rank") - _at([0, *holes[:-1]], F.col("label")) + _at(taken, F.col("label"))
    )
    return placed.unionByName(spare).select(
        "doc_id", "size", F.col("text_crc32").cast("bigint").alias("text_crc32"), F.lit("rows").alias("law"),
        F.col("label").cast("int").alias("shard"), F.col("_rank").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
