"""Sharding by balanced label propagation: linked documents meet, counts stay at most one apart.

Documents with equal texts are linked. Every document starts in a shard by a
hash of its id; the members of one group in one start shard form a piece (so a
group has at most as many pieces as there are shards, whatever its size). In
each round every piece looks at the shards of its group's pieces and asks to
move to the one that holds most of the group and has room; requests beyond a
shard's room are admitted by a stable hash in proportion. Rounds are joins and
aggregations over pieces; loads per shard (one number each) reach the driver.

At last documents are ordered within their shard, linked groups first. What lies
beyond a shard's quota (unlinked documents before any other) fills the shards
below theirs, so counts differ by one at most.

Edge cases: a NULL text counts as empty and is linked with empty texts; a NULL
id is hashed as such; repeated rows are documents of their own; fewer documents
than shards leave shards empty; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewscope.llm.common import unit_hash
from reviewscope.operators.ordering import PART, POS, block_totals, stage_in_order
from reviewscope.session import materialize

SHARDS = 24
ROUNDS = 6


def _start_shard(key: str, shards: int):
    return F.floor(unit_hash(key, seed="start-shard") * shards).cast("int")


def propagate(pieces: DataFrame, quota: int, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """Moves pieces (grp, start, shard, n, members) towards most of their group, within ``quota`` per shard.

    Stops early when no piece wants to move.
    """
    room = [quota] * shards
    for turn in range(rounds):
        loads = {r["shard"]: r["n"] for r in pieces.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        room = [quota - loads.get(s, 0) for s in range(shards)]
        open_ = F.array(*[F.lit(r > 0) for r in room])
        held = pieces.groupBy("grp", "shard").agg(F.sum("n").alias("held"))
        tie = F.xxhash64("grp", "shard")
        best = (
            held.withColumn("has_room", F.get(open_, F.col("shard"))).where("has_room")
            .groupBy("grp").agg(F.max(F.struct("held", tie.alias("tie"), F.col("shard").alias("to"))).alias("best"))
        )
        own = held.select("grp", "shard", F.col("held").alias("own"))
        wish = (
            pieces.join(own, ["grp", "shard"]).join(best, "grp", "left")
            .withColumn("to", F.col("best.to"))
            .withColumn("moves", F.coalesce(
                (F.col("to") != F.col("shard"))
                & ((F.col("best.held") > F.col("own")) | ((F.col("best.held") == F.col("own")) & (F.col("best.tie") > tie))),
                F.lit(False),
            ))
        )
        wish = materialize(wish.select("grp", "start", "shard", "n", "members", "to", "moves"), "wishes")
        asked = {r["to"]: r["n"] for r in wish.where("moves").groupBy("to").agg(F.sum("n").alias("n")).collect()}
        if not asked:
            break
        share = F.array(*[F.lit(float(min(1.0, max(0, room[s]) / asked[s])) if asked.get(s) else 0.0) for s in range(shards)])
        # A group that fits a shard moves as a whole or not at all, a larger one piece by piece.
        part = F.when(F.col("members") > quota, F.col("start"))
        admit = F.col("moves") & (unit_hash("grp", part, seed=f"admit-{turn}") < F.get(share, F.col("to")))
        pieces = materialize(wish.select("grp", "start", "n", "members", F.when(admit, F.col("to")).otherwise(F.col("shard")).alias("shard")), "pieces")
    return pieces


def shard_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot and grown_shard."""
    whole = F.coalesce(F.col(text), F.lit(""))
    base = materialize(docs.select(
        F.col(key).alias("key"), (F.octet_length(whole) + 8).cast("long").alias("size"), F.crc32(whole).alias("text_crc32"),
        F.md5(whole).alias("grp"), _start_shard(key, shards).alias("start"),
    ), "shard-base")
    total = base.count()
    fewest, extra = divmod(total, shards)
    quota = [fewest + (s < extra) for s in range(shards)]

    pieces = base.groupBy("grp", "start").agg(F.count("*").alias("n"))
    linked = Window.partitionBy("grp")
    pieces = pieces.withColumn("members", F.sum("n").over(linked)).where("members > 1").select("grp", "start", F.col("start").alias("shard"), "n", "members")
    moved = propagate(materialize(pieces, "pieces"), max(fewest, 1), shards, rounds).withColumnRenamed("shard", "to")

    placed = base.join(moved.select("grp", "start", "to"), ["grp", "start"], "left").select(
        F.coalesce("to", "start").alias("shard"), F.col("to").isNull().alias("free"), "grp", "key", "size", "text_crc32",
    )
    staged = stage_in_order(placed, "shard", "free", "grp", "key", name="shard-order")
    blocks = block_totals(staged, ["shard"], F.lit(1))
    counts = {r["shard"]: r["n"] for r in blocks.groupBy("shard").agg(F.first("group_total").alias("n")).collect()}
    have = [counts.get(s, 0) for s in range(shards)]

    def lookup(values: list[int]):
        return F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]), F.col("shard"))

    over_before = [sum(max(0, have[t] - quota[t]) for t in range(s)) for s in range(shards)]
    at = F.col("before") + F.col(POS) - F.col("block_first")
    numbered = staged.join(F.broadcast(blocks), ["shard", PART]).withColumn("at", at).withColumn(
        "spare", F.when(F.col("at") >= lookup(quota), F.col("at") - lookup(quota) + lookup(over_before)),
    )
    shard, slot, filled = F.col("shard"), F.col("at"), 0
    for s in range(shards):
        holes = max(0, quota[s] - have[s])
        if holes:
            here = (F.col("spare") >= filled) & (F.col("spare") < filled + holes)
            shard = F.when(here, F.lit(s)).otherwise(shard)
            slot = F.when(here, F.col("spare") - filled + have[s]).otherwise(slot)
            filled += holes
    return numbered.select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("rows").alias("law"),
        shard.cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("grp").alias("group"),
    )
