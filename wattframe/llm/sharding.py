"""Sharding by balanced label propagation, in native expressions.

Documents that share a link (here: equal texts) pull one another to one shard.
In each round a document may move to the shard where most of its link's
documents are; moves into a shard are granted up to its quota, in the order of
a hash.  At the end documents are ranked by (label, link) and the ranks cut
into equal runs, so counts differ by one at most and a link is cut only where
a run ends or it is larger than a shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.common import staged

SHARDS = 8
ROUNDS = 4
SLACK = 0.02  # of a shard's share, by which labels may exceed it before the final cut
PER_BUCKET = 5000


def _before(value: Column, group: list, order: list) -> Column:
    """The sum of ``value`` over earlier rows of a group."""
    rows = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(rows), F.lit(0)).cast("long")


def running(df: DataFrame, groups: list[str], order: list[str], value: str, buckets: int) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over earlier rows of the group, by hash bucket and order.

    Two levels: sums of buckets, then rows within a bucket; no group is sorted whole.
    """
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sums = dealt.groupBy(*groups, "_bucket").agg(F.sum(value).alias("_sum"))
    starts = sums.select(*groups, "_bucket", _before(F.col("_sum"), groups, ["_bucket"]).alias("_start"))
    return (dealt.withColumn("_within", _before(F.col(value), [*groups, "_bucket"], order))
            .join(starts, [*groups, "_bucket"]).withColumn("before", F.col("_start") + F.col("_within"))
            .drop("_bucket", "_start", "_within"))


def propagated(blocks: DataFrame, total: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Labels after moving: rows (link, label, n), n documents of a link with that label.

    Documents of a link with one label move alike, so they are one block; the
    number of blocks is at most ``shards`` a link however many share it.
    """
    quota = int(total / shards * (1 + SLACK)) + 1
    blocks = staged(blocks, "blocks")
    buckets = total // PER_BUCKET + 1
    for turn in range(rounds):
        most = Window.partitionBy("link").orderBy(F.desc("n"), F.xxhash64("link", "label"))
        wish = blocks.withColumn("target", F.first("label").over(most))
        moves = wish.where("target <> label")
        if moves.isEmpty():
            break
        stay = {r["label"]: r["n"] for r in wish.where("target = label").groupBy("label").agg(F.sum("n").alias("n")).collect()}
        room = F.create_map(*[F.lit(x) for s in range(shards) for x in (s, max(quota - stay.get(s, 0), 0))])
        leaving = {r["label"]: r["n"] for r in moves.groupBy("label").agg(F.sum("n").alias("n")).collect()}
        ordered = running(moves.withColumn("target", F.col("target")), ["target"], ["link", "label"], "n", buckets)
        granted = ordered.withColumn("goes", F.col("before") + F.col("n") <= F.element_at(room, F.col("target")))
        placed = granted.select("link", F.when(F.col("goes"), F.col("target")).otherwise(F.col("label")).alias("label"), "n")
        blocks = staged(wish.where("target = label").select("link", "label", "n").union(placed)
                        .groupBy("link", "label").agg(F.sum("n").alias("n")), "blocks")
        if not leaving:
            break
    return blocks


def sharded(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of ``docs``.

    The law is ``rows``: shard counts differ by one at most, and slots are
    gapless from 0 in each.  Equal texts are linked; null text counts as empty
    and has size 1.  Repeated rows each take a slot.  Rows without doc_id are
    dealt like others.  No rows give no shards.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = staged(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text)).alias("link"),
        F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("initial")), "rows")
    total = rows.count()
    blocks = rows.groupBy("link", F.col("initial").alias("label")).agg(F.count("*").alias("n"))
    links = propagated(blocks, total, shards, rounds)
    buckets = total // PER_BUCKET + 1

    # Where each link starts in the order (label of most of its documents, link).
    top = links.groupBy("link").agg(F.sum("n").alias("n"), F.max_by("label", F.struct("n", F.xxhash64("link", "label"))).alias("label"))
    sums = top.groupBy("label").agg(F.sum("n").alias("labelled"))
    offsets = sums.select("label", _before(F.col("labelled"), [], ["label"]).alias("offset"))
    starts = staged(running(top, ["label"], ["link"], "n", buckets).join(offsets, "label")
                    .select("link", "n", (F.col("offset") + F.col("before")).alias("start")), "starts")

    # Where each document stands within its link; large links are cut to portions.
    several = starts.where("n > 1").select("link", "start", F.floor(F.col("n") / PER_BUCKET + 1).alias("portions"))
    alone = rows.join(starts.where("n = 1").select("link", F.col("start").alias("rank")), "link")
    held = (rows.join(several, "link")
            .withColumn("portion", F.pmod(F.xxhash64("doc_id"), F.col("portions"))))
    counted = held.groupBy("link", "portion").agg(F.count("*").alias("rows"))
    begin = counted.select("link", "portion", _before(F.col("rows"), ["link"], ["portion"]).alias("begin"))
    within = F.row_number().over(Window.partitionBy("link", "portion").orderBy("doc_id")) - 1
    together = (held.withColumn("within", within).join(begin, ["link", "portion"])
                .withColumn("rank", F.col("start") + F.col("begin") + F.col("within")))
    columns = ["doc_id", "size", "text_crc32", "rank"]
    ranks = alone.select(*columns).union(together.select(*columns))

    # Ranks cut to runs whose lengths differ by one at most.
    each, more = total // shards, total % shards
    rank = F.col("rank")
    wide = more * (each + 1)
    shard = F.when(rank < wide, F.floor(rank / (each + 1))).otherwise(
        more + F.floor((rank - wide) / max(each, 1))).cast("int")
    first = F.least(F.col("shard"), F.lit(more)) * (each + 1) + F.greatest(F.col("shard") - more, F.lit(0)) * each
    return ranks.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (rank - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
