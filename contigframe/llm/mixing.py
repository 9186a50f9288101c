"""Mixing sources to target weights (DataFrame functions only).

Every source is one stream of words, cut into blocks of ``BLOCK`` words, or of fewer where the source would have less than ``LEAST`` blocks. The mix has as many slots as the targets need
blocks; slots are dealt to output shards, and in each shard the sources' counts are a multinomial draw (one weighted draw per
slot). What the draws miss a source's quota by is settled in one last shard: surplus slots are void, missing ones are
appended. The i-th slot of a source takes block ``pi(i mod n)`` of its n blocks in epoch ``i div n``, with ``pi`` a pseudorandom
permutation keyed by source and epoch, so a block is taken at most once an epoch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contigframe.llm import util

BLOCK, LEAST = 64, 1_024
SHARD = 65_536
CELLS = 4_096
#: Parts that each source's stream is ordered in; fixed, as the order of the stream must not depend on the session.
LOTS = 4_096
EPOCHS = 3
ROUNDS = 12
SEED = 20_240


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(util.WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """Per source: its size, weight and target. Weights are 1, 2, 3, repeating, by code point, null last; a target stops at
    ``epochs`` times its source's size, and the excess is reshared by weight until none is above.

    That fixed point is a water level: in ascending order of cap by weight, the first sources are at their cap, and all
    others take the level times their weight. One row per source is all that the global windows see.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name, by_cap = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("ratio", F.col("source").asc_nulls_last())
    per = per.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("double")).withColumn("cap", (F.lit(epochs) * F.col("source_size")).cast("double"))
    per = per.withColumn("ratio", F.col("cap") / F.col("weight"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    per = (
        per.withColumn("total", F.sum("source_size").over(everything.orderBy("ratio")).cast("double"))
        .withColumn("all_weight", F.sum("weight").over(everything.orderBy("ratio")))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    )
    # levels fall from the first source on that they don't fill to its cap, so the largest such one holds
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything.orderBy("ratio"))
    return per.withColumn("water", level).select(
        "source", "source_size", "weight", F.when(F.col("water").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("water") * F.col("weight"))).alias("target")
    )


def permuted(i: Column, n: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of 0..n-1 (swap-or-not): each round maps i to itself or to its partner K - i, by a bit of
    the larger of both. Every round is its own inverse, so the whole is a permutation for any n."""

    def turn(x: Column, r: Column) -> Column:
        partner = F.pmod(util.mix(SEED, r, *key) - x, n)
        return F.when(util.mix(SEED + 1, r, F.greatest(x, partner), *key).bitwiseAND(F.lit(1)) == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), i, turn)


def block_size(source_size: Column, most: int) -> Column:
    """Words of a source's blocks: quotas are whole blocks, so a small source has small ones, to come near its target."""
    return F.greatest(F.least(F.floor(source_size / LEAST), F.lit(most)), F.lit(1)).cast("long")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken.

    Defined cases: null text has size 0 and takes 0. A null source is a source, ordered last. If no text has a word, all
    targets are 0. Rows repeated with the same id are separate rows of the stream. Reruns agree whatever the session's settings
    and the rows' order, as all draws are hashes. An empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    with util.Scratch(spark) as tmp:
        key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
        sizes = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"))
        sizes = tmp.written(sizes.withColumn("source_key", key), "sizes")
        targets = source_targets(sizes)
        blocks = F.ceil(F.col("source_size") / block_size(F.col("source_size"), block)).cast("long")
        per_block = F.col("source_size") / F.col("blocks")
        targets = (
            targets.withColumn("blocks", blocks)
            .withColumn("quota", F.when(F.col("blocks") > 0, F.least(F.round(F.col("target") / per_block).cast("long"), F.col("blocks") * EPOCHS)).otherwise(F.lit(0)))
            .withColumn("source_key", key)
        )
        targets = tmp.written(targets, "targets")
        taken = tmp.written(_document_takes(sizes, _block_takes(_slots(spark, targets, shard, tmp)), block), "taken")
        out = util.join_heavy(taken, targets.select("source_key", "source_size", "target"), ["source_key"])
        return util.written(out.select("doc_id", "size", "source_size", "target", "taken"), "mix")


def _slots(spark: SparkSession, targets: DataFrame, shard: int, tmp: util.Scratch) -> DataFrame:
    """(source_key, blocks, i): the slots of each source, numbered from 0 without a gap."""
    n = targets.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    upto = Window.orderBy("source_key")
    shares = (
        targets.where("quota > 0").select("source_key", "blocks", "quota")
        .withColumn("hi", F.sum("quota").over(upto.rowsBetween(Window.unboundedPreceding, 0)) / F.lit(float(max(n, 1))))
        .withColumn("lo", F.coalesce(F.lag("hi").over(upto), F.lit(0.0)))
    )
    cells = shares.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * CELLS).cast("int"), F.least(F.floor(F.col("hi") * CELLS).cast("int"), F.lit(CELLS - 1)))))
    # drawn: a uniform number for each slot falls into one source's share
    u = F.pmod(util.mix(SEED + 2, F.col("slot")), F.lit(1 << 40)) / float(1 << 40)
    drawn = (
        spark.range(n).select(F.col("id").alias("slot"), F.floor(F.col("id") / shard).cast("long").alias("shard")).withColumn("u", u)
        .withColumn("cell", F.floor(F.col("u") * CELLS).cast("int"))
        .join(cells, "cell").where("u >= lo and u < hi").select("shard", "slot", "source_key")
    )
    counts = drawn.groupBy("source_key", "shard").agg(F.count("*").alias("c"))
    before = Window.partitionBy("source_key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("c").over(before), F.lit(0)))
    counts = tmp.written(counts, "shards")
    kept = counts.join(targets.select("source_key", "blocks", "quota"), "source_key").withColumn("last", F.least(F.col("first") + F.col("c"), F.col("quota")))
    # a row becomes up to ``shard`` slots, so the few rows are spread before
    spread = kept.where("last > first").repartition(util.salt_count(spark), "source_key", "shard")
    inner = spread.select("source_key", "blocks", F.explode(F.sequence("first", F.col("last") - 1)).alias("i"))
    had = counts.groupBy("source_key").agg(F.sum("c").alias("had"))
    short = targets.join(had, "source_key", "left").withColumn("had", F.coalesce("had", F.lit(0))).where("quota > had")
    return inner.unionByName(short.select("source_key", "blocks", F.explode(F.sequence("had", F.col("quota") - 1)).alias("i")))


def _block_takes(slots: DataFrame) -> DataFrame:
    """(source_key, block, times): slots are joined to blocks by index."""
    epoch = F.floor(F.col("i") / F.col("blocks")).cast("long")
    at = permuted(F.col("i") % F.col("blocks"), F.col("blocks"), F.col("source_key"), epoch)
    return slots.select("source_key", at.alias("block")).groupBy("source_key", "block").agg(F.count("*").alias("times"))


def _document_takes(sizes: DataFrame, takes: DataFrame, block: int) -> DataFrame:
    """(source_key, doc_id, size, taken): documents in stream order (hashed lot, then id), cut at the block borders and joined to the blocks' takes."""
    worded = sizes.where("size > 0").withColumn("lot", F.pmod(util.mix(SEED + 3, F.col("doc_id")), F.lit(LOTS)).cast("int"))
    per_lot = worded.groupBy("source_key", "lot").agg(F.sum("size").alias("lot_size"))
    before = Window.partitionBy("source_key").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)  # at most LOTS rows
    whole = F.sum("lot_size").over(Window.partitionBy("source_key"))
    per_lot = per_lot.withColumns({"lot_start": F.coalesce(F.sum("lot_size").over(before), F.lit(0)), "words": block_size(whole, block)}).drop("lot_size")
    inside = Window.partitionBy("source_key", "lot").orderBy("doc_id", "size")
    placed = (
        worded.withColumn("row", F.row_number().over(inside))
        .withColumn("in_lot", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .join(per_lot, ["source_key", "lot"]).withColumn("start", F.col("lot_start") + F.col("in_lot"))
    )
    cut = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / F.col("words")).cast("long"), F.floor((F.col("start") + F.col("size") - 1) / F.col("words")).cast("long"))))
    overlap = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("words")) - F.greatest(F.col("start"), F.col("block") * F.col("words"))
    cut = cut.withColumn("overlap", overlap).join(takes, ["source_key", "block"], "left")
    taken = cut.groupBy("source_key", "lot", "row", "doc_id", "size").agg(F.coalesce(F.sum(F.col("overlap") * F.col("times")), F.lit(0)).alias("taken"))
    columns = ["source_key", "doc_id", "size", "taken"]
    return taken.select(*columns).unionByName(sizes.where("size = 0").withColumn("taken", F.lit(0).cast("long")).select(*columns))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix in whole documents, with the columns of ``docs``: a document is repeated as often as its words were taken; a
    fraction of a repeat is rounded by a hash of its id, in proportion. Texts without a word stay once. Rows repeated with one id
    are repeated alike, as often as the one of them that is taken most. A null id is an id; an empty table gives an empty result."""
    taken = mix_sources(docs, id_col, text_col, source_col).groupBy("doc_id").agg(F.max(F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(1.0)).alias("__times"))
    times = taken.withColumnRenamed("doc_id", "__id")
    draw = F.pmod(util.mix(SEED + 4, F.col(id_col)), F.lit(1 << 40)) / float(1 << 40)
    whole = F.floor(F.col("__times")).cast("int")
    copies = whole + F.when(draw < F.col("__times") - whole, 1).otherwise(0)
    out = docs.join(times, F.col(id_col).eqNullSafe(F.col("__id"))).withColumn("__copies", copies).where("__copies > 0")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(util.documents(spark, sf_dir))
