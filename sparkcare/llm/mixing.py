"""Mixing sources to target weights by Sainte-Lague apportionment (DataFrame functions only).

A document's size is its number of words.  Sources stand in code point order, null last, and
have the weights ``weights``, repeated; they share the sum of all sizes by weight, a target
stops at ``most`` times its source's size, and the excess is shared again by weight.  The mix
is made of blocks of equal length:

* the block length is a 256th of the smallest target, between MIN_BLOCK and MAX_BLOCK words;
* highest quotients give the sources their blocks (``apportion``: each target is rounded to
  whole blocks, then the few blocks that are missing or too many go by quotient);
* a source is cut into shards by a hash of the row, and its blocks are apportioned to its
  shards in the same way;
* in a shard documents stand in seeded order, end to end, and are cut into blocks; a shard
  with ``q`` blocks to give out of ``n`` takes each block floor(q/n) or ceil(q/n) times,
  every n/q-th one more from a seeded start on.  What a document gives follows from its
  place by arithmetic, so no row is made for a block.

The sources and the shards (at most about SHARDS and one for each source) are the only
tables that are ordered as a whole; they hold sums, not documents.  A source with any share of
the rows is spread over its shards; equal rows are counted first and dealt out in units of
COPIES, so they spread too.  Order and shards come from the rows' content alone: another run,
another file layout or a task that runs again gives the same mix.

Defined cases: a null or empty text has size 0 and nothing is taken of it; a null source is a
source of its own; repeated rows each have their own place; a source without words has target
0; rows without any word at all give targets of 0; an empty table gives an empty result; only
id, source and text are read, so other columns and their names don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BLOCKS_EACH = 256
MIN_BLOCK, MAX_BLOCK = 16, 1024
SHARD_WORDS = 1 << 16
SHARDS = 1 << 20
COPIES = 4096
WORD = r"[^\x20\x09-\x0D]+"


def seeded(seed: int, *parts: Column) -> Column:
    """Hex digest of the seed and the parts."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(p.cast("string") for p in parts)))


def number_in(digest: Column, below: Column) -> Column:
    """A number from 0 to ``below`` - 1 out of a digest."""
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.greatest(below, F.lit(1)))


def apportion(parties: DataFrame, claim: str, seats: str, group: list[str], order: str, out: str) -> DataFrame:
    """Sainte-Lague: ``out`` seats for each row of ``parties``, ``seats`` in all for each group,
    to the highest quotients claim / (2k + 1); of equal quotients the smaller ``order`` is first.

    Rounding claim * seats / sum of claims is the result for some number of seats, at
    most half the number of parties away; the next quotients up or down give the rest."""
    every = Window.partitionBy(*(group or [F.lit(0)]))
    base = (parties.withColumn("_sum", F.sum(claim).over(every).cast("double"))
            .withColumn("_count", F.count(F.lit(1)).over(every))
            .withColumn("_base", F.when((F.col(claim) > 0) & (F.col("_sum") > 0),
                                        F.floor(F.col(claim) * F.col(seats) / F.col("_sum") + 0.5)).otherwise(F.lit(0)).cast("long"))
            .withColumn("_open", F.col(seats) - F.sum("_base").over(every)))
    reach = F.ceil(F.col("_count") * F.col(claim) / F.col("_sum") / 2).cast("long") + 2
    near = (base.where((F.col("_open") != 0) & (F.col(claim) > 0))
            .withColumn("_k", F.explode(F.when(F.col("_open") > 0, F.sequence(F.col("_base"), F.col("_base") + reach))
                                        .otherwise(F.sequence(F.greatest(F.col("_base") - reach, F.lit(-1)), F.col("_base") - 1))))
            .where("_k >= 0")
            .withColumn("_quotient", F.col(claim) / (2 * F.col("_k") + 1)))
    up = F.col("_open") > 0
    first = Window.partitionBy(*(group or [F.lit(0)])).orderBy(
        F.when(up, -F.col("_quotient")).otherwise(F.col("_quotient")),
        F.when(up, F.col(order)).otherwise(-F.col(order)), F.when(up, F.col("_k")).otherwise(-F.col("_k")))
    moved = (near.withColumn("_place", F.row_number().over(first)).where(F.col("_place") <= F.abs("_open"))
             .groupBy(*group, order).agg(F.sum(F.signum("_open")).cast("long").alias("_moved")))
    return (base.join(moved, [*group, order], "left")
            .withColumn(out, F.col("_base") + F.coalesce("_moved", F.lit(0)))
            .drop("_sum", "_count", "_base", "_open", "_moved"))


def targets(sources: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``sources`` (source, source_size) with number, weight, target and block length."""
    whole = Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("number"), F.lit(len(weights))) + 1).cast("int"))
    numbered = (sources.withColumn("number", F.row_number().over(whole.orderBy(F.asc_nulls_last("source"))).cast("long") - 1)
                .withColumn("weight", weight.cast("long")).withColumn("_cap", most * F.col("source_size")))
    # Capped sources are those first in the order of cap / weight.  The level that the others
    # share is the largest of the levels with every such beginning capped.
    before = whole.orderBy(F.col("_cap") / F.col("weight"), "number").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0))).cast("double")
             / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast("double"))
    found = (numbered.withColumn("_level", level)
             .withColumn("target", F.least(F.max("_level").over(whole) * F.col("weight"), F.col("_cap").cast("double"))))
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(whole)
    block = F.greatest(F.lit(MIN_BLOCK), F.least(F.lit(MAX_BLOCK), F.floor(F.coalesce(least, F.lit(0.0)) / BLOCKS_EACH)))
    return found.withColumn("block", block.cast("long")).drop("_cap", "_level")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 11,
                id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, and runs, the
    taken words as (first, end, times), words counted from 0."""
    id_, text = docs[id_col], docs[text_col].cast("string")
    key = seeded(seed, F.when(id_.isNull(), "n").otherwise(F.concat(F.lit("v"), id_.cast("string"))),
                 F.when(text.isNull(), "-").otherwise(F.md5(text.cast("binary"))))
    rows = docs.select(id_.alias("doc_id"), docs[source_col].cast("string").alias("source"), key.alias("key"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rows = stored(rows.groupBy("source", "doc_id", "key", "size").agg(F.count(F.lit(1)).alias("copies")))

    sources = targets(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size")),
                      weights, most)
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0)))
    sources = sources.withColumn("_all", F.floor(total / F.col("block") + 0.5).cast("long"))
    sources = sources.withColumn("shards", F.ceil(F.col("source_size") / F.greatest(
        F.lit(shard_words), F.ceil(total / SHARDS))).cast("long"))
    sources = stored(apportion(sources, "target", "_all", [], "number", "blocks").drop("_all"))

    units = (rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES).cast("long"))))
             .withColumn("copies", F.least(F.lit(COPIES).cast("long"), F.col("copies") - F.col("part") * COPIES))
             .withColumn("key", F.md5(F.concat_ws(":", "key", F.col("part").cast("string")))))
    place = sources.select(F.col("source").alias("_source"), "number", "source_size", "target", "block", "shards")
    units = (units.join(place, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
             .withColumn("shard", number_in(F.col("key"), F.col("shards"))))

    shards = (units.groupBy("number", "shard").agg(F.sum(F.col("size") * F.col("copies")).alias("words"),
                                                   F.first("block").alias("block"))
              .withColumn("n", F.ceil(F.col("words") / F.col("block")).cast("long")))
    # The last block of a shard may be short: a block of this source is worth size / blocks words.
    own = (shards.groupBy("number").agg(F.sum("n").alias("_n"))
           .join(sources.select("number", "source_size", "block", "blocks"), "number")
           .select("number", F.when(F.col("source_size") > 0, F.least(most * F.col("_n"), F.floor(
               F.col("blocks") * F.col("block") * (F.col("_n") / F.col("source_size")) + 0.5).cast("long")))
               .otherwise(F.lit(0)).cast("long").alias("quota")))
    shards = apportion(shards.join(own, "number"), "n", "quota", ["number"], "shard", "q")
    shards = shards.select("number", "shard", "n", "q", number_in(
        seeded(seed, F.col("number"), F.col("shard")), F.col("n")).alias("c"))

    order = Window.partitionBy("number", "shard").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    placed = (units.withColumn("start", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(order), F.lit(0)))
              .join(shards, ["number", "shard"])
              .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
              .withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
              .withColumn("end", F.col("start") + F.col("size")))

    def given(block: Column) -> Column:
        """Blocks taken, with repeats, before this one."""
        return F.floor((block * F.col("q") + F.col("c")) / F.greatest(F.col("n"), F.lit(1))).cast("long")

    def taken(at: Column) -> Column:
        block = F.floor(at / F.col("block")).cast("long")
        return (given(block) * F.col("block")
                + (at - block * F.col("block")) * (given(block + 1) - given(block)))

    def run(block: Column) -> Column:
        return F.struct((F.greatest(block * F.col("block"), F.col("start")) - F.col("start")).alias("first"),
                        (F.least((block + 1) * F.col("block"), F.col("end")) - F.col("start")).alias("end"),
                        (given(block + 1) - given(block)).alias("times"))

    blocks = F.sequence(F.floor(F.col("start") / F.col("block")).cast("long"),
                        F.floor((F.col("end") - 1) / F.col("block")).cast("long"))
    runs = F.when(F.col("size") > 0, F.filter(F.transform(blocks, run), lambda r: r["times"] > 0))
    return placed.select("doc_id", "source", "size", "source_size", "target",
                         F.when(F.col("size") > 0, taken(F.col("end")) - taken(F.col("start"))).otherwise(F.lit(0)).alias("taken"),
                         F.coalesce(runs, F.array().cast("array<struct<first:bigint,end:bigint,times:bigint>>")).alias("runs"))
