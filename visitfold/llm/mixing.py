"""Sources mixed to target weights by a splitting tree over blocks; DataFrame functions only.

A source's documents are dealt by hash into blocks of some ``block_words`` words. Its target
is an exact number of words: so many whole passes over its blocks, and a further draw of
permuted blocks, of which the last is settled document by document. Every drawn block is a
ticket. The tree splits the sources' numbers of tickets: a node sends the tickets with the
lowest keys to its left child, exactly as many as that child's shards hold, which draws that
child's quotas from the multivariate hypergeometric distribution; draws of nested nodes agree,
so one rank of all tickets decides on every level. Then every shard takes as many blocks of
each source as its quota says, the next ones of the source in an order of their own. Within
a shard documents are shuffled.

Ranks and running totals go over hash buckets first, so no task gets a source or the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitfold.llm.common import WORD, boxed, settle

# Weights and limit that the query states.
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3

BLOCK_WORDS = 65_536
SHARD_BLOCKS = 16
SEED = 7

#: Leading hexadecimal digits of a key that make its bucket: 4,096 buckets.
BUCKET_DIGITS = 3
RANGES = 64
#: Passes that fill the gap in a source's last block with ever smaller documents.
FILLS = 6


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _code(seed: int, *parts: Column) -> Column:
    """A key of 32 hexadecimal digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[part.cast("string") for part in parts]))


def document_key(docs: DataFrame, doc_id: str, text: str, seed: int) -> Column:
    """Equal for repeated rows only, so these share their fate."""
    number = F.coalesce(docs[f"`{doc_id}`"].cast("string"), F.lit("null"))
    content = F.coalesce(F.md5(docs[f"`{text}`"].cast("binary")), F.lit("null"))
    return _code(seed, number, content)


def running_total(rows: DataFrame, group: str, key: str, value: str, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over rows of the group with smaller keys (hex digits)."""
    rows = rows.withColumn("bucket", F.substring(key, 1, BUCKET_DIGITS))
    earlier = (Window.unboundedPreceding, -1)
    over = Window.partitionBy(group).orderBy("bucket").rowsBetween(*earlier)
    before = (
        rows.groupBy(group, "bucket")
        .agg(F.sum(value).alias("in_bucket"))
        .select(
            group, "bucket", F.coalesce(F.sum("in_bucket").over(over), F.lit(0)).alias("buckets_before")
        )
    )
    inside = Window.partitionBy(group, "bucket").orderBy(key).rowsBetween(*earlier)
    total = F.col("buckets_before") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return (
        rows.join(before, [group, "bucket"]).withColumn(name, total).drop("bucket", "buckets_before")
    )


def source_numbers(sizes: DataFrame) -> DataFrame:
    """``place`` of each source by code point, from 0, null last; ranges are numbered apart."""
    order = F.asc_nulls_last("source")
    ranged = settle(
        sizes.repartitionByRange(RANGES, order).withColumn("range", F.spark_partition_id()), "sources"
    )
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.groupBy("range")
        .count()
        .select("range", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    )
    inside = Window.partitionBy("range").orderBy(order)
    return ranged.join(before, "range").select(
        "source", "source_size", (F.col("before") + F.row_number().over(inside) - 1).alias("place")
    )


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_REPEATS
) -> DataFrame:
    """source, source_size, place and target from (source, source_size).

    Targets share the sum of all sizes by weight; one above ``most`` times its source's size
    stops there and the excess is shared anew, until none is above. Each round is one
    aggregate; the common level rises until it is stable.
    """
    weight = F.element_at(
        F.array(*map(F.lit, map(float, weights))), (F.col("place") % len(weights) + 1).cast("int")
    )
    named = settle(source_numbers(sizes).withColumn("weight", weight), "sources")
    limit = F.col("source_size") * float(most)
    level = 0.0
    while True:
        full = limit < F.col("weight") * level
        row = named.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, limit).otherwise(0.0)).alias("stopped"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not row["all"] or not row["open"]:
            break
        higher = (row["all"] - row["stopped"]) / row["open"]
        if higher <= level:
            break
        level = higher
    return named.withColumn("target", F.least(limit, F.col("weight") * level)).drop("weight")


def _fitting(last: DataFrame) -> DataFrame:
    """Documents of sources' last blocks that still fit into ``left`` words, as place, key.

    First in permuted order, then the longest that fit, a few times; rows with equal keys
    go together.
    """

    def upto(*order: Column | str) -> Window:
        frame = Window.partitionBy("place").orderBy(*order)
        return frame.rangeBetween(Window.unboundedPreceding, Window.currentRow)

    whole = Window.partitionBy("place")
    rows = last.where("size > 0").withColumn("fits", F.sum("size").over(upto("key")) <= F.col("left"))
    for _ in range(FILLS):
        used = F.sum(F.when(F.col("fits"), F.col("size")).otherwise(0)).over(whole)
        rows = rows.withColumn("room", F.col("left") - used)
        small = ~F.col("fits") & (F.col("size") <= F.col("room"))
        total = F.sum(F.when(small, F.col("size")).otherwise(0)).over(upto(F.desc("size"), "key"))
        rows = rows.withColumn("fits", F.col("fits") | (small & (total <= F.col("room"))))
    return rows.where("fits").select("place", "key").distinct().withColumn("settled", F.lit(1))


def shard_quotas(tickets: DataFrame, levels: int) -> DataFrame:
    """node, place, quota: how many tickets of each source the leaves of the tree get.

    There are ``2 ** levels`` leaves, as equal as their number allows.
    """
    one = tickets.withColumn("tree", F.lit(0)).withColumn("one", F.lit(1))
    total = max(1, tickets.count())
    ranked = running_total(one, "tree", "ticket", "one", "rank")
    node = F.expr(f"rank * {1 << levels} div {total}").cast("long")
    return ranked.groupBy(node.alias("node"), "place").agg(F.count("*").alias("quota"))


def quota_tree(quotas: DataFrame, levels: int) -> DataFrame:
    """level, node, place, quota: each node's tickets by source, from the root down to the leaves.

    The children 2n and 2n + 1 of node n share its quotas between them, and hold equally
    many tickets (one more on one side if their number is odd).
    """
    level = F.explode(F.sequence(F.lit(0), F.lit(levels)))
    each = quotas.select("node", "place", "quota", level.alias("level"))
    node = F.expr(f"node div cast(power(2, {levels} - level) as bigint)")
    return each.groupBy("level", node.alias("node"), "place").agg(F.sum("quota").alias("quota"))


def deal(tickets: DataFrame, shard_blocks: int) -> DataFrame:
    """place, block, copy and shard: every shard's quota of each source, in permuted blocks.

    Shards number their slots of a source one after another; the source's blocks take the
    slots in the order of ``draw``, a key that the tree has not seen.
    """
    shards = max(1, -(-tickets.count() // shard_blocks))
    quotas = settle(shard_quotas(tickets, (shards - 1).bit_length()), "quotas")
    before = F.sum("quota").over(Window.partitionBy("place").orderBy("node")) - F.col("quota")
    slots = quotas.withColumn("before", before).select(
        "place",
        F.col("node").cast("int").alias("shard"),
        F.explode(F.sequence(F.col("before"), F.col("before") + F.col("quota") - 1)).alias("slot"),
    )
    drawn = running_total(tickets.withColumn("one", F.lit(1)), "place", "draw", "one", "slot")
    return drawn.join(slots, ["place", "slot"]).select("place", "block", "copy", "shard")


def mixture(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_blocks: int = SHARD_BLOCKS,
    seed: int = SEED,
) -> DataFrame:
    """What the mix takes of each row: key, doc_id, size, source_size, target, copies, taken, shards.

    Size counts words; a null text has none. Sources are weighted in order of code point, a
    null source last, the weights repeating. A row is taken 0 to ``most`` times; ``shards``
    has the shard of each copy. A source's taken words fall short of its target by less than
    the shortest document left out of its last block. Repeated rows share their fate. Rows
    without words may get copies that count nothing. The same rows and seed give the same
    result. An empty table gives no rows.
    """
    units = settle(
        docs.select(
            document_key(docs, doc_id, text, seed).alias("key"),
            docs[f"`{doc_id}`"].alias("doc_id"),
            docs[f"`{source}`"].cast("string").alias("source"),
            word_count(docs[f"`{text}`"]).alias("size"),
        ),
        "units",
    )
    sizes = units.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0)
    sources = settle(
        source_targets(sizes, weights, most)
        .withColumn("full", passes.cast("int"))
        .withColumn("rest", goal - F.col("full") * F.col("source_size"))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long"))
        .withColumnRenamed("source", "named"),
        "sources",
    )
    number = F.conv(F.substring("key", 25, 8), 16, 10).cast("long")
    placed = (
        units.join(sources, F.col("source").eqNullSafe(F.col("named")))
        .withColumn("block", number % F.col("blocks"))
        .drop("named", "source", "blocks")
    )
    blocks = (
        placed.groupBy("place", "block")
        .agg(F.sum("size").alias("words"), F.max("full").alias("full"), F.max("rest").alias("rest"))
        .withColumn("block_key", _code(seed, F.col("place"), F.col("block")))
    )
    blocks = settle(
        running_total(blocks, "place", "block_key", "words", "before")
        .withColumn("left", F.col("rest") - F.col("before"))
        .withColumn("whole", (F.col("rest") > 0) & (F.col("words") <= F.col("left")))
        .withColumn("last", ~F.col("whole") & (F.col("left") > 0))
        .select("place", "block", "full", "left", "whole", "last"),
        "blocks",
    )
    draws = F.col("full") + (F.col("whole") | F.col("last")).cast("int")
    tickets = settle(
        blocks.where(draws > 0)
        .select("place", "block", F.explode(F.sequence(F.lit(1), draws)).alias("copy"))
        .withColumn("ticket", _code(seed, F.col("place"), F.col("block"), F.col("copy")))
        .withColumn("draw", _code(seed, F.col("place"), F.col("block"), F.col("copy"), F.lit("draw"))),
        "tickets",
    )
    dealt = (
        deal(tickets, shard_blocks)
        .groupBy("place", "block")
        .agg(F.array_sort(F.collect_list(F.struct("copy", "shard"))).alias("dealt"))
        .select("place", "block", F.col("dealt.shard").alias("dealt"))
    )
    decided = blocks.drop("left").join(dealt, ["place", "block"], "left")
    last = placed.join(blocks.where("last").select("place", "block", "left"), ["place", "block"])
    taken = F.col("full") + (F.col("whole") | F.col("settled").isNotNull()).cast("int")
    return (
        placed.drop("full", "rest")
        .join(decided, ["place", "block"])
        .join(_fitting(last), ["place", "key"], "left")
        .withColumn("copies", taken)
        .select(
            *("key", "doc_id", "size", "source_size", "target", "copies"),
            (F.col("size") * F.col("copies")).alias("taken"),
            F.slice(F.coalesce("dealt", F.array().cast("array<int>")), F.lit(1), F.col("copies")).alias("shards"),
        )
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, **settings
) -> DataFrame:
    """The mixed rows themselves: ``doc`` (the row) and shard, shuffled within each shard.

    A row taken twice is there twice. Settings are those of ``mixture``.
    """
    taken = mixture(docs, doc_id, text, seed=seed, **settings).where("copies > 0")
    copies = settle(taken.select("key", "shards").dropDuplicates(["key"]), "copies")
    rows = docs.select(boxed(docs).alias("doc"), document_key(docs, doc_id, text, seed).alias("key"))
    each = rows.join(copies, "key").select("doc", "key", F.posexplode("shards").alias("copy", "shard"))
    return (
        each.withColumn("order", _code(seed, F.col("key"), F.col("copy")))
        .repartition("shard")
        .sortWithinPartitions("shard", "order")
        .select("doc", "shard")
    )
