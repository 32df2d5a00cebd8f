"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree (SQL functions only).

Targets are water-filled: every source gets its weight's share of the wanted total, none more than
`most` times its size, and what is cut off is shared again by weight.  A source is taken in whole
epochs; the remainder is drawn as disjoint blocks in permuted order, and of the block at the border
the first documents in hash order.  The drawn blocks of all sources are then dealt to output shards
by a binary tree: each node gives a simple random sample of its blocks, of exactly the left half's
capacity, to the left child.  The counts per source in the children are therefore multivariate
hypergeometric, and the quotas of the sources stay exact.  Within a shard the documents are ordered
by a hash.

Blocks number about the square root of a source's documents, so the tables of blocks and the tree stay
small, and no window holds more than one source's blocks or one block's documents.  Documents meet
their blocks in a join on (source, block), which splits hot sources.

Defined results: NULL text has size 0 and is never short of its target; NULL is a source of its own,
sorted last; an empty table gives an empty result; repeated rows are drawn together; a column of the
input that is named like the result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilframe.llm.frames import WORD, pick, small
from vigilframe.session import materialize

DOCS_A_BLOCK = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """(source, n, source_size) -> the same and `target`; weights repeat over the sources in code-point order."""
    by_rank = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("w", F.element_at(cycle, (F.row_number().over(by_rank) - 1) % len(weights) + 1))
    ranked = ranked.withColumn("fill", most * F.col("source_size") / F.col("w"))
    # With the sources in the order of the level at which they are full, the level that all others reach is known
    # as soon as one of them, filled to it, would not be full.
    order = Window.orderBy("fill", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = ranked.withColumn("wanted", share * F.sum("source_size").over(everything)).withColumn(
        "level",
        (F.col("wanted") - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)),
    )
    level = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "level"))).over(everything)["level"]
    full = most * F.col("source_size")
    return levels.withColumn("target", F.least(F.coalesce(level * F.col("w"), full), full)).select(
        "source", "n", "source_size", "target")


def deal(draws: DataFrame, shards: int, seed: str) -> DataFrame:
    """Give each draw (source, block, copy) a shard by the splitting tree; shards differ by one block at most."""
    tree = draws.withColumns({"low": F.lit(0), "high": F.lit(shards), "node": F.lit(1)})
    level = 0
    while 1 << level < shards:
        key = F.xxhash64(F.lit(f"{seed}-{level}"), "node", "source", "block", "copy")
        within = Window.partitionBy("node")
        middle = F.floor((F.col("low") + F.col("high") + 1) / 2).cast("int")
        room = F.round(F.count(F.lit(1)).over(within) * (middle - F.col("low")) / (F.col("high") - F.col("low")))
        order = within.orderBy(key, "source", "block", "copy")
        tree = tree.withColumns({"left": F.row_number().over(order) <= room, "middle": middle}).withColumns({
            "node": F.when(F.col("left"), F.col("node") * 2).otherwise(F.col("node") * 2 + 1),
            "high": F.when(F.col("left"), F.col("middle")).otherwise(F.col("high")),
            "low": F.when(F.col("left"), F.col("low")).otherwise(F.least("middle", F.col("high") - 1)),
        })
        level += 1
    return tree.select("source", "block", "copy", F.col("low").alias("shard"), "cut")


def mix_sources(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", size: str = "size", weights=(3, 1, 2),
    share: float = 1.5, most: float = 2.0, shards: int = 16, seed: str = "mix", into: str = "mix",
) -> DataFrame:
    """Add a struct `into` (source_size, target, draws): each draw is one use of the whole document in the mix.

    `size` names a column of non-negative whole numbers.  A draw holds its copy number, its shard and its place
    in the shard; see `mixed` for the mix itself.
    """
    order = F.xxhash64(F.lit(f"{seed}-order"), F.col(f"`{doc_id}`"), F.col(f"`{size}`"))
    base = materialize(pick(docs, source=source, size=size, doc=doc_id).select(
        "source", "size", F.xxhash64(F.lit(f"{seed}-block"), "doc").alias("spot"),
        F.xxhash64(F.lit(f"{seed}-order"), "doc", "size").alias("order")), "mix-base")
    totals = base.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    targets = source_targets(totals, list(weights), share, most).withColumns({
        "blocks": F.greatest(F.lit(1), F.least(F.ceil(F.col("n") / DOCS_A_BLOCK), F.ceil(F.sqrt("n")))),
        "epochs": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0),
    }).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    targets = materialize(targets, "mix-targets")
    placed = base.join(small(targets), base.source.eqNullSafe(targets.source)).select(
        targets.source, "size", "order", F.pmod("spot", "blocks").alias("block"), "epochs", "rest")
    blocks = placed.groupBy("source", "block", "epochs", "rest").agg(F.sum("size").alias("words"))
    permuted = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(f"{seed}-permute"), "source", "block"), "block")
    blocks = blocks.withColumn("before", F.sum("words").over(permuted) - F.col("words"))
    quota = F.col("rest") - F.col("before")
    blocks = materialize(blocks.select(
        "source", "block", "epochs", "words",
        F.least(F.greatest(quota, F.lit(0.0)), F.col("words").cast("double")).alias("quota")), "mix-blocks")

    border = blocks.filter("quota > 0 AND quota < words").select("source", "block", "quota")
    here = placed.alias("p").join(
        small(border).alias("b"), (F.col("p.block") == F.col("b.block")) & F.col("p.source").eqNullSafe(F.col("b.source"))
    ).select("p.source", "p.block", "p.order", "p.size", "quota")
    running = F.sum("size").over(Window.partitionBy("source", "block").orderBy("order").rangeBetween(
        Window.unboundedPreceding, 0))
    cuts = here.withColumn("reached", running).filter(F.col("reached") - F.col("size") / 2 <= F.col("quota")).groupBy(
        "source", "block").agg(F.max("order").alias("cut"))

    b, c = blocks.alias("b"), cuts.alias("c")
    drawn = b.join(c, (F.col("b.block") == F.col("c.block")) & F.col("b.source").eqNullSafe(F.col("c.source")), "left").select(
        "b.source", "b.block", "epochs", "cut",
        (F.col("epochs") + F.when(F.col("quota") >= F.col("words"), F.col("words") > 0).otherwise(F.col("cut").isNotNull()).cast("int")).alias("uses"),
        ((F.col("quota") > 0) & (F.col("quota") < F.col("words"))).alias("partial"))
    draws = drawn.filter("uses > 0").select(
        "source", "block", F.explode(F.sequence(F.lit(0), F.col("uses").cast("int") - 1)).alias("copy"), "cut", "partial", "epochs")
    draws = draws.select("source", "block", "copy", F.when(F.col("partial") & (F.col("copy") == F.col("epochs")), F.col("cut")).alias("cut"))
    dealt = deal(draws, shards, seed).groupBy("source", "block").agg(
        F.sort_array(F.collect_list(F.struct("copy", "shard", "cut"))).alias("uses"))
    dealt = materialize(dealt, "mix-draws")

    t, u = targets.alias("t"), dealt.alias("u")
    rows = docs.drop(into) if into in docs.columns else docs
    rows = rows.select(F.struct(*[F.col(f"`{x}`") for x in rows.columns]).alias("doc"), F.col(f"`{source}`").alias("s"),
                       order.alias("o"), F.xxhash64(F.lit(f"{seed}-block"), F.col(f"`{doc_id}`")).alias("spot"),
                       F.col(f"`{doc_id}`").alias("id"))
    rows = rows.join(small(targets).alias("t"), F.col("s").eqNullSafe(F.col("t.source"))).withColumn(
        "at", F.pmod("spot", F.col("t.blocks")))
    rows = rows.join(small(dealt).alias("u"), (F.col("at") == F.col("u.block")) & F.col("s").eqNullSafe(F.col("u.source")), "left")
    kept = F.filter(F.coalesce(F.col("uses"), F.array().cast("array<struct<copy:int,shard:int,cut:bigint>>")),
                    lambda x: x["cut"].isNull() | (F.col("o") <= x["cut"]))
    placed_at = F.transform(kept, lambda x: F.struct(
        x["copy"].alias("copy"), x["shard"].alias("shard"),
        F.xxhash64(F.lit(f"{seed}-place"), x["shard"], x["copy"], F.col("id")).alias("place")))
    return rows.select("doc.*", F.struct("source_size", "target", placed_at.alias("draws")).alias(into))


def mixed(docs: DataFrame, into: str = "mix") -> DataFrame:
    """The mix: one row per draw, dealt by shard and ordered by place in it (write with `partitionBy("shard")`)."""
    rows = docs.withColumn("draw", F.explode(f"{into}.draws")).select(
        *[c for c in docs.columns if c not in (into, "shard", "place", "draw")], "draw.shard", "draw.place")
    return rows.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place")
