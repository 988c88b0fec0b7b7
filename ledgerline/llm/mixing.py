"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is measured in words and cut into equal blocks of ``block_words``.  The blocks are dealt
to the sources as seats by highest quotients ``votes / (2k - 1)``; a source's blocks are dealt to
its shards the same way.  A shard holds about ``shard_words`` words, so a hot source is simply
many shards.  Inside a shard the documents stand in a seeded order, the line of their words is
cut into blocks, and the shard's quota takes whole rounds over the line and then the first blocks
of one more round.  A quota is held at ``cap`` rounds, so no document is taken more than ``cap``
times.  Everything is DataFrame work: per-document rows are shuffled once, on (source, shard).

Defined cases: a null text has size 0 and is never taken; null sources form one source, last in
order; a null or repeated doc_id is a row like any other (rows that agree in every column are
interchangeable); an empty table gives an empty result; other columns of ``docs`` are ignored.
The table of sources (one row each) is ranked in one task; documents never are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import checked_broadcast, staged, word_count

SEED = 20_240_607
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 20


def source_targets(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """(source, z) -> source, z, rank, target: weighted shares of sum(z), each at most cap * z.

    With sources in the order of cap*z/weight, the level that the weights share once the first
    i sources are full rises up to the first source that does not fill and falls after it, so
    the final level is the largest of them."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    by_need = Window.orderBy(F.col("need"), F.col("rank"))
    rest = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    full = by_need.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("z").over(everything) - F.coalesce(F.sum(F.lit(cap) * F.col("z")).over(full), F.lit(0.0))) / F.sum("w").over(rest)
    return (
        ranked.withColumn("w", w)
        .withColumn("need", F.lit(float(cap)) * F.col("z") / F.col("w"))
        .withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least(F.lit(float(cap)) * F.col("z"), F.col("level") * F.col("w")))
        .select("source", "z", "rank", "target")
    )


def apportion(votes: DataFrame, group: Sequence[str], key: str, seats: Column) -> DataFrame:
    """Sainte-Lague seats: ``votes`` has the group columns, ``key`` and ``votes``; ``seats`` is the
    group's number of seats.  Returns group columns, key, seats.  Ties go to the smaller key.

    With S keys, V votes and N seats, the rounded shares votes/d sum to at least N at the divisor
    V/(N + S/2) and to at most N at V/(N - S/2).  Only the quotients between the two are ranked:
    a few rows per key, whatever the number of seats."""
    over = Window.partitionBy(*group)
    half = F.count(F.lit(1)).over(over) / 2
    total = F.sum("votes").over(over)
    low = F.when(F.col("__n") > F.col("__half"), F.floor(F.col("votes") * (F.col("__n") - F.col("__half")) / F.col("__total") + 0.5) - 1)
    high = F.floor(F.col("votes") * (F.col("__n") + F.col("__half")) / F.col("__total") + 0.5) + 1
    spans = (
        votes.where("votes > 0")
        .select(*group, key, "votes", seats.cast("long").alias("__n"))
        .withColumn("__half", half)
        .withColumn("__total", total)
        .withColumn("__low", F.greatest(F.coalesce(low, F.lit(0)), F.lit(0)).cast("long"))
        .withColumn("__high", F.greatest(high.cast("long"), F.col("__low") + 1))
        .withColumn("__left", F.col("__n") - F.sum("__low").over(over))
    )
    quotients = spans.withColumn("__seat", F.explode(F.sequence("__low", "__high"))).withColumn(
        "__quotient", F.when(F.col("__seat") > F.col("__low"), F.col("votes") / (2 * F.col("__seat") - 1))
    )
    order = Window.partitionBy(*group).orderBy(F.col("__quotient").desc_nulls_last(), F.col(key), F.col("__seat"))
    won = (F.col("__quotient").isNotNull() & (F.row_number().over(order) <= F.col("__left"))).cast("long")
    return (
        quotients.withColumn("__won", won)
        .groupBy(*group, key)
        .agg((F.first("__low") + F.sum("__won")).alias("seats"))
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    cap: int = 3,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, quota_blocks, taken."""
    sized = staged(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"),
        ),
        "mix_sizes",
    )
    sources = staged(
        source_targets(sized.groupBy("source").agg(F.sum("size").alias("z")), weights, cap)
        .withColumn("shards", F.greatest(F.ceil(F.col("z") / shard_words), F.lit(1))),
        "mix_sources",
    )
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / block_words)
    won = apportion(
        sources.withColumn("all", F.lit(0)).withColumn("votes", F.col("target")).withColumn("blocks", blocks),
        ["all"], "rank", F.col("blocks"),
    ).select("rank", F.col("seats").alias("blocks"))
    sources = sources.join(won, "rank", "left").withColumn("blocks", F.coalesce("blocks", F.lit(0)))
    sources = checked_broadcast(staged(sources, "mix_blocks")).withColumnRenamed("source", "source_name")
    placed = (
        sized.join(sources, sized["source"].eqNullSafe(sources["source_name"]))
        .withColumn("shard", F.pmod("h", F.col("shards")))
        .drop("source_name")
    )
    shards = placed.groupBy("rank", "shard").agg(F.sum("size").alias("votes"), F.first("blocks").alias("blocks"))
    quotas = apportion(shards, ["rank"], "shard", F.col("blocks")).withColumnRenamed("seats", "quota_blocks")
    line = Window.partitionBy("rank", "shard")
    order = line.orderBy("h", "doc_id", "size")
    end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    extra = F.greatest(F.lit(0), F.least(F.col("end"), F.col("over")) - (F.col("end") - F.col("size")))
    return (
        placed.join(quotas, ["rank", "shard"], "left")
        .withColumn("quota_blocks", F.coalesce("quota_blocks", F.lit(0)))
        .withColumn("end", end)
        .withColumn("line", F.sum("size").over(line))
        .withColumn("quota", F.least(F.col("quota_blocks") * block_words, F.col("line") * cap))
        .withColumn("rounds", F.when(F.col("line") > 0, F.floor(F.col("quota") / F.col("line"))).otherwise(F.lit(0)))
        .withColumn("over", F.col("quota") - F.col("rounds") * F.col("line"))
        .select(
            "doc_id",
            "source",
            "size",
            F.col("z").alias("source_size"),
            "target",
            "quota_blocks",
            (F.col("rounds") * F.col("size") + extra).cast("long").alias("taken"),
        )
    )
