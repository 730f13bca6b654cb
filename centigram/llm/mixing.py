"""Mixing sources to target weights by a multivariate hypergeometric splitting tree.

Each source's documents fall into small blocks by a seeded hash, which is a random
permutation of the source.  A source that must give `goal` words gives whole passes over its
blocks and then blocks in permuted order until the goal is met, so its block quota is exact.
A binary tree over the output shards splits the vector of quotas: a node draws its left half
from the multivariate hypergeometric law with a generator seeded by the node, so any task can
rebuild any path and no state is shared.  A leaf's share is a range of positions in every
source's block sequence; ranges are disjoint.  Rows are shuffled within their shard by hash.

A hot source is only more blocks: no step gathers the rows of one source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from centigram.llm.common import cut

#: Fixed values of the contract.
WEIGHTS = (3, 1, 2)
TOTAL_PERCENT = 150
MOST_TIMES = 2
WORD = "[^\\x20\\x09-\\x0D]+"

#: Words that a task which writes drawn documents holds, and pieces of a shard; several pieces meet in a task.
TASK_WORDS = 4_000_000
PIECES = 64

BLOCK_DOCS = 256
SHARD_WORDS = 20_000_000
BLOCKS_A_GROUP = 1024
LEAVES_A_TASK = 256
SEED = 17


def sized(docs: DataFrame) -> DataFrame:
    """Columns that the plan needs; size is the number of words."""
    return docs.select(
        "doc_id",
        "source",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64("text").alias("text_key"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = TOTAL_PERCENT, most: int = MOST_TIMES) -> DataFrame:
    """One row per source: sid, source_size, n_docs, target and goal (target in whole words).

    Sources in code point order, null last, take the weights in turn.  The water level rises
    until the targets hold the total: sources whose cap lies below it get their cap, the rest
    level times weight.  Sorted by cap per weight, a source is capped if the level that would
    suit all from it onwards reaches its cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
        .withColumn("sid", F.row_number().over(by_name) - 1)
        .withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int")).cast("double"))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
    )
    rising = Window.orderBy(F.col("cap") / F.col("w"), "sid")
    whole = Window.partitionBy(F.lit(0))
    total = F.sum("source_size").over(whole) * (percent / 100)
    before = F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("w").over(rising.rowsBetween(0, Window.unboundedFollowing))
    level = (total - before) / left
    per = per.withColumn("level", level).withColumn("free", F.col("level") * F.col("w") < F.col("cap"))
    first = F.min(F.when(F.col("free"), F.struct((F.col("cap") / F.col("w")).alias("o"), "sid", "level"))).over(whole)
    return per.withColumn("water", first["level"]).select(
        "sid",
        "source",
        "source_size",
        "n_docs",
        F.least("cap", F.coalesce(F.col("water") * F.col("w"), F.col("cap"))).alias("target"),
    ).withColumn("goal", F.round("target").cast("long"))


def running(blocks: DataFrame) -> DataFrame:
    """words_before and rank of each block within its source, summed in two levels."""
    group = F.floor(F.col("block") / BLOCKS_A_GROUP).cast("long")
    blocks = blocks.withColumn("g", group)
    inner = Window.partitionBy("sid", "g").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("sid").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    groups = (
        blocks.groupBy("sid", "g")
        .agg(F.sum("words").alias("gw"), F.count(F.lit(1)).alias("gn"))
        .select("sid", "g", zero(F.sum("gw").over(outer)).alias("gw"), zero(F.sum("gn").over(outer)).alias("gn"))
    )
    return (
        blocks.withColumn("iw", zero(F.sum("words").over(inner)))
        .withColumn("n", zero(F.count(F.lit(1)).over(inner)))
        .join(groups, ["sid", "g"])
        .withColumn("words_before", F.col("iw") + F.col("gw"))
        .withColumn("rank", F.col("n") + F.col("gn"))
        .drop("iw", "n", "gw", "gn", "g")
    )


def leaves(quota: np.ndarray, shards: int, low: int, high: int, seed: int = SEED) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, starts, counts) of the leaves low <= shard < high of the splitting tree."""
    todo = [(0, shards, np.zeros(len(quota), np.int64), quota.astype(np.int64))]
    while todo:
        a, b, start, count = todo.pop()
        if b <= low or a >= high:
            continue
        if b - a == 1:
            yield a, start, count
            continue
        middle = (a + b) // 2
        total = int(count.sum())
        share = total * (middle - a) // (b - a)
        rng = np.random.default_rng([seed, a, b])
        left = rng.multivariate_hypergeometric(count, share, method="marginals") if total else count * 0
        todo += [(middle, b, start + left, count - left), (a, middle, start, left)]


def positions(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """(sid, position, shard) for every block draw."""
    tasks = -(-shards // LEAVES_A_TASK)
    schema = pa.schema([("sid", pa.int64()), ("shard", pa.int64()), ("start", pa.int64()), ("n", pa.int64())])

    def split(key, table):
        order = np.argsort(table.column("sid").to_numpy())
        sids = table.column("sid").to_numpy()[order]
        quota = table.column("quota").to_numpy()[order]
        low = key[0].as_py() * LEAVES_A_TASK
        rows = list(leaves(quota, shards, low, min(shards, low + LEAVES_A_TASK), seed))
        fields = (
            np.tile(sids, len(rows)),
            np.repeat([r[0] for r in rows], len(sids)),
            np.concatenate([r[1] for r in rows]),
            np.concatenate([r[2] for r in rows]),
        )
        return pa.table([pa.array(f, pa.int64()) for f in fields], schema=schema)

    return (
        quotas.select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"), F.col("sid").cast("long"), F.col("quota").cast("long"))
        .groupBy("task")
        .applyInArrow(split, "sid long, shard long, start long, n long")
        .where("n > 0")
        .select("sid", "shard", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("position"))
    )


def clamp(x: Column, top: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(x, top))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    percent: int = TOTAL_PERCENT,
    most: int = MOST_TIMES,
    whole_documents: bool = False,
    shard_words: int = SHARD_WORDS,
    block_docs: int = BLOCK_DOCS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document row: doc_id, source, text_key, size, source_size, target, taken, draws.

    draws lists (epoch, shard, words).  The one document on which a source's goal falls is
    drawn in part, or with whole_documents wholly or not at all, whichever is nearer.  Null
    texts have size 0 and are never drawn; a null source is a source; equal rows are equal
    documents; with no words at all every target is 0; an empty table gives an empty result.
    Results depend on the rows only, not on their order or partitions.
    """
    sizes = cut(sized(docs))
    per = cut(targets(sizes, weights, percent, most))
    words = per.agg(F.sum("goal")).first()[0] or 0
    shards = max(1, -(-words // shard_words))
    per = per.withColumn("n_blocks", F.ceil(F.col("n_docs") / block_docs)).withColumn(
        "full", F.when(F.col("source_size") > 0, F.floor(F.col("goal") / F.col("source_size"))).otherwise(F.lit(0).cast("long"))
    ).withColumn("rest", F.col("goal") - F.col("full") * F.col("source_size"))

    hashed = F.xxhash64(F.col("doc_id"), F.col("d.source"), F.lit(seed))
    placed = (
        sizes.alias("d")
        .join(per.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
        .select("doc_id", "d.source", "text_key", "size", "sid", "source_size", "target", "n_blocks", "full", "rest", hashed.alias("h"))
        .withColumn("block", F.floor(F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53)) * F.col("n_blocks")))
    )
    placed = cut(placed)
    blocks = cut(running(placed.groupBy("sid", "block").agg(F.sum("size").alias("words"), F.first("full").alias("full"), F.first("rest").alias("rest"))))
    used = (F.col("words_before") < F.col("rest")).cast("long")
    quotas = blocks.groupBy("sid").agg(
        F.sum(F.col("full") + used).alias("quota"), F.count(F.lit(1)).alias("in_source")
    )
    draws = (
        blocks.join(quotas.select("sid", "in_source"), "sid")
        .where((F.col("full") + used) > 0)
        .select("sid", "block", "in_source", "rank", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") + used - 1)).alias("epoch"))
        .select("sid", "block", "epoch", (F.col("epoch") * F.col("in_source") + F.col("rank")).alias("position"))
        .join(positions(quotas.where("quota > 0"), shards, seed), ["sid", "position"])
        .groupBy("sid", "block")
        .agg(F.collect_list(F.struct("epoch", "shard")).alias("places"))
    )
    before = F.coalesce(
        F.sum("size").over(Window.partitionBy("sid", "block").orderBy("h", "doc_id", "text_key", "size").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0).cast("long"),
    )
    left = F.col("rest") - F.col("words_before") - F.col("b")
    part = F.when(2 * left >= F.col("size"), F.col("size")).otherwise(F.lit(0).cast("long")) if whole_documents else clamp(left, F.col("size"))
    share = F.transform(
        F.array_sort("places"),
        lambda x: F.struct(x["epoch"].alias("epoch"), x["shard"].alias("shard"), F.when(x["epoch"] < F.col("full"), F.col("size")).otherwise(F.col("part")).alias("words")),
    )
    drawn = (
        placed.join(blocks.select("sid", "block", "words_before"), ["sid", "block"])
        .join(draws, ["sid", "block"], "left")
        .withColumn("b", before)
        .withColumn("part", part)
        .withColumn("draws", F.coalesce(F.filter(share, lambda x: x["words"] > 0), F.array().cast("array<struct<epoch:bigint,shard:bigint,words:bigint>>")))
    )
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    return drawn.select("doc_id", "source", "text_key", "size", "source_size", "target", taken.alias("taken"), "draws")


def mixed_documents(docs: DataFrame, mixed: DataFrame, seed: int = SEED) -> DataFrame:
    """The documents as drawn: a row per draw, sharded and shuffled within the shard.

    Equal rows pair off one to one with their plans.  A shard is dealt to tasks in pieces, each a
    range of its shuffled order, and the number of tasks follows the words that are drawn, so that
    a task holds about TASK_WORDS at any size.
    """
    key = ["doc_id", "text_key", "source_key"]
    twin = Window.partitionBy(*key).orderBy(F.lit(0))
    tasks = -(-(mixed.agg(F.sum("taken")).first()[0] or 0) // TASK_WORDS)
    plans = mixed.withColumn("source_key", F.xxhash64("source")).select(*key, "draws").withColumn("twin", F.row_number().over(twin))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.xxhash64("source").alias("source_key"))
    rows = rows.withColumn("twin", F.row_number().over(twin))
    same = [rows[c].eqNullSafe(plans[c]) for c in (*key, "twin")]
    drawn = rows.join(plans, same).select("row", rows["doc_id"].alias("id"), rows["text_key"].alias("text_key"), rows["twin"].alias("twin"), F.explode("draws").alias("draw"))
    # Rows without an id, or with one id, have places of their own by their text and number.
    shuffled = F.xxhash64("id", "text_key", "twin", "draw.epoch", "draw.shard", F.lit(seed))
    piece = F.floor((F.col("place") / F.lit(float(1 << 64)) + 0.5) * PIECES)
    return (
        drawn.withColumn("shard", F.col("draw.shard"))
        .withColumn("place", shuffled)
        .withColumn("piece", F.least(piece, F.lit(PIECES - 1).cast("long")))
        .repartition(max(1, tasks), "shard", "piece")
        .sortWithinPartitions("shard", "place", "id")
        .select("row.*")
    )
