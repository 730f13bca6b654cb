"""Hard negatives by exact search over lists that clusters of anchors share.

Anchors are clustered by direction.  For a cluster, no member's product with a candidate
exceeds its own length times the candidate's length times the cosine of the angle between the
candidate and the cluster's centre, less the widest angle of a member.  Candidates are sorted
by that bound once, and every member walks the same list until the bound of what is left
proves that nothing on it can enter its result.  So nothing is lost, whatever the clusters are like.

Candidates are dealt to shards by hash and anchors to blocks of a cluster, both of bounded
size; a pair of one shard and one block is a task's unit, and a task returns a few rows per
anchor.  The first walk finds the positives, the second one the negatives for their scores.
Clusters that are wide, as random directions give, prove little: then the walk is long, and
the work is that of all anchors against all rows, in blocks.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from centigram.llm.common import cut, prepare

#: Every so many-th id is an anchor; positives and negatives wanted; scale of a component.
ANCHOR_EVERY, POSITIVES, NEGATIVES, SCALE = 100, 5, 10, 256.0
#: Rows whose id this divides take the next of LABELS labels.
RELABEL_EVERY, LABELS = 7, 10
#: Negative scores in hundredths of the positive's.
LOW, HIGH = 30, 90
#: Candidates of a shard and anchors of a block, at most; first and longest piece of a list read at once.
SHARD_ROWS, BLOCK_ANCHORS = 16_384, 2_048
PIECE, LONGEST = 256, 4_096
#: Anchors (per vector length) that the clusters are fitted on, anchors a cluster, most clusters, rounds.
FIT_ANCHORS, CLUSTER_ANCHORS, CLUSTERS, ROUNDS = 10_000, 256, 64, 8
#: Squared length up to which all products fit 64 bits, and up to which doubles add them exactly.
WIDEST, EXACT = float(1 << 62), float(1 << 53)


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, width, vec) of the rows that take part, one per vec_id."""
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("double"))
    real = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    square = F.aggregate("scaled", F.lit(0.0), lambda total, x: total + x * x)
    moved = (F.col("vec_id") % RELABEL_EVERY) == 0
    return (
        embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & real)
        .select("vec_id", F.when(moved, (F.col("label") + 1) % LABELS).otherwise(F.col("label")).cast("long").alias("label"), scaled.alias("scaled"))
        .where(square <= WIDEST)
        .select("vec_id", F.struct("label", F.transform("scaled", lambda x: x.cast("long")).alias("vec")).alias("row"))
        .groupBy("vec_id")
        .agg(F.min("row").alias("row"))
        .select("vec_id", "row.label", F.size("row.vec").alias("width"), "row.vec")
    )


def matrix(table: pa.Table | pa.RecordBatch, column: str = "vec") -> np.ndarray:
    """A list column of equal lengths as rows of integers."""
    flat = table.column(column)
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    small = {k: a.astype(np.int16) if a.size and a.dtype == np.int64 and k == "vec" and np.abs(a).max() < 1 << 15 else a for k, a in arrays.items()}
    np.savez(out, **small)
    return out.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as held:
        return {k: held[k].astype(np.int64) if k == "vec" else held[k] for k in held.files}


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))


def directions(x: np.ndarray) -> np.ndarray:
    """Unit vectors; a zero vector stays zero."""
    return x / np.maximum(lengths(x), 1e-300)[:, None]


def centres(x: np.ndarray, count: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means: centres of directions, from spread out first ones."""
    unit = directions(x)
    picked, nearest = [0], unit @ unit[0]
    while len(picked) < count:
        picked.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[picked[-1]])
    centre = unit[picked].copy()
    for _ in range(rounds):
        of = np.argmax(unit @ centre.T, axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, of, unit)
        filled = np.bincount(of, minlength=count) > 0
        centre[filled] = directions(total[filled])
    return centre


def clustered(anchors: DataFrame) -> DataFrame:
    """anchors with the `number` of their block, from 0 for each width, and how many there are.

    A block holds anchors of one cluster, about BLOCK_ANCHORS at most.  A cluster's anchors are
    dealt to its blocks by hash, so a number may stay empty.
    """
    by_hash = Window.partitionBy("width").orderBy(F.xxhash64("vec_id"), "vec_id")
    sample = anchors.withColumn("turn", F.row_number().over(by_hash)).where(F.col("turn") <= FIT_ANCHORS)

    def fit(key, table):
        x = matrix(table.sort_by("turn"))
        found = centres(x, max(1, min(CLUSTERS, len(x) // CLUSTER_ANCHORS)))
        return pa.table({"width": pa.array([key[0].as_py()], pa.int32()), "centres": pa.array([found.tobytes()], pa.binary())})

    fitted = cut(sample.select("width", "turn", "vec").groupBy("width").applyInArrow(fit, "width int, centres binary"))
    joined = anchors.join(fitted, "width").repartition("vec_id")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = []
            for vec, data in zip(batch.column("vec").to_pylist(), batch.column("centres").to_pylist(), strict=True):
                held = np.frombuffer(data, np.float64).reshape(-1, len(vec)) if vec else np.zeros((1, 0))
                cluster.append(int(np.argmax(held @ np.array(vec, np.float64))))
            names = ["vec_id", "label", "width", "vec"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(cluster, pa.int32())], names=[*names, "cluster"])

    named = joined.select("vec_id", "label", "width", "vec", "centres").mapInArrow(assign, "vec_id long, label long, width int, vec array<long>, cluster int")
    named = cut(named)
    sizes = named.groupBy("width", "cluster").agg(F.ceil(F.count(F.lit(1)) / int(BLOCK_ANCHORS * 0.9)).cast("int").alias("blocks"))
    whole = Window.partitionBy("width")  # a row per cluster, CLUSTERS at most
    before = whole.orderBy("cluster").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumns({"base": F.coalesce(F.sum("blocks").over(before), F.lit(0)), "numbers": F.sum("blocks").over(whole)})
    dealt = F.col("base") + F.pmod(F.xxhash64("vec_id", F.lit(47)), F.col("blocks"))
    return named.join(sizes, ["width", "cluster"]).select(
        "vec_id", "label", "width", "vec", dealt.cast("int").alias("number"), F.col("numbers").cast("int").alias("numbers")
    )


class Walk:
    """A list of candidates in the order of a cluster's bound, and the cluster's members."""

    def __init__(self, members: np.ndarray, candidates: np.ndarray) -> None:
        self.members = members
        unit, reach = directions(members), lengths(members)
        centre = directions(unit.sum(axis=0, keepdims=True))[0]
        widest = np.arccos(np.clip(unit[reach > 0] @ centre, -1, 1)).max(initial=0.0)
        size = lengths(candidates)
        angle = np.arccos(np.clip(directions(candidates) @ centre, -1, 1))
        # Angles are good to about 1e-8; the bound gives way by more, so rounding loses nothing.
        bound = size * (np.cos(np.maximum(0.0, angle - widest)) + 1e-6)
        self.order = np.argsort(-bound, kind="stable")
        self.bound = bound[self.order]
        self.list = candidates[self.order]
        self.reach = reach
        kind = np.float64 if reach.max(initial=0.0) * size.max(initial=0.0) <= EXACT else np.int64
        self.exact_members, self.exact_list = members.astype(kind), self.list.astype(kind)

    def pieces(self, going: np.ndarray) -> Iterator[tuple[np.ndarray, slice, np.ndarray, np.ndarray]]:
        """(active members, piece of the list, their products, each member's bound on the rest), while any is going."""
        start, length = 0, PIECE
        while start < len(self.order) and going.any():
            active = np.flatnonzero(going)
            piece = slice(start, min(start + length, len(self.order)))
            scores = (self.exact_members[active] @ self.exact_list[piece].T).astype(np.int64)
            left = self.bound[min(piece.stop, len(self.order) - 1)]
            yield active, piece, scores, self.reach[active] * left + 1e-6
            start, length = piece.stop, min(2 * length, LONGEST)


def best(ids: np.ndarray, scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Highest scores first, ties by the smaller id."""
    order = np.lexsort((ids, -scores))[:most]
    return ids[order], scores[order]


NOTHING = (np.zeros(0, np.int64), np.zeros(0, np.int64))


def walk_positives(block: dict, shard: dict, most: int = POSITIVES) -> Iterator[tuple[int, int, int]]:
    """(anchor, id, score) of each member's best rows of its own label in one shard."""
    walk = Walk(block["vec"], shard["vec"])
    ids, labels = shard["ids"][walk.order], shard["labels"][walk.order]
    n = len(block["ids"])
    kept = [NOTHING] * n
    least, going = np.full(n, np.iinfo(np.int64).min), np.ones(n, bool)
    for active, piece, scores, rest in walk.pieces(going):
        hit = (scores >= least[active, None]) & (labels[piece] == block["labels"][active, None]) & (ids[piece] != block["ids"][active, None])
        for j in np.flatnonzero(hit.any(axis=1)).tolist():
            k, at = active[j], np.flatnonzero(hit[j])
            kept[k] = best(np.append(kept[k][0], ids[piece][at]), np.append(kept[k][1], scores[j, at]), most)
            if len(kept[k][1]) == most:
                least[k] = kept[k][1][-1]
        full = least[active] > np.iinfo(np.int64).min
        going[active[full & (least[active] > rest)]] = False
    for k in range(n):
        yield from ((int(block["ids"][k]), int(i), int(s)) for i, s in zip(*kept[k], strict=True))


def walk_negatives(block: dict, shard: dict, most: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> Iterator[tuple[int, int, int, int, int]]:
    """(anchor, positive, positive score, id, score) of each pair's best rows of other labels in range, in one shard."""
    walk = Walk(block["vec"], shard["vec"])
    ids, labels = shard["ids"][walk.order], shard["labels"][walk.order]
    scores_of = block["scores"]  # a row per member; -1 where it has fewer positives or a negative score, for which no range exists
    n, wide = scores_of.shape
    # Python's integers: a hundredfold may pass 64 bits.
    floor = np.array([[-(-low * p // 100) for p in row] for row in scores_of.tolist()], np.int64).reshape(n, wide)
    ceiling = np.array([[high * p // 100 for p in row] for row in scores_of.tolist()], np.int64).reshape(n, wide)
    open_pair = scores_of >= 0
    least = np.where(open_pair, floor, np.iinfo(np.int64).max)
    kept = {}
    going = open_pair.any(axis=1)
    ceiling = np.where(open_pair, ceiling, np.iinfo(np.int64).min)
    for active, piece, scores, rest in walk.pieces(going):
        hit = (scores >= least[active].min(axis=1)[:, None]) & (scores <= ceiling[active].max(axis=1)[:, None]) & (labels[piece] != block["labels"][active, None])
        for j in np.flatnonzero(hit.any(axis=1)).tolist():
            k, at = active[j], np.flatnonzero(hit[j])
            s, i = scores[j, at], ids[piece][at]
            for q in np.flatnonzero(open_pair[k]).tolist():
                fit = (s >= least[k, q]) & (s <= ceiling[k, q])
                if fit.any():
                    old = kept.get((k, q), NOTHING)
                    kept[k, q] = best(np.append(old[0], i[fit]), np.append(old[1], s[fit]), most)
                    if len(kept[k, q][1]) == most:
                        least[k, q] = kept[k, q][1][-1]
        # A pair is settled when the rest cannot reach its range, or the worst of its full list.
        open_pair[active] &= least[active] <= rest[:, None]
        least[~open_pair] = np.iinfo(np.int64).max
        ceiling[~open_pair] = np.iinfo(np.int64).min
        going[active] = open_pair[active].any(axis=1)
    for (k, q), (i, s) in kept.items():
        spot = (int(block["ids"][k]), int(block["positives"][k, q]), int(scores_of[k, q]))
        yield from ((*spot, int(a), int(b)) for a, b in zip(i, s, strict=True))


def meet(shards: DataFrame, blocks: DataFrame, walk: Callable, schema: str) -> DataFrame:
    """What walk returns for every shard with every block of vectors of its length.

    Both sides are a row per shard or block; each is told the numbers of the other side, and they
    meet by (width, shard, number), so no key holds more than one pair.
    """
    left = shards.join(blocks.groupBy("width").agg(F.max("numbers").alias("numbers")), "width")
    right = blocks.join(shards.groupBy("width").agg(F.max("shards").alias("shards")), "width")
    left = left.select("width", "shard", "shard_data", F.explode(F.sequence(F.lit(0), F.col("numbers") - 1)).alias("number"))
    right = right.select("width", "number", "block_data", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    names = [field.split()[0] for field in schema.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column("block_data"), batch.column("shard_data"), strict=True):
                rows = list(walk(unpacked(a.as_py()), unpacked(b.as_py())))
                columns = zip(*rows, strict=True) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return left.join(right, ["width", "shard", "number"]).select("block_data", "shard_data").mapInArrow(each, schema)


def sharded(rows: DataFrame, shard_rows: int) -> DataFrame:
    """(width, shard, shards, shard_data): candidates dealt by hash, a row per shard; a shard may stay empty."""
    sizes = rows.groupBy("width").agg(F.ceil(F.count(F.lit(1)) / int(shard_rows * 0.9)).cast("int").alias("shards"))
    dealt = rows.join(sizes, "width").withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(53)), F.col("shards")).cast("int"))

    keys = ["width", "shard", "shards"]

    def pack(key, table):
        data = packed(ids=table.column("vec_id").to_numpy(), labels=table.column("label").to_numpy(), vec=matrix(table))
        spot = {n: pa.array([k.as_py()], pa.int32()) for n, k in zip(keys, key, strict=True)}
        return pa.table(spot | {"shard_data": pa.array([data], pa.binary())})

    made = dealt.select(*keys, "vec_id", "label", "vec").groupBy(*keys).applyInArrow(pack, "width int, shard int, shards int, shard_data binary")
    return cut(made)


def blocked(anchors: DataFrame, extra: list[str]) -> DataFrame:
    """(width, number, numbers, block_data): anchors of a block in one row, with other columns of arrays of longs."""
    keys = ["width", "number", "numbers"]

    def pack(key, table):
        more = {c: matrix(table, c) for c in extra}
        data = packed(ids=table.column("vec_id").to_numpy(), labels=table.column("label").to_numpy(), vec=matrix(table), **more)
        spot = {n: pa.array([k.as_py()], pa.int32()) for n, k in zip(keys, key, strict=True)}
        return pa.table(spot | {"block_data": pa.array([data], pa.binary())})

    made = anchors.select(*keys, "vec_id", "label", "vec", *extra).groupBy(*keys).applyInArrow(pack, "width int, number int, numbers int, block_data binary")
    return cut(made)


def mine(embeddings: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    A row without a vec_id, a label or a vector, or with a component that is null or not finite, takes
    no part; nor does one whose squared scaled length passes 2 ** 62, for its scores would not fit
    64 bits.  Only vectors of one length have a score.  A vec_id stands for one row: of repeated
    ones, the one with the least label, then vector, counts.  Ties go to the smaller vec_id.
    Anchors without positives, and positives without negatives in range (all with a negative
    score), give no row.  An empty table gives an empty result.
    """
    prepare(embeddings.sparkSession)
    rows = cut(usable(embeddings.select("vec_id", "embedding", "label")))
    shards = sharded(rows, shard_rows)
    anchors = cut(clustered(rows.where(F.col("vec_id") % ANCHOR_EVERY == 0)))
    near = meet(shards, blocked(anchors, []), walk_positives, "anchor_id long, positive_id long, score long")
    place = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    near = near.withColumn("place", F.row_number().over(place)).where(F.col("place") <= POSITIVES)
    # Each anchor's positives side by side, filled up to POSITIVES.
    listed = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "score"))).alias("near"))
    filled = [F.coalesce(F.get("near", F.lit(k)).getField("score"), F.lit(-1)) for k in range(POSITIVES)]
    named = [F.coalesce(F.get("near", F.lit(k)).getField("positive_id"), F.lit(-1)) for k in range(POSITIVES)]
    asking = anchors.join(listed, "vec_id").withColumns({"scores": F.array(*filled), "positives": F.array(*named)})
    far = meet(
        shards, blocked(asking, ["scores", "positives"]), walk_negatives,
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEGATIVES)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
