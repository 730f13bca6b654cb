"""Embedding near-duplicates: a small-world graph per shard, searched by every vector.

Vectors with a label are made unit vectors; equal ones are one class.  The classes of a label
are dealt by hash to shards of bounded size.  Each shard builds a hierarchical navigable
small-world graph, and every class of the label searches every shard's graph, in blocks of
bounded size.  A search widens its beam until the worst vector in it is below the threshold,
so it ends past the whole neighbourhood; audits compare sampled searches with all vectors of
the shard and double the least beam until they pass.  Cosines of what a search returns are
computed in double precision.  Links leave a task as counts and as a spanning forest, never as
all pairs, and the forests are united into components.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centigram.llm.common import components, cut, prepare

THRESHOLD = 0.93
#: Most classes in a shard and in a block of searches.
SHARD_ROWS = 8_192
BLOCK_ROWS = 2_048
#: Links a node keeps (twice as many on the ground layer), beam while building, first beam.
LINKS, BUILD_BEAM, FIRST_BEAM = 12, 48, 48
#: Searches that an audit compares with all vectors, and the recall that it asks for.
AUDITS, RECALL = 64, 0.999


class Graph:
    """A navigable small-world graph over rows of unit vectors."""

    def __init__(self, x: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM, seed: int = 1) -> None:
        n = len(x)
        self.x = x
        self.links, self.beam = links, beam
        draws = np.random.default_rng(seed).random(n)
        self.level = np.minimum((-np.log(np.maximum(draws, 1e-12)) / np.log(links)).astype(np.int64), 8)
        self.layers = [np.full((n, links * (2 if k == 0 else 1)), -1, np.int32) for k in range(int(self.level.max(initial=0)) + 1)]
        self.seen = np.zeros(n, np.int64)
        self.stamp = 0
        self.entry, self.top = 0, -1
        for node in range(n):
            self.insert(node)

    def search(self, q: np.ndarray, start: list[int], beam: int, layer: int, floor: float = 2.0) -> list[tuple[float, int]]:
        """The beam, best first: as wide as asked, and wider while its worst is above floor.

        Unexpanded members of the beam are expanded together, a wave at a time.
        """
        self.stamp += 1
        ids = np.array(start, np.int64)
        self.seen[ids] = self.stamp
        sims = self.x[ids] @ q
        todo = np.ones(len(ids), bool)
        table = self.layers[layer]
        while todo.any():
            near = table[ids[todo]].ravel()
            todo[:] = False
            near = near[near >= 0]
            near = near[self.seen[near] != self.stamp]
            if not len(near):
                break
            near = np.unique(near)
            self.seen[near] = self.stamp
            new = self.x[near] @ q
            ids, sims = np.concatenate([ids, near]), np.concatenate([sims, new])
            todo = np.concatenate([todo, np.ones(len(near), bool)])
            if len(ids) > beam:
                worst = np.partition(sims, len(sims) - beam)[len(sims) - beam]
                keep = sims >= min(worst, floor)
                ids, sims, todo = ids[keep], sims[keep], todo[keep]
        order = np.argsort(-sims, kind="stable")
        return list(zip(sims[order].tolist(), ids[order].tolist(), strict=True))

    def spread(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours nearer to the node than to each other, then the nearest of the rest."""
        ids = [i for _, i in found]
        if len(ids) <= most:
            return ids
        chosen: list[int] = []
        left: list[int] = []
        between = self.x[ids] @ self.x[ids].T
        place = {i: k for k, i in enumerate(ids)}
        for s, i in found:
            if len(chosen) >= most:
                break
            if all(between[place[i], place[j]] < s for j in chosen):
                chosen.append(i)
            else:
                left.append(i)
        return chosen + left[: most - len(chosen)]

    def insert(self, node: int) -> None:
        level = int(self.level[node])
        if self.top < 0:
            self.entry, self.top = node, level
            return
        q, start = self.x[node], [self.entry]
        for layer in range(self.top, level, -1):
            start = [self.search(q, start, 1, layer)[0][1]]
        for layer in range(min(level, self.top), -1, -1):
            found = [f for f in self.search(q, start, self.beam, layer) if f[1] != node][: self.beam]
            table = self.layers[layer]
            mine = self.spread(found, self.links)
            table[node, : len(mine)] = mine
            for other in mine:
                row = table[other]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = node
                else:
                    ids = np.append(row, node).astype(np.int64)
                    sims = self.x[ids] @ self.x[other]
                    order = np.argsort(-sims, kind="stable")
                    kept = self.spread([(float(sims[k]), int(ids[k])) for k in order], len(row))
                    row[:] = -1
                    row[: len(kept)] = kept
            start = [i for _, i in found[:4]]
        if level > self.top:
            self.entry, self.top = node, level

    def around(self, q: np.ndarray, floor: float, beam: int) -> list[int]:
        """Nodes found with similarity of at least about floor."""
        start = [self.entry]
        for layer in range(self.top, 0, -1):
            start = [self.search(q, start, 4, layer)[0][1]]
        return [i for s, i in self.search(q, start, beam, 0, floor - 1e-4) if s >= floor - 1e-4]

    def audited(self, floor: float, beam: int = FIRST_BEAM, audits: int = AUDITS, recall: float = RECALL) -> int:
        """The least beam whose sampled searches find the asked share of the true neighbours."""
        n = len(self.x)
        picked = np.random.default_rng(3).permutation(n)[:audits]
        near = [np.flatnonzero(self.x @ self.x[k] >= floor) for k in picked]
        total = sum(map(len, near))
        while beam < n:
            hit = sum(len(np.intersect1d(self.around(self.x[k], floor, beam), want)) for k, want in zip(picked, near, strict=True))
            if hit >= recall * total:
                break
            beam *= 2
        return beam

    def packed(self, beam: int) -> bytes:
        out = io.BytesIO()
        np.savez(out, x=self.x, head=np.array([self.entry, self.top, beam]), **{f"l{k}": t for k, t in enumerate(self.layers)})
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> tuple[Graph, int]:
        held = np.load(io.BytesIO(data))
        graph = cls.__new__(cls)
        graph.x = held["x"]
        graph.entry, graph.top, beam = (int(v) for v in held["head"])
        graph.layers = [held[f"l{k}"] for k in range(graph.top + 1)]
        graph.seen, graph.stamp = np.zeros(len(graph.x), np.int64), 0
        return graph, beam


def vectors_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.stack([np.asarray(v, np.float64) for v in flat.to_pylist()]) if len(flat) else np.zeros((0, 0))


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, width, unit) of every vector.

    unit is null unless the vector can link: labelled, finite, not zero and without nulls.
    """
    values = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    square = F.aggregate("w", F.lit(0.0), lambda a, x: a + x * x)
    return (
        embeddings.select("vec_id", "label", values.alias("v"))
        .withColumn("big", F.when(F.col("label").isNotNull() & finite, F.array_max(F.transform("v", F.abs))))
        .withColumn("w", F.when(F.col("big") > 0, F.transform("v", lambda x: x / F.col("big"))))  # squares stay in range
        .withColumn("norm", F.sqrt(square))
        .select("vec_id", "label", F.size("v").alias("width"), F.transform("w", lambda x: x / F.col("norm") + 0.0).alias("unit"))
    )


class Forest:
    """A spanning forest of the links that a task has seen."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}
        self.edges: list[tuple[int, int]] = []

    def root(self, a: int) -> int:
        parent = self.parent
        parent.setdefault(a, a)
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    def add(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.edges.append((a, b))


def linked(classes: DataFrame, threshold: float, shard_rows: int, block_rows: int) -> DataFrame:
    """Rows (node, other, links): a class's links in one shard, or a forest edge to another."""
    space = ["label", "width"]
    sizes = classes.groupBy(*space).agg(F.count(F.lit(1)).alias("size"))
    parts = lambda rows: F.greatest(F.lit(1), F.ceil(F.col("size") / rows)).cast("int")
    sizes = sizes.select(*space, parts(int(shard_rows * 0.8)).alias("shards"), parts(int(block_rows * 0.8)).alias("blocks"))
    dealt = cut(
        classes.join(sizes, space)
        .withColumn("shard", F.pmod(F.xxhash64("node", F.lit(41)), F.col("shards")).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("node", F.lit(43)), F.col("blocks")).cast("int"))
    )

    def build(key, table):
        graph = Graph(vectors_of(table.column("unit")).astype(np.float32))
        beam = graph.audited(threshold)
        return pa.table(
            {
                "label": table.column("label").slice(0, 1),
                "width": table.column("width").slice(0, 1),
                "shard": table.column("shard").slice(0, 1),
                "blocks": table.column("blocks").slice(0, 1),
                "graph": pa.array([graph.packed(beam)], pa.large_binary()).cast(pa.binary()),
                "nodes": pa.array([table.column("node").to_pylist()], pa.list_(pa.int64())),
                "many": pa.array([table.column("many").to_pylist()], pa.list_(pa.int64())),
                "units": pa.array([vectors_of(table.column("unit")).tobytes()], pa.binary()),
            }
        )

    label = classes.schema["label"].dataType.simpleString()
    graphs = cut(
        dealt.select(*space, "shard", "blocks", "node", "many", "unit")
        .groupBy(*space, "shard")
        .applyInArrow(build, f"label {label}, width int, shard int, blocks int, graph binary, nodes array<long>, many array<long>, units binary")
    )
    asked = dealt.select(*space, "block", "node", "unit", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    offered = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def search(key, left, right):
        out: list[tuple[int, int | None, int]] = []
        forest = Forest()
        if left.num_rows and right.num_rows:
            graph, beam = Graph.unpacked(right.column("graph")[0].as_py())
            nodes = np.array(right.column("nodes")[0].as_py(), np.int64)
            many = np.array(right.column("many")[0].as_py(), np.int64)
            own = left.column("node").to_numpy()
            q = vectors_of(left.column("unit"))
            exact = np.frombuffer(right.column("units")[0].as_py(), np.float64).reshape(len(nodes), -1)
            for k in range(len(own)):
                near = np.array(graph.around(q[k].astype(np.float32), threshold, beam), np.int64)
                near = near[nodes[near] != own[k]]
                near = near[exact[near] @ q[k] >= threshold]
                if len(near):
                    out.append((int(own[k]), None, int(many[near].sum())))
                    for other in nodes[near].tolist():
                        forest.add(int(own[k]), other)
        out += ((a, b, 0) for a, b in forest.edges)
        node, other, links = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"node": pa.array(node, pa.int64()), "other": pa.array(other, pa.int64()), "links": pa.array(links, pa.int64())})

    keys = [*space, "shard", "block"]
    return asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInArrow(search, "node long, other long, links long")


def near_duplicates(
    embeddings: DataFrame, threshold: float = THRESHOLD, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector.

    Null, zero and not finite vectors, vectors with null components and vectors without a
    label link with nothing, nor do vectors of different lengths.  Equal vectors always link.
    Rows with a repeated vec_id are vectors of their own, each with the links and the component
    of its own vector.  A row without a vec_id links with nothing.  An empty table gives an
    empty result.
    """
    prepare(embeddings.sparkSession)
    units = cut(usable(embeddings).withColumn("unit", F.when(F.col("vec_id").isNotNull(), F.col("unit"))))
    classes = cut(
        units.where("unit IS NOT NULL")
        .groupBy("label", "width", "unit")
        .agg(F.min("vec_id").cast("long").alias("least"), F.count(F.lit(1)).alias("many"))
        # Named by what it is: a repeated vec_id may stand for several classes.
        .withColumn("node", F.xxhash64("label", "width", "unit"))
    )
    found = cut(linked(classes, threshold, shard_rows, block_rows))
    counts = found.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    members = classes.join(counts, "node", "left").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    heads = members.groupBy("component").agg(F.min("least").alias("head"))
    named = members.join(heads, "component").select(
        "label", "width", "unit", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("links"), "head"
    )
    return (
        units.join(named, ["label", "width", "unit"], "left")
        .select("vec_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("head", F.col("vec_id").cast("long")).alias("component_id"))
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )
