"""Merkle manifest of a table: few levels are stored, the others are made again for proofs.

Every source has a tree over its rows in doc_id order, and one more tree stands over the
sources.  A parent is the hash of up to FAN consecutive nodes.  An aligned subtree of LEVELS
levels, FAN ** LEVELS nodes at most, is one row of the manifest: only its lowest nodes are
stored, and the node on its top is a lowest node of the next stored level.  A proof is
extracted from the top down.  Each subtree makes its missing nodes again from its stored
ones, emits the siblings that every stored node meets on its way up, adds the siblings that
came from the subtree above, and forgets the rest.

Rows find their place in a source by a range sort and counts per range, so a source that
holds a third of all rows is dealt over many tasks, and no task ever holds more than its range or
one subtree at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from centigram.llm.common import BATCH_ROWS, cut, discard, fold, prepare, shared_folder

#: Children of a node, and levels from one stored level to the next.
FAN = 3
LEVELS = 6
#: Columns that make a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree over the sources.
TOP = ""


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def part(value: Column) -> Column:
    """Byte count, colon and value; a dash for a null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """The hash of a row, of its own text or of another one in its place."""
    values = [F.col(c) for c in FIELDS[:-1]] + [F.col(FIELDS[-1]) if text is None else text]
    return F.sha2(F.concat(*map(part, values)), 256)


def tampered() -> Column:
    """The leaf of a row without its line feeds where crc32(doc_id) is even; rows without a doc_id stay."""
    changed = F.col("doc_id").isNotNull() & (fold("doc_id", 2) == 0)
    return F.when(changed, leaf(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).otherwise(leaf())


def depth(leaves: int) -> int:
    """Levels above the leaves of a tree; a lone leaf is its own root."""
    levels, width = 0, 1
    while width < leaves:
        levels, width = levels + 1, width * FAN
    return levels


def interior(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and the levels above them."""
    rows = [nodes]
    for _ in range(levels):
        below = rows[-1]
        rows.append([digest("".join(below[k : k + FAN])) for k in range(0, len(below), FAN)])
    return rows


def siblings(rows: list[list[str]], place: int) -> list[dict[str, str]]:
    """What stands left and right of the way up from one node, level by level."""
    steps = []
    for below in rows[:-1]:
        first = place - place % FAN
        steps.append({"left": "".join(below[first:place]), "right": "".join(below[place + 1 : first + FAN])})
        place //= FAN
    return steps


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows, with `place` (from 0, within `tree`) and `size` (rows of the tree), stored.

    Rows are sorted by range over all trees.  Each range counts its trees' rows on its own;
    counts of earlier ranges give what to add.
    """
    stored = cut(rows.withColumn("row", F.monotonically_increasing_id()))  # tells equal rows apart
    keys = ["tree", *order, "row"]
    sorted_rows = stored.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("range", F.spark_partition_id())
    kind = sorted_rows.withColumn("local", F.lit(0).cast("long")).schema

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, count = None, 0
        for batch in batches:
            local = []
            for t in batch.column("tree").to_pylist():
                if t != tree:
                    tree, count = t, 0
                local.append(count)
                count += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local, pa.int64())], names=[*batch.schema.names, "local"])

    numbered = cut(sorted_rows.mapInArrow(number, kind))
    counts = numbered.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("tree", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(whole).alias("size"))
    return numbered.join(starts, ["tree", "range"]).withColumn("place", F.col("start") + F.col("local")).drop("start", "local", "range", "row")


def subtrees(nodes: DataFrame, members: list[str]) -> DataFrame:
    """One row (tree, size, block, nodes) for each aligned run of FAN ** LEVELS nodes, in order."""
    block = F.floor(F.col("place") / F.lit(FAN**LEVELS)).cast("long")
    return (
        nodes.withColumn("block", block)
        .groupBy("tree", "size", "block")
        .agg(F.array_sort(F.collect_list(F.struct("place", *members))).alias("nodes"))
    )


def climb(size: int, level: int) -> int:
    """Levels that a subtree standing on a level has."""
    return max(0, min(LEVELS, depth(size) - level))


def tops(blocks: DataFrame, level: int) -> DataFrame:
    """(tree, size, place, digest) of the node on top of each subtree."""

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("nodes").to_pylist()
            sizes = batch.column("size").to_pylist()
            ends = [interior([n["digest"] for n in x], climb(s, level))[-1][0] for x, s in zip(nodes, sizes, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("size"), batch.column("block"), pa.array(ends, pa.string())], names=["tree", "size", "place", "digest"]
            )

    return blocks.mapInArrow(top, "tree string, size long, place long, digest string")


def grow(rows: DataFrame, order: list[str], members: list[str], path: str) -> int:
    """Store every LEVELS-th level of the trees over rows (tree, digest and others) below path; the number of levels stored.

    `path/at=k` has the subtrees on level k * LEVELS and `path/root` one row (tree, digest) per
    tree.  The driver sees the size of the largest tree.
    """
    spark = rows.sparkSession
    nodes = ranked(rows, order)
    at, largest = 0, None
    while largest is None or depth(largest) > at * LEVELS:
        subtrees(nodes, members if at == 0 else ["digest"]).write.parquet(f"{path}/at={at}")
        blocks = spark.read.parquet(f"{path}/at={at}")
        if largest is None:
            largest = blocks.agg(F.max("size")).first()[0] or 0
        done = cut(tops(blocks, at * LEVELS))
        above = at * LEVELS + LEVELS
        ended = F.col("size") <= F.lit(FAN**above)
        done.where(ended).select("tree", "digest").write.mode("append").parquet(f"{path}/root")
        nodes = done.where(~ended)
        at += 1
    return at


class Manifest:
    """Where a manifest's tables are, and how many levels they store."""

    def __init__(self, spark: SparkSession, path: str, rows: int, top: int) -> None:
        self.spark, self.path, self.rows, self.top = spark, path, rows, top

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def remove(self) -> None:
        discard(self.spark, self.path)


def source_key(name: str = "source") -> Column:
    """A text that sorts as the source does, null first; never null itself."""
    return F.coalesce(F.concat(F.lit("s"), F.col(name).cast("string")), F.lit("n"))


def build(docs: DataFrame, path: str | None = None, candidate: Column | None = None) -> Manifest:
    """Store the manifest of documents: leaves, every LEVELS-th level above them, roots.

    candidate is the leaf that a proof will be tried on, by default the row's own.  Leaves of one source
    ascend by doc_id, null first, and rows with one doc_id by their hash; equal rows are leaves of
    their own.  A null source is a source.  Null columns and empty texts are told apart.  An
    empty table has no leaves and no root.  Columns of other names take no part.
    """
    spark = docs.sparkSession
    prepare(spark)
    path = path or f"{shared_folder(spark)}/manifest-{uuid.uuid4().hex}"
    rows = docs.select("doc_id", source_key().alias("tree"), leaf().alias("digest"), (leaf() if candidate is None else candidate).alias("candidate"))
    levels = grow(rows, ["doc_id", "digest"], ["digest", "doc_id", "candidate"], f"{path}/rows")
    subroots = spark.read.parquet(f"{path}/rows/root").select(F.lit(TOP).alias("tree"), F.col("tree").alias("source"), "digest")
    top = grow(subroots, ["source"], ["digest", "source"], f"{path}/sources")
    return Manifest(spark, path, levels, top)


STEPS = "array<struct<left:string,right:string>>"
STEPS_ARROW = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def extract(blocks: DataFrame, above: DataFrame, level: int, members: list[str]) -> DataFrame:
    """(tree, place, members, what else above has, steps) for every stored node of the subtrees.

    above has one row (tree, place, steps and others) for the node on top of each subtree.
    """
    others = [c for c in above.columns if c not in ("tree", "place", "steps")]
    joined = blocks.join(above.withColumnRenamed("place", "block"), ["tree", "block"])
    kinds = dict(blocks.selectExpr("inline(nodes)").dtypes)
    schema = ", ".join(["tree string", "place long", *(f"{m} {kinds[m]}" for m in members), *(f"{c} string" for c in others), f"steps {STEPS}"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("nodes").type.value_type
            wanted = pa.schema(
                [("tree", pa.string()), ("place", pa.int64()), *((m, node.field(m).type) for m in members), *((c, pa.string()) for c in others), ("steps", STEPS_ARROW)]
            )
            columns: dict[str, list] = {f.name: [] for f in wanted}
            for k in range(batch.num_rows):
                (row,) = batch.slice(k, 1).to_pylist()
                nodes = row["nodes"]
                rows = interior([n["digest"] for n in nodes], climb(row["size"], level))
                n = len(nodes)
                columns["tree"] += [row["tree"]] * n
                columns["steps"] += (siblings(rows, i) + row["steps"] for i in range(n))
                for m in ("place", *members):
                    columns[m] += (x[m] for x in nodes)
                for c in others:
                    columns[c] += [row[c]] * n
                if len(columns["tree"]) >= BATCH_ROWS or k + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_pydict(columns, schema=wanted)
                    columns = {f.name: [] for f in wanted}

    return joined.mapInArrow(emit, schema)


def descend(manifest: Manifest, name: str, levels: int, tops: DataFrame, members: list[str]) -> DataFrame:
    """The ways up of all rows of the trees in one part of a manifest, from the top level down.

    tops has (tree, steps and others) for each tree's root.
    """
    above = None
    for at in reversed(range(levels)):
        blocks = manifest.table(f"{name}/at={at}")
        # A tree whose last stored level this is hangs from its root; place 0 is its only subtree.
        last = blocks.where(F.col("size") <= F.lit(FAN ** (at * LEVELS + LEVELS))).select("tree").distinct()
        roots = tops.join(last, "tree", "left_semi").withColumn("place", F.lit(0).cast("long"))
        above = roots if above is None else above.unionByName(roots)
        above = extract(blocks, above, at * LEVELS, members if at == 0 else [])
    return above


def prove(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, candidate, subroot, root and steps of every row.

    steps lists, level by level up to the root, the digests left and right of the way, each side
    as one text; both are empty where a run has one node.
    """
    one = manifest.table("sources/root").select("tree", F.col("digest").alias("root"))
    tops = one.withColumn("steps", F.array().cast(STEPS))
    over = descend(manifest, "sources", manifest.top, tops, ["digest", "source"])
    sources = over.select(F.col("source").alias("tree"), F.col("digest").alias("subroot"), "root", "steps")
    # One row a source; stored, because every level of the rows' trees joins it.
    sources = cut(sources)
    return descend(manifest, "rows", manifest.rows, sources, ["digest", "doc_id", "candidate"]).select(
        "doc_id", F.col("digest").alias("leaf"), "candidate", "subroot", "root", "steps"
    )


def refold(leaf: str = "candidate", steps: str = "steps") -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(steps, F.col(leaf), lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(steps: str = "steps") -> Column:
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def verified(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    Proofs are tried on rows of which every second, by crc32 of the doc_id, has lost its line
    feeds.  The manifest is deleted when the result is stored, unless a path is given for it.
    """
    manifest = build(docs, path, tampered())
    out = prove(manifest).select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), refold().alias("folded_root"))
    out = out.withColumn("verified", F.col("folded_root") == F.col("root"))
    if path is None:
        out = cut(out)
        manifest.remove()
    return out
