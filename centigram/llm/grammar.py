"""Token files compressed by Re-Pair grammars, with random access.

Texts become token ids, an end id closes every document, and documents are sorted by doc_id
over ranges.  Consecutive documents of a range make shards of about SHARD_IDS ids, and each
shard has a grammar of its own: the most frequent pairs of symbols are replaced by
nonterminals, again and again, until no pair occurs LEAST times or a round gains next to
nothing.  A round replaces all pairs down to a number of occurrences that falls from round to
round, so that a shard takes a few passes over arrays.  No pair reaches over the end of a
document, so every document is a run of symbols of its own.

A shard is one row of a Parquet table: range, block, ids, docs, doc_ids and payload.  Spark commits
the files, so a lost task leaves nothing half written.  payload is little-endian:

    4 bytes   RPG1
    u32 x 5   bits of a symbol, documents, terminals, rules, symbols
    u32 x terminals     the token id of each terminal, ascending
    u32 x rules         expansion length of each rule, in ids
    u32 x documents     symbols of each document
    u32 x documents     ids of each document
    packed              left and right symbol of each rule, alternating
    packed              the documents' symbols

Packed symbols take `bits` each, lowest bit first.  Symbols below `terminals` are terminals, the
others are rules in the order they were made, each of earlier symbols only.

Expansion lengths say which symbol holds the id at a position and which of its two parts, so
any run of ids is decoded without the rest.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from centigram.llm import bpe
from centigram.llm.common import batch_of, cut, discard, prepare, shared_folder, texts

#: The id that closes a document.
END_ID = 2
#: Ids of a shard (one document may have more) and of a range of documents; most ranges.
SHARD_IDS = 1 << 20
RANGE_IDS = 8 << 20
RANGES = 20_000
#: Least number of occurrences of a replaced pair; by how much each round's least number falls;
#: a round that shortens the shard by less than one in so many symbols is the last.
LEAST = 16
SHARE = 8
GAIN = 256
#: Cells of the table that counts pairs before they are told apart.
CELLS = 18
#: An index of so many shards or fewer is broadcast (about 40 bytes each).
SMALL_INDEX = 100_000

MAGIC = b"RPG1"
HEADER = "<4s5I"


def cells(left: np.ndarray, right: np.ndarray, seed: int) -> np.ndarray:
    """A cell of the counting table for each pair of symbols, others in each round."""
    mixed = left * np.uint32(0x9E3779B1)
    mixed += right * np.uint32(0x85EBCA77 + 2 * seed)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    mixed >>= np.uint32(32 - CELLS)
    return mixed


def frequent(pair: np.ndarray, least: int) -> np.ndarray:
    """The distinct pairs that occur `least` times, by sorting."""
    in_order = np.sort(pair)
    start = np.flatnonzero(np.concatenate([[True], in_order[1:] != in_order[:-1]]))
    return in_order[start[np.diff(np.append(start, len(in_order))) >= least]]


def repair(symbols: np.ndarray, last: np.ndarray, first_rule: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, last, rules) after replacing frequent pairs, see the module's docstring.

    last marks the end of each document.  rules has one row (left, right) per nonterminal,
    numbered from first_rule.  A round counts one pair per cell of a table exactly; pairs whose
    cell another one holds wait for the next round's cells, and a last count by sorting finds
    any that are left.
    """
    symbols, last, rules, made = symbols.astype(np.uint32), last.copy(), [], first_rule
    seed, least_now = 0, 0
    held, name, chosen = np.zeros(1 << CELLS, np.int64), np.zeros(1 << CELLS, np.uint32), np.zeros(1 << CELLS, bool)
    while len(symbols) > 1:
        seed += 1
        cell = cells(symbols[:-1], symbols[1:], seed)
        hot = (np.bincount(cell, minlength=1 << CELLS) >= least)[cell]
        hot &= ~last[:-1]
        place = np.flatnonzero(hot)
        if not len(place):
            break
        cell = cell[place]
        pair = symbols[place].astype(np.int64) << 32 | symbols[place + 1]
        held[cell] = pair
        same = held[cell] == pair
        count = np.bincount(cell[same], minlength=1 << CELLS)
        top = int(count.max())
        if top >= least:
            least_now = max(least, (min(least_now, top) if least_now else top) // SHARE)
            np.greater_equal(count, least_now, out=chosen)
        else:
            keys = frequent(pair, least)
            if not len(keys):
                break
            key_cell = cells((keys >> 32).astype(np.uint32), (keys & 0xFFFFFFFF).astype(np.uint32), seed)
            held[key_cell] = keys
            chosen[:] = False
            chosen[key_cell] = True
            same = held[cell] == pair
        picked = np.flatnonzero(same & chosen[cell])
        place, cell = place[picked], cell[picked]
        # Overlapping occurrences: every second one of a run, from its left end.
        index = np.arange(len(place))
        run = np.concatenate([[True], place[1:] != place[:-1] + 1])
        alternate = np.flatnonzero((index - np.maximum.accumulate(np.where(run, index, 0))) % 2 == 0)
        place, cell = place[alternate], cell[alternate]
        used = np.flatnonzero(np.bincount(cell, minlength=1 << CELLS))
        name[used] = np.arange(made, made + len(used))
        rules.append(np.stack([held[used] >> 32, held[used] & 0xFFFFFFFF], axis=1))
        made += len(used)
        symbols[place] = name[cell]
        last[place] = last[place + 1]
        stays = np.ones(len(symbols), bool)
        stays[place + 1] = False
        symbols, last = symbols[stays], last[stays]
        if least_now == least and len(place) * GAIN < len(symbols):
            break
    return symbols, last, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


def packed(values: np.ndarray, bits: int) -> bytes:
    """Values of `bits` bits each, one after the other, lowest bit first."""
    wide = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(wide, axis=1, bitorder="little")[:, :bits].ravel(), bitorder="little").tobytes()


def unpacked(data: memoryview, first: int, count: int, bits: int) -> np.ndarray:
    """`count` values from the first-th on."""
    start, stop = first * bits, (first + count) * bits
    flat = np.unpackbits(np.frombuffer(data[start // 8 : -(-stop // 8)], np.uint8), bitorder="little")[start % 8 :][: count * bits]
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = flat.reshape(count, bits)
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def compress(ids: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> bytes:
    """The payload of a shard: ids of documents of the given sizes, each at least one."""
    present = np.zeros(int(ids.max()) + 1, bool)
    present[ids] = True
    terminals = np.flatnonzero(present)
    dense = (np.cumsum(present) - 1)[ids]
    last = np.zeros(len(ids), bool)
    last[np.cumsum(sizes) - 1] = True
    symbols, last, rules = repair(dense, last, len(terminals), least)
    length = np.ones(len(terminals) + len(rules), np.int64)
    pairs = rules.tolist()
    for k, (left, right) in enumerate(pairs, len(terminals)):
        length[k] = length[left] + length[right]
    runs = np.diff(np.concatenate([[-1], np.flatnonzero(last)]))
    bits = max(1, (len(length) - 1).bit_length())
    head = struct.pack(HEADER, MAGIC, bits, len(sizes), len(terminals), len(rules), len(symbols))
    numbers = [terminals, length[len(terminals) :], runs, sizes]
    return b"".join([head, *(np.asarray(x, "<u4").tobytes() for x in numbers), packed(rules.ravel(), bits), packed(symbols, bits)])


class Shard:
    """Random access to a payload; only the header's tables and the rules are read at once."""

    def __init__(self, payload: bytes) -> None:
        magic, self.bits, self.docs, terminals, rules, self.symbols = struct.unpack_from(HEADER, payload)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = struct.calcsize(HEADER)

        def numbers(count: int) -> np.ndarray:
            nonlocal at
            at += 4 * count
            return np.frombuffer(payload, "<u4", count, at - 4 * count).astype(np.int64)

        self.terminals, length, runs, self.sizes = numbers(terminals), numbers(rules), numbers(self.docs), numbers(self.docs)
        self.length = np.concatenate([np.ones(terminals, np.int64), length])
        self.doc_symbol = np.concatenate([[0], np.cumsum(runs)])
        self.doc_start = np.concatenate([[0], np.cumsum(self.sizes)])
        view = memoryview(payload)
        rule_bytes = -(-2 * rules * self.bits // 8)
        self.rules = unpacked(view[at : at + rule_bytes], 0, 2 * rules, self.bits).astype(np.int64).reshape(rules, 2)
        self.body = view[at + rule_bytes :]

    def whole(self) -> np.ndarray:
        """All ids.  Where the rules' own expansions are short together, symbols are looked up in them."""
        total, terminals = int(self.doc_start[-1]), len(self.terminals)
        if int(self.length[terminals:].sum()) > total:
            return self.ids()
        flat = np.concatenate([self.terminals.astype("<u4"), self.expand(np.arange(terminals, len(self.length)))])
        begins = np.cumsum(self.length) - self.length
        symbol = unpacked(self.body, 0, self.symbols, self.bits)
        size = self.length[symbol]
        shift = begins[symbol] - (np.cumsum(size) - size)
        return flat[np.arange(total) + np.repeat(shift, size)]

    def expand(self, symbol: np.ndarray, place: np.ndarray | None = None, first: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids first to stop of what symbols at ascending places stand for."""
        size, terminals = self.length[symbol], len(self.terminals)
        place = np.cumsum(size) - size if place is None else place
        partly = stop is not None
        out = np.zeros((stop if partly else int(size.sum())) - first, "<u4")
        while len(symbol):
            if partly:
                wanted = (place < stop) & (place + self.length[symbol] > first)
                symbol, place = symbol[wanted], place[wanted]
            done = symbol < terminals
            out[place[done] - first] = self.terminals[symbol[done]]
            rest = np.flatnonzero(~done)
            left, right = self.rules[symbol[rest] - terminals].T
            place = place[rest]
            symbol, place = np.concatenate([left, right]), np.concatenate([place, place + self.length[left]])
        return out

    def ids(self, first: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids first to stop of the shard; of the documents that they lie in, only symbols that cover them are expanded."""
        total = int(self.doc_start[-1])
        stop = total if stop is None else min(stop, total)
        if first >= stop:
            return np.zeros(0, "<u4")
        a = int(np.searchsorted(self.doc_start, first, "right")) - 1
        b = int(np.searchsorted(self.doc_start, stop, "left"))
        symbol = unpacked(self.body, int(self.doc_symbol[a]), int(self.doc_symbol[b] - self.doc_symbol[a]), self.bits).astype(np.int64)
        size = self.length[symbol]
        return self.expand(symbol, int(self.doc_start[a]) + np.cumsum(size) - size, first, stop)

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.doc_start[k]), int(self.doc_start[k + 1]))


def tokens(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n, ids) of every whole text, the end id included; ids of 16 bits if the vocabulary allows."""
    prepare(docs.sparkSession)
    get = bpe.worker(tokenizer)
    kind = id_type(tokenizer, end_id)
    key = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], kind)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = get()
        for batch in batches:
            rows = [np.append(plain(encoder, t, kind), end) for t in batch.column("text").to_pylist()]
            schema = pa.schema([pa.field("doc_id", batch.column("doc_id").type), pa.field("n", pa.int64()), pa.field("ids", pa.binary())])
            yield batch_of({"doc_id": batch.column("doc_id"), "n": [len(r) for r in rows], "ids": [r.tobytes() for r in rows]}, schema)

    return texts(docs).mapInArrow(each, f"doc_id {key}, n long, ids binary")


def plain(encoder: bpe.Encoder, text: str, kind: str) -> np.ndarray:
    """Ids of a text; one of ASCII needs no look for characters that the libraries may split apart differently."""
    if encoder.fast is not None and text.isascii() and not any(s in text for s in encoder.special):
        return np.array(encoder.fast.encode_ordinary(text), kind)
    return np.frombuffer(encoder.span(text), "<u4").astype(kind)


def id_type(tokenizer: str, end_id: int) -> str:
    size = bpe.tools(tokenizer).get_vocab_size(with_added_tokens=True)
    return "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS, range_ids: int = RANGE_IDS, least: int = LEAST) -> None:
    """Write documents as shards of token ids below path: `shards`, and their `index`.

    Documents ascend by doc_id, null first; rows with one doc_id by a hash of their ids, and
    equal rows follow each other.  A null or empty text is the end id alone.  An empty table
    writes no shard.  Columns beside doc_id and text take no part.
    """
    spark = docs.sparkSession
    raw = f"{path}/raw"
    key = docs.schema["doc_id"].dataType.simpleString()
    numbered = tokens(docs, tokenizer, end_id).withColumns({"tie": F.xxhash64("ids"), "row": F.monotonically_increasing_id()})
    numbered.write.option("compression", "zstd").parquet(raw)
    # The range sort samples its input; it reads the stored keys, not the texts again.
    stored = spark.read.parquet(raw)
    total = stored.agg(F.sum("n")).first()[0] or 0
    ranges = min(RANGES, max(1, -(-total // range_ids)))
    kind = id_type(tokenizer, end_id)
    keys = ["doc_id", "tie", "row"]
    placed = stored.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).select("doc_id", "n", "ids", F.spark_partition_id().alias("range"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, names, doc_type, span = 0, [], [], None, None

        def shard() -> pa.RecordBatch:
            sizes = np.array([len(x) for x in held])
            payload = compress(np.concatenate(held).astype(np.int64), sizes, least)
            fields = {"range": [span], "block": [block], "ids": [int(sizes.sum())], "docs": [len(sizes)], "doc_ids": [names], "payload": [payload]}
            schema = pa.schema(
                [("range", pa.int32()), ("block", pa.int32()), ("ids", pa.int64()), ("docs", pa.int32()), ("doc_ids", pa.list_(doc_type)), ("payload", pa.binary())]
            )
            return batch_of(fields, schema)

        size = 0
        for batch in batches:
            doc_type = batch.column("doc_id").type
            for doc, n, data, span in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "ids", "range")), strict=True):  # noqa: B007
                if held and size + n > shard_ids:
                    yield shard()
                    block, held, names, size = block + 1, [], [], 0
                held.append(np.frombuffer(data, kind))
                names.append(doc)
                size += n
        if held:
            yield shard()

    made = placed.mapInArrow(shards, f"range int, block int, ids long, docs int, doc_ids array<{key}>, payload binary")
    made.write.option("compression", "none").parquet(f"{path}/shards")
    sizes = spark.read.parquet(f"{path}/shards").select("range", "block", "ids", "docs")
    before = (Window.unboundedPreceding, -1)
    per = sizes.groupBy("range").agg(F.sum("ids").alias("n"))  # RANGES rows at most
    per = per.select("range", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(*before)), F.lit(0)).alias("base"))
    inner = F.coalesce(F.sum("ids").over(Window.partitionBy("range").orderBy("block").rowsBetween(*before)), F.lit(0))
    sizes.withColumn("inner", inner).join(per, "range").select(
        "range", "block", (F.col("base") + F.col("inner")).alias("start"), "ids", "docs"
    ).write.parquet(f"{path}/index")
    discard(spark, raw)


def started(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """rows of (range, block, ...) with `start`, the ids before their shard."""
    index = spark.read.parquet(f"{path}/index").select("range", "block", "start")
    if index.count() <= SMALL_INDEX:
        index = F.broadcast(index)
    return rows.join(index, ["range", "block"])


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if wanted, ids of every document."""
    prepare(spark)
    table = spark.read.parquet(f"{path}/shards").select("range", "block", "doc_ids", "payload")
    key = table.schema["doc_ids"].dataType.elementType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                names = batch.column("doc_ids").slice(k, 1).flatten()
                shard = Shard(batch.column("payload")[k].as_py())
                starts = shard.doc_start.tolist()
                data = shard.whole().tobytes()
                parts = [data[4 * a : 4 * b] for a, b in zip(starts, starts[1:], strict=False)]
                spot = [np.full(shard.docs, batch.column(c)[k].as_py(), np.int32) for c in ("range", "block")]
                columns = [*map(pa.array, spot), names, pa.array(starts[:-1], pa.int64()), pa.array(shard.sizes), pa.array(map(zlib.crc32, parts), pa.int64())]
                labels = ["range", "block", "doc_id", "local", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(parts, pa.binary())] * with_ids, names=labels + ["ids"] * with_ids)

    rows = table.mapInArrow(each, f"range int, block int, doc_id {key}, local long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
    out = started(spark, path, rows).withColumn("start", F.col("start") + F.col("local"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids)


def window(spark: SparkSession, path: str, first: int, count: int) -> DataFrame:
    """(start, ids): ids first to first + count of the whole corpus, a row for each shard that holds some.

    Only those shards are read, and of them only the symbols that cover the ids are expanded.
    """
    index = spark.read.parquet(f"{path}/index").where((F.col("start") < first + count) & (F.col("start") + F.col("ids") > first))
    table = spark.read.parquet(f"{path}/shards").select("range", "block", "payload")
    found = table.join(index.select("range", "block", "start"), ["range", "block"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {"start": [], "ids": []}
            for start, payload in zip(batch.column("start").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                a = max(0, first - start)
                rows["start"].append(start + a)
                rows["ids"].append(Shard(payload).ids(a, first + count - start).tobytes())
            yield batch_of(rows, pa.schema([("start", pa.int64()), ("ids", pa.binary())]))

    return found.select("start", "payload").mapInArrow(each, "start long, ids binary")


def digests(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from files written and read back.

    The files are deleted when the result is stored, unless a path is given for them.
    """
    spark = docs.sparkSession
    place = path or f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write(docs, tokenizer, place)
    out = read(spark, place, with_ids=False)
    if path is None:
        out = cut(out)
        discard(spark, place)
    return out
