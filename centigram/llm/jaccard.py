"""N-gram Jaccard join by vertical partitioning of a global order of shingles.

A document is the set of its hashed five-word shingles; equal sets are one class.  The global
order sorts shingles by how full their cell of a fixed-size count sketch is, then by hash, so
common shingles come last.  Two sets with Jaccard similarity at least s share a shingle in
their first n - ceil(s n) + 1 in any common order.  Those prefixes, few of which hold common
shingles, are the candidate index: every class that shares a prefix shingle meets there.

Candidates are settled by vertical partitioning.  The order is cut into fragments of about
equal weight, rarest shingles first, and every class has a row for each fragment.  Fragment by
fragment, the two rows of every open pair meet and their partial overlap is added to the pair's sum.
A pair leaves as soon as what is left of the smaller set cannot make the sum large enough; most
unlike pairs go after the first fragment, so the later ones are joined for few.  Pairs whose
sum over all fragments passes are links.

Members of one prefix list do not all pair off.  First each is compared with a few leaders of
the list and its neighbours by size, and the links found are joined to components.  Then only
members of *different* components are compared, in rounds, until no list holds two that are
neither linked nor compared.  A group of copies of any size costs a few comparisons a member,
and no link between components is lost.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centigram.llm.common import components, cut, discard, mix64, prepare, raw, shared_folder, texts

WORDS = 5
PERCENT = 80
#: Cells of the count sketch that orders shingles, and slices in which tasks pass it on.
CELLS = 1 << 20
SLICES = 16
#: Fragments of the global order: the rarer half, which settles most unlike pairs, and the rest.
FRAGMENTS = 2
#: Lists of so many members or fewer are compared in full at once.
SMALL = 4
#: Rows of one list that go to one task; a cell of the sketch fuller by more is salted.
HOT_ROWS = 50_000
#: Shares of the open pairs compared in each round, one in so many; the last takes all that are left.
ROUNDS = (16, 1)
#: Others that a member of a long list meets in a round that is not the last, about so many whatever the list's length.
MEETS = 128
#: Open pairs, bounded by their lists' sizes, that the last round takes without rounds before it.
AT_ONCE = 2_000_000
#: Bits of the filter that keeps candidate classes when texts are read again.
FILTER_BITS = 1 << 23
#: Text bytes whose words and shingles are hashed at once, or one longer text: what a core's cache holds.
PIECE_BYTES = 1 << 18
#: Words of so many bytes or fewer are hashed together, eight bytes at a time.
SHORT_WORD = 64
#: Rows of lists that are compared at once.
LIST_ROWS = 20_000
#: Lower case for A-Z, one kind of white space.
FOLD = bytes.maketrans(bytes(range(65, 91)) + bytes(range(9, 14)), bytes(range(97, 123)) + b" " * 5)


class Shingler:
    """Sorted distinct 64-bit hashes of texts' shingles."""

    def __init__(self, width: int = WORDS) -> None:
        self.width = width
        self.odd = mix64(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def __call__(self, text: bytes) -> np.ndarray:
        return self.sets([text])[0]

    def sets(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The sets of many texts behind each other, and where each ends (from the second entry; the first is 0)."""
        hashes, sizes = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        start, held = 0, 0
        for k, text in enumerate(found):
            held += len(text)
            if held >= PIECE_BYTES or k == len(found) - 1:
                h, size = self._piece(found[start : k + 1])
                hashes.append(h)
                sizes.append(size)
                start, held = k + 1, 0
        return np.concatenate(hashes), np.cumsum(np.concatenate(sizes))

    def _piece(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        words, count = word_hashes(found)
        last = np.cumsum(count)
        first = last - count
        total = np.zeros(len(words), np.uint64)
        if len(words) >= self.width:
            n = len(words) - self.width + 1
            rolled = words[:n] * self.odd[0]
            for k in range(1, self.width):
                rolled = mix64(rolled) + words[k : k + n] * self.odd[k]
            total[:n] = mix64(rolled)
        # A shingle that would run into the next text is none.
        whole = np.repeat(last, count) - np.arange(len(words)) >= self.width
        few = np.flatnonzero((count > 0) & (count < self.width))
        if len(few):  # the whole sequence is its one shingle; its length tells it from others
            one = count[few].astype(np.uint64)
            for k in range(self.width - 1):
                has = count[few] > k
                one[has] = mix64(one[has] ^ (words[first[few[has]] + k] * self.odd[k]))
            total[first[few]] = one
            whole[first[few]] = True
        hashes = total[whole]
        ends = np.concatenate([[0], np.cumsum(np.where(count < self.width, count > 0, count - self.width + 1))])
        for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            hashes[s:e].sort()
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = hashes[1:] != hashes[:-1]
        fresh[ends[:-1][ends[:-1] < ends[1:]]] = True
        return hashes[fresh], np.diff(np.concatenate([[0], np.cumsum(fresh)])[ends])


def word_hashes(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of texts in their order, and each text's number of words."""
    data = b" ".join(found).translate(FOLD)
    held = np.frombuffer(data + b" " * 8, np.uint8)
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = held[: len(data)] != 32
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    size = end - start
    # Eight bytes from every place on; those past a word's end are masked.
    eight = np.ndarray((len(held) - 7,), "<u8", held, 0, (1,))
    out = mix64(size.astype(np.uint64))
    k, more = 0, np.flatnonzero(size <= SHORT_WORD)
    while len(more):
        left = np.minimum(size[more] - k, 8).astype(np.uint64)
        out[more] = mix64(out[more] ^ (eight[start[more] + k] & (np.uint64(2**64 - 1) >> (np.uint64(64) - np.uint64(8) * left))))
        k += 8
        more = more[size[more] > k]
    for j in np.flatnonzero(size > SHORT_WORD).tolist():
        out[j] = xxhash.xxh3_64_intdigest(data[start[j] : end[j]])
    begins = np.cumsum([0] + [len(x) + 1 for x in found])
    return out, np.diff(np.searchsorted(start, begins))


def signature(hashes: np.ndarray) -> int:
    """A 64-bit hash of the whole set, as a signed integer."""
    return xxhash.xxh3_64_intdigest(hashes.data) - (1 << 63)


def signatures(hashes: np.ndarray, ends: np.ndarray) -> list[int]:
    return [signature(hashes[s:e]) for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def firsts(sigs: list[int], ends: np.ndarray, seen: set[int]) -> list[int]:
    """Places of the sets with words that were not seen before; they are seen then."""
    out = []
    for k, (s, size) in enumerate(zip(sigs, np.diff(ends).tolist(), strict=True)):
        if size and s not in seen:
            seen.add(s)
            out.append(k)
    return out


def parts_of(ends: np.ndarray, places: list[int]) -> np.ndarray:
    """Which hashes belong to the sets at these places."""
    mine = np.zeros(len(ends) - 1, bool)
    mine[places] = True
    return np.repeat(mine, np.diff(ends))


def cells_of(hashes: np.ndarray, cells: int) -> np.ndarray:
    if cells & (cells - 1):
        return (hashes % np.uint64(cells)).astype(np.int64)
    return (hashes & np.uint64(cells - 1)).astype(np.int64)  # the same, faster


def scan(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """Rows of classes (doc_id, n, sig) and, from each task, slices of its count sketch."""
    key = docs.schema["doc_id"].dataType.simpleString()
    width = cells // SLICES

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts, seen = Shingler(), np.zeros(cells, np.int32), set()
        kind = pa.int64()
        for batch in batches:
            kind = batch.column("doc_id").type
            h, ends = shingles.sets(raw(batch.column("text")))
            sig = signatures(h, ends)
            np.add.at(counts, cells_of(h[parts_of(ends, firsts(sig, ends, seen))], cells), np.int32(1))
            empty = pa.nulls(len(sig))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(np.diff(ends), pa.int64()), pa.array(sig, pa.int64()), empty.cast(pa.int32()), empty.cast(pa.binary())],
                ["doc_id", "n", "sig", "slice", "counts"],
            )
        if seen:
            none = pa.nulls(SLICES)
            parts = [zlib.compress(counts[k * width : (k + 1) * width].tobytes(), 1) for k in range(SLICES)]
            yield pa.record_batch(
                [none.cast(kind), none.cast(pa.int64()), none.cast(pa.int64()), pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())],
                ["doc_id", "n", "sig", "slice", "counts"],
            )

    return texts(docs).mapInArrow(read, f"doc_id {key}, n long, sig long, slice int, counts binary")


def summed(slices: DataFrame, cells: int = CELLS) -> np.ndarray:
    """The sketch of the whole corpus: CELLS integers, whatever the input."""

    def add(key, table):
        total = np.zeros(cells // SLICES, np.int64)
        for part in table.column("counts").to_pylist():
            total += np.frombuffer(zlib.decompress(part), np.int32)
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(cells, np.int64)
    rows = slices.select("slice", "counts").groupBy("slice").applyInArrow(add, "slice int, counts binary").collect()
    width = cells // SLICES
    for r in rows:
        out[r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(bytes(r["counts"]), np.int64)
    return out


def ranks(sketch: np.ndarray) -> np.ndarray:
    """Order of fullness in 16 bits: equal for equally full cells up to rounding."""
    return np.minimum(np.round(np.log2(1.0 + sketch) * 1500), 65535).astype(np.uint16)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def salts(sketch: np.ndarray, hot: int = HOT_ROWS) -> np.ndarray:
    """Parts that the lists of each cell are dealt to, by how much fuller it is than usual."""
    over = sketch - np.int64(np.median(sketch))
    return np.clip(-(-over // hot), 1, 30_000).astype(np.uint16)


def prefixes(docs: DataFrame, order: Callable[[], tuple], percent: int = PERCENT) -> DataFrame:
    """(h, salt, sig, n, pos) for the prefix shingles of every class with words; a task tells a class once.

    The salt is 0 for a whole list, else the list's part from 1.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingler(), set()
        full, parts, _ = order()
        for batch in batches:
            h, ends = shingles.sets(raw(batch.column("text")))
            sigs = signatures(h, ends)
            cell = cells_of(h, len(full))
            rank, sizes = full[cell], np.diff(ends).tolist()
            own = firsts(sigs, ends, seen)
            if own:
                times = [prefix_length(sizes[k], percent) for k in own]
                # Hashes of a set are sorted, so ties go by hash.
                first = np.concatenate([ends[k] + np.argsort(rank[ends[k] : ends[k + 1]], kind="stable")[:p] for k, p in zip(own, times, strict=True)])
                sig = np.repeat(np.array([sigs[k] for k in own], np.int64), times)
                part = parts[cell[first]].astype(np.int64)
                yield pa.record_batch(
                    [
                        pa.array(h[first].view(np.int64)),
                        pa.array(np.where(part > 1, 1 + sig % part, 0), pa.int16()),
                        pa.array(sig),
                        pa.array(np.repeat(np.array([sizes[k] for k in own], np.int32), times)),
                        pa.array(np.concatenate([np.arange(p, dtype=np.int32) for p in times])),
                    ],
                    ["h", "salt", "sig", "n", "pos"],
                )

    return texts(docs).select("text").mapInArrow(read, "h long, salt short, sig long, n int, pos int")


def priority(sig: np.ndarray, seed: int) -> np.ndarray:
    """A fixed random order of classes, the same in every list."""
    return mix64(sig.view(np.uint64) ^ mix64(np.array([seed], np.uint64))[0])


def enough(least, n1, n2, percent: int = PERCENT):
    """Whether two sets of n1 and n2 with at most `least` in common can be similar enough.

    In the list of the *first* shingle that two sets share, what either has before it is not
    shared, so they share at most the smaller of the rests, n - pos.  Similar sets pass there;
    it does no harm that later lists, with smaller rests, may refuse them.
    """
    return least * (100 + percent) >= percent * (n1 + n2)


def runs(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], rows: int = LIST_ROWS) -> Iterator[list[np.ndarray]]:
    """The columns of several batches together, about so many rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield [np.concatenate([x.column(c).to_numpy(zero_copy_only=False) for x in held]) for c in columns]
            held, size = [], 0
    if held:
        yield [np.concatenate([x.column(c).to_numpy(zero_copy_only=False) for x in held]) for c in columns]


def lists(rows: DataFrame, percent: int = PERCENT, small: int = SMALL, piece: int = HOT_ROWS) -> DataFrame:
    """Candidate pairs (a, b), and the members (h, sig, n, rest) of lists that were not compared in full.

    Rows arrive sorted by shingle within each partition, so a list is a run of rows, read
    piece by piece.  In a long list every member is paired with the two members that come
    first in two fixed random orders.
    """

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple[int, int]] = set()
        names = ["a", "b", "h", "n", "rest"]

        def settle(h: np.ndarray, salt: np.ndarray, sig: np.ndarray, n: np.ndarray, pos: np.ndarray, partial: bool) -> Iterator[pa.RecordBatch]:
            if not len(h):
                return
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (sig[1:] != sig[:-1])
            h, salt, sig, n = h[fresh], salt[fresh], sig[fresh], n[fresh].astype(np.int64)
            rest = n - pos[fresh]
            start = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (salt[1:] != salt[:-1])]))
            length = np.diff(np.append(start, len(h)))
            first, second, left = [], [], []
            for m in range(2, small + 1):
                i, j = np.triu_indices(m, 1)
                of = start[length == m][:, None]
                first.append((of + i).ravel())
                second.append((of + j).ravel())
            kept = (length > small) | (salt[start] != 0) | partial
            for s, m in zip(start[kept].tolist(), length[kept].tolist(), strict=True):
                left.append(np.arange(s, s + m))
                if m > max(small, 1):
                    leaders = {int(np.argmin(priority(sig[s : s + m], seed))) for seed in (1, 2)}
                    first.append(np.concatenate([np.full(m, k + s) for k in leaders]))
                    second.append(np.tile(np.arange(s, s + m), len(leaders)))
            if first:
                i, j = np.concatenate(first), np.concatenate(second)
                near = enough(np.minimum(rest[i], rest[j]), n[i], n[j], percent) & (i != j)
                a, b = np.minimum(sig[i], sig[j])[near], np.maximum(sig[i], sig[j])[near]
                found = set(zip(a.tolist(), b.tolist(), strict=True)) - told
                if len(told) < 500_000:
                    told.update(found)
                if found:
                    x, y = zip(*found, strict=True)
                    none = pa.nulls(len(x))
                    yield pa.record_batch([pa.array(x, pa.int64()), pa.array(y, pa.int64()), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int64())], names)
            if left:
                k = np.concatenate(left)
                yield pa.record_batch([pa.array(sig[k]), pa.nulls(len(k)).cast(pa.int64()), pa.array(h[k]), pa.array(n[k]), pa.array(rest[k])], names)

        carried: list[np.ndarray] | None = None
        partial = False
        for now in runs(batches, ("h", "salt", "sig", "n", "pos")):
            if carried is not None:
                now = [np.concatenate([x, y]) for x, y in zip(carried, now, strict=True)]
            if not len(now[0]):
                continue
            same = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            last = int(np.argmax(same))
            if last:
                head = int(np.argmax((now[0] != now[0][0]) | (now[1] != now[1][0]))) if partial else 0
                yield from settle(*(x[:head] for x in now), True)
                yield from settle(*(x[head:last] for x in now), False)
                partial = False
            carried = [x[last:] for x in now]
            if len(carried[0]) >= piece:  # a list longer than a piece goes on in pieces
                yield from settle(*carried, True)
                partial = True
                carried = [x[:0] for x in carried]
        if carried is not None:
            yield from settle(*carried, partial)

    placed = rows.repartition("h", "salt").sortWithinPartitions("h", "salt", "sig")
    return placed.mapInArrow(pair, "a long, b long, h long, n long, rest long")


def bits_of(keys: np.ndarray, bits: int) -> np.ndarray:
    k = keys.view(np.uint64)
    return np.concatenate([mix64(k) % np.uint64(bits), mix64(k ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(bits)]).astype(np.int64)


def key_filter(keys: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit array of fixed size that holds every key (a column `key` of longs), and some others."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(bits, bool)
        for batch in batches:
            found[bits_of(batch.column("key").to_numpy(zero_copy_only=False), bits)] = True
        if found.any():
            packed = np.packbits(found)
            parts = np.array_split(packed, SLICES)
            yield pa.record_batch([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["slice", "bits"])

    def join(key, table):
        parts = [np.frombuffer(p, np.uint8) for p in table.column("bits").to_pylist()]
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.bitwise_or.reduce(parts).tobytes()], pa.binary())})

    marked = keys.select("key").mapInArrow(mark, "slice int, bits binary").groupBy("slice").applyInArrow(join, "slice int, bits binary")
    rows = {r["slice"]: bytes(r["bits"]) for r in marked.collect()}
    if not rows:
        return np.zeros(bits, bool)
    return np.unpackbits(np.frombuffer(b"".join(rows[k] for k in range(SLICES)), np.uint8))[:bits].astype(bool)


def boundaries(sketch: np.ndarray, count: int = FRAGMENTS) -> tuple[np.ndarray, np.ndarray]:
    """Where the order is cut: the rank of fullness and, within it, the hash at which each next fragment begins.

    Shingles of one rank spread evenly over their hashes, so fragments weigh alike even if
    all cells are equally full.
    """
    weight = np.bincount(ranks(sketch), weights=sketch, minlength=1)
    ends = np.cumsum(weight)
    at = ends[-1] * np.arange(1, count) / count
    rank = np.searchsorted(ends, at, side="right").clip(max=len(ends) - 1)
    share = np.clip((at - ends[rank] + weight[rank]) / np.maximum(weight[rank], 1e-9), 0, 1 - 2**-53)
    return rank.astype(np.int64), (share * 2.0**64).astype(np.uint64)


def fragment_of(hashes: np.ndarray, full: np.ndarray, begins: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The fragment of each shingle, from 0 for the rarest."""
    rank = full[cells_of(hashes, len(full))].astype(np.int64)
    out = np.zeros(len(hashes), np.int64)
    for r, h in zip(*begins, strict=True):
        out += (rank > r) | ((rank == r) & (hashes >= h))
    return out


def fragments(docs: DataFrame, wanted: Callable[[], np.ndarray], order: Callable[[], tuple]) -> DataFrame:
    """(sig, fragment, hashes, later) of the classes of wanted documents: a row per fragment, also for an empty one.

    later is how many of the class's shingles lie in the fragments to come.  A class may come
    more than once, each time alike.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen, bits = Shingler(), set(), wanted()
        full, _, begins = order()
        count = len(begins[0]) + 1
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            hit = bits[bits_of(keys, len(bits))].reshape(2, len(keys)).all(axis=0)
            picked = batch.column("text").take(pa.array(np.flatnonzero(hit)))
            h, ends = shingles.sets(raw(picked))
            sigs = signatures(h, ends)
            own = firsts(sigs, ends, seen)
            if own:
                mine = parts_of(ends, own)
                h, length = h[mine], np.diff(ends)[own]
                # A row for each set and fragment, in this order.
                row = np.repeat(np.arange(len(own)) * count, length) + fragment_of(h, full, begins)
                size = np.bincount(row, minlength=len(own) * count).reshape(len(own), count)
                lists_end = pa.array(np.concatenate([[0], np.cumsum(size.ravel())]), pa.int32())
                yield pa.record_batch(
                    [
                        pa.array(np.repeat(np.array([sigs[k] for k in own], np.int64), count)),
                        pa.array(np.tile(np.arange(count, dtype=np.int32), len(own))),
                        pa.ListArray.from_arrays(lists_end, pa.array(h[np.argsort(row, kind="stable")].view(np.int64))),
                        pa.array((size.sum(axis=1, keepdims=True) - np.cumsum(size, axis=1)).ravel().astype(np.int32)),
                    ],
                    ["sig", "fragment", "hashes", "later"],
                )

    keyed = texts(docs).select(F.xxhash64("doc_id").alias("key"), "text")
    return keyed.mapInArrow(read, "sig long, fragment int, hashes array<long>, later int")


def partial_overlaps(pairs: DataFrame, rows: DataFrame, sides: tuple[str, str] = ("a", "b")) -> DataFrame:
    """pairs with `here`, the overlap in one fragment, both sides' sizes in it, and `later_a` and `later_b`.

    Sides are joined in the order given; the result is dealt by the last one.
    """
    a = rows.select(F.col("sig").alias("a"), F.col("hashes").alias("x"), F.col("later").alias("later_a"))
    b = rows.select(F.col("sig").alias("b"), F.col("hashes").alias("y"), F.col("later").alias("later_b"))
    here = [F.size(F.array_intersect("x", "y")).alias("here"), F.size("x").alias("here_a"), F.size("y").alias("here_b")]
    met = pairs
    for side in sides:
        met = met.join({"a": a, "b": b}[side], side)
    met = met.select(*pairs.columns, *here, "later_a", "later_b")
    # A class that came more than once came alike each time.
    return met.groupBy(*pairs.columns).agg(*(F.max(c).alias(c) for c in ("here", "here_a", "here_b", "later_a", "later_b")))


def linked(docs: DataFrame, pairs: DataFrame, heads: DataFrame, order: Callable[[], tuple], count: int = FRAGMENTS, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union, by sums over fragments.

    Texts are read once more, but only those of classes in these pairs are cut into fragments,
    which are stored by fragment and deleted at the end.
    """
    spark = docs.sparkSession
    concerned = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
    bits = key_filter(heads.join(concerned, "sig").select(F.xxhash64("head").alias("key")))
    wanted = spark.sparkContext.broadcast(np.packbits(bits))  # fixed size
    path = f"{shared_folder(spark)}/fragments-{uuid.uuid4().hex}"
    rows = fragments(docs, lambda: np.unpackbits(wanted.value).astype(bool), order)
    rows.write.option("compression", "none").partitionBy("fragment").parquet(path)
    wanted.destroy()
    stored = spark.read.schema("sig long, hashes array<long>, later int, fragment int").parquet(path)
    total = pairs.select("a", "b").withColumn("both", F.lit(0))
    for k in range(count):
        # The pairs left after a fragment lie by its last side, with which the next one begins: one query and one shuffle less.
        sides = ("b", "a") if k % 2 else ("a", "b")
        partial = partial_overlaps(total, stored.where(F.col("fragment") == k), sides).withColumn("both", F.col("both") + F.col("here"))
        # The first fragment tells both sets' whole sizes.
        size = F.col("here_a") + F.col("later_a") + F.col("here_b") + F.col("later_b") if k == 0 else F.col("size")
        partial = partial.withColumn("size", size.cast("long"))
        most = F.col("both") + F.least("later_a", "later_b")
        total = partial.where(most * (100 + percent) >= percent * F.col("size")).select("a", "b", "size", "both")
    links = cut(total.select("a", "b"))
    discard(spark, path)
    return links


def open_lists(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """The members of lists in several components, with their component and their list's largest one.

    The number bounds the pairs that `crossing` can make of them, all lists together.
    """
    member = members.join(labels.select(F.col("node").alias("sig"), "component"), "sig", "left").withColumn(
        "component", F.coalesce("component", "sig")
    )
    per = member.groupBy("h", "component").agg(F.count(F.lit(1)).alias("m"))
    # Stored, so that later joins are between plain tables and Spark can split a long list's partition.
    per = per.groupBy("h").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("m").alias("size"), F.max("m").alias("most"), F.max_by("component", F.struct("m", "component")).alias("main")
    )
    split = cut(per.where("kinds > 1"))
    bound = split.agg(F.sum((F.col("size") - F.col("most")).cast("double") * F.col("size"))).first()[0] or 0
    return cut(member.join(split.select("h", "main", "size"), "h")), int(bound)


def told_pairs(opened: DataFrame, part: int = 1, percent: int = PERCENT) -> DataFrame:
    """Pairs of one open list in different components, by each list: members outside its largest with all others.

    With part > 1 a hash picks one such pair in so many, to join components cheaply before the
    rest is compared.  There a member looks in only one of its lists, a long one: a pair of a large
    group shares many, and each would tell it again.  In a list of over part * MEETS members it meets
    MEETS others or so, lest the pairs grow with the square of the list.
    """
    few = opened.where("component <> main").select("h", F.col("sig").alias("s1"), F.col("n").alias("n1"), F.col("rest").alias("r1"), F.col("component").alias("c1"), "size")
    every = opened.select("h", F.col("sig").alias("s2"), F.col("n").alias("n2"), F.col("rest").alias("r2"), F.col("component").alias("c2"))
    near = enough(F.least("r1", "r2"), F.col("n1"), F.col("n2"), percent)
    if part > 1:
        # Of lists about as long as the longest in which sets of its own size pass, a hash picks one.
        best = F.struct(enough(F.col("r1"), F.col("n1"), F.col("n1"), percent), F.floor(F.log2("size")), F.xxhash64("s1", "h"))
        few = few.groupBy("s1", "n1", "c1").agg(F.max_by(F.struct("h", "r1", "size"), best).alias("at")).select("s1", "n1", "c1", "at.*")
    share = F.greatest(F.lit(part), F.col("size") / MEETS).cast("long") if part > 1 else F.lit(1)
    return (
        few.join(every, "h")
        .where((F.col("c1") != F.col("c2")) & near & (F.pmod(F.col("s1").bitwiseXOR(F.col("s2")), share) == 0))
        .select(F.least("s1", "s2").alias("a"), F.greatest("s1", "s2").alias("b"))
    )


def crossing(opened: DataFrame, part: int = 1, percent: int = PERCENT) -> DataFrame:
    return told_pairs(opened, part, percent).distinct()


def groups(docs: DataFrame, percent: int = PERCENT, small: int = SMALL, cells: int = CELLS, hot: int = HOT_ROWS, at_once: int = AT_ONCE) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id reachable by links) of every document.

    Words fold A-Z; a text of fewer than five words has its whole sequence as one shingle; a
    null, empty or blank text has none and links with nothing.  Equal sets always link.  Rows
    with a repeated doc_id are one document in links and stay as many rows in the result.  A
    null doc_id never heads a group unless all of it are null.  An empty table gives an empty
    result.
    """
    spark = docs.sparkSession
    prepare(spark)
    found = cut(scan(docs, cells))
    classes = found.where("sig IS NOT NULL").select("doc_id", "n", "sig")
    sketch = summed(found.where("slice IS NOT NULL"), cells)
    order = spark.sparkContext.broadcast((ranks(sketch), salts(sketch, hot), boundaries(sketch)))  # fixed size
    # Not stored: it is joined by sig each time, and so comes with the shuffle that the join needs.
    heads = classes.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("head"), F.max("n").alias("n"))

    met = cut(lists(prefixes(docs, lambda: order.value, percent), percent, small, hot))
    pairs = cut(met.where("b IS NOT NULL").select("a", "b").distinct())
    # A list read in pieces may tell a member twice, which costs a comparison at most.
    members = met.where("b IS NULL").select(F.col("a").alias("sig"), "h", "n", "rest")

    links = linked(docs, pairs, heads, lambda: order.value, percent=percent)
    labels, opened = components(links), None
    for part in ROUNDS:
        # Lists stay as they are while no link joins two components.
        if opened is None:
            opened, bound = open_lists(members, labels)
        if not bound:
            break
        if part > 1 and bound <= at_once:
            continue
        more = cut(crossing(opened, part, percent).join(pairs, ["a", "b"], "left_anti"))
        if more.isEmpty():
            continue
        pairs = pairs.union(more)
        fresh = linked(docs, more, heads, lambda: order.value, percent=percent)
        if not fresh.isEmpty():
            # What is known of a component is one link from each of its members.
            known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
            labels, opened = components(known.union(fresh)), None
    named = heads.join(labels.select(F.col("node").alias("sig"), F.col("component").alias("class")), "sig", "left")
    named = named.select("sig", "head", F.coalesce("class", "sig").alias("class"))
    least = named.groupBy("class").agg(F.min("head").alias("least"))
    of = named.join(least, "class").select("sig", "least")
    return classes.join(of, "sig", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id")
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents without near copies: of each group the row with the least doc_id stays.

    Equal rows are one; rows without a doc_id cannot be told apart and all stay.
    """
    heads = groups(docs, percent).where("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(heads, "doc_id", "left_semi").withColumn("__text", F.xxhash64("text"))
    return named.dropDuplicates(["doc_id", "__text"]).drop("__text").union(docs.where("doc_id IS NULL"))
