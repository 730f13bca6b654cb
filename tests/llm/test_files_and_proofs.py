"""Token files, manifests and hard negatives against plain versions, also on odd tables."""

import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from tokenizers import Tokenizer

from centigram.llm import grammar, merkle, negatives
from centigram.llm.queries import table, tokenizer_path

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, place long, ids binary, row long, `range` int, digest string, payload binary"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, repeats, ties, a very long text, and columns with the names that the operators use."""
    rows = [
        (1, "one\ntwo", "en", "a", 7), (2, "é <|endoftext|> # #\n", "fr", "b", None), (2, "other text", None, "b", 1), (2, "other text", None, "b", 1),
        (3, None, "en", None, 0), (4, "", None, None, None), (None, "no id\n", "en", "a", 3), (None, None, None, None, None), (5, "long words " * 40_000, "en", "a", 9),
        (10, "x\n\n", "en", "", 3), (-6, "y\n", "en", "Ω", 3), *((k, "aa aa aa\n" * 9, "en", "a", 2) for k in range(20, 60)),
    ]
    return spark.createDataFrame([(*r, "s", 1, b"x", 2, 3, "y", b"z") for r in rows], SCHEMA)


def encoded(rows, tokenizer=None):
    """The documents' ids by the reference library, in the files' order up to ties."""
    encoder = Tokenizer.from_file(tokenizer or tokenizer_path())
    encoder.no_truncation()
    encoder.no_padding()
    return [(d, np.array([*encoder.encode(t or "", add_special_tokens=False).ids, 2], "<u4")) for d, t in rows]


def test_repair_rounds_trip():
    rng = np.random.default_rng(5)
    passage = rng.integers(0, 50_000, 700)
    for sizes, ids in (
        ([1], [2]),
        ([1, 1, 1], [2, 2, 2]),
        ([5000], np.full(5000, 7)),
        ([300] * 40, np.tile(rng.integers(0, 9, 100), 120)),
        ([703] * 50, np.concatenate([np.append(passage, [k, k, 2]) for k in range(50)])),
        (rng.integers(1, 90, 400), None),
    ):
        sizes = np.asarray(sizes)
        ids = rng.zipf(1.3, int(sizes.sum())) % 60_000 if ids is None else np.asarray(ids)
        payload = grammar.compress(ids, sizes)
        shard = grammar.Shard(payload)
        assert (shard.ids() == ids).all() and (shard.whole() == ids).all()
        ends = np.cumsum(sizes)
        for k in range(len(sizes)):
            assert (shard.document(k) == ids[ends[k] - sizes[k] : ends[k]]).all()
        for first, stop in ((0, 1), (len(ids) // 3, len(ids) // 2), (len(ids) - 1, len(ids)), (5, 5), (0, len(ids) + 9)):
            assert (shard.ids(first, stop) == ids[first:stop]).all()
    assert len(grammar.compress(np.tile(passage, 50), np.full(50, 700))) < 50 * 700 // 4


def test_repair_leaves_no_frequent_pair():
    rng = np.random.default_rng(6)
    ids, last = rng.integers(0, 40, 30_000), np.zeros(30_000, bool)
    last[999::1000] = True
    symbols, ends, rules = grammar.repair(ids, last, 40, least=16)
    pairs = symbols[:-1].astype(np.int64) << 32 | symbols[1:]
    assert ends.sum() == 30 and len(rules)
    # Overlapping occurrences count twice here; the last round gained next to nothing.
    _, count = np.unique(pairs[~ends[:-1]], return_counts=True)
    assert count[count >= 16].sum() * grammar.GAIN < 2 * 16 * len(symbols)
    used = np.bincount(np.concatenate([symbols, rules.ravel()]).astype(np.int64), minlength=40 + len(rules))
    assert (used[40:] > 0).all()


def test_packed_symbols():
    rng = np.random.default_rng(7)
    for bits in (1, 3, 8, 13, 17, 24, 32):
        values = rng.integers(0, 1 << bits, 1000)
        data = memoryview(grammar.packed(values, bits))
        assert (grammar.unpacked(data, 0, 1000, bits) == values).all()
        assert (grammar.unpacked(data, 333, 41, bits) == values[333:374]).all()


def test_token_files_of_a_whole_table(spark, tmp_path):
    docs = table(spark, SMALL, "documents")
    rows = encoded([(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()])
    want, at = {}, 0
    for doc, ids in rows:
        want[doc] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in grammar.digests(docs, tokenizer_path()).collect()} == want
    path = str(tmp_path / "files")
    grammar.write(docs, tokenizer_path(), path, shard_ids=3000, range_ids=20_000)
    read = grammar.read(spark, path).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in read} == want
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in read)
    whole = np.concatenate([ids for _, ids in rows])
    for first, count in ((0, 10), (2990, 20), (at // 2, 9000), (at - 5, 50)):
        parts = sorted((r.start, bytes(r.ids)) for r in grammar.window(spark, path, first, count).collect())
        assert b"".join(p for _, p in parts) == whole[first : first + count].tobytes()


def test_token_files_of_odd_rows(spark, odd, tmp_path):
    path = str(tmp_path / "odd")
    grammar.write(odd, tokenizer_path(), path, shard_ids=500, range_ids=5000)
    rows = sorted(grammar.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1]]
    order = [r.doc_id for r in rows]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    key = lambda pair: (pair[0] is not None, pair[0] or 0, pair[1])
    want = [(d, ids.tobytes()) for d, ids in encoded([(r.doc_id, r.text) for r in odd.collect()])]
    assert sorted(((r.doc_id, bytes(r.ids)) for r in rows), key=key) == sorted(want, key=key)
    assert grammar.digests(odd.limit(0), tokenizer_path()).count() == 0


def H(text):
    return sha256(text.encode()).hexdigest()


def plain_leaf(r, text):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def levels(nodes):
    rows = [nodes]
    while len(rows[-1]) > 1:
        rows.append([H("".join(rows[-1][k : k + 3])) for k in range(0, len(rows[-1]), 3)])
    return rows


def way(rows, place):
    for below in rows[:-1]:
        first = place - place % 3
        yield "".join(below[first:place]), "".join(below[place + 1 : first + 3])
        place //= 3


def plain_manifest(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, plain_leaf(r, r.text)))
        trees[s] = levels([plain_leaf(r, r.text) for r in by[s]])
    top = levels([trees[s][-1][0] for s in order])
    for k, s in enumerate(order):
        for place, r in enumerate(by[s]):
            steps = [*way(trees[s], place), *way(top, k)]
            changed = r.text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            node = plain_leaf(r, r.text.replace("\n", "") if changed else r.text)
            for left, right in steps:
                node = H(left + node + right)
            proof = H("".join(left + right for left, right in steps))
            yield str(r.doc_id), plain_leaf(r, r.text), trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]


@pytest.mark.parametrize("stored", [1, 2, 6])
def test_manifest_of_odd_rows(spark, odd, stored, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", stored)
    got = merkle.verified(odd).collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == sorted(plain_manifest(odd.collect()))
    assert {r.verified for r in got} == {True, False}


def test_manifest_of_whole_and_tiny_tables(spark, odd):
    docs = table(spark, SMALL, "documents")
    assert sorted((str(r[0]), *r[1:]) for r in merkle.verified(docs).collect()) == sorted(plain_manifest(docs.collect()))
    one = odd.where("doc_id = 1")
    (r,) = merkle.verified(one).collect()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == H("")
    assert merkle.verified(odd.limit(0)).count() == 0


def test_only_some_levels_are_stored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    docs = table(spark, SMALL, "documents").select("doc_id", merkle.F.lit("one").alias("source"), "lang", "n_chars", "text")
    manifest = merkle.build(docs, str(tmp_path / "manifest"))
    n = docs.count()
    stored = [manifest.table(f"rows/at={k}").selectExpr("sum(size(nodes))").first()[0] for k in range(manifest.rows)]
    assert stored == [n, -(-n // 9), -(-n // 81)]
    proofs = merkle.prove(manifest)
    assert proofs.where(merkle.refold() == merkle.F.col("root")).count() == n
    assert proofs.where(merkle.F.size("steps") != merkle.depth(n)).count() == 0


def plain_negatives(rows):
    kept = {}
    for r in rows:
        if None in (r.vec_id, r.label, r.embedding) or not all(x is not None and np.isfinite(x) for x in r.embedding):
            continue
        one = ((r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [int(np.floor(256 * x)) for x in r.embedding])
        kept[r.vec_id] = min(one, kept.get(r.vec_id, one))
    for a, (label, vec) in kept.items():
        if a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(vec, w, strict=True)), i, m == label) for i, (m, w) in kept.items() if i != a and len(w) == len(vec)]
        scored.sort()
        for p, i, _ in [s for s in scored if s[2]][:5]:
            far = [(n, j) for n, j, same in scored if not same and 30 * -p <= 100 * -n <= 90 * -p][:10]
            yield from ((a, i, k, j, -p, -n) for k, (n, j) in enumerate(far, 1))


def test_hard_negatives_of_a_whole_table(spark):
    vectors = table(spark, "/root/testdata/sf0.01", "embeddings")
    want = sorted(plain_negatives(vectors.collect()))
    assert len(want) > 100
    for shard_rows in (40, negatives.SHARD_ROWS):
        assert sorted(map(tuple, negatives.mine(vectors, shard_rows).collect())) == want


def test_hard_negatives_of_odd_rows(spark):
    rng = np.random.default_rng(8)
    nan, inf = float("nan"), float("inf")
    rows = [(int(k), [float(x) for x in rng.integers(-2, 3, 3)], int(rng.integers(0, 3))) for k in range(0, 600, 4)]  # many ties
    rows += [(k, [0.02 * k, 1.0, 1e-4 * k], 1) for k in range(1, 60, 4)] + [(100, [0.5, 0.25, 0.0], 1), (100, [9.0, 9.0, 9.0], 2), (7, [1.0, 1.0, 1.0], 1)]
    rows += [(200, [0.0, 0.0, 0.0], 1), (2, [0.0, 0.0, 0.0], 1), (3, None, 1), (6, [nan, 1.0, 1.0], 1), (10, [inf, 1.0, 1.0], 1), (11, [1.0, None, 1.0], 1)]
    rows += [(None, [1.0, 1.0, 1.0], 1), (14, [1.0, 1.0, 1.0], None), (15, [], 1), (700, [], 2), (18, [1.0, 2.0], 1), (800, [1.0, 1.0], 1), (19, [1.0, 0.5], 2), (22, [2.0, 1.0], 1)]
    df = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], "vec_id long, embedding array<double>, label int, width int, number int, shard string")
    want = sorted(plain_negatives(df.select("vec_id", "embedding", "label").collect()))
    assert sorted(map(tuple, negatives.mine(df, 30).collect())) == want
    assert negatives.mine(df.limit(0)).count() == 0
    huge = spark.createDataFrame([(0, [1e30], 1), (1, [1e30], 1), (2, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    assert negatives.mine(huge).count() == 0


def test_walks_stop_early():
    rng = np.random.default_rng(9)
    near = np.array([1000, 0, 0, 0]) + rng.integers(-20, 20, (50, 4))
    far = rng.integers(-300, 300, (100_000, 4))
    walk = negatives.Walk(near[:10], np.concatenate([near, far]))
    going = np.ones(10, bool)
    read = 0
    for active, piece, scores, rest in walk.pieces(going):
        read = piece.stop
        worst_found = np.sort(scores, axis=1)[:, -5]
        going[active[worst_found > rest]] = False
    assert not going.any() and read < 10_000
