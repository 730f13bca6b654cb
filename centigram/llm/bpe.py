"""BPE encoding and decoding with content-defined chunks that documents share.

A rolling hash over code points cuts every text where the last WINDOW characters say so, so
equal passages of different documents fall into equal chunks.  A chunk is encoded once: the
part between its first and its last safe place is encoded and kept, and what lies outside,
its two ragged ends, is kept as text.  A join of two chunks is repaired by encoding the end
of one with the beginning of the next; if a chunk has no safe place, the repair goes on into
the next chunk until it meets one.

A place is safe when a character that is not white space stands before a space or a line
feed.  The splitting pattern of these vocabularies has no alternative in which white space
follows another character, so a split always falls there and no merge reaches over it.
Encoding span by span between safe places therefore gives exactly the ids of the whole
text, and the tests compare every id.

Chunks are kept per Python worker, and forgotten when they pass KEEP_BYTES.
Nothing is shuffled and a lost task is only computed again.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from centigram.llm.common import batch_of, prepare, texts

#: Characters that decide on a cut, mean chunk length (a power of two), memory for chunks.
WINDOW = 16
MEAN_CHUNK = 2048
KEEP_BYTES = 96 << 20
FACTOR = np.uint32(0x9E3779B1)

SAFE = re.compile(r"(?<=\S)(?=[ \n])")
LAST_SAFE = re.compile(r"(?s).*(?<=\S)(?=[ \n])")
#: Beyond the Latin blocks, where libraries may know different versions of Unicode, the
#: reference library encodes.
FOREIGN = re.compile("[^\x00-\u024f]")
#: The splitting step that both libraries share.
PRE_TOKENIZER = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The tokenizer's alphabet for bytes: printable ones stand for themselves, the rest follow.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_alphabet() -> dict[str, int]:
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(others)}


def cut_places(text: str) -> np.ndarray:
    """Ends of the chunks but the last, by a rolling polynomial hash of WINDOW code points."""
    if len(text) <= MEAN_CHUNK:
        return np.zeros(0, np.int64)
    h = np.frombuffer(text.encode("utf-32-le"), np.uint32) * FACTOR
    h ^= h >> np.uint32(15)
    width = 1
    while width < WINDOW:  # a hash of 2w characters from two neighbouring hashes of w
        h = h[:-width] * np.uint32(pow(int(FACTOR), width, 1 << 32)) + h[width:]
        width *= 2
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    return np.flatnonzero(h >> np.uint32(32 - MEAN_CHUNK.bit_length() + 1) == 0) + WINDOW


class Encoder:
    """Ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.fast = ranked(tokenizer)
        self.chunks: dict[str, tuple[str, bytes, str] | None] = {}
        self.held = 0
        self.reused = 0
        self.encoded = 0

    def span(self, text: str) -> bytes:
        """Ids of text that begins and ends at safe places or at the ends of its document."""
        if not text:
            return b""
        if self.fast is None or FOREIGN.search(text) or any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()

    def chunk(self, text: str) -> tuple[str, bytes, str] | None:
        """(ragged head, ids of the middle, ragged tail); None without a safe place."""
        if text in self.chunks:
            self.reused += 1
            return self.chunks[text]
        self.encoded += 1
        first, last = SAFE.search(text), LAST_SAFE.match(text)
        if first is None:
            known = None
        else:
            a, b = first.start(), last.end()
            known = (text[:a], self.span(text[a:b]), text[b:])
        self.held += 300 + 2 * len(text) + len(known[1] if known else b"")
        if self.held > KEEP_BYTES:
            self.chunks.clear()
            self.held = 0
        self.chunks[text] = known
        return known

    def encode(self, text: str) -> bytes:
        parts, ragged, start = [], "", 0
        for end in [*cut_places(text).tolist(), len(text)]:
            piece = text[start:end]
            start = end
            known = self.chunk(piece)
            if known is None:
                ragged += piece
                continue
            head, middle, tail = known
            parts += (self.span(ragged + head), middle)
            ragged = tail
        parts.append(self.span(ragged))
        return b"".join(parts)


def ranked(tokenizer):
    """A faster encoder with the same merges, if merges are numbered in order, else None."""
    import tiktoken

    model = json.loads(tokenizer.to_str())
    if model["pre_tokenizer"] != PRE_TOKENIZER or model["normalizer"] or model["model"]["type"] != "BPE":
        return None
    vocab, merges = model["model"]["vocab"], model["model"]["merges"]
    joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges]
    if any(vocab[m] != 256 + k for k, m in enumerate(joined)):
        return None
    letters = byte_alphabet()
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe


class Decoder:
    """Bytes of ids by gathering from one table of all tokens."""

    def __init__(self, tokenizer) -> None:
        letters = byte_alphabet()
        special = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
        size = max([i for i in tokenizer.get_vocab(with_added_tokens=True).values()], default=-1) + 1
        table = [b""] * size
        for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
            table[i] = special[i].encode() if i in special else bytes(letters[c] for c in token)
        self.length = np.array([len(t) for t in table], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(table), np.uint8)

    def decode(self, ids: bytes) -> str:
        row = np.frombuffer(ids, "<u4").astype(np.int64)
        length = self.length[row]
        ends = np.cumsum(length)
        places = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.start[row] - ends + length, length)
        return self.flat[places].tobytes().decode("utf-8", "replace")


def tools(path: str):
    """The vocabulary file's tokenizer, without truncation and padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def worker(path: str) -> Callable[[], tuple[Encoder, Decoder]]:
    """Encoder and decoder of a Python worker, kept from task to task."""

    def get() -> tuple[Encoder, Decoder]:
        import builtins

        kept = builtins.__dict__.setdefault("_bpe_workers", {})
        if path not in kept:
            tokenizer = tools(path)
            kept[path] = (Encoder(tokenizer), Decoder(tokenizer))
        return kept[path]

    return get


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) of every whole text.

    A null text is an empty one and has no ids; repeated rows give repeated results; an empty
    table gives an empty one.
    """
    return _run(docs, path, "ids binary", lambda e, d, t: e.encode(t), ("ids",))


def encode_digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and hashes of the ids and of the text that they decode to."""

    def digest(encoder: Encoder, decoder: Decoder, text: str) -> tuple:
        ids = encoder.encode(text)
        back = decoder.decode(ids).encode()
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()

    return _run(docs, path, "n_tokens long, ids_sha256 string, decoded_sha256 string", digest, ("n_tokens", "ids_sha256", "decoded_sha256"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of a table of (doc_id, ids); null ids are none."""
    prepare(encoded.sparkSession)
    get = worker(path)
    key = encoded.schema["doc_id"].dataType.simpleString()

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = get()
        for batch in batches:
            rows = [decoder.decode(x or b"") for x in batch.column("ids").to_pylist()]
            schema = pa.schema([pa.field("doc_id", batch.column("doc_id").type), pa.field("text", pa.string())])
            yield batch_of({"doc_id": batch.column("doc_id"), "text": rows}, schema)

    return encoded.select("doc_id", "ids").mapInArrow(back, f"doc_id {key}, text string")


def _run(docs: DataFrame, path: str, columns: str, make: Callable, names: tuple[str, ...]) -> DataFrame:
    prepare(docs.sparkSession)
    get = worker(path)
    key = docs.schema["doc_id"].dataType.simpleString()
    kinds = {"ids": pa.binary(), "n_tokens": pa.int64()}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = get()
        for batch in batches:
            rows = [make(encoder, decoder, t) for t in batch.column("text").to_pylist()]
            columns = [rows] if len(names) == 1 else ([*zip(*rows, strict=True)] if rows else [()] * len(names))
            schema = pa.schema([pa.field("doc_id", batch.column("doc_id").type), *(pa.field(n, kinds.get(n, pa.string())) for n in names)])
            yield batch_of({"doc_id": batch.column("doc_id")} | dict(zip(names, columns, strict=True)), schema)

    return texts(docs).mapInArrow(each, f"doc_id {key}, {columns}")
