"""Personal data: exact patterns plus a character BiLSTM-CRF trained from labelled spans.

The patterns find the base spans, which always stay and are the labels.  The model learns from
them as they stand, from the same spans in writings that the patterns cannot read (labelled by
how they were made), and from numbers that are none.  It reads character classes in overlapping
windows; emissions of overlapping windows are blended by how central a character is, and one
Viterbi pass per run of windows reconciles them.  A span must hold a digit or an at sign, so
windows without either cannot hold one and are not read.  A decoded span grows to the ends of the
numbers (of the words, for an e-mail) that it cuts and by the base spans of its kind that it meets.
It is added if it has the digits or signs that its kind needs and meets no base span, or those of
its kind only and adds letters or digits to them; it may hold pattern matches that failed.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centigram.llm.common import batch_of, prepare, texts

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)
WINDOW, STRIDE = 64, 32
WIDTH, EMBED = 20, 10
#: Documents and windows that the fit may read, steps and rows a step.
TRAIN_DOCS, TRAIN_WINDOWS, STEPS, BATCH = 20_000, 8_192, 500, 64

#: Fixed values of the contract, written so that they match the same text in linear time.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
EMAIL = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SIGN = re.compile("[0-9@]")
DIGIT = re.compile("[0-9]")
#: Between the numbers of an added ip: a dot, in brackets or with blanks, or the word.
DOT = re.compile(r" ?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)|\.) ?", re.I)
#: What the training puts between the numbers of an ip and the groups of a card.
IP_DOTS = ("[.]", "(.)", "[dot]", "(dot)", " . ", " [.] ")
CARD_GAPS = (".", "/", "  ", " / ", "_", " - ", ". ")
Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: from each at sign back over its local part, no further than the last match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        found = EMAIL.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def candidates(text: str) -> tuple[list[Span], list[Span]]:
    """Pattern matches that pass and that fail, as (start, kind, end)."""
    passed: list[Span] = []
    failed: list[Span] = []
    if "@" in text:
        passed += ((s, 0, e) for s, e in emails(text))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            (passed if all(map(small, m[0].split("."))) else failed).append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            d = digits_of(m[0])
            (passed if 14 <= len(d) <= 19 and luhn(d) else failed).append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                (passed if 10 <= len(digits_of(m[0])) <= 15 else failed).append((m.start(), 3, m.end()))
    return sorted(passed), failed


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def character_classes() -> np.ndarray:
    """Class of each code point below 256; all above share the last class."""
    table = np.full(257, 1, np.uint8)
    for low, high, k in (("0", "9", 2), ("a", "z", 3), ("A", "Z", 4)):
        table[ord(low) : ord(high) + 1] = k
    for k, c in enumerate("@.-_+%()\n\t ,:/[]'", 5):
        table[ord(c)] = k
    table[192:257] = 3
    return table


CLASS = character_classes()
CLASSES = int(CLASS.max()) + 1


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return CLASS[np.minimum(points, 256)]


def runs(text: str) -> list[tuple[int, int]]:
    """Runs of windows, as ranges of strides, that hold a digit or an at sign."""
    ks = {k for m in SIGN.finditer(text) for k in (m.start() // STRIDE - 1, m.start() // STRIDE)}
    out: list[list[int]] = []
    for k in sorted(ks - {-1}):
        if out and k == out[-1][1] + 1:
            out[-1][1] = k
        else:
            out.append([k, k])
    return [(a, b) for a, b in out]


def padded(row: np.ndarray, start: int) -> np.ndarray:
    piece = row[start : start + WINDOW]
    return np.pad(piece, (0, WINDOW - len(piece))) if len(piece) < WINDOW else piece


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def initial(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    scaled = lambda *s: (rng.normal(0, 1 / np.sqrt(s[0]), s)).astype(np.float32)
    p = {"embed": scaled(CLASSES, EMBED) * 2, "out": scaled(2 * WIDTH, TAGS), "bias": np.zeros(TAGS, np.float32), "trans": np.zeros((TAGS, TAGS), np.float32)}
    for d in ("f", "b"):
        p |= {f"x{d}": scaled(EMBED, 4 * WIDTH), f"h{d}": scaled(WIDTH, 4 * WIDTH), f"c{d}": np.repeat(np.float32([0, 1, 0, 0]), WIDTH)}
    return p


def read(p: dict[str, np.ndarray], d: str, x: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Hidden states over time (T, rows, WIDTH) of one direction; gates are in, forget, out, cell."""
    steps, rows, _ = x.shape
    h = c = np.zeros((rows, WIDTH), np.float32)
    out = np.empty((steps, rows, WIDTH), np.float32)
    drive = x @ p[f"x{d}"] + p[f"c{d}"]
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        z = drive[t] + h @ p[f"h{d}"]
        gates, new = sigmoid(z[:, : 3 * WIDTH]), np.tanh(z[:, 3 * WIDTH :])
        i, f, o = gates[:, :WIDTH], gates[:, WIDTH : 2 * WIDTH], gates[:, 2 * WIDTH :]
        before, last = c, h
        c = f * c + i * new
        squashed = np.tanh(c)
        h = o * squashed
        out[t] = h
        if keep is not None:
            keep.append((t, i, f, o, new, before, squashed, last))
    return out


def unread(p: dict[str, np.ndarray], d: str, x: np.ndarray, keep: list, g: np.ndarray, slope: dict[str, np.ndarray]) -> np.ndarray:
    """Back through time; adds to slope and returns the gradient of x."""
    gx = np.zeros_like(x)
    gh = gc = np.zeros((x.shape[1], WIDTH), np.float32)
    for t, i, f, o, new, before, squashed, last in reversed(keep):
        gh = gh + g[t]
        gc = gc + gh * o * (1 - squashed**2)
        gz = np.hstack([gc * new * i * (1 - i), gc * before * f * (1 - f), gh * squashed * o * (1 - o), gc * i * (1 - new**2)])
        slope[f"h{d}"] += last.T @ gz
        slope[f"x{d}"] += x[t].T @ gz
        slope[f"c{d}"] += gz.sum(axis=0)
        gx[t] = gz @ p[f"x{d}"].T
        gh, gc = gz @ p[f"h{d}"].T, gc * f
    return gx


def emissions(p: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """(rows, WINDOW, TAGS) tag scores of windows of character classes."""
    x = p["embed"][rows.T]
    both = np.concatenate([read(p, "f", x), read(p, "b", x)], axis=2)
    return (both @ p["out"] + p["bias"]).transpose(1, 0, 2)


def learn(rows: np.ndarray, tags: np.ndarray, steps: int = STEPS, seed: int = 9) -> dict[str, np.ndarray]:
    """Adam on the negative log likelihood of the tag paths under the CRF."""
    p = initial()
    if not len(rows):
        p["bias"][0] = 10
        return p
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    rng = np.random.default_rng(seed)
    for step in range(1, steps + 1):
        take = rng.integers(0, len(rows), BATCH)
        slope = gradient(p, rows[take], tags[take])
        rate = 0.03 * (1 - 0.9 * step / steps)
        for k in p:
            first[k] = 0.9 * first[k] + 0.1 * slope[k]
            second[k] = 0.99 * second[k] + 0.01 * slope[k] ** 2
            p[k] = p[k] - np.float32(rate) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
    return {k: v.astype(np.float32) for k, v in p.items()}


def gradient(p: dict[str, np.ndarray], rows: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
    n, steps = rows.shape
    x = p["embed"][rows.T]
    kept: dict[str, list] = {"f": [], "b": []}
    hidden = np.concatenate([read(p, "f", x, kept["f"]), read(p, "b", x, kept["b"])], axis=2)
    e = hidden @ p["out"] + p["bias"]
    ahead, behind = np.empty_like(e), np.empty_like(e)
    ahead[0], behind[-1] = e[0], 0
    for t in range(1, steps):
        ahead[t] = e[t] + logsumexp(ahead[t - 1][:, :, None] + p["trans"], 1)
    for t in range(steps - 2, -1, -1):
        behind[t] = logsumexp(p["trans"][None] + (e[t + 1] + behind[t + 1])[:, None, :], 2)
    z = logsumexp(ahead[-1], 1)
    ge = np.exp(ahead + behind - z[None, :, None])
    pair = np.exp(ahead[:-1, :, :, None] + p["trans"] + (e[1:] + behind[1:])[:, :, None, :] - z[None, :, None, None])
    slope = {k: np.zeros_like(v) for k, v in p.items()}
    slope["trans"] = pair.sum(axis=(0, 1))
    np.add.at(slope["trans"], (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
    ge[np.arange(steps)[:, None], np.arange(n)[None, :], tags.T] -= 1
    slope["out"] = np.einsum("tnh,tnk->hk", hidden, ge)
    slope["bias"] = ge.sum(axis=(0, 1))
    gh = ge @ p["out"].T
    gx = unread(p, "f", x, kept["f"], gh[:, :, :WIDTH], slope) + unread(p, "b", x, kept["b"], gh[:, :, WIDTH:], slope)
    np.add.at(slope["embed"], rows.T, gx)
    return {k: v / n for k, v in slope.items()}


def best_paths(p: dict[str, np.ndarray], blended: list[np.ndarray]) -> list[np.ndarray]:
    """Viterbi over runs of any length; runs of like length go together."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(blended)
    order = sorted(range(len(blended)), key=lambda k: -len(blended[k]))
    for at in range(0, len(order), 256):
        group = order[at : at + 256]
        steps = len(blended[group[0]])
        lengths = np.array([len(blended[k]) for k in group])
        e = np.zeros((steps, len(group), TAGS), np.float32)
        for j, k in enumerate(group):
            e[: lengths[j], j] = blended[k]
        back = np.zeros((steps, len(group), TAGS), np.uint8)
        score = e[0].copy()
        for t in range(1, steps):
            live = int((lengths > t).sum())
            options = score[:live, :, None] + p["trans"]
            back[t, :live] = options.argmax(axis=1)
            score[:live] = options.max(axis=1) + e[t, :live]
        for j, k in enumerate(group):
            path = np.empty(lengths[j], np.int64)
            path[-1] = score[j].argmax()
            for t in range(lengths[j] - 1, 0, -1):
                path[t - 1] = back[t, j, path[t]]
            out[k] = path
    return out


#: A character's weight in a window: how far it is from the window's ends.
CENTRAL = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)).astype(np.float32)[:, None]


def decoded(p: dict[str, np.ndarray], rows: list[str]) -> list[list[Span]]:
    """Spans that the model finds in each text, reconciled over all windows."""
    places = [(j, a, b) for j, text in enumerate(rows) for a, b in runs(text)]
    classes = {j: codes(rows[j]) for j, _, _ in places}
    spans: list[list[Span]] = [[] for _ in rows]
    for chunk in chunks_of(places, 2_000):
        windows = [(j, k) for j, a, b in chunk for k in range(a, b + 1)]
        x = np.stack([padded(classes[j], k * STRIDE) for j, k in windows])
        e = np.concatenate([emissions(p, x[i : i + 512]) for i in range(0, len(x), 512)])
        blended, at = [], 0
        for j, a, b in chunk:
            length = (b - a) * STRIDE + WINDOW
            total, weight = np.zeros((length, TAGS), np.float32), np.zeros((length, 1), np.float32)
            for k in range(b - a + 1):
                total[k * STRIDE : k * STRIDE + WINDOW] += e[at] * CENTRAL
                weight[k * STRIDE : k * STRIDE + WINDOW] += CENTRAL
                at += 1
            blended.append((total / weight)[: len(classes[j]) - a * STRIDE])
        for (j, a, _), path in zip(chunk, best_paths(p, blended), strict=True):
            spans[j] += ((s + a * STRIDE, k, t + a * STRIDE) for s, k, t in tagged(path))
    return spans


def chunks_of(places: list, windows: int) -> Iterator[list]:
    """Consecutive places with about so many windows; a single long run is a chunk."""
    part, size = [], 0
    for place in places:
        part.append(place)
        size += place[2] - place[1] + 1
        if size >= windows:
            yield part
            part, size = [], 0
    if part:
        yield part


def tagged(path: np.ndarray) -> Iterator[Span]:
    start, kind = 0, -1
    for t, tag in enumerate([*path.tolist(), 0]):
        begins, now = tag % 2 == 1, (tag - 1) // 2 if tag else -1
        if kind >= 0 and (now != kind or begins):
            yield start, kind, t
            kind = -1
        if now >= 0 and kind < 0:
            start, kind = t, now


def plausible(kind: int, piece: str) -> bool:
    n = len(digits_of(piece))
    if kind == 0:
        return "@" in piece[1:-1] and "." in piece and not re.search(r"\s", piece)
    if kind == 1:
        return address(piece)
    if kind == 2:
        return 14 <= n <= 19 and luhn(digits_of(piece)) and not re.search("[A-Za-z]", piece)
    grouped = piece.startswith(("+", "00")) or len(re.findall("[0-9]+", piece)) > 2
    return 10 <= n <= 15 and grouped and not re.search(r"[^0-9+ ().\-]", piece)


def address(piece: str) -> bool:
    """Four numbers up to 255 in any dotted writing, or a version 6 address that holds a digit."""
    if ":" in piece:
        try:
            ipaddress.IPv6Address(piece)
        except ValueError:
            return False
        return bool(DIGIT.search(piece))
    parts = DOT.split(piece)
    return len(parts) == 4 and all(re.fullmatch("[0-9]+", x) and small(x) for x in parts)


def wider(text: str, span: Span, base: Span) -> bool:
    """Whether a span holds a base span of its kind and letters or digits beyond it."""
    s, k, e = span
    b, j, t = base
    if j != k or not s <= b <= t <= e:
        return False
    beyond = text[s:b] + text[t:e]
    if k == 0 and re.search(r"[@,;:<>()\[\]\"=/|\\]", beyond):
        return False
    return any(x.isalnum() for x in beyond)


def completed(text: str, s: int, e: int, kind: int) -> tuple[int, int]:
    """The span moved out to the ends of the numbers, or of an e-mail's words, that it cuts."""
    inside = str.isalnum if kind == 0 else DIGIT.match
    while 0 < s < e and inside(text[s - 1]) and inside(text[s]):
        s -= 1
    while s < e < len(text) and inside(text[e - 1]) and inside(text[e]):
        e += 1
    return s, e


def find(p: dict[str, np.ndarray], rows: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, added spans) of each text."""
    out = []
    for text, own in zip(rows, decoded(p, rows), strict=True):
        base, _ = candidates(text)
        added: list[Span] = []
        for s, k, e in own:
            while s < e and text[s].isspace():
                s += 1
            while e > s and (text[e - 1].isspace() or text[e - 1] in ",;:"):
                e -= 1
            s, e = completed(text, s, e, k)
            for b, j, t in base:
                if j == k and s < t and b < e:
                    s, e = min(s, b), max(e, t)
            clash = any(s < t and b < e and not wider(text, (s, k, e), (b, j, t)) for b, j, t in base)
            if s < e and not clash and plausible(k, text[s:e]):
                added.append((s, k, e))
        out.append((base, added))
    return out


def writings(kind: int, piece: str) -> Iterator[tuple[str, int]]:
    """Other texts for a base span, each with how many of its first characters are the span."""
    d = digits_of(piece)
    if kind == 0:
        name, host = piece.split("@", 1)
        plain = re.sub("[^A-Za-z]", "", name) or "x"
        forms = []
        for who, where in ((name, host), (plain, ".".join(host.split(".")[-2:])), (plain[:3], re.sub("[0-9]", "", host))):
            half = -(-len(who) // 2)
            forms += [f"{who}@{where}", *(f"{who[:half]}{x}{who[half:]}@{where}" for x in "üñ'")]
            forms += [f"{who}@{where[:1]}ö{where[1:]}", f"{who}@{where.replace('.', '[.]')}"]
    elif kind == 1:
        parts = piece.split(".")
        a, b, c, e = (f"{int(x):x}" for x in parts)
        forms = [x.join(parts) for x in IP_DOTS]
        forms += [f"2001:db8:{a}:{b}::{c}{e}", f"2001:db8::{a}", f"fe80::{a}{b}:{c}ff:fe{e}:{a}", f"{a}20:{b}:{c}:{e}:{a}{b}:{c}:{e}{a}:{b}{c}"]
    elif kind == 2:
        groups = [d[at : at + 4] for at in range(0, len(d), 4)]
        forms = [x.join(groups) for x in CARD_GAPS]
        for x in " -":
            yield from ((f"{x.join(groups)} {after}", len(x.join(groups))) for after in (f"{d[:2]}/{d[2:4]}", d[:3]))
    else:
        land, area, middle, last = d[:-10] or "1", d[-10:-7], d[-7:-4], d[-4:]
        forms = [f"({area}) {middle}-{last}", f"{area}-{middle}-{last}", f"{area}.{middle}.{last}"]
        for x in (land, d[1:3], d[2:5]):
            number = f"{x} {area} {middle} {last}"
            forms.append(f"00{number}")
            yield from ((f"+{number} {after}", len(number) + 1) for after in (f"20{d[2:8]}", d[:6]))
    yield from ((x, len(x)) for x in forms)
    if kind > 1:
        yield f"20{d[:2]}-{d[2:4]}-{d[4:6]} {d[6:8]}:{d[8:10]}", 0
        yield f"{d[:1]},{d[1:4]},{d[4:7]}.{d[7:9]}", 0
        yield d[:9], 0
        yield f"{d[0]}.{d[1]}.{d[2:4]}", 0
        yield f"{d[:4]}-{d[4:8]}", 0


def labelled(text: str) -> list[tuple[bytes, bytes]]:
    """Classes and tags of the windows of a text, and of its base spans written otherwise."""
    places = runs(text)
    if not places:
        return []
    base, _ = candidates(text)
    tags = np.zeros(len(text) + WINDOW, np.uint8)
    for s, k, e in base:
        tags[s:e] = 2 + 2 * k
        tags[s] = 1 + 2 * k
    row = codes(text)
    out = [(padded(row, w * STRIDE).tobytes(), tags[w * STRIDE : w * STRIDE + WINDOW].tobytes()) for a, b in places for w in range(a, b + 1)]
    for s, k, e in base:
        if e - s > WINDOW:
            continue
        for form, length in writings(k, text[s:e]):
            before = max(0, s - 1 - zlib.crc32(form.encode()) % STRIDE)
            after = min(len(text), e + WINDOW)
            made = np.zeros(len(form), np.uint8)
            made[:length] = 2 + 2 * k
            made[: min(length, 1)] = 1 + 2 * k
            given = np.concatenate([tags[before:s], made, tags[e:after]])
            out.append((padded(codes(text[before:s] + form + text[e:after]), 0).tobytes(), padded(given, 0).tobytes()))
    return out


def training_windows(docs: DataFrame, limit_docs: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes and tags of windows from a hash sample of about limit_docs documents."""
    step = max(1, docs.count() // limit_docs)
    sampled = texts(docs).where(F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(step)) == 0)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(dict.fromkeys(row for text in batch.column("text").to_pylist() for row in labelled(text)))
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], ["x", "y"])

    found = sampled.mapInArrow(label, "x binary, y binary").orderBy(F.xxhash64("x", "y"), "x", "y").limit(limit).toPandas()
    shape = (len(found), WINDOW)
    make = lambda c: np.frombuffer(b"".join(map(bytes, found[c])), np.uint8).reshape(shape).astype(np.int64)
    return make("x"), make("y")


def fit(docs: DataFrame, limit_docs: int = TRAIN_DOCS, limit: int = TRAIN_WINDOWS) -> dict[str, np.ndarray]:
    """The model's parameters; without any window to learn from, one that finds nothing."""
    return learn(*training_windows(docs, limit_docs, limit))


def _each(docs: DataFrame, columns: dict[str, pa.DataType], make: Callable[[str, list[Span], list[Span]], tuple], passed: tuple[str, ...]) -> DataFrame:
    prepare(docs.sparkSession)
    p = fit(docs)
    kept = docs.select(*(F.col(f"`{c}`") for c in passed), F.coalesce("text", F.lit("")).alias("__text"))
    kinds = {"string": pa.string(), "long": pa.int64()}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("__text").to_pylist()
            made = [make(t, b, a) for t, (b, a) in zip(rows, find(p, rows), strict=True)]
            values = [*zip(*made, strict=True)] if made else [()] * len(columns)
            fields: dict[str, Any] = {c: batch.column(c) for c in passed} | dict(zip(columns, values, strict=True))
            schema = pa.schema([pa.field(c, batch.column(c).type) for c in passed] + [pa.field(c, kinds[k]) for c, k in columns.items()])
            yield batch_of(fields, schema)

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in passed] + [f"`{c}` {k}" for c, k in columns.items()])
    return kept.mapInArrow(each, schema)


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, base counts by kind, base_sha256, all spans of every whole text and their number.

    A null text is an empty one and has no spans; repeated rows give repeated results; an
    empty table gives an empty one.
    """

    def make(text: str, base: list[Span], added: list[Span]) -> tuple:
        n = [sum(k == j for _, k, _ in base) for j in range(len(KINDS))]
        return (*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added), len(base) + len(added))

    columns = {f"n_{k}": "long" for k in KINDS} | {"base_sha256": "string", "spans": "string", "n_spans": "long"}
    return _each(docs, columns, make, ("doc_id",))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets.

    Overlapping spans become one, named by the first.  A null text becomes an empty one.
    n_chars follows the text; other columns stay.
    """

    def make(text: str, base: list[Span], added: list[Span]) -> tuple:
        parts, done = [], 0
        for s, k, e in sorted(base + added):
            if s >= done:
                parts += (text[done:s], f"<{KINDS[k].upper()}>")
            done = max(done, e)
        clean = "".join(parts) + text[done:]
        return (clean, len(clean))

    passed = tuple(c for c in docs.columns if c not in ("text", "n_chars"))
    columns = {"text": "string"} | ({"n_chars": "long"} if "n_chars" in docs.columns else {})
    return _each(docs, columns, make, passed).select(*(F.col(f"`{c}`") for c in docs.columns))
