"""Quality classifier: Bradley-Terry ranking of documents by pairwise preferences.

Each document has a score linear in its text statistics.  A labelled good document beats a
labelled bad one; the chance of that is the logistic function of their difference in score,
and the weights maximise the likelihood of the preferences.  The threshold is the quantile of
the training scores at the share of bad documents, and the reported score is the chance that
the document beats a document on the threshold.

All labelled rows and all pairs of them count.  A Newton step needs of the pairs only sums that
follow from each label's rows by score, so every task adds its rows' counts, first and second
moments up in narrow bins of the score, and the driver gets a table of fixed size a step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centigram.llm import labels as L
from centigram.llm.common import cut, fold
from centigram.llm.stats import RATIOS, named, text_stats
from centigram.operators.quantiles import exact_quantiles

#: Ridge penalty, Newton steps at most, bins of the score at most and the least width of one.
RIDGE = 1e-3
STEPS = 25
BINS = 2048
WIDTH = 0.1
#: Labelled rows that one task adds up: few enough that TASKS share a small table, else many.
FEW_ROWS, MANY_ROWS, TASKS = 2_000, 100_000, 32
CLIP = 6.0


@dataclass(frozen=True)
class Ranker:
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    threshold: float

    def total(self, prefix: str = "") -> Column:
        """The score before it is made a chance, less the threshold."""
        total = F.lit(-self.threshold)
        for name, c, s, w in zip(RATIOS, self.centre, self.scale, self.weights[: len(RATIOS)], strict=True):
            total = total + clipped(name, c, s, prefix) * F.lit(w)
        for name, c, s, w in zip(RATIOS, self.centre, self.scale, self.weights[len(RATIOS) :], strict=True):
            total = total + clipped(name, c, s, prefix) * clipped(name, c, s, prefix) * F.lit(w)
        return total

    def score(self, prefix: str = "") -> Column:
        """0 to 1, and 0.5 on the threshold."""
        bounded = F.least(F.greatest(self.total(prefix), F.lit(-30.0)), F.lit(30.0))
        return 1 / (1 + F.exp(-bounded))


def clipped(name: str, centre: float, scale: float, prefix: str = "") -> Column:
    return F.least(F.greatest((F.col(prefix + name) - F.lit(centre)) / F.lit(scale), F.lit(-CLIP)), F.lit(CLIP))


def design(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - centre) / scale, -CLIP, CLIP)
    return np.hstack([z, z * z])


def lone(bad: int, fine: int) -> Ranker | None:
    """Without both labels there is no preference: every document then scores 0.5 if nothing is
    known, above 0.5 if all known ones are good, below if all are bad."""
    if bad and fine:
        return None
    width = len(RATIOS)
    return Ranker((0.0,) * width, (1.0,) * width, (0.0,) * 2 * width, -1.0 if fine else 1.0 if bad else 0.0)


def binned(z: np.ndarray, good: np.ndarray, w: np.ndarray, width: float) -> dict[tuple[int, int], np.ndarray]:
    """(label, bin of the score): rows, sum of scores, sum of z, upper half of the sum of z z'."""
    score = z @ w
    place = np.clip(np.floor(score / width), -BINS // 2, BINS // 2 - 1).astype(np.int64)
    upper = np.triu_indices(z.shape[1])
    out = {}
    for label in (0, 1):
        mine = np.flatnonzero(good == label)
        mine = mine[np.argsort(place[mine], kind="stable")]
        start = np.flatnonzero(np.diff(place[mine], prepend=-BINS))
        for rows in np.split(mine, start[1:]) if len(mine) else ():
            y = z[rows]
            out[label, int(place[rows[0]])] = np.concatenate([[len(rows), score[rows].sum()], y.sum(axis=0), (y.T @ y)[upper]])
    return out


def newton(sums: Callable[[np.ndarray, float], dict[tuple[int, int], np.ndarray]], size: int) -> np.ndarray:
    """Weights that maximise the likelihood of all preferences, from binned sums at given weights.

    Rows of a bin count with their mean score.  A step that makes the loss greater is halved.
    """
    upper = np.triu_indices(size)

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        # No z exceeds CLIP, no z * z its square, so the bins reach all scores.
        reach = np.abs(w[: size // 2]).sum() * CLIP + np.abs(w[size // 2 :]).sum() * CLIP * CLIP
        table = sums(w, max(WIDTH, 2 * reach / BINS))
        side = []
        for label in (0, 1):
            rows = np.array([v for (of, _), v in sorted(table.items()) if of == label])
            square = np.zeros((len(rows), size, size))
            square[:, upper[0], upper[1]] = rows[:, 2 + size :]
            square = square + square.transpose(0, 2, 1) * (1 - np.eye(size))
            side.append((rows[:, 0], rows[:, 1] / rows[:, 0], rows[:, 2 : 2 + size], square))
        (n0, s0, z0, q0), (n1, s1, z1, q1) = side
        pairs = n0.sum() * n1.sum()
        ahead = s1[:, None] - s0
        p = 1 / (1 + np.exp(np.clip(ahead, -30, 30)))
        loss = n1 @ np.logaddexp(0, -ahead) @ n0 / pairs + RIDGE / 2 * (w @ w)
        gradient = -((p @ n0) @ z1 - (n1 @ p) @ z0) / pairs + RIDGE * w
        v = p * (1 - p)
        both = z1.T @ v @ z0
        hessian = np.tensordot(v @ n0, q1, 1) + np.tensordot(n1 @ v, q0, 1) - both - both.T
        return loss, gradient, hessian / pairs + RIDGE * np.eye(size)

    w = np.zeros(size)
    loss, gradient, hessian = at(w)
    for _ in range(STEPS):
        step, part = np.linalg.solve(hessian, gradient), 1.0
        after = at(w - step)
        while after[0] > loss + 1e-4 and part > 1e-2:
            part /= 2
            after = at(w - part * step)
        if after[0] > loss:
            break
        w, gain = w - part * step, loss - after[0]
        loss, gradient, hessian = after
        if gain < 1e-7:
            break
    return w


def around(share: float) -> tuple[float, float]:
    return max(0.0, share - 0.002), min(1.0, share + 0.002)


def fit(x: np.ndarray, good: np.ndarray) -> Ranker:
    """The ranker of rows in memory; `learned` does the same with rows of a table."""
    bad, fine = int((good == 0).sum()), int((good == 1).sum())
    if none := lone(bad, fine):
        return none
    centre, scale = x[good == 1].mean(axis=0), np.maximum(x[good == 1].std(axis=0), 1e-3)
    z = design(x, centre, scale)
    w = newton(lambda w, width: binned(z, good, w, width), z.shape[1])
    low, high = np.quantile(z @ w, around(bad / len(good)))
    return Ranker(tuple(centre.tolist()), tuple(scale.tolist()), tuple(w.tolist()), float((low + high) / 2))


def learned(stats: DataFrame, labels: DataFrame) -> Ranker:
    """Fit on all labelled documents that are not held out."""
    rows = stats.where("NOT held_out AND doc_id IS NOT NULL").select("doc_id", *RATIOS).dropDuplicates(["doc_id"])
    known = cut(rows.join(L.one_label(labels, "quality"), "doc_id").select("label", *RATIOS))
    moments = [f(F.when(F.col("label") == 1, F.col(c))) for f in (F.avg, F.stddev_pop) for c in RATIOS]
    rows, fine, *moments = known.agg(F.count("label"), F.count_if(F.col("label") == 1), *moments).first()
    if none := lone(rows - fine, fine):
        return none
    # Every task sends a row per bin, so tasks without many rows would send more than they read.
    known = known.coalesce(max(-(-rows // MANY_ROWS), min(TASKS, -(-rows // FEW_ROWS))))
    centre, scale = np.array(moments[: len(RATIOS)]), np.maximum(moments[len(RATIOS) :], 1e-3)
    size = 2 * len(RATIOS)

    def sums(w: np.ndarray, width: float) -> dict[tuple[int, int], np.ndarray]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in RATIOS])
                for k, v in binned(design(x, centre, scale), batch.column("label").to_numpy(zero_copy_only=False), w, width).items():
                    held[k] = held[k] + v if k in held else v
            if held:
                keys = np.array(list(held))
                yield pa.record_batch([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array([v.tobytes() for v in held.values()], pa.binary())], ["label", "bin", "sums"])

        def total(key: tuple, table: pa.Table) -> pa.Table:
            added = sum(np.frombuffer(v, np.float64) for v in table.column("sums").to_pylist())
            return pa.table({"label": [key[0].as_py()], "bin": [key[1].as_py()], "sums": pa.array([added.tobytes()], pa.binary())})

        schema = "label long, bin long, sums binary"
        found = known.mapInArrow(add, schema).groupBy("label", "bin").applyInArrow(total, schema)
        return {(r["label"], r["bin"]): np.frombuffer(bytes(r["sums"]), np.float64) for r in found.collect()}  # 2 * BINS rows at most

    w = newton(sums, size)
    plain = Ranker(tuple(centre.tolist()), tuple(scale.tolist()), tuple(w.tolist()), 0.0)
    marks = exact_quantiles(known.select(plain.total().alias("total")), around((rows - fine) / rows), ["total"]).first()["quantiles"]
    return Ranker(plain.centre, plain.scale, plain.weights, sum(marks) / 2)


def measured(docs: DataFrame) -> DataFrame:
    return cut(named(text_stats(docs)).withColumn("held_out", fold("doc_id", 3) == 1))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Documents whose crc32(doc_id) modulo 3 is 1 are held out of training.  Null and empty
    texts have zero statistics and a score like any other; a null doc_id is scored but never
    trained on; repeated rows give repeated results; an empty table gives an empty one.
    Neither lang, source nor doc_id enters a score.
    """
    stats = measured(docs)
    return stats.select("doc_id", "held_out", learned(stats, labels).score().alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score of at least 0.5, as they are."""
    ranker = learned(measured(docs), labels)
    kept = text_stats(docs, tuple(docs.columns)).where(ranker.score("__") >= 0.5)
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
