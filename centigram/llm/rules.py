"""Quality rules: a decision list learned by sequential covering.

Rules reject.  Each is a conjunction of threshold conditions on text statistics, grown on one
part of the labelled rows by information gain, pruned on the other, and added to the list
while it stays precise there.  The rows it covers are then set aside.  The list becomes one
ordered CASE expression, evaluated by Spark over every document.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from centigram.llm import labels as L
from centigram.llm.common import cut
from centigram.llm.stats import COUNTS, RATIOS, named, text_stats

#: Labelled rows that the learner may read.
TRAIN_ROWS = 30_000
MAX_RULES = 24
MAX_CONDITIONS = 4
CUTS = 48
#: A rule must be this precise on both parts, and cover so many bad rows.
PRECISION = 0.9
LEAST_COVER = 2
#: Fixed values of the contract's base rules.
LEAST_WORDS = 50
REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    value: float

    def holds(self, x: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
        v = x[:, names.index(self.name)]
        return v > self.value if self.above else v <= self.value

    def expression(self) -> Column:
        c, v = F.col(self.name), F.lit(self.value)
        return c > v if self.above else c <= v

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.value:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
    mask = np.ones(len(x), bool)
    for c in rule:
        mask &= c.holds(x, names)
    return mask


def cut_points(v: np.ndarray) -> np.ndarray:
    """Midpoints between neighbouring values at the column's quantiles."""
    u = np.unique(v)
    if len(u) < 2:
        return u[:0]
    mids = (u[1:] + u[:-1]) / 2
    if len(mids) <= CUTS:
        return mids
    return np.unique(np.concatenate([mids[np.linspace(0, len(mids) - 1, CUTS // 2).astype(int)], np.quantile(v, np.linspace(0.01, 0.99, CUTS // 2))]))


def grow(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...]) -> Rule:
    """Conditions added while each gains information about bad rows."""
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS and bad.any() and not bad.all():
        base = np.log2(bad.mean())
        best, best_gain = None, 1e-9
        for j, name in enumerate(names):
            points = cut_points(x[:, j])
            if not len(points):
                continue
            over = x[:, j][None, :] > points[:, None]
            for above, mask in ((True, over), (False, ~over)):
                hits = (mask & bad).sum(axis=1)
                total = mask.sum(axis=1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(hits >= LEAST_COVER, hits * (np.log2(hits / np.maximum(total, 1)) - base), 0)
                k = int(np.argmax(gain))
                if gain[k] > best_gain:
                    best, best_gain = Condition(name, above, float(points[k])), float(gain[k])
        if best is None:
            break
        rule += (best,)
        kept = best.holds(x, names)
        x, bad = x[kept], bad[kept]
    return rule


def worth(rule: Rule, x: np.ndarray, bad: np.ndarray, names: tuple[str, ...]) -> float:
    hit = covers(rule, x, names)
    return (float((hit & bad).sum()) - float((hit & ~bad).sum())) / max(1, int(hit.sum()))


def prune(rule: Rule, x: np.ndarray, bad: np.ndarray, names: tuple[str, ...]) -> Rule:
    """The shortest beginning of the rule that is worth as much on held-back rows."""
    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k], x, bad, names) >= worth(best, x, bad, names):
            best = rule[:k]
    return best


def learn(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...], seed: int = 3) -> list[Rule]:
    """Rules in order.  Rows of one label only teach nothing: the list is then empty."""
    rules: list[Rule] = []
    part = np.random.default_rng(seed).random(len(x)) < 0.67
    while len(rules) < MAX_RULES and bad[part].any():
        grown = grow(x[part], bad[part], names)
        if not grown:
            break
        rule = prune(grown, x[~part], bad[~part], names)
        if not precise(rule, x, bad, names):
            rule = grown
        if not precise(rule, x, bad, names):
            break
        rules.append(rule)
        left = ~covers(rule, x, names)
        x, bad, part = x[left], bad[left], part[left]
    return rules


def precise(rule: Rule, x: np.ndarray, bad: np.ndarray, names: tuple[str, ...]) -> bool:
    hit = covers(rule, x, names)
    return int((hit & bad).sum()) >= LEAST_COVER and bool(bad[hit].mean() >= PRECISION)


def expression(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; 0 if none does."""
    first = F.lit(0)
    for k in range(len(rules), 0, -1):
        both = reduce(lambda a, b: a & b, (c.expression() for c in rules[k - 1]))
        first = F.when(both, F.lit(k)).otherwise(first)
    return first


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, the contract's counts, base_failed, kept and the number of the rejecting rule.

    Null and empty texts have no words and fail the base rules; repeated rows give repeated
    results; with no usable label the list is empty and the base rules decide alone; an empty
    table gives an empty result.
    """
    stats = cut(named(text_stats(docs)).withColumn("base_failed", base_failed()))
    known = L.sample(stats.select("doc_id", *RATIOS), L.one_label(labels, "quality"), rows)
    rules = learn(known[list(RATIOS)].to_numpy(float), known["label"].to_numpy(int) == 0, RATIOS)
    return stats.withColumn("rule", expression(rules)).select(
        "doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("rule") == 0)).alias("kept"), "rule"
    )
