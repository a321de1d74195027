"""Quality classifier: a sparse ensemble of rules over text statistics, scored by Spark columns."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name

#: Labelled rows that the driver fits on, at most; picked by a hash of their ids.
MOST_ROWS = 20_000
TREES = 40
DEPTH = 3
THRESHOLD = 0.3

#: A condition is (statistic, is at most?, bound); a rule is some of them together.
Condition = tuple[str, bool, float]
Rule = tuple[Condition, ...]


def _share(text: Column, unwanted: str) -> Column:
    """Share of the characters that are left when those of the class are taken out."""
    return F.length(F.regexp_replace(text, unwanted, "")) / F.greatest(F.length(text), F.lit(1))


def statistics(text: Column) -> dict[str, Column]:
    """Numbers about a whole text; a null or empty one has none of anything (all 0)."""
    t = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(t, r"\s+"), "")
    lines = F.array_remove(F.split(t, r"\n+"), "")
    n_words, n_lines = F.size(words), F.size(lines)
    some = F.greatest(n_words, F.lit(1))
    return {
        "letters": _share(t, r"\P{L}+"),
        "capitals": _share(t, r"\P{Lu}+"),
        "digits": _share(t, r"[^0-9]+"),
        "blanks": _share(t, r"\S+"),
        "stops": _share(t, r"[^.,;:]+"),
        "calls": _share(t, r"[^!?]+"),
        "signs": _share(t, r"[\p{L}\p{N}\s.,;:!?'\"-]+"),
        "words": F.log1p(n_words.cast("double")),
        "word_length": F.length(t) / some,
        "new_words": F.size(F.array_distinct(words)) / some,
        "words_a_line": F.log1p(n_words / F.greatest(n_lines, F.lit(1))),
        "new_lines": F.size(F.array_distinct(lines)) / F.greatest(n_lines, F.lit(1)),
    }


def with_statistics(docs: DataFrame, text: str, into: str) -> DataFrame:
    """The statistics as one struct column, computed once per row whatever reads them."""
    columns = statistics(F.col(text))
    named = {f"{into}_{k}": v.cast("double") for k, v in columns.items()}
    held = docs.withColumns(named)
    struct = F.struct(*[F.col(f"{into}_{k}").alias(k) for k in columns])
    return held.withColumn(into, F.explode(F.array(struct))).drop(*named)


# -- trees and rules -------------------------------------------------------------------------


def _tree(x: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, weight: np.ndarray,
          names: list[str], depth: int, least: int) -> tuple[list[Rule], np.ndarray]:
    """A regression tree on gradients: the paths to all its nodes, and the value it gives each row."""
    rules: list[Rule] = []
    value = np.zeros(len(x))

    def grow(rows: np.ndarray, path: Rule) -> None:
        g, h = slope[rows].sum(), weight[rows].sum()
        value[rows] = g / (h + 1.0)
        if len(path) == depth:
            return
        best = (1e-6, None, None)
        for j, bounds in enumerate(cuts):
            if not len(bounds):
                continue
            bin_ = np.searchsorted(bounds, x[rows, j], side="left")
            gs = np.cumsum(np.bincount(bin_, slope[rows], len(bounds) + 1))[:-1]
            hs = np.cumsum(np.bincount(bin_, weight[rows], len(bounds) + 1))[:-1]
            ns = np.cumsum(np.bincount(bin_, minlength=len(bounds) + 1))[:-1]
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            gain[(ns < least) | (len(rows) - ns < least)] = 0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = gain[k], j, bounds[k]
        _, j, bound = best
        if j is None:
            return
        low = x[rows, j] <= bound
        for side, at_most in ((rows[low], True), (rows[~low], False)):
            longer = (*path, (names[j], at_most, float(bound)))
            rules.append(longer)
            grow(side, longer)

    grow(np.arange(len(x)), ())
    return rules, value


def holds(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for name, at_most, bound in rule:
        column = x[:, names.index(name)]
        out &= (column <= bound) if at_most else (column > bound)
    return out


def tree_rules(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = TREES,
               depth: int = DEPTH, rate: float = 0.3) -> list[Rule]:
    """Distinct rules of boosted trees, each grown on a random half of the rows (fixed seed)."""
    random = np.random.default_rng(7)
    cuts = [np.unique(np.quantile(c, np.linspace(0.01, 0.99, 50)))[:-1] for c in x.T]
    margin, rules = np.zeros(len(y)), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        mask = random.random(len(y)) < 0.5
        weight = np.where(mask, np.maximum(p * (1 - p), 1e-6), 0)
        found, value = _tree(
            x, cuts, np.where(mask, y - p, 0), weight, names, depth, max(5, len(y) // 500)
        )
        margin += rate * np.clip(value, -4, 4)
        rules.update(dict.fromkeys(found))
    return list(rules)


def lasso(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic weights under an L1 penalty (intercept free), by accelerated proximal steps.

    ``r`` may be truth values, which take an eighth of the room; numbers are made of some columns at a time.
    """
    n, k = r.shape
    a, mean, scale = np.ones((n, k + 1)), np.zeros(k), np.zeros(k)
    for some in np.array_split(np.arange(k), max(1, k // 32)):
        here = slice(some[0], some[-1] + 1) if len(some) else slice(0)
        part = r[:, here].astype(float)
        mean[here], scale[here] = part.mean(axis=0), np.maximum(part.std(axis=0), 1e-3)
        a[:, 1:][:, here] = (part - mean[here]) / scale[here]
    step = 4 * n / (np.linalg.norm(a, 2) ** 2 + 1e-9)
    w = z = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ z, -30, 30)))
        moved = z - step * (a.T @ (p - y) / n)
        moved[1:] = np.sign(moved[1:]) * np.maximum(np.abs(moved[1:]) - step * penalty, 0)
        faster = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = moved + (t - 1) / faster * (moved - w)
        w, t = moved, faster
    weights = w[1:] / scale
    return float(w[0] - weights @ mean), weights


@dataclass
class RuleModel:
    """A logistic model whose inputs are rules; ``score`` compiles it into a Spark column."""

    intercept: float
    weights: dict[Rule, float]

    def margin(self, stats: Column) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights.items():
            every = F.lit(True)
            for name, at_most, bound in rule:
                value = stats[name]
                every = every & ((value <= bound) if at_most else (value > bound))
            total = total + F.when(every, F.lit(weight)).otherwise(F.lit(0.0))
        return total

    def score(self, stats: Column) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin(stats)))

    def scores(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        margin = np.full(len(x), self.intercept)
        for rule, weight in self.weights.items():
            margin += weight * holds(rule, x, names)
        return 1 / (1 + np.exp(-margin))


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str]) -> RuleModel:
    """Rules of trees, weighted by a lasso whose penalty does best on a fifth left out.

    Without rows, or with one class only, the score is that class's share, drawn towards a half.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    if len(y) < 50 or share * (len(y) + 2) < 6 or (1 - share) * (len(y) + 2) < 6:
        return RuleModel(float(np.log(share / (1 - share))), {})
    rules = tree_rules(x, y, names)
    r = np.column_stack([holds(rule, x, names) for rule in rules])
    out = np.arange(len(y)) % 5 == 4
    best = (np.inf, 0.01)
    for penalty in (0.03, 0.01, 0.003, 0.001):
        b, w = lasso(r[~out], y[~out], penalty, steps=150)
        p = np.clip(1 / (1 + np.exp(-(b + r[out] @ w))), 1e-6, 1 - 1e-6)
        loss = -np.mean(y[out] * np.log(p) + (1 - y[out]) * np.log(1 - p))
        best = min(best, (loss, penalty))
    b, w = lasso(r, y, best[1])
    return RuleModel(b, {rule: float(v) for rule, v in zip(rules, w, strict=True) if abs(v) > 1e-4})


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    label: str = "quality", most_rows: int = MOST_ROWS,
) -> RuleModel:
    """Fit on at most ``most_rows`` labelled documents, picked by a hash of their ids.

    Null labels and ids are left out.  The picked ids are few and are broadcast; only the picked
    documents' statistics reach the driver, one row for each label: of documents that share an id,
    those of the least.
    """
    picked = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
        .select(F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id", "_y").limit(most_rows)
    )
    held = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(
        F.broadcast(picked), "_id"
    )
    names = list(statistics(F.lit("")))
    one = with_statistics(held, "_text", "_stats").groupBy("_id", "_y").agg(F.min("_stats").alias("_stats"))
    rows = one.select("_id", "_y", "_stats.*").toPandas()
    rows = rows.sort_values(["_id", "_y", *names], kind="stable")
    return fit_rules(rows[names].to_numpy(float), rows["_y"].to_numpy(float), names)


def score(
    docs: DataFrame, model: RuleModel, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The documents with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Every text gets a score, empty and null ones that of a text without words.  Columns of these
    names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    stats = free_name(docs, "stats")
    scored = with_statistics(docs.select(*kept), text, stats)
    return scored.withColumn("score", model.score(F.col(stats))).withColumn(
        "predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)
    ).drop(stats)
