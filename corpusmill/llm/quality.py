"""Quality classifier: a sparse ensemble of rules, compiled into Spark column expressions.

Statistics of a whole text are columns. Shallow trees are grown over them on labelled rows; each path from a root is a rule, a
conjunction of bounds on statistics. A logistic regression with a lasso penalty weights the rules and drops most of them. What is left is
one expression over the statistics: no Python runs where documents are scored.

The labelled rows are a bounded sample, ``most_labelled`` rows with the least hashes of their ids. Labels of one id are averaged;
an even split is no label.

Rows: null texts count as empty, and empty texts get a score like any other. Labels without a row, and rows without an id, don't train.
Without labels, or with labels of one kind, all scores are the share of label 1 (0.5 without any). Repeated rows are scored alike, an empty
table gives an empty result, and columns not named in ``keep`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import check_names

#: What the rules are about. Shares are of characters unless said otherwise.
STATISTICS = ("chars", "words", "word_length", "distinct", "letters", "capitals", "digits", "odd", "exclaims", "lines", "bars", "repeats")


def statistics(text: Column) -> dict[str, Column]:
    text = F.coalesce(text.cast("string"), F.lit(""))
    chars = F.length(text)
    share = lambda n: n / F.greatest(chars, F.lit(1))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n_words = F.size(words)
    without = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    count = lambda part: chars - F.length(F.replace(text, F.lit(part)))
    return {
        "chars": F.log1p(chars.cast("double")),
        "words": F.log1p(n_words.cast("double")),
        "word_length": chars / F.greatest(n_words, F.lit(1)),
        "distinct": F.size(F.array_distinct(words)) / F.sqrt(F.greatest(n_words, F.lit(1)).cast("double")),
        "letters": share(without(r"[^\p{L}]+")),
        "capitals": share(without(r"[^\p{Lu}]+")),
        "digits": share(without(r"[^\p{N}]+")),
        "odd": share(without(r"[\p{L}\p{N}\s.,;:!?'\"()\-|]+")),
        "exclaims": share(count("!")),
        "lines": share(count("\n")),
        "bars": share(count("|")),
        "repeats": share(chars - without(r"(?<!\S)(\S++)(?=\s++\1(?!\S))")),
    }


#: (statistic, above) -> bound; a rule holds if every statistic is above, or else not above, its bound
Rule = tuple[tuple[int, bool, float], ...]


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...] = ()
    weights: tuple[float, ...] = ()

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for rule, w in zip(self.rules, self.weights, strict=True):
            z += w * holds(rule, x)
        return 1 / (1 + np.exp(-z))

    def column(self, stats: dict[str, Column]) -> Column:
        z = F.lit(self.intercept)
        for rule, w in zip(self.rules, self.weights, strict=True):
            met = F.lit(True)
            for f, above, bound in rule:
                met = met & ((stats[STATISTICS[f]] > bound) if above else (stats[STATISTICS[f]] <= bound))
            z = z + F.when(met, F.lit(w)).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    met = np.ones(len(x), bool)
    for f, above, bound in rule:
        met &= (x[:, f] > bound) == above
    return met


def tree_paths(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, least: int) -> list[Rule]:
    """Every path from the root of one tree, grown by Gini gain on a bootstrap and on some of the statistics at each node."""
    rows = rng.integers(0, len(y), len(y))
    bounds = []
    for f in range(x.shape[1]):
        v = np.unique(np.quantile(x[:, f], np.linspace(0.005, 0.995, 80)))
        bounds.append((v[1:] + v[:-1]) / 2)
    out: list[Rule] = []

    def grow(at: np.ndarray, path: Rule) -> None:
        if len(path) == depth or len(at) < 2 * least or y[at].min() == y[at].max():
            return
        best = (1e-9, -1, 0.0)
        ys = y[at].astype(float)
        total, pos = len(at), ys.sum()
        before = pos * (total - pos) / total
        for f in rng.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False):
            if not len(bounds[f]):
                continue
            bins = np.searchsorted(bounds[f], x[at, f], side="left")
            n = np.cumsum(np.bincount(bins, minlength=len(bounds[f]) + 1))[:-1]
            p = np.cumsum(np.bincount(bins, ys, len(bounds[f]) + 1))[:-1]
            fits = (n >= least) & (total - n >= least)
            with np.errstate(divide="ignore", invalid="ignore"):
                after = p * (n - p) / n + (pos - p) * (total - n - pos + p) / (total - n)
            gain = np.where(fits, before - after, -1)
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), f, bounds[f][gain.argmax()])
        if best[1] < 0:
            return
        for above in (False, True):
            step = (*path, (int(best[1]), above, float(best[2])))
            out.append(tuple(sorted(step)))
            grow(at[(x[at, best[1]] > best[2]) == above], step)

    grow(rows, ())
    return out


def lasso_logistic(a: np.ndarray, y: np.ndarray, penalty: float, rounds: int) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient steps; the intercept isn't penalised."""
    n, m = a.shape
    full = np.hstack([np.ones((n, 1), np.float64), a])
    v = np.ones(m + 1)
    for _ in range(30):  # largest eigenvalue
        v = full.T @ (full @ v)
        v /= np.linalg.norm(v)
    step = 4 * n / (np.linalg.norm(full @ v) ** 2)
    w, ahead, t = np.zeros(m + 1), np.zeros(m + 1), 1.0
    for _ in range(rounds):
        g = full.T @ (1 / (1 + np.exp(-(full @ ahead))) - y) / n
        new = ahead - step * g
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = new + (last - 1) / t * (new - w)
        w = new
    return float(w[0]), w[1:]


def fit_rules(x: np.ndarray, y: np.ndarray, *, trees: int = 40, depth: int = 3, penalty: float = 0.0005, rounds: int = 600, least: int = 5, seed: int = 11) -> RuleModel:
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
        return RuleModel(float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    rules = sorted({r for _ in range(trees) for r in tree_paths(x, y, rng, depth, least)})
    columns, chosen, seen = [], [], set()
    for rule in rules:  # rules that hold on the same rows are one
        met = holds(rule, x)
        if (key := met.tobytes()) not in seen and 0 < met.sum() < len(y):
            seen.add(key)
            columns.append(met)
            chosen.append(rule)
    if not chosen:
        return fit_rules(x[:0], y[:0])
    a = np.array(columns, np.float64).T
    intercept, weights = lasso_logistic(a, y.astype(float), penalty, rounds)
    kept = [i for i in range(len(chosen)) if abs(weights[i]) > 1e-6]
    return RuleModel(intercept, tuple(chosen[i] for i in kept), tuple(float(weights[i]) for i in kept))


def held_out(doc_id: Column) -> Column:
    """Whether the label of this id is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, *, label: str, text: str, doc_id: str, most_labelled: int) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of the sample, at most ``most_labelled`` rows of a few numbers each."""
    known = labels.select(F.col(doc_id).cast("long").alias("__id"), F.col(label).cast("double").alias("y")).where("__id IS NOT NULL AND y IS NOT NULL").where(~held_out(F.col("__id")))
    known = known.groupBy("__id").agg(F.avg("y").alias("y")).where("y <> 0.5")
    known = known.orderBy(F.xxhash64("__id"), "__id").limit(most_labelled)
    texts = docs.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("__text")).join(F.broadcast(known), "__id")
    stats = statistics(F.col("__text"))
    rows = texts.select("__id", "y", *[stats[s].cast("double").alias(s) for s in STATISTICS]).orderBy("__id", *STATISTICS).limit(most_labelled).collect()
    return np.array([[r[s] for s in STATISTICS] for r in rows], float).reshape(-1, len(STATISTICS)), np.array([r["y"] > 0.5 for r in rows], bool)


def fit_quality(docs: DataFrame, labels: DataFrame, *, label: str = "quality", text: str = "text", doc_id: str = "doc_id", most_labelled: int = 12_000) -> RuleModel:
    return fit_rules(*labelled(docs, labels, label=label, text=text, doc_id=doc_id, most_labelled=most_labelled))


def score_quality(df: DataFrame, model: RuleModel, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, none of them named score, and ``score``, the probability of label 1."""
    check_names(keep, ("score",))
    stats = statistics(F.col(text))
    rows = df.select(*[F.col(k).alias(f"__keep{i}") for i, k in enumerate(keep)], *[stats[s].cast("double").alias(f"__{s}") for s in STATISTICS])
    score = model.column({s: F.col(f"__{s}") for s in STATISTICS})
    return rows.select(*[F.col(f"__keep{i}").alias(k) for i, k in enumerate(keep)], score.alias("score"))
